"""Document quality by Naive Bayes support vectors.

A document is the set of its n-grams (bytes in twos and threes, words in ones and twos, and for 2, 4 and 8
words the pattern "all the same word"), hashed into 2**FEATURE_BITS indicators. Each indicator is scaled by the log ratio of its smoothed frequencies in the two
classes, the vector is brought to unit length, and a linear hinge-loss model is fitted on the scaled vectors by
dual coordinate descent. The score is the logistic function of twice the margin, so 0.5 is the decision border.

The model is fitted on a bounded sample: of each class the ``per_class`` labelled documents with the smallest hash
of their id, and of those at most SAMPLE_BYTES of features. Scoring reads every whole text in one narrow pass.

Defined cases: NULL and empty texts are the empty set, scored by the bias; documents with contradicting labels
are not learned from; repeated rows are scored each, and learned from once; without rows of both classes every
score is 0.5; an empty table gives an empty table; further columns stay as they are (the score columns replace
columns of the same name).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.words import find_words, release, run_hashes, run_starts, slices, word_hashes

FEATURE_BITS = 18
#: bytes of feature indices of one class the driver takes to fit
SAMPLE_BYTES = 32 << 20


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(buf: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The indices of the n-grams present in each document, ascending."""
    shift = np.uint64(64 - FEATURE_BITS)
    words = find_words(buf, offsets)
    hashes = word_hashes(words)
    singles = (run_hashes(hashes, 1, 11) >> shift).astype(np.int64)
    at = run_starts(words, 2)
    pairs = (run_hashes(hashes, 2, 12) >> shift).astype(np.int64)[at]
    pair_ends = np.searchsorted(at, words.first)
    twice = np.zeros(len(hashes), bool)  # the word equals the one before it in its document
    twice[1:] = hashes[1:] == hashes[:-1]
    twice[words.first[:-1][words.counts > 0]] = False
    four = twice.copy()
    for back in (1, 2):
        four[back:] &= twice[:-back]
        four[:back] = False
    eight = four.copy()
    eight[4:] &= four[:-4]
    eight[:4] = False
    wide = buf.astype(np.uint32)
    twos = wide[:-1] << 8 | wide[1:]
    threes = twos[:-1] << 8 | wide[2:]
    scatter = lambda x, odd: (x * np.uint32(odd)) >> np.uint32(32 - FEATURE_BITS)
    twos, threes = scatter(twos, 0x9E3779B1), scatter(threes, 0x85EBCA77)
    present = np.zeros(1 << FEATURE_BITS, bool)
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        present[twos[a:max(a, b - 1)]] = True
        present[threes[a:max(a, b - 2)]] = True
        present[singles[words.first[d]:words.first[d + 1]]] = True
        present[pairs[pair_ends[d]:pair_ends[d + 1]]] = True
        for slot, run in ((1, twice), (2, four), (3, eight)):
            if run[words.first[d]:words.first[d + 1]].any():
                present[slot] = True
        found = np.flatnonzero(present)
        present[found] = False
        yield found


@dataclass
class Model:
    """Weight and squared scale of every indicator, and the bias."""

    weight: np.ndarray
    square: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        norm = float(self.square[found].sum()) ** 0.5
        margin = (float(self.weight[found].sum()) / norm if norm else 0.0) + self.bias
        return float(1 / (1 + np.exp(-min(max(2 * margin, -500.0), 500.0))))


def fit(rows: list[np.ndarray], good: np.ndarray, share: float, cost: float = 1.0, rounds: int = 30, seed: int = 7) -> Model:
    """Scale by log-count ratios, then fit the hinge loss by dual coordinate descent.

    ``share`` is the part of all labelled documents that are good; it weighs the classes of the sample.
    """
    size = 1 << FEATURE_BITS
    if not len(rows) or good.all() or not good.any():
        return Model(np.zeros(size, np.float32), np.ones(size, np.float32), 0.0)
    counts = {True: np.ones(size), False: np.ones(size)}
    for found, label in zip(rows, good.tolist()):
        counts[label][found] += 1
    ratio = np.log(counts[True] / (good.sum() + 2)) - np.log(counts[False] / ((~good).sum() + 2))
    square = ratio * ratio
    norms = [float(square[found].sum()) ** 0.5 or 1.0 for found in rows]
    y = np.where(good, 1.0, -1.0)
    upper = np.where(good, cost * share * len(y) / good.sum(), cost * (1 - share) * len(y) / (~good).sum())
    weight, bias, alpha = np.zeros(size), 0.0, np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)).tolist():
            found, norm = rows[i], norms[i]
            gradient = y[i] * (float(weight[found].sum()) / norm + bias) - 1
            new = min(max(alpha[i] - gradient / 2, 0.0), upper[i])  # a unit vector and the bias feature: the diagonal is 2
            step = (new - alpha[i]) * y[i]
            if step:
                # weight holds the model in unscaled indicators times the scale: one factor of the ratio twice
                weight[found] += step / norm * square[found]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return Model(weight.astype(np.float32), square.astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, per_class: int, seed: int) -> Model:
    """Fit on the bounded sample of the labelled documents outside the held-out third."""
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("high")).where("y = high").drop("high")
    )
    rank = F.xxhash64(F.col("id").cast("string"), F.lit(seed))
    chosen = [known.where(F.col("y") == y).orderBy(rank, "id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(chosen[0].union(chosen[1]))  # at most 2 * per_class rows
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(ids, "id")
    rows = rows.groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text"))  # of several texts the smallest, whatever the order of rows

    sets = rows.select(F.col("y").cast("int"), "text", rank.alias("rank"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in slices(batch.column(1)):
                found = [x.astype(np.int32).tobytes() for x in features(buf, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(found, pa.binary())], names=["y", "rank", "found"])

    taken: dict[int, list[np.ndarray]] = {0: [], 1: []}
    room = {0: SAMPLE_BYTES, 1: SAMPLE_BYTES}
    for row in sets.mapInArrow(keyed, "y int, rank long, found binary").orderBy("rank").toLocalIterator():
        room[row.y] -= len(row.found)
        if room[row.y] >= 0 or not taken[row.y]:
            taken[row.y].append(np.frombuffer(row.found, np.int32))
    totals = dict(known.groupBy(F.col("y").cast("int")).count().collect())
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    return fit(taken[0] + taken[1], np.array([False] * len(taken[0]) + [True] * len(taken[1]), bool), share)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                   per_class: int = 3000, seed: int = 7) -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to ``docs``; the model is fitted while the plan is built."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text, label, per_class, seed))
    release()  # the driver, of the sample
    added = [T.StructField("score", T.DoubleType(), False)]
    new = {"score", "predicted", "held_out"}
    source = docs.columns.index(text)
    keep = [i for i, c in enumerate(docs.columns) if c.lower() not in new]
    schema = T.StructType([docs.schema[i] for i in keep] + added)
    positions = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in slices(batch.column(source)):
                scores = [model.value.score(found) for found in features(buf, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column(k).slice(i, j - i) for k in keep] + [pa.array(scores, pa.float64())], names=schema.fieldNames())

    scored = positions.mapInArrow(run, schema)
    return scored.withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "held_out": held_out(F.col(doc_id))})
