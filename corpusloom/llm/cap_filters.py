"""Near copies among embeddings of one label by spherical-cap filters.

Vectors link when their labels are equal and their cosine in double precision reaches ``least``.

1. Equal vectors of a label are one point with a multiplicity from here on.
2. *Filters.* A random rotation is followed by a product code: the axes are cut into three blocks, each block has its own
   random codebook, and a filter direction is one codeword per block. There are DIRECTIONS directions for each point, so
   books grow with the cube root of the points and buckets keep their size. A point is list-decoded to all directions whose caps contain
   it: those with a cosine of at least a threshold, at which a random point has PER_POINT of them on average. A point in
   fewer than AT_LEAST caps is decoded with wider ones. Decoding keeps a partial codeword only if the best of
   the blocks to come can lift it over the threshold, so it never looks at all directions.
3. *Join.* Points meet in the buckets (label, filter) they share. Buckets of one point drop out, large ones are cut into a grid of
   cells of bounded size.
4. *Verify.* Inside a cell all cosines are computed exactly. A pair counts in the smallest filter both were decoded to,
   so once. Cells give counts per point and a spanning forest of their links, never lists of pairs.

The filters are an index: every row is indexed; recall against brute force is measured in the tests, also with the codes that
tables of up to 10^9 points get (over 0.99 for a cosine of 0.98). Vectors of few components get smaller books, as narrower caps would
part linked vectors; their buckets grow with the table.

Defined cases: NULL vectors, zero vectors, vectors with NULL or non-finite components and NULL labels link with nothing
(0 links, their own component, kept); vectors of different lengths never link; rows that repeat an id are
vectors of their own; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.session import pin

#: filter directions for each point, and at least
DIRECTIONS = 8
LEAST_DIRECTIONS = 4_096
#: caps a point lies in on average, and at least
PER_POINT = 20
AT_LEAST = 12
#: axes from which on the code has three blocks; below, one book of at most LOW_BOOK directions covers the sphere
BLOCKS = 3
LOW_AXES = 6
LOW_BOOK = 4_096
#: caps stay wider than linked vectors are apart by this much of cosine; vectors of few components get smaller books for it
MARGIN = 0.1
#: points of one side of a cell
CELL = 256
#: filters of a cell's points that are compared at a time
COLUMNS = 2_048


def read_vectors(df: DataFrame) -> DataFrame:
    """(id, label, v): the components as doubles in one binary, NULL for vectors that link with nothing."""
    id_type, label_type = (df.schema[i].dataType.simpleString() for i in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            for value in batch.column(2):
                x = None
                if value.is_valid and len(value) and not value.values.null_count:
                    x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    x = None if not np.isfinite(x).all() or not x.any() else x + 0.0  # -0.0 becomes 0.0
                out.append(None if x is None else x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "v"])

    return df.mapInArrow(run, f"id {id_type}, label {label_type}, v binary")


def unit_rows(raw: list[bytes]) -> np.ndarray:
    """Vectors of one length scaled to unit length in double precision."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class ProductCode:
    """The filter directions for vectors of one length among ``points`` points that link from a cosine of ``least``."""

    def __init__(self, size: int, points: int, least: float, seed: int):
        rng = np.random.default_rng([seed, size, points])
        directions = max(LEAST_DIRECTIONS, DIRECTIONS * points)
        blocks = BLOCKS if size >= LOW_AXES else 1
        self.book = int(np.ceil(directions ** (1 / blocks)))
        self.rotation, _ = np.linalg.qr(rng.standard_normal((size, size)))
        self.cuts = np.array_split(np.arange(size), blocks)
        trial = rng.standard_normal((64, size))
        trial /= np.linalg.norm(trial, axis=1, keepdims=True)
        if blocks == 1:
            self.book = min(self.book, LOW_BOOK)
        while True:
            self.books = []
            for axes in self.cuts:
                book = rng.standard_normal((self.book, len(axes)))
                self.books.append(book / np.linalg.norm(book, axis=1, keepdims=True) / np.sqrt(blocks))
            self.threshold = self._balanced(trial)
            if self.threshold <= least - MARGIN or self.book <= 4:
                break
            self.book = self.book * 3 // 4  # so many caps would be too narrow for linked vectors to share

    def _balanced(self, trial: np.ndarray) -> float:
        """The threshold at which the rows lie in PER_POINT caps on average."""
        scores = self._scores(trial)
        threshold = float(sum(x[0].max(axis=1) for x in scores).mean())
        while threshold > 0 and len(self._exceeding(scores, threshold)[0]) < PER_POINT * len(trial):
            threshold -= 0.05 / np.sqrt(trial.shape[1])
        return threshold

    def _scores(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per block the scores of its codewords, descending, and their numbers."""
        turned = unit @ self.rotation
        out = []
        for axes, book in zip(self.cuts, self.books):
            score = turned[:, axes] @ book.T
            order = np.argsort(-score, axis=1)
            out.append((np.take_along_axis(score, order, axis=1), order))
        return out

    def _exceeding(self, scores: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all directions that reach ``threshold``."""
        n = len(scores[0][0])
        row, name, total = np.arange(n), np.zeros(n, np.int64), np.zeros(n)
        for k, (score, order) in enumerate(scores):
            to_come = sum((x[0][:, 0] for x in scores[k + 1:]), np.zeros(n))
            # codewords are sorted, so those that suffice are the first ones: one search among the scores of all rows
            reach = 4.0 * np.arange(n)
            ascending = (reach[:, None] - score).ravel()
            fit = np.searchsorted(ascending, reach[row] - (threshold - total - to_come[row]), side="right")
            fit = np.clip(fit - row * self.book, 0, self.book)
            which = np.arange(fit.sum()) - np.repeat(np.cumsum(fit) - fit, fit)
            row, name, total = np.repeat(row, fit), np.repeat(name, fit), np.repeat(total, fit)
            total = total + score[row, which]
            name = name * self.book + order[row, which]
        return row, name

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Per row all filters whose caps contain it, ascending."""
        scores = self._scores(unit)
        out: list[np.ndarray] = [None] * len(unit)
        todo, threshold = np.arange(len(unit)), self.threshold
        while len(todo):
            row, name = self._exceeding([(x[todo], order[todo]) for x, order in scores], threshold)
            order = np.lexsort((name, row))
            count = np.bincount(row, minlength=len(todo))
            ends = np.cumsum(count)
            enough = (count >= AT_LEAST) | (threshold <= 0)
            for k in np.flatnonzero(enough).tolist():
                out[todo[k]] = name[order[ends[k] - count[k]:ends[k]]]
            todo, threshold = todo[~enough], threshold - 0.2 / np.sqrt(unit.shape[1])
        return out


def _decode_points(points: DataFrame, size_of: int, least: float, seed: int) -> DataFrame:
    """Add the array ``filters`` to the rows (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, ProductCode] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                raw = part.column(1).to_pylist()
                sizes = np.array([len(x) // 8 for x in raw])
                filters: list[np.ndarray] = [None] * len(raw)
                for size in set(sizes.tolist()):
                    rows = np.flatnonzero(sizes == size)
                    if size not in codes:
                        codes[size] = ProductCode(size, size_of, least, seed)
                    for k, found in zip(rows.tolist(), codes[size].decode(unit_rows([raw[k] for k in rows.tolist()]))):
                        filters[k] = found
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(filters, pa.list_(pa.int64()))], names=["u", "v", "filters"])

    return points.mapInArrow(run, "u long, v binary, filters array<long>")


def _meet_below(rows: list[tuple], a: np.ndarray, b: np.ndarray, f: int) -> np.ndarray:
    """Whether two rows, of those in ``a`` and ``b``, share a filter below ``f``: then that one's cell counts them."""
    used = np.union1d(a, b).tolist()
    below = [np.array(rows[k][3], np.int64) for k in used]
    below = [x[x < f] for x in below]
    name = np.concatenate([*below, np.zeros(0, np.int64)])
    row = np.repeat(np.array(used, np.int64), [len(x) for x in below])
    _, column, held = np.unique(name, return_inverse=True, return_counts=True)
    meet = np.zeros((len(rows), len(rows)), bool)
    for low in range(0, len(held), COLUMNS):
        some = (column >= low) & (column < low + COLUMNS) & (held[column] > 1)
        has = np.zeros((len(rows), min(COLUMNS, len(held) - low)), np.float32)
        has[row[some], column[some] - low] = 1
        meet |= has @ has.T > 0
    return meet


def _compare(index: list[tuple], query: list[tuple], f: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, number of vectors linked, point of its component in this cell) of a cell; no query: index against itself."""
    rows = index + query
    u = np.array([r[0] for r in rows], np.int64)
    weight = np.array([r[1] for r in rows], np.int64)
    n = len(index)
    linked = np.zeros((len(rows), len(rows)), bool)
    sizes = np.array([len(r[2]) for r in rows])
    for size in set(sizes.tolist()):
        same = np.flatnonzero(sizes == size)
        unit = unit_rows([rows[k][2] for k in same.tolist()])
        linked[np.ix_(same, same)] = unit @ unit.T >= least
    np.fill_diagonal(linked, False)
    if query:
        linked[:n, :n] = linked[n:, n:] = False
    a, b = np.nonzero(np.triu(linked))
    first = ~_meet_below(rows, a, b, f)[a, b]
    a, b = a[first], b[first]
    count = np.bincount(a, weight[b], len(rows)).astype(np.int64) + np.bincount(b, weight[a], len(rows)).astype(np.int64)
    label = np.arange(len(rows))
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = count > 0
    return u[some], count[some], u[label[some]]


def near_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                 least: float = 0.98, seed: int = 5, size_of: int | None = None) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``df``.

    ``size_of`` is the number of points that the code is made for, by default that of the different vectors.

    Runs jobs while it is built; their results lie in the shared folder (``spark.checkpoint.dir``).
    """
    named = df.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v"))
    alive = F.col("v").isNotNull() & F.col("label").isNotNull()
    rows = pin(read_vectors(named).withColumn("u", F.when(alive, F.xxhash64("label", "v"))).withColumn("v", F.when(alive, F.col("v"))))
    points = pin(rows.where("u is not null").groupBy("u", "label", "v").agg(F.count("*").alias("m")))
    coded = pin(_decode_points(points.select("u", "v"), size_of or points.count(), least, seed).join(points.select("u", "label", "m"), "u"))

    hits = coded.select("u", "label", F.explode("filters").alias("f"))
    buckets = pin(
        hits.groupBy("label", "f").agg(F.count("*").alias("n")).where("n > 1")
        .select("label", "f", F.ceil(F.col("n") / CELL).cast("int").alias("parts"))
    )
    placed = hits.join(buckets, ["label", "f"]).withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int"))
    cells = placed.select(
        "u", "label", "f",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(
            F.least(k, "part").alias("i"), F.greatest(k, "part").alias("j"), (k < F.col("part")).cast("int").alias("role")))).alias("cell"),
    ).select("u", "label", "f", "cell.*")
    grid = cells.join(coded.select("u", "m", "v", "filters"), "u").select("label", "f", "i", "j", "role", "u", "m", "v", "filters")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, sides = None, ([], [])

        def done() -> pa.RecordBatch:
            index, query = sides
            empty = np.zeros(0, np.int64)
            out = (empty, empty, empty)
            if cell is not None and (len(index) > 1 and cell[2] == cell[3] or index and query):
                out = _compare(index, query, cell[1], least)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["u", "n", "root"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(9)]
            for lab, f, i, j, role, u, m, v, filters in zip(*columns):
                if (lab, f, i, j) != cell:
                    if cell is not None:
                        yield done()
                    cell, sides = (lab, f, i, j), ([], [])
                sides[role].append((u, m, v, filters))
        if cell is not None:
            yield done()

    dealt = grid.repartition("label", "f", "i", "j").sortWithinPartitions("label", "f", "i", "j")
    found = pin(dealt.mapInArrow(run, "u long, n long, root long"))
    links = found.groupBy("u").agg(F.sum("n").alias("n"))
    whole = components(found.select(F.col("u").alias("a"), F.col("root").alias("b")))
    known = pin(
        points.select("u", "m").join(links, "u", "left").join(whole.withColumnRenamed("id", "u"), "u", "left")
        .select("u", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "u").alias("c"))
    )
    judged = pin(rows.select("id", "u").join(known, "u", "left").select("id", "n_links", "c"))
    least_id = pin(judged.where("c is not null").groupBy("c").agg(F.min("id").alias("component_id")))
    component = F.coalesce("component_id", "id")
    return judged.join(least_id, "c", "left").select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
