"""Removal of passages of ``k`` words that an earlier document also has, with Aho-Corasick automata.

A window is ``k`` consecutive words of one document. A word goes if it lies in a window whose words also
stand in a document with a smaller id. The result is exact for all windows of all documents, yet only a
part of them is shuffled:

1. *Anchors.* Equal windows have the same smallest hash among the runs of ANCHOR words inside them. Only the
   runs that are the smallest of some window (about two in ten) go to a first shuffle; a window whose anchor
   occurs in one document only is unique. Documents with equal words are one text from here on: every copy but
   the first is removed whole.
2. *Confirm.* The windows at recurring anchors are shuffled by their hash (64 bits, and 24 of a second hash) and
   streamed in the order of the documents; occurrences behind the first document are to go.
3. *Automata.* Consecutive such windows of a document form passages. Documents are dealt into shards of bounded size; the
   passages of a shard are compiled into Aho-Corasick automata (pyahocorasick) of bounded size, and every document
   of the shard is streamed through them to locate every occurrence.

Each document belongs to one shard and each shard holds its own documents' passages only, so the work stays in
proportion to the input.

Defined cases: NULL and blank texts have no words and nothing is removed; documents with fewer than ``k`` words keep all;
rows that repeat an id are judged by that id (they never remove each other's words); rows with a NULL id are
left alone and hide nothing; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.ngram_join import recurring
from corpusloom.llm.words import Words, find_words, run_hashes, run_starts, slices, small_batches, word_hashes
from corpusloom.session import pin

#: words of an anchor
ANCHOR = 6
#: ids that may be broadcast; beyond that they are joined
BROADCAST_IDS = 500_000
#: bytes of text worked on at a time, and bytes of passages compiled into one automaton: some tens of MB in a worker
SLICE = 256 << 10
AUTOMATON_BYTES = 256 << 10
#: text ids a task remembers so as to give a text once
SEEN = 200_000
#: words of one pattern; longer passages are cut with an overlap of a window
PATTERN_WORDS = 200


def joined(words: Words) -> list[bytes]:
    """The words of every document joined by single blanks."""
    buf = words.buf
    keep = np.zeros(len(buf) + 1, np.int32)
    np.add.at(keep, words.start, 1)
    np.add.at(keep, words.end, -1)
    keep = np.cumsum(keep)[:-1].astype(bool)
    out = buf.copy()
    blank = words.end[words.end < len(buf)]
    blank = blank[~keep[blank]]
    out[blank] = 32
    keep[blank] = True
    ends = np.concatenate([[0], np.cumsum(keep)])
    packed = out[keep].tobytes()
    n = words.first
    last = np.maximum(n[1:] - 1, 0)
    some = np.diff(n) > 0
    first_byte = ends[words.start[np.minimum(n[:-1], max(len(words.start) - 1, 0))]] if len(words.start) else np.zeros(len(last), int)
    last_byte = ends[words.end[np.minimum(last, max(len(words.start) - 1, 0))]] if len(words.start) else np.zeros(len(last), int)
    return [packed[a:b] if ok else b"" for a, b, ok in zip(first_byte.tolist(), last_byte.tolist(), some.tolist())]


def _window_anchors(words: Words, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start words of all windows, anchor hash of each)."""
    starts = run_starts(words, k)
    width = k - ANCHOR + 1
    low = run_hashes(hashes, ANCHOR, 77)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        low = np.minimum(low[:len(low) - step], low[step:])
        reach += step
    return starts, low[starts]


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for i, j, buf, offsets in slices(batch.column(text), SLICE):
            yield batch.slice(i, j - i), find_words(buf, offsets)


def scan(texts: DataFrame) -> DataFrame:
    """Per row (id, text, further columns) its text id ``s``, number of words, digests of its joined words and of the text itself,
    and the further columns."""
    id_type = texts.schema[0].dataType.simpleString()
    more = T.StructType(texts.schema.fields[2:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, buf, offsets in slices(batch.column(1), SLICE):
                words = find_words(buf, offsets)
                digests = [hashlib.sha256(x) for x in joined(words)]
                raw = [hashlib.sha256(buf[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(map(_text_id, digests), pa.int64()), pa.array(words.counts),
                     pa.array([d.hexdigest() for d in digests], pa.string()), pa.array(raw, pa.string())]
                    + [batch.column(c).slice(i, j - i) for c in range(2, batch.num_columns)],
                    names=["id", "s", "n", "sha", "raw", *more.names])

    own = T.StructType.fromDDL(f"id {id_type}, s long, n long, sha string, raw string")
    return texts.mapInArrow(run, T.StructType(own.fields + more.fields))


def _text_id(digest) -> int:
    return int.from_bytes(digest.digest()[:8], "little", signed=True)


def anchor_rows(texts: DataFrame, k: int) -> DataFrame:
    """(h, s) of the anchors of all texts with an id; a task gives a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch, words in _slices(batches, 1):
            s = np.array([_text_id(hashlib.sha256(x)) for x in joined(words)], np.int64)
            take = np.zeros(len(s), bool)
            for d, (key, known) in enumerate(zip(s.tolist(), batch.column(0).is_valid().to_pylist())):
                if known and key not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    take[d] = True
            starts, low = _window_anchors(words, word_hashes(words), k)
            doc = words.doc()[starts]
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
            new &= take[doc]
            yield pa.RecordBatch.from_arrays([pa.array(low[new].view(np.int64)), pa.array(s[doc[new]])], names=["h", "s"])

    return texts.mapInArrow(run, "h long, s long")


def _with_text_id(texts: DataFrame) -> DataFrame:
    id_type = texts.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _slices(batches, 1):
            sha = [hashlib.sha256(x).hexdigest() for x in joined(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sha, pa.string())], names=["r", "text", "sha"])

    return texts.mapInArrow(run, f"r {id_type}, text string, sha string")


#: a window is told apart by 64 bits of one hash and 34 of another; the rest of the second number holds its position
_PLACE = 30
_HIGH = np.int64(-1) << np.int64(_PLACE)


def _candidates(chosen: DataFrame, k: int) -> DataFrame:
    """(w, x, r, t) of the windows at recurring anchors of the rows (r, t, text, anchors)."""
    id_type = chosen.schema["r"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _slices(batches, 2):
            hashes = word_hashes(words)
            starts, low = _window_anchors(words, hashes, k)
            anchors = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            at = starts[np.isin(low.view(np.int64), anchors)]
            doc = words.doc()[at]
            x = run_hashes(hashes, k, 2)[at].view(np.int64) & _HIGH | (at - words.first[doc])
            doc = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(run_hashes(hashes, k, 1)[at].view(np.int64)), pa.array(x), batch.column(0).take(doc), batch.column(1).take(doc)], names=["w", "x", "r", "t"])

    return chosen.select("r", "t", "text", "anchors").mapInArrow(run, f"w long, x long, r {id_type}, t long")


def _late(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by (w, high bits of x, r): (r, t, position) of all behind the first document.

    A streaming step that remembers one window and its first document.
    """
    before: tuple[int, int, object] | None = None
    for batch in batches:
        w, x = (batch.column(c).to_numpy() for c in (0, 1))
        if not len(w):
            continue
        high = x & _HIGH
        start = np.ones(len(w), bool)
        start[1:] = (w[1:] != w[:-1]) | (high[1:] != high[:-1])
        goes_on = before is not None and before[:2] == (w[0], high[0])
        lead = np.maximum.accumulate(np.where(start, np.arange(len(w)), 0))
        firsts = batch.column(2).take(pa.array(lead))
        if goes_on:
            own = pa.array([before[2]] * int((lead == 0).sum()), batch.column(2).type)
            firsts = pa.concat_arrays([own, firsts.slice(len(own))])
        before = (int(w[-1]), int(high[-1]), firsts[len(w) - 1].as_py())
        late = np.flatnonzero(pc.greater(batch.column(2), firsts).to_numpy(zero_copy_only=False))
        pos = (x[late] & ~_HIGH).astype(np.int32)
        late = pa.array(late)
        yield pa.RecordBatch.from_arrays([batch.column(2).take(late), batch.column(3).take(late), pa.array(pos)], names=["r", "t", "pos"])


def _passages(starts: list[int], k: int) -> Iterator[tuple[int, int]]:
    """(first word, end word) of runs of consecutive windows."""
    starts = sorted(starts)
    i = 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] <= starts[j] + 1 and starts[j + 1] - starts[i] <= PATTERN_WORDS - k:
            j += 1
        yield starts[i], starts[j] + k
        i = j + 1


def _locate(shard: DataFrame, k: int) -> DataFrame:
    """(sha, spans, n_removed, kept) of the rows (sha, text, pos): word spans to remove, and the words left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words in _slices(batches, 1):
            lines, ends, starts = [], [], []
            for d, text in enumerate(joined(words)):
                a, b = words.first[d:d + 2]
                end = np.cumsum(words.end[a:b] - words.start[a:b] + 1) - 1
                lines.append(b" " + text + b" ")
                ends.append(end + 1)  # of every word in the line with its leading blank
                starts.append(end + 1 - (words.end[a:b] - words.start[a:b]))
            covered = [np.zeros(len(e) + 1, np.int32) for e in ends]
            automaton, size = ahocorasick.Automaton(), 0
            patterns: dict[str, tuple[int, set[int]]] = {}  # text -> words, documents it is late in

            def stream() -> None:
                for text, value in patterns.items():
                    automaton.add_word(text, (len(text), value[0], value[1]))
                automaton.make_automaton()
                for d, line in enumerate(lines):
                    for end, (length, n, owners) in automaton.iter(line.decode("latin-1")):
                        if d in owners:
                            last = int(np.searchsorted(ends[d], end))
                            covered[d][last - n + 1] += 1
                            covered[d][last + 1] -= 1

            for d, pos in enumerate(batch.column(2).to_pylist()):
                for begin, end in _passages(pos, k):
                    text = lines[d][starts[d][begin] - 1:ends[d][end - 1] + 1].decode("latin-1")
                    if text not in patterns:
                        size += len(text)
                        patterns[text] = (end - begin, set())
                    patterns[text][1].add(d)
                    if size >= AUTOMATON_BYTES:
                        stream()
                        automaton, size = ahocorasick.Automaton(), 0
                        patterns.clear()
            if patterns:
                stream()
            spans, removed, kept = [], [], []
            for d, line in enumerate(lines):
                gone = np.cumsum(covered[d][:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                spans.append([{"first": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
                removed.append(int(gone.sum()))
                left = line.split(b" ")[1:-1]
                kept.append(b" ".join(w for w, g in zip(left, gone.tolist()) if not g).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["sha", "spans", "n_removed", "kept"])

    return shard.select("sha", "text", "pos").mapInArrow(run, "sha string, spans array<struct<first: long, end: long>>, n_removed long, kept string")


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 13, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``df``: (id, n_words, n_removed, spans, kept, words_sha256, text_sha256), then its columns ``carry``.

    ``spans`` are the word ranges to remove and ``kept`` the words left, joined by single blanks; ``kept`` is NULL
    where nothing is removed (the text stays as it is; ``words_sha256`` is the digest of its joined words).
    Runs jobs while it is built; their results lie in the shared folder (``spark.checkpoint.dir``).
    """
    small_batches(df.sparkSession)
    carry = carry or []
    given = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    texts = given.select("id", "text")
    docs = pin(scan(given))
    rows = anchor_rows(texts, k).repartition("h").sortWithinPartitions("h", "s")
    own = pin(rows.mapInArrow(recurring, "h long, s long").groupBy("s").agg(F.collect_list("h").alias("anchors")))

    # texts are told apart by their digests; ``t`` does so among the texts of one document id, and is 0 for most
    first = pin(docs.where("id is not null and n > 0").groupBy("s", "sha").agg(F.min("id").alias("r")))
    several = pin(first.groupBy("r").count().where("count > 1").select("r"))
    if not several.isEmpty():
        first = first.join(several.withColumn("many", F.lit(True)), "r", "left")
        first = pin(first.select("s", "sha", "r", F.when(F.col("many"), F.xxhash64("sha")).otherwise(0).alias("t")))
    else:
        first = first.withColumn("t", F.lit(0).cast("long"))
    wanted = pin(own.join(first, "s").drop("s"))
    ids = wanted.select(F.col("r").alias("id")).distinct()
    if wanted.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    picked = _with_text_id(texts.join(ids, "id", "left_semi"))
    chosen = pin(picked.join(wanted, ["sha", "r"]).select("r", "t", "sha", "text", "anchors"))

    windows = _candidates(chosen, k).repartition("w").sortWithinPartitions("w", F.shiftright("x", _PLACE), "r")
    id_type = texts.schema[0].dataType.simpleString()
    # pinned so that the shuffled windows are gone from disk before whole texts are shuffled
    late = pin(windows.mapInArrow(_late, f"r {id_type}, t long, pos int").groupBy("r", "t").agg(F.sort_array(F.collect_set("pos")).alias("pos")))
    behind = chosen.select("r", "t", "sha", "text").join(late, ["r", "t"])
    removed = pin(_locate(behind, k).groupBy("sha").agg(*[F.first(c).alias(c) for c in ("spans", "n_removed", "kept")]))

    judged = docs.join(first.select("sha", "r"), "sha", "left").join(removed, "sha", "left")
    copy = (F.col("id") > F.col("r")) & (F.col("n") >= k)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n").alias("end")))
    alone = F.col("id").isNull()
    none = F.array().cast("array<struct<first: long, end: long>>")
    return judged.select(
        F.col("id").alias(doc_id),
        F.col("n").alias("n_words"),
        F.when(alone, F.lit(0)).when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(alone, none).when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(alone, None).when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.col("sha").alias("words_sha256"), F.col("raw").alias("text_sha256"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )
