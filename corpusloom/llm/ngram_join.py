"""Similarity join of documents on word n-gram sets by T-occurrence search, and its components.

A document's set holds the hashes of its distinct runs of ``k`` lower-cased words; two documents
link when 100 * |intersection| >= percent * |union|. The join is exact:

1. Documents with equal sets share one set id and are one vertex from then on.
2. *Order.* A count sketch over all n-grams of all documents (fixed size, one pass) gives one global
   order of n-grams, rare before frequent. Linked sets share an n-gram among the first
   p = n - ceil(percent/100 * n) + 1 in that order of each of them, and c more among the first p + c. Only
   these go to the shuffle, packed by hash, and n-grams of a single set drop out there. A set that is left with too few cannot link;
   of the others' n-grams the c most frequent (long lists) are not needed to find every link.
3. *Stars.* The pivot of an n-gram is the set with the largest part of recurring n-grams; every other
   set is compared with the pivot it meets most often. Large groups of near copies become one component here,
   with work linear in the group.
4. *Rest.* Only n-grams whose sets still lie in different components need more. At the first n-gram that two sets share, both
   must have as many recurring n-grams left as linked sets of their sizes share, which leaves few pairs even in large groups; each
   such pair counts once, however many n-grams it shares. A set is searched for among its partners
   by shortened recurring n-grams, and what shares enough of them is compared in full. Blocks are cut into cells of bounded size.
5. *T-occurrence* in every cell: inverted lists of the cell's sets; for a query needing an overlap of T the L
   longest lists are set aside, the short lists are heap-merged, what occurs T - L times is probed in the
   long lists by binary search (DivideSkip), and the exact overlap decides.

Defined cases: NULL and blank texts have an empty set and link with nothing; documents with fewer than ``k``
words have their whole word sequence as the only element; rows that repeat an id are rows of their own, with
the same component if their texts link; a NULL id takes part but never names a component; an empty table gives
an empty table; further columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.words import Words, find_words, mix, run_hashes, run_starts, slices, word_hashes
from corpusloom.session import pin

#: counters of the order sketch (one byte each when broadcast), and blocks they are summed in
SKETCH_BITS = 20
SKETCH_BLOCKS = 256
#: percent of a set sent beyond its prefix: what a set must share then rules out most sets that share a passage only
EXTRA = 15
#: ids that may be broadcast; beyond that they are joined
BROADCAST_IDS = 500_000
#: rounds of comparing sets with one pivot each, before what is left is searched for in blocks
STARS = 2
#: sets of one side of a cell
CELL = 256
#: sets of one side of a cell where pairs are made by positions, pairs made at a time, and rows that are read for it
PAIR_CELL = 4096
PAIRS = 1 << 18
AT_ONCE = 1 << 16
#: n-grams of a bucket are 2**BUCKET_BITS rows on average; a sketch slot above 2**HOT_BITS may hold a hot n-gram
BUCKET_BITS = 17
HOT_BITS = 20
#: rows that a task packs at a time, and that one packed row may hold
FLUSH = 1 << 19
PACKED = 2048
#: weight of a binary probe against a step of the heap when the long lists are chosen
PROBE_WEIGHT = 0.0085


def ngram_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, n-gram hash) of all n-grams, repeated ones included."""
    hashes = word_hashes(words)
    at = run_starts(words, k)
    doc = words.doc()
    docs, grams = [doc[at]], [run_hashes(hashes, k, k)[at]]
    counts = words.counts
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            docs.append(short)
            grams.append(run_hashes(hashes, n, n)[words.first[short]])
    return np.concatenate(docs), np.concatenate(grams)


def _distinct(docs: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sorted by document and n-gram, each pair once."""
    if (docs[1:] < docs[:-1]).any():
        order = np.argsort(docs, kind="stable")
        docs, grams = docs[order], grams[order]
    else:
        grams = grams.copy()
    # sorting the documents one by one is several times faster than a sort by two keys
    bounds = [0, *(np.flatnonzero(docs[1:] != docs[:-1]) + 1).tolist(), len(docs)]
    for a, b in zip(bounds, bounds[1:]):
        grams[a:b].sort()
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (grams[1:] != grams[:-1])
    return docs[new], grams[new]


def _set_ids(docs: np.ndarray, grams: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, ends and ids of the sets of ``rows`` documents."""
    n = np.bincount(docs, minlength=rows).astype(np.int64)
    ends = np.cumsum(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams), dtype=np.uint64)])
    return n, ends, mix(sums[ends] - sums[ends - n] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Words]]:
    """(first column, lower-cased words of the second) of runs of rows."""
    for batch in batches:
        for i, j, buf, offsets in slices(batch.column(1)):
            yield batch.column(0).slice(i, j - i), find_words(buf, offsets, lower=True)


def scan(texts: DataFrame, k: int) -> DataFrame:
    """One pass over all texts: per document its size ``n`` and set id ``s``, and per task a sketch of n-gram counts.

    Rows with a ``block`` are parts of sketches, the others documents.
    """
    id_type = texts.schema[0].dataType.simpleString()
    names = ["id", "n", "s", "block", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        kind, slots, waiting = None, [], 0
        for ids, words in _text_slices(batches):
            kind = ids.type
            docs, grams = _distinct(*ngram_sets(words, k))
            slots.append((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
            waiting += len(grams)
            if waiting >= len(total):
                total += np.bincount(np.concatenate(slots), minlength=len(total))
                slots, waiting = [], 0
            n, _, s = _set_ids(docs, grams, len(ids))
            none = len(ids)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(s), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names)
        if waiting:
            total += np.bincount(np.concatenate(slots), minlength=len(total))
        if total.any():
            parts = np.minimum(total, 2**31 - 1).astype(np.int32).reshape(SKETCH_BLOCKS, -1)
            none = SKETCH_BLOCKS
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(none, kind), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()), pa.array(range(none), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=names)

    return texts.mapInArrow(run, f"id {id_type}, n long, s long, block int, counts binary")


def gram_classes(sketches: DataFrame) -> np.ndarray:
    """For each sketch slot the bit length of the number of n-grams in it, over all documents.

    The sketches of the tasks are summed block by block in a streaming step; the driver receives 2**SKETCH_BITS
    bytes whatever the input.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(raw.as_buffer(), np.int32).astype(np.int64)
                sums[block] = sums[block] + found if block in sums else found
        logs = [np.ceil(np.log2(x + 1)).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(logs, pa.binary())], names=["block", "counts"])

    out = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), np.uint8)
    for block, raw in sketches.select("block", "counts").repartition("block").mapInArrow(add, "block int, counts binary").collect():
        out[block] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1)


def prefix_length(n, percent: int):
    """Of a set of ``n``: how many n-grams in the global order hold one of any set it links with."""
    return n - (percent * n + 99) // 100 + 1


def extended_length(n, percent: int):
    """The same and EXTRA percent of the set more: linked sets share as many more of these as the smaller one has."""
    return prefix_length(n, percent) + EXTRA * n // 100


def prefix_rows(texts: DataFrame, k: int, percent: int, classes: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, rows) of the n-grams in the extended prefixes of all sets, packed: ``rows`` holds pairs (h, s); a task gives a set once.

    N-grams are dealt to buckets by their hash. Where the sketch counts more than HOT n-grams in a slot, one of them may have any
    number of sets: those go to further buckets, by set, as many as their number needs.
    """
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def pack(h: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
        bucket = (h.view(np.uint64) & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
        level = shared.value[(h.view(np.uint64) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
        hot = level > HOT_BITS
        if hot.any():
            bucket[hot] += np.uint64(buckets) * (np.uint64(1) + mix(s[hot].view(np.uint64)) % (np.uint64(1) << (level[hot].astype(np.uint64) - np.uint64(BUCKET_BITS))))
        order = np.argsort(bucket.astype(np.uint16) if not hot.any() and buckets <= 1 << 16 else bucket, kind="stable")
        bucket = bucket[order]
        new = np.ones(len(h), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        first = np.flatnonzero(new)
        new[(np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))) % PACKED == 0] = True
        first = np.flatnonzero(new)
        rows = np.stack([h[order], s[order]], axis=1)
        packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((np.append(first, len(h)) * 16).astype(np.int32)), pa.py_buffer(rows)])
        return pa.RecordBatch.from_arrays([pa.array(bucket[first].view(np.int64)), packed], names=["bucket", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for ids, words in _text_slices(batches):
            docs, grams = _distinct(*ngram_sets(words, k))
            n, ends, s = _set_ids(docs, grams, len(ids))
            # the n-grams of a document are sorted, so a stable sort by class alone orders them
            key = docs * 64 + shared.value[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
            order = np.argsort(key.astype(np.uint16) if len(ids) <= 1 << 10 else key, kind="stable")
            rank = np.arange(len(docs)) - np.repeat(ends - n, n)
            take = np.zeros(len(ids), bool)
            for d, key in enumerate(s.tolist()):
                if n[d] and key not in seen:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(key)
                    take[d] = True
            kept = (rank < extended_length(n, percent)[docs]) & take[docs]
            parts.append((grams[order[kept]].view(np.int64), s[docs[kept]]))
            waiting += len(parts[-1][0])
            if waiting >= FLUSH:
                yield pack(*map(np.concatenate, zip(*parts)))
                parts, waiting = [], 0
        if waiting:
            yield pack(*map(np.concatenate, zip(*parts)))

    return texts.mapInArrow(run, "bucket long, rows binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(bucket, h, s), sorted by h and s, of every bucket of packed rows that come sorted by bucket."""

    def ordered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        h, s = np.concatenate(parts).reshape(-1, 2).T
        order = np.argsort(h)
        h, s = h[order], s[order]
        again = np.zeros(len(h), bool)
        again[1:] = h[1:] == h[:-1]
        again[:-1] |= again[1:]
        some = np.flatnonzero(again)
        s[some] = s[some[np.lexsort((s[some], h[some]))]]
        return h, s

    last, parts = None, []
    for batch in batches:
        for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            if bucket != last and parts:
                yield last, *ordered(parts)
                parts = []
            last = bucket
            parts.append(np.frombuffer(raw.as_buffer(), np.int64).copy())
    if parts:
        yield last, *ordered(parts)


def recurring_rows(packed: DataFrame, buckets: int) -> DataFrame:
    """(h, s, df) of the n-grams with several sets, each row once; ``df`` counts the sets, and is HOT for what was dealt by set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, h, s in unpacked(batches):
            if bucket >= buckets:
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
                h, s = h[new], s[new]
                df = np.full(len(h), 1 << HOT_BITS, np.int64)
            else:
                (found,) = recurring(iter([pa.RecordBatch.from_arrays([pa.array(h), pa.array(s)], names=["h", "s"])]))
                h, s = (found.column(c).to_numpy() for c in (0, 1))
                first = np.flatnonzero(np.diff(h, prepend=h[:1] - 1)) if len(h) else np.zeros(0, np.int64)
                sizes = np.diff(np.append(first, len(h)))
                df = np.minimum(np.repeat(sizes, sizes), 1 << HOT_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(s), pa.array(df)], names=["h", "s", "df"])

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "h long, s long, df long")


def recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, s): the distinct rows of every h with more than one s.

    A streaming step that remembers one row, so a group of any size passes through.
    """
    last: tuple[int, int] | None = None
    given = False
    for batch in batches:
        h, s = (batch.column(c).to_numpy() for c in (0, 1))
        if not len(h):
            continue
        if last is not None:
            h, s = np.concatenate([[last[0]], h]), np.concatenate([[last[1]], s])
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
        h, s = h[new], s[new]
        same = h[1:] == h[:-1]
        out = np.zeros(len(h), bool)
        out[1:] |= same
        out[:-1] |= same
        again = given and last is not None
        given = bool(out[-1]) or again and len(h) == 1
        if again:
            out[0] = False
        last = (int(h[-1]), int(s[-1]))
        yield pa.RecordBatch.from_arrays([pa.array(h[out]), pa.array(s[out])], names=["h", "s"])


def full_sets(texts: DataFrame, k: int) -> DataFrame:
    """(s, grams) of the rows (id, text): set id and all n-gram hashes of the text, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words in _text_slices(batches):
            docs, grams = _distinct(*ngram_sets(words, k))
            n, ends, s = _set_ids(docs, grams, len(ids))
            sets = [grams[b - size:b].tobytes() for size, b in zip(n.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(sets, pa.binary())], names=["s", "grams"])

    return texts.mapInArrow(run, "s long, grams binary")


class InvertedLists:
    """Inverted lists over the sets of one cell."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        grams = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, grams))
        self.grams, self.owner = grams[order], owner[order]

    def linked(self, query: np.ndarray, percent: int) -> list[int]:
        """Indices of the sets whose overlap with ``query`` reaches ``percent`` of the union."""
        n = len(query)
        least = -(-percent * n // 100)  # no set that links overlaps less than this
        return self.search(query, least, -(-percent * (n + self.sizes) // (100 + percent)))

    def search(self, query: np.ndarray, least: int, needs: np.ndarray) -> list[int]:
        """Indices of the sets whose overlap with ``query`` reaches their entry of ``needs``, which is ``least`` or more."""
        low = np.searchsorted(self.grams, query, "left")
        high = np.searchsorted(self.grams, query, "right")
        found = np.flatnonzero(high > low)
        if len(query) == 0 or len(found) < least:
            return []
        lengths = (high - low)[found]
        by_length = found[np.argsort(lengths, kind="stable")]
        skip = min(least - 1, int(least / (PROBE_WEIGHT * np.log2(max(2, lengths.max())) + 1)))
        cut = len(by_length) - skip
        lists = [self.owner[low[i]:high[i]].tolist() for i in by_length.tolist()]
        short, long = lists[:cut], lists[cut:]
        out = []
        for member, hits in groupby(heapq.merge(*short)):
            overlap = sum(1 for _ in hits)
            need = int(needs[member])
            if overlap + len(long) < need:
                continue
            for i, rest in enumerate(long):
                if overlap + len(long) - i < need:
                    break
                at = bisect_left(rest, member)
                overlap += at < len(rest) and rest[at] == member
            if overlap >= need:
                out.append(member)
        return out


def shared_at_least(a, b, percent: int):
    """N-grams that linked sets of sizes ``a`` and ``b`` share among their extended prefixes.

    They share t in all; the first |x| - t + c in the global order of each hold c of these.
    """
    t = -(-percent * (a + b) // (100 + percent))
    return t + np.minimum(extended_length(a, percent) - a, extended_length(b, percent) - b)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of many rows at once, of rows sorted by their first ``keys`` columns; no group is cut in two."""
    held: list[list[np.ndarray]] = []
    waiting, enough = 0, AT_ONCE
    for batch in batches:
        held.append([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)])
        waiting += batch.num_rows
        if waiting >= enough:
            columns = [np.concatenate(x) for x in zip(*held)]
            last = np.ones(waiting, bool)
            for x in columns[:keys]:
                last &= x == x[-1]
            cut = waiting - int(last.sum())
            if cut:
                yield [x[:cut] for x in columns]
            held, waiting = [[x[cut:] for x in columns]], waiting - cut
            enough = max(AT_ONCE, 2 * waiting)
    if waiting:
        yield [np.concatenate(x) for x in zip(*held)]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """First rows of the groups of sorted rows."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for x in keys:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def marks_and_places(rows: DataFrame) -> DataFrame:
    """Of the rows (s, h, df, n, least), per set a row (s, n, grams): its recurring n-grams, 32 bits of each, sorted; and rows (s, n, h, common, left).

    Equal n-grams stay equal when shortened, so too small an overlap rules a link out. The n-grams of a set are ordered by df
    and h, as in every other set; all but the last least - 1 get rows. ``left`` counts them from this one on,
    ``common`` is the part of the set that recurs, in 2**-30, above 32 bits of ``s`` that settle ties.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s, h, df, n, least in whole_groups(batches, 1):
            order = np.lexsort((h, df, s))
            s, h, n, least = s[order], h[order], n[order], least[order]
            first = _starts(s)
            sizes = np.diff(np.append(first, len(s)))
            every = np.repeat(sizes, sizes)
            left = every - (np.arange(len(s)) - np.repeat(first, sizes))
            short = (h & 0xFFFFFFFF).astype(np.uint32)
            marks = [np.sort(short[a:a + m]).tobytes() for a, m in zip(first.tolist(), sizes.tolist())]
            common = (every / n * 2**30).astype(np.int64) << 32 | s & 0xFFFFFFFF
            kept = left >= least
            none, rest = len(first), int(kept.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[first]), pa.array(n[first]), pa.array(marks, pa.binary()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[kept]), pa.array(n[kept]), pa.nulls(rest, pa.binary()), pa.array(h[kept]), pa.array(common[kept]), pa.array(left[kept])], names=names)

    names = ["s", "n", "grams", "h", "common", "left"]
    rows = rows.select("s", "h", "df", "n", "least").repartition("s").sortWithinPartitions("s")
    return rows.mapInArrow(run, "s long, n long, grams binary, h long, common long, left long")


def pairs_within(first: np.ndarray, s: np.ndarray, n: np.ndarray, c: np.ndarray, left: np.ndarray, query: np.ndarray, percent: int) -> Iterator[np.ndarray]:
    """Pairs of sets (a, b), a < b, that may link, of the groups of sets that share an n-gram and start at the rows ``first``.

    They lie in different components ``c``, and one of them is a ``query``. ``left`` counts the marks of a set from this n-gram on:
    at the first one that two sets share, all that they share is still to come, so linked sets have as many left as they must share.
    """
    sizes = np.diff(np.append(first, len(s)))
    group = np.repeat(np.arange(len(first)), sizes)
    # whatever size a partner in the group has: the bound is lowest at the least or the largest
    low = np.maximum(np.minimum.reduceat(n, first)[group], -(-percent * n // 100))
    high = np.minimum(np.maximum.reduceat(n, first)[group], 100 * n // percent)
    keep = left >= np.minimum(shared_at_least(n, low, percent), shared_at_least(n, high, percent)) - 2
    group, s, n, c, left, query = (x[keep] for x in (group, s, n, c, left, query))
    first = _starts(group)
    sizes = np.diff(np.append(first, len(s)))
    first, many = (np.repeat(x, sizes) for x in (first, sizes))
    asked = np.flatnonzero(query)
    total = np.cumsum(many[asked])
    at = 0
    while at < len(asked):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        one = asked[at:to]
        a = np.repeat(one, many[one])
        b = first[a] + np.arange(len(a)) - np.repeat(np.cumsum(many[one]) - many[one], many[one])
        other = c[a] != c[b]
        a, b = a[other], b[other]
        near = (100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])) & (np.minimum(left[a], left[b]) >= shared_at_least(n[a], n[b], percent))
        a, b = s[a[near]], s[b[near]]
        if len(a):
            yield np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        at = to


def near_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (block, s): the pairs that ``pairs_within`` finds among the rows (h, s, n, c, left) of n-grams whose sets lie in several components.

    The queries are the sets outside one of these components. Many sets of one n-gram form a grid of cells with about
    PAIR_CELL sets on either side, so that no task meets an unbounded number.
    """
    cells = F.ceil(F.count("*") / PAIR_CELL).cast("int").alias("cells")
    open_grams = pin(rows.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max_by("c", "left").alias("main"), cells)
                     .where("low < high").select("h", "main", "cells"))
    met = rows.join(open_grams, "h").select("h", "s", "n", "c", "left", (F.col("c") != F.col("main")).alias("query"), "cells")
    own, every = F.pmod(F.xxhash64("s"), F.col("cells")).cast("int"), F.sequence(F.lit(0), F.col("cells") - 1)
    at = lambda i, j, query: F.struct(i.alias("i"), j.alias("j"), query.alias("query"))
    places = F.when(F.col("cells") == 1, F.array(at(F.lit(0), F.lit(0), F.col("query")))).otherwise(F.concat(
        F.transform(every, lambda j: at(own, j, F.lit(False))),
        F.when(F.col("query"), F.transform(every, lambda i: at(i, own, F.lit(True)))).otherwise(F.array().cast("array<struct<i:int,j:int,query:boolean>>"))))
    grid = met.withColumn("at", F.explode(places)).select("h", "at.i", "at.j", "s", "n", "c", "left", "at.query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, i, j, s, n, c, left, query in whole_groups(batches, 3):
            for pairs in pairs_within(_starts(h, i, j), s, n, c, left, query, percent):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["block", "s"])

    return grid.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(run, "block long, s long").distinct()


def search_blocks(members: DataFrame, sets: DataFrame, percent: int, marks: bool = False) -> DataFrame:
    """Edges (a, b) between sets of one block: every ``query`` set is searched for among its ``index`` sets.

    With ``marks`` the sets are marks, and the pairs are those that share as many as linked sets of their sizes must.
    ``members`` has (block, s, query, index). A block is cut into a grid of cells with about CELL sets on either
    side, so that no task meets an unbounded block.
    """
    members = pin(members)
    sizes = pin(
        members.groupBy("block").agg(
            F.ceil(F.sum(F.col("index").cast("int")) / CELL).cast("int").alias("ni"),
            F.ceil(F.sum(F.col("query").cast("int")) / CELL).cast("int").alias("nq"),
            F.min("s").alias("low"), F.max("s").alias("high"),
        ).where("ni > 0 and nq > 0 and low < high").drop("low", "high")
    )
    placed = members.join(sizes, "block")
    place = lambda n: F.pmod(F.xxhash64("s"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cells = (
        placed.where("index").select("block", place("ni").alias("i"), every("nq").alias("j"), F.lit(0).alias("role"), "s")
        .union(placed.where("query").select("block", every("ni").alias("i"), place("nq").alias("j"), F.lit(1).alias("role"), "s"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, sets, full, lists = None, [], [], [], None
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            block, i, j, role, s = (batch.column(c).to_pylist() for c in range(5))
            for key, part, owner, raw, n in zip(zip(block, i, j), role, s, batch.column(5), batch.column(6).to_pylist()):
                grams = np.frombuffer(raw.as_buffer(), np.uint32 if marks else np.uint64)
                if key != cell:
                    cell, ids, sets, full, lists = key, [], [], [], None
                if part == 0:
                    ids.append(owner)
                    sets.append(grams.copy())
                    full.append(n)
                    continue
                if lists is None:
                    lists, sets = InvertedLists(sets), []
                if marks:
                    needs = shared_at_least(np.array(full), n, percent)
                    hits = lists.search(grams, int(needs.min()), needs)
                else:
                    hits = lists.linked(grams, percent)
                pairs += [(owner, ids[m]) for m in hits if ids[m] != owner]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    n = F.col("n") if marks else F.lit(0).cast("long")
    grid = cells.join(sets, "s").select("block", "i", "j", "role", "s", "grams", n.alias("n"))
    return grid.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "role").mapInArrow(run, "a long, b long")


def star_blocks(named: DataFrame, percent: int, again: bool) -> DataFrame:
    """Blocks of one query each: a pivot and the sets to compare it with, from the rows (h, s, n, common, left, c).

    Where an n-gram's sets lie in several components, its pivot is the set with the largest ``common``: the part of
    its n-grams that recur, which is largest for the original of edited copies. With ``again`` that set was a pivot
    before, and the pivot is the same among the sets outside its component. A set in another component than
    its pivots, and near enough in size, is compared with the one it meets most often.
    """
    if again:
        lead = pin(named.groupBy("h").agg(F.max_by("c", "common").alias("lead"), F.min("c").alias("low"), F.max("c").alias("high"))
                   .where("low < high").select("h", "lead"))
        tops = named.join(lead, "h").where("c <> lead")
        named = named.join(lead.select("h"), "h")
    else:
        tops = named
    top = pin(tops.groupBy("h").agg(*(F.max_by(x, "common").alias(name) for x, name in (("s", "pivot"), ("n", "pivot_n"), ("c", "pivot_c")))))
    met = named.join(top, "h").where(
        (F.col("c") != F.col("pivot_c")) & (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n"))
    ).groupBy("s", "pivot").count()
    return pairs_blocks(pin(met.groupBy("s").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("block"))))


def pairs_blocks(pairs: DataFrame) -> DataFrame:
    """Blocks that compare the set ``block`` with the sets ``s`` it stands with."""
    return pairs.select("block", "s", F.lit(False).alias("query"), F.lit(True).alias("index")).union(
        pairs.select("block").distinct().select("block", F.col("block").alias("s"), F.lit(True).alias("query"), F.lit(False).alias("index")))


def ngram_join(df: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``df``: size of its set, smallest id reachable by links.

    Runs jobs while it is built; their results lie in the shared folder (``spark.checkpoint.dir``).
    """
    texts = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    scanned = pin(scan(texts, k))
    docs = scanned.where("block is null").select("id", "n", "s")
    classes = gram_classes(scanned.where("block is not null"))
    total = docs.agg(F.sum("n")).first()[0] or 0
    buckets = (extended_length(total, percent) >> BUCKET_BITS) + 1
    members = pin(recurring_rows(prefix_rows(texts, k, percent, classes, buckets), buckets))

    # A set stays only if it shares enough n-grams; of these the most frequent are not needed.
    # The bound below is the least of shared_at_least over all partners, which lies at one end of their sizes.
    low, high = f"(({percent} * n + 99) div 100)", f"(100 * n div {percent})"
    extra = lambda x: f"({EXTRA} * {x} div 100 + 1 - ({percent} * {x} + 99) div 100)"
    shared = lambda x: f"(({percent} * (n + {x}) + {99 + percent}) div {100 + percent} + least({extra('n')}, {extra(x)}))"
    least = F.greatest(F.expr(f"least({shared(low)}, {shared(high)}) - 2"), F.lit(1))
    sizes = docs.groupBy("s").agg(F.max("n").alias("n")).select("s", "n", least.alias("least"))
    enough = pin(members.groupBy("s").count().join(sizes, "s").where("count >= least").select("s", "n", "least"))
    if enough.count() <= BROADCAST_IDS:
        enough = F.broadcast(enough)
    placed = pin(marks_and_places(members.join(enough, "s")))
    marks = placed.where("grams is not null").select("s", "grams", "n")
    members = placed.where("h is not null").select("h", "s", "n", "common", "left")

    wanted = docs.join(marks.select("s"), "s").groupBy("s").agg(F.min("id").alias("w")).select("w").distinct()
    wanted = pin(wanted)
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts_of = texts.join(wanted, F.col("id").eqNullSafe(F.col("w")), "left_semi")
    sets = pin(full_sets(texts_of, k).groupBy("s").agg(F.first("grams").alias("grams")))

    edges, named = None, members.withColumn("c", F.col("s"))
    for number in range(STARS):
        found = pin(search_blocks(star_blocks(named, percent, number > 0), sets, percent))
        edges = found if edges is None else edges.union(found)
        found = components(edges).withColumnRenamed("id", "s")
        named = pin(members.join(found, "s", "left").select("h", "s", "n", "common", "left", F.coalesce("component", "s").alias("c")))

    near = search_blocks(pairs_blocks(pin(near_pairs(named, percent))), marks, percent, marks=True)
    near = near.select(F.least("a", "b").alias("block"), F.greatest("a", "b").alias("s")).distinct()
    more = pin(search_blocks(pairs_blocks(pin(near)), sets, percent))
    whole = components(edges.union(more))

    of_set = pin(docs.select("s", "id", "n").join(whole.withColumnRenamed("id", "s"), "s", "left")
                 .select("id", "n", F.when(F.col("n") > 0, F.coalesce("component", "s")).alias("c")))
    least = pin(of_set.where("c is not null").groupBy("c").agg(F.min("id").alias("component_id")))
    return of_set.join(least, "c", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
