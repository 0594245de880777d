"""Benchmark passages and their paraphrases in documents by latent semantic retrieval.

1. *Counts.* One pass over all documents counts hashed terms; they give inverse frequencies.
2. *Latent space.* The TF-IDF matrix of the benchmark's passages is factored by randomised SVD: a random
   projection, power iterations of A'A in blocks of passages spread over the tasks, and an orthonormal basis of
   the result. Terms the benchmark does not have carry no weight, so text unlike it is close to zero.
3. *Search.* Every document is cut into steps of STEP words; for each length of benchmark passages windows of about that
   length start at every step. All windows of all documents are projected and compared by cosine with all benchmark
   passages of that length, in blocks.
4. *Bound.* The item's words that stand anywhere around a candidate are no fewer than their longest common subsequence; only
   candidates where they are too few are left out, so nothing that the checks would confirm is lost.
5. *Checks.* Around each candidate the longest common subsequence of words with the item must cover ``least_lcs`` of
   the item's words, and ``least_answer`` of its answer, the item's last sentence (its last quarter if it has one
   sentence), must stand there. Items with fewer than SHORT words must be covered whole.

Words are runs of characters other than ASCII blanks and punctuation, A-Z lower-cased.

Defined cases: NULL and empty texts match nothing, NULL and empty items are not searched for; rows that repeat an id are searched
each and reported once per id and item with their best match; a NULL document id is not reported; an empty table on either
side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.llm.words import Words, find_words, mix, release, slices, word_hashes

TERM_BITS = 16
TERM_BLOCKS = 64
STEP = 8
RANK = 64
POWER_ROUNDS = 2
#: rows of the random projection drawn at a time
RANDOM_ROWS = 1 << 12
#: steps per window; an item is searched for at the largest that does not exceed its length, long items in pieces of it
SCALES = (1, 2, 3, 4, 6)
SHORT = 8
#: slots of the bound's table for each item word, and at most 2**BOUND_BITS; words that share a slot only raise the bound
BOUND_ROOM = 64
BOUND_BITS = 22
#: words around candidates that are looked up at a time
BOUND_WORDS = 1 << 20
#: benchmark passages per broadcast; more of them are searched for in several passes over the documents
PASSAGES = 50_000

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _FOLD[_low:_high] = np.arange(_low, _high)
_FOLD[65:91] += 32


def fold_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-cased words without punctuation."""
    return find_words(_FOLD[buf], offsets)


def _terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def term_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of every hashed term in all documents; tasks' counts are summed block by block."""
    width = (1 << TERM_BITS) // TERM_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << TERM_BITS, np.int64)
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column(0)):
                total += np.bincount(_terms(word_hashes(fold_words(buf, offsets))), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(range(TERM_BLOCKS), pa.int32()), pa.array([x.tobytes() for x in total.reshape(TERM_BLOCKS, width)], pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = np.frombuffer(raw.as_buffer(), np.int64)
                sums[block] = sums[block] + found if block in sums else found
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "counts"])

    schema = "block int, counts binary"
    out = np.zeros((TERM_BLOCKS, width), np.int64)
    for block, raw in texts.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        out[block] = np.frombuffer(raw, np.int64)
    return out.reshape(-1)


@dataclass
class Passage:
    """A piece of an item that is searched for: hashed terms and word codes of the whole item."""

    item: int
    scale: int
    terms: np.ndarray


@dataclass
class Item:
    """An item's words as hashes; its answer starts at word ``answer``."""

    item_id: object
    words: np.ndarray
    answer: int


def read_item(item_id: object, text: str) -> Item:
    raw = text.encode("utf-8", "surrogatepass")
    words = fold_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    ends = [i for i, b in enumerate(raw) if b in b".!?" and raw[i + 1:].strip(b" .!?\n\t\r\"')")]
    answer = int(np.searchsorted(words.start, ends[-1])) if ends else len(words.start) - max(1, len(words.start) // 4)
    return Item(item_id, word_hashes(words), min(answer, max(0, len(words.start) - 1)))


def cut_items(items: list[Item]) -> list[Passage]:
    """The pieces items are searched for by: whole if they fit a scale, else overlapping pieces of the largest."""
    out = []
    for k, item in enumerate(items):
        n = len(item.words)
        scale = max((s for s in SCALES if s * STEP <= n), default=SCALES[0])
        length = scale * STEP
        piece = n if n < length + length // 2 else length
        for at in range(0, max(1, n - piece + 1), max(1, piece // 2)):
            out.append(Passage(k, scale, _terms(item.words[at:at + piece])))
        if (n - piece) % max(1, piece // 2):
            out.append(Passage(k, scale, _terms(item.words[n - piece:])))
    return out


def latent_basis(df: DataFrame, passages: list[Passage], weight: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The passages' terms, ascending, and an orthonormal basis (these terms x rank) of the leading right singular space of their TF-IDF rows.

    Other terms have no part in that space, so neither driver nor broadcasts hold rows for them. Each power iteration maps
    blocks of passages over the tasks; a task returns only the rows of A'(A B) of its own terms, and these are summed before
    they reach the driver, packed.
    """
    spark = df.sparkSession
    terms = np.unique(np.concatenate([p.terms for p in passages]))
    rank = min(RANK, len(passages), len(terms))
    rng = np.random.default_rng(seed)
    basis = np.empty((len(terms), rank), np.float32)
    for low in range(0, 1 << TERM_BITS, RANDOM_ROWS):
        a, b = np.searchsorted(terms, [low, low + RANDOM_ROWS])
        basis[a:b] = rng.standard_normal((RANDOM_ROWS, rank))[terms[a:b] - low]
    own_weight = weight[terms]
    rows = [(i, np.searchsorted(terms, p.terms).tolist()) for i, p in enumerate(passages)]
    stored = spark.createDataFrame(rows, "i int, terms array<int>").repartition(max(1, min(len(rows) // 500 + 1, 200)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term = batch.column(0).to_numpy().astype(np.int64)
            row = batch.column(1).flatten().to_numpy().astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (term, row)], names=["term", "row"])

    def step(current: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(current)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of = {}
                for places in batch.column(1).to_pylist():
                    t, n = np.unique(np.array(places, np.int64), return_counts=True)
                    row = n * own_weight[t]
                    row = row / (np.linalg.norm(row) or 1.0)
                    y = row @ shared.value[t]
                    for term, value in zip(t.tolist(), np.outer(row, y)):
                        of[term] = of[term] + value if term in of else value
                yield pa.RecordBatch.from_arrays([pa.array(list(of), pa.int32()), pa.array([x.tolist() for x in of.values()], pa.list_(pa.float64()))], names=["term", "row"])

        summed = stored.mapInArrow(run, "term int, row array<double>").groupBy("term").agg(
            F.array(*[F.sum(F.col("row")[k]) for k in range(rank)]).alias("row"))
        out = np.zeros_like(current)
        for term, row in summed.mapInArrow(pack, "term binary, row binary").collect():
            out[np.frombuffer(term, np.int64)] = np.frombuffer(row, np.float32).reshape(-1, rank)
        return out

    for _ in range(POWER_ROUNDS):
        basis = step(basis)
        basis, _ = np.linalg.qr(basis)
    return terms, np.ascontiguousarray(basis, np.float32)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & at.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


class Searcher:
    """Benchmark passages in the latent space, ready for slices of documents; ``terms`` are those of the rows of ``basis`` (all if None)."""

    def __init__(self, items: list[Item], passages: list[Passage], basis: np.ndarray, weight: np.ndarray,
                 least_cosine: float, least_lcs: float, least_answer: float, terms: np.ndarray | None = None):
        self.items, self.least = items, (least_cosine, least_lcs, least_answer)
        terms = np.arange(1 << TERM_BITS) if terms is None else terms
        self.projection = basis * weight[terms, None].astype(np.float32)
        self.row = np.zeros(1 << TERM_BITS, np.int32)
        self.row[terms] = np.arange(len(terms))
        self.known = np.zeros(1 << TERM_BITS, bool)
        self.known[terms] = np.abs(self.projection).sum(axis=1) > 0
        self.scales = {}
        for scale in sorted({p.scale for p in passages}):
            own = [p for p in passages if p.scale == scale]
            matrix = np.array([self.projection[self.row[p.terms]].sum(axis=0) for p in own], np.float32)
            norm = np.maximum(np.linalg.norm(matrix, axis=1), 1e-12)
            self.scales[scale] = (np.ascontiguousarray((matrix / norm[:, None]).T), np.array([p.item for p in own]))
        self.size = np.array([len(item.words) for item in items])
        self.need = np.where(self.size < SHORT, self.size, least_lcs * self.size)
        # every 64 words of an item are a unit with one bit for each of them
        units = -(-self.size // 64)
        self.unit = np.concatenate([[0], np.cumsum(units)])
        self.unit_key = mix(np.arange(1, self.unit[-1] + 1, dtype=np.uint64))
        words = np.concatenate([item.words for item in items])
        place = np.arange(len(words)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        of = np.repeat(self.unit[:-1], self.size) + place // 64
        bits = np.uint64(1) << (place % 64).astype(np.uint64)
        self.shift = np.uint64(64 - min(BOUND_BITS, (BOUND_ROOM * len(words)).bit_length()))
        self.table = np.zeros(1 << int(np.uint64(64) - self.shift), np.uint64)
        np.bitwise_or.at(self.table, (words + self.unit_key[of]) >> self.shift, bits)
        self.unit_bits = np.zeros(self.unit[-1], np.uint64)
        np.bitwise_or.at(self.unit_bits, of, bits)

    def possible(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether enough words of the item stand among the words low to high: never fewer than their subsequence."""
        out = np.zeros(len(item), bool)
        order = np.argsort(self.size[item], kind="stable")
        a = 0
        while a < len(order):
            width = 3 * int(self.size[item[order[a]]]) + STEP
            part = order[a:a + max(1, BOUND_WORDS // width)]
            part = part[self.size[item[part]] <= 2 * self.size[item[part[0]]]]
            a += len(part)
            place = low[part, None] + np.arange((high[part] - low[part]).max())
            outside = place >= high[part, None]
            around = hashes[np.minimum(place, len(hashes) - 1)]
            bound = np.zeros(len(part), np.int64)
            for k in range(int(np.max(np.diff(self.unit)[item[part]]))):
                own = np.flatnonzero(np.diff(self.unit)[item[part]] > k)
                unit = self.unit[item[part[own]]] + k
                found = self.table[(around[own] + self.unit_key[unit, None]) >> self.shift]
                found[outside[own]] = 0
                bound[own] += np.bitwise_count(np.bitwise_or.reduce(found, axis=1) & self.unit_bits[unit])
            out[part] = bound >= self.need[item[part]]
        return out

    def search(self, words: Words) -> Iterator[tuple[int, int, int, float, int, float]]:
        """(document, item, first word, cosine, lcs, answer share) of confirmed matches."""
        if not len(words.start):
            return
        hashes = word_hashes(words)
        terms = _terms(hashes)
        counts = words.counts
        steps = -(-counts // STEP)
        first = np.concatenate([[0], np.cumsum(steps)])
        doc = np.repeat(np.arange(len(counts)), steps)
        at = words.first[doc] + (np.arange(len(doc)) - first[doc]) * STEP
        known = np.flatnonzero(self.known[terms])
        table = np.zeros((len(doc), self.projection.shape[1]), np.float32)
        if not len(known):
            return
        step_of = np.searchsorted(at, known, "right") - 1
        new = np.flatnonzero(np.concatenate([[True], step_of[1:] != step_of[:-1]]))
        for a in range(0, len(new), 4096):
            b = min(a + 4096, len(new))
            lo, hi = new[a], new[b] if b < len(new) else len(known)
            table[step_of[new[a:b]]] = np.add.reduceat(self.projection[self.row[terms[known[lo:hi]]]], new[a:b] - lo, axis=0)
        best: dict[tuple[int, int], tuple] = {}
        for scale, (matrix, items) in self.scales.items():
            window = table.copy()
            for back in range(1, scale):
                same = np.flatnonzero(doc[back:] == doc[:-back]) if back < len(doc) else np.zeros(0, np.int64)
                window[same] += table[same + back]
            norm = np.linalg.norm(window, axis=1)
            rows = np.flatnonzero(norm > 0)
            for a in range(0, len(rows), 8192):
                part = rows[a:a + 8192]
                for c in range(0, len(items), 2048):
                    cosine = window[part] @ matrix[:, c:c + 2048]
                    hit = np.nonzero(cosine >= (self.least[0] * norm[part])[:, None])
                    low, high = self.around(words, doc[part[hit[0]]], at[part[hit[0]]], self.size[items[c + hit[1]]])
                    likely = self.possible(hashes, low, high, items[c + hit[1]])
                    for w, i in zip(part[hit[0][likely]].tolist(), hit[1][likely].tolist()):
                        item = int(items[c + i])
                        d = int(doc[w])
                        value = float(window[w] @ matrix[:, c + i] / norm[w])
                        found = self.check(hashes, words, d, int(at[w]), item)
                        if found and ((d, item) not in best or (*found, value) > (*best[d, item][2:4], best[d, item][1])):
                            best[d, item] = (int(at[w] - words.first[d]), value, *found)
        for (d, item), (start, value, common, answer) in best.items():
            yield d, item, start, value, common, answer

    @staticmethod
    def around(words: Words, d, at, n):
        """Range of the words around a window of document ``d`` that are compared with an item of ``n`` words."""
        return np.maximum(words.first[d], at - n), np.minimum(words.first[d + 1], at + 2 * n + STEP)

    def check(self, hashes: np.ndarray, words: Words, d: int, at: int, item: int) -> tuple[int, float] | None:
        """Common subsequence and answer share around a window, if they suffice."""
        target = self.items[item]
        n = len(target.words)
        low, high = self.around(words, d, at, n)
        region = hashes[low:high].tolist()
        wanted = target.words.tolist()
        common = lcs(wanted, region)
        if common < (n if n < SHORT else self.least[1] * n):
            return None
        answer = wanted[target.answer:]
        there = set(region)
        share = sum(w in there for w in answer) / max(1, len(answer))
        return (common, share) if share >= self.least[2] else None


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", least_cosine: float = 0.5, least_lcs: float = 0.6, least_answer: float = 0.4,
                 seed: int = 3) -> DataFrame:
    """(doc_id, item_id, first_word, cosine, lcs, lcs_share, answer_share) of every benchmark item found in a document.

    The benchmark is read by the driver in groups of PASSAGES passages at most; each group is one pass over the documents.
    """
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField(item_id, benchmark.schema[item_id].dataType),
        T.StructField("first_word", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("lcs", T.LongType()),
        T.StructField("lcs_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType())])
    result = spark.createDataFrame([], schema)
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where(F.length(F.trim("t")) > 0)
    weight = None

    def search(items: list[Item]) -> DataFrame:
        nonlocal weight
        if weight is None:
            counts = term_counts(texts.select("text"))
            weight = np.log((counts.sum() + 2) / (counts + 1)) ** 2
        passages = cut_items(items)
        terms, basis = latent_basis(docs, passages, weight, seed)
        shared = spark.sparkContext.broadcast(Searcher(items, passages, basis, weight, least_cosine, least_lcs, least_answer, terms))
        release()  # the driver

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                out: list[list] = [[] for _ in schema]
                for i, _, buf, offsets in slices(batch.column(1)):
                    for d, item, start, cosine, common, answer in shared.value.search(fold_words(buf, offsets)):
                        if ids[i + d].is_valid:
                            target = shared.value.items[item]
                            values = (ids[i + d].as_py(), target.item_id, start, cosine, common, common / len(target.words), answer)
                            for column, value in zip(out, values):
                                column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(out, arrow)], names=schema.fieldNames())

        return texts.mapInArrow(run, schema)

    arrow = [to_arrow_type(f.dataType) for f in schema]
    group: list[Item] = []
    room = PASSAGES
    for row in rows.toLocalIterator():
        item = read_item(row.i, row.t)
        if len(item.words):
            group.append(item)
            room -= 1 + len(item.words) // (SCALES[-1] * STEP // 2)
        if room <= 0:
            result, group, room = result.union(search(group)), [], PASSAGES
    if group:
        result = result.union(search(group))
    best = F.max_by(F.struct("first_word", "cosine", "lcs", "lcs_share", "answer_share"), F.struct("lcs", "answer_share", "cosine", -F.col("first_word")))
    return result.groupBy(doc_id, item_id).agg(best.alias("best")).select(doc_id, item_id, "best.*")
