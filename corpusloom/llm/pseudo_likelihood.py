"""Language-model scores by masked pseudo-likelihood.

Every token of a document is predicted from the words on both sides of it, and the sum of the log
probabilities is the document's pseudo-log-likelihood.

1. *Words.* All words of all documents are counted in a table with one row per distinct word, which grows with the corpus. The HEAD
   most frequent words are tokens of their own, every other word is the token of its shape (length and last letter).
   Counts of at most KNOWN frequent words are sent to the tasks; the others stay in the table and are joined.
2. *Classes.* Head words are put into classes of like company: their counts of neighbours are projected on the main directions
   and halved at the median until a class has at most CLASS_WORDS words.
3. *Network.* Token vectors of SPAN words on either side, weighted by position, are added up and pass through tanh. A softmax
   gives the class or the shape, a second one the word within the class. A word of a shape takes its share of the shape's
   words, from the counts. The probabilities of all words sum to one.
4. *Training* in numpy inside the tasks. Distinct texts are dealt by a hash into shards of about SHARD_TOKENS tokens, in a fixed order.
   In each of ROUNDS rounds every shard starts from the shared parameters and follows the gradient at every ROUNDS-th position, so that every position
   of every text is a target once; the parameters are then averaged with the number of targets as weight.
5. *Scoring* predicts every word of every whole document. The word is masked from the counts as well: the share of a
   word of a shape rests on its occurrences in other rows (leave one out), so words that only this row has are as
   unlikely as unseen ones.

Shards and their order depend on the texts alone, so scores do not depend on the split into tasks but for the rounding of sums.

Defined cases: NULL and blank texts have 0 words, sums of 0 and NULL means; windows over the ends of a document see a border token;
repeated rows are counted and scored each, and learnt once; words are runs of bytes without white space, A-Z in lower case; an empty table gives
an empty table; other columns stay as they are (score columns replace columns of the same name).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.words import Words, find_words, keep_memory, one_thread, release, slices, small_batches, word_hashes
from corpusloom.operators.skew import spread_join
from corpusloom.session import pin

HEAD = 4096
CLASS_WORDS = 64
SHAPES = 16
#: words whose counts every task holds (17 bytes each); rarer ones are joined
KNOWN = 1 << 18
#: counts a task gathers before it gives them on
HELD = 400_000
#: most frequent tokens whose neighbourhood makes the classes
COMPANY = 64
SPAN = 2
HIDDEN = 24
ROUNDS = 2
BATCH = 4096
RATE = 0.15
SHARD_TOKENS = 1_000_000
#: tokens of whole texts that a worker trains on at a time
CHUNK = 1 << 15
#: digests a task remembers so as to give a text once
SEEN = 200_000
#: pseudo count of every word of a shape
ALPHA = 0.5
FLOOR = 100_000
#: logits up to this size have exponentials in float32
REACH = 80

_OFFSETS = np.array([o for o in range(-SPAN, SPAN + 1) if o])
_COUNTS = "h long, shape int, n long"


# ---- words

_LENGTHS = np.array([0, 0, 0, 0, 1, 1, 1, 2, 2, 2, 3]) * 4
_KINDS = np.full(256, 3)
_KINDS[97:123] = 1
_KINDS[list(b"aeiou")] = 0
_KINDS[48:58] = 2


def shapes_of(words: Words) -> np.ndarray:
    """Length (to 3, 6, 9 and more bytes) and last byte (vowel, other letter, digit, any other) of every word."""
    return _LENGTHS.take(words.end - words.start, mode="clip") + _KINDS.take(words.buf.take(words.end - 1))


def _summed(h: np.ndarray, shape: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, their shapes and sums of ``n`` (None: 1 each)."""
    order = np.argsort(h)
    h = h.take(order)
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])[:len(h)])
    sums = np.diff(first, append=len(h)) if n is None else np.add.reduceat(n.take(order), first) if len(first) else n
    return h.take(first), shape.take(order.take(first)), sums


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, shape, n) of every distinct word of the column, summed in the tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return _summed(*[np.concatenate(x) for x in zip(*held)])

        def given(h: np.ndarray, shape: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(shape, pa.int32()), pa.array(n)], names=["h", "shape", "n"])

        for batch in batches:
            for _, _, buf, offsets in slices(batch.column(0)):
                words = find_words(buf, offsets, lower=True)
                held.append(_summed(word_hashes(words), shapes_of(words)))
                size += len(held[-1][0])
                if size >= HELD:
                    held = [merged()]
                    size = len(held[0][0])
                    if size >= HELD // 2:
                        yield given(*held[0])
                        held, size = [], 0
        if held:
            yield given(*merged())

    return texts.mapInArrow(run, _COUNTS).groupBy("h").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """Known words in the order of their hashes, their counts and tokens; per shape the counts of all words beside the head."""

    hashes: np.ndarray
    n: np.ndarray
    token: np.ndarray
    head_n: np.ndarray
    shape_n: np.ndarray
    shape_words: np.ndarray
    _index: tuple | None = None  # made in each process, at the first look-up

    @property
    def head(self) -> int:
        return len(self.head_n)

    @property
    def border(self) -> int:
        return self.head + SHAPES

    @classmethod
    def of(cls, counts: DataFrame, head: int, known: int) -> Lexicon:
        """From the pinned table of all words; the driver receives at most ``known`` of them, whole classes of like counts."""
        bucket = F.floor(F.log2("n") * 16).cast("int")
        levels = counts.groupBy(bucket.alias("bucket")).count().collect()  # some hundred rows
        least, total = None, 0
        for row in sorted(levels, reverse=True):
            total += row["count"]
            if total > known:
                break
            least = row.bucket
        rows = counts.where(bucket >= least if least is not None else F.lit(False)).toArrow()
        h = rows.column("h").to_numpy().view(np.uint64)
        n, shape = rows.column("n").to_numpy(), rows.column("shape").to_numpy()
        order = np.lexsort((h, -n))
        h, n, shape = h[order], n[order], shape[order]
        size = min(head, len(h))
        token = np.where(np.arange(len(h)) < size, np.arange(len(h)), size + shape).astype(np.uint16)
        by_hash = np.argsort(h)
        shape_n, shape_words = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for row in counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
            shape_n[row.shape], shape_words[row.shape] = row.n, row.words
        np.subtract.at(shape_n, shape[:size], n[:size])
        np.subtract.at(shape_words, shape[:size], 1)
        return cls(h[by_hash], n[by_hash], token[by_hash], n[:size].astype(np.int64), shape_n, shape_words)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """As np.searchsorted: hashes are uniform, so their leading bits lead to the place or just before it."""
        if self._index is None:
            bits = max(1, (2 * len(self.hashes)).bit_length())
            starts = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)
            self._index = np.uint64(64 - bits), starts, np.append(self.hashes, np.uint64(2**64 - 1))
        shift, starts, closed = self._index
        at = starts.take((hashes >> shift).view(np.int64))
        open_ = np.flatnonzero(closed.take(at) < hashes)
        while len(open_):
            at[open_] += 1
            open_ = open_[closed[at[open_]] < hashes[open_]]
        return at

    def tokens(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token of every word, and its count where it is known, else 0."""
        shape = self.head + shapes_of(words)
        if not len(self.hashes):
            return shape.astype(np.uint16), np.zeros(len(hashes), np.int64)
        at = np.minimum(self._places(hashes), len(self.hashes) - 1)
        found = self.hashes.take(at) == hashes
        return np.where(found, self.token.take(at), shape.astype(np.uint16)), self.n.take(at) * found


def share(n, own, shape_n, shape_words):
    """Probability of a word within its shape by its other occurrences; of a word nobody else has, ALPHA's part."""
    return (n - own + ALPHA) / (shape_n - own + ALPHA * shape_words)


# ---- windows

def padded(tokens: np.ndarray, first: np.ndarray, border: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all documents with SPAN borders around each, and the place of every token in there."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = np.arange(len(tokens)) + SPAN * (doc + 1)
    out = np.full(len(tokens) + SPAN * len(first), border, np.uint16)
    out[place] = tokens
    return out, place


def company(distinct: DataFrame, head: int, border: int) -> np.ndarray:
    """How often each of the most frequent tokens stands left and right of every head word, over all distinct texts."""
    width = min(COMPANY, head)
    blocks = 64
    rows_of = np.array_split(np.arange(head), blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(head * 2 * width, np.int64)
        for batch in batches:
            texts = [np.frombuffer(raw.as_buffer(), np.uint16) for raw in batch.column("tokens")]
            if not texts:
                continue
            tokens, ends = np.concatenate(texts), np.cumsum([len(x) for x in texts])
            ends = ends[(ends > 0) & (ends < len(tokens))]
            for side, (own, near) in enumerate(((tokens[1:], tokens[:-1]), (tokens[:-1], tokens[1:]))):
                ok = (own < head) & (near < width)
                ok[ends - 1] = False  # neighbours in two texts
                ok = np.flatnonzero(ok)
                np.add.at(total, (own.take(ok).astype(np.int64) * 2 + side) * width + near.take(ok), 1)
        if total.any():
            table = total.reshape(head, -1)
            parts = [table[r[0]:r[-1] + 1].tobytes() if len(r) else b"" for r in rows_of]
            yield pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array(parts, pa.binary())], names=["part", "total"])

    out = np.zeros((head, 2 * width))
    for part, (_, total) in _added(distinct.select("tokens").mapInArrow(run, "part int, total binary").withColumn("weight", F.lit(1.0)), np.int64).items():
        if len(rows_of[part]):
            out[rows_of[part]] = total.reshape(-1, 2 * width)
    return out


def _added(rows: DataFrame, kind: type) -> dict[int, tuple[float, np.ndarray]]:
    """Sums of the rows (part, weight, total) by part, added in a streaming step of each partition."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[float, np.ndarray]] = {}
        for batch in batches:
            for part, weight, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = np.frombuffer(raw.as_buffer(), kind)
                old = sums.get(part, (0.0, 0))
                sums[part] = (old[0] + weight, old[1] + found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([w for w, _ in sums.values()], pa.float64()),
             pa.array([x.tobytes() for _, x in sums.values()], pa.binary())], names=["part", "weight", "total"])

    found = rows.select("part", "weight", "total").repartition("part").mapInArrow(add, "part int, weight double, total binary").collect()
    return {r.part: (r.weight, np.frombuffer(r.total, kind)) for r in found}


def classes_of(counts: np.ndarray) -> list[np.ndarray]:
    """Head words in classes of at most CLASS_WORDS with like neighbours, halved at the median of the widest direction."""
    if not len(counts):
        return []
    rates = np.sqrt((counts + 1e-3) / (counts + 1e-3).sum(axis=1, keepdims=True))
    rates -= rates.mean(axis=0)
    values, vectors = np.linalg.eigh(rates.T @ rates)
    points = rates @ vectors[:, np.argsort(-values)[:16]]
    out, open_ = [], [np.arange(len(counts))]
    while open_:
        rows = open_.pop()
        if len(rows) <= CLASS_WORDS:
            out.append(np.sort(rows))
            continue
        own = points[rows] - points[rows].mean(axis=0)
        order = rows[np.lexsort((rows, points[rows, np.argmax(own.var(axis=0))]))]
        open_ += [order[len(order) // 2:], order[:len(order) // 2]]
    return out


# ---- network

@dataclass
class Network:
    """Token vectors, weights of the positions, and the outputs: classes and shapes, and words within a class."""

    vectors: np.ndarray  # tokens x hidden
    near: np.ndarray  # positions x hidden
    inner: np.ndarray  # hidden
    out: np.ndarray  # hidden x (classes + shapes)
    bias: np.ndarray  # classes + shapes
    words: np.ndarray  # classes x hidden x words of a class
    word_bias: np.ndarray  # classes x words of a class
    group: np.ndarray  # class or, behind these, shape of every token; fixed
    member: np.ndarray  # number of a head word within its class; fixed

    LEARNT = ("vectors", "near", "inner", "out", "bias", "words", "word_bias")

    @classmethod
    def start(cls, classes: list[np.ndarray], lexicon: Lexicon, seed: int) -> Network:
        """Random vectors; the biases give every word its share of the corpus."""
        rng = np.random.default_rng(seed)
        head, k = lexicon.head, len(classes)
        group, member = np.zeros(head + SHAPES, np.int64), np.zeros(head, np.int64)
        group[head:] = k + np.arange(SHAPES)
        word_bias = np.full((k, CLASS_WORDS), -1e4, np.float32)  # no word there
        sums = np.zeros(k + SHAPES)
        for c, rows in enumerate(classes):
            group[rows], member[rows] = c, np.arange(len(rows))
            n = lexicon.head_n[rows].astype(float)
            word_bias[c, :len(rows)] = np.log(n / n.sum())
            sums[c] = n.sum()
        sums[k:] = lexicon.shape_n
        bias = np.log((sums + ALPHA) / (sums + ALPHA).sum())
        normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return cls(normal(head + SHAPES + 1, HIDDEN), np.ones((len(_OFFSETS), HIDDEN), np.float32) + normal(len(_OFFSETS), HIDDEN),
                   np.zeros(HIDDEN, np.float32), np.zeros((HIDDEN, k + SHAPES), np.float32), bias.astype(np.float32),
                   np.zeros((k, HIDDEN, CLASS_WORDS), np.float32), word_bias, group, member)

    def pack(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).reshape(-1) for name in self.LEARNT]).astype(np.float64)

    def unpack(self, flat: np.ndarray) -> Network:
        """A network of this form with other learnt parameters."""
        parts, i = [], 0
        for name in self.LEARNT:
            old = getattr(self, name)
            parts.append(flat[i:i + old.size].reshape(old.shape).astype(np.float32))
            i += old.size
        return Network(*parts, self.group, self.member)

    def hidden(self, context: np.ndarray) -> np.ndarray:
        """Hidden rows, with a one behind them that meets the bias."""
        total = np.repeat(self.inner[None], len(context), axis=0)
        for p in range(len(_OFFSETS)):
            own = self.vectors.take(context[:, p], axis=0)
            total += _times(own, self.near[p], out=own)
        out = np.empty((len(context), HIDDEN + 1), np.float32)
        out[:, HIDDEN] = 1
        out[:, :HIDDEN] = np.tanh(total, out=total)
        return out

    def by_class(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Rows of the targets that are head words in the order of their classes, member of each, and (class, first, end) of the runs."""
        group = self.group[target]
        rows = np.flatnonzero(group < len(self.words))
        rows = rows[np.argsort(group[rows].astype(np.uint16), kind="stable")]
        of = group[rows]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(rows)]]) if len(rows) else np.zeros(1, np.int64)
        return rows, self.member[target[rows]], list(zip(of[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist()))

    def outer(self, hidden: np.ndarray) -> np.ndarray:
        """Logits of the classes and shapes."""
        return hidden @ np.concatenate([self.out, self.bias[None]])

    def within(self, own: np.ndarray, runs: list[tuple[int, int, int]]) -> np.ndarray:
        """Logits of the words of their classes, for hidden rows in the order of the classes."""
        logits = np.empty((len(own), CLASS_WORDS), np.float32)
        words = np.concatenate([self.words, self.word_bias[:, None]], axis=1)
        for c, a, b in runs:
            np.matmul(own[a:b], words[c], out=logits[a:b])
        return logits

    def logs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of every target token: of a head word, or of the shape of any other."""
        hidden = self.hidden(context)
        out = _log_softmax(self.outer(hidden), self.group[target]).astype(np.float64)
        rows, members, runs = self.by_class(target)
        out[rows] += _log_softmax(self.within(hidden.take(rows, axis=0), runs), members)
        return out


def _times(rows: np.ndarray, by: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Every row times ``by``, eight rows at a time: numpy is slow over short rows. Arrays without gaps."""
    n, width = len(rows) // 8 * 8, 8 * len(by)
    np.multiply(rows[:n].reshape(-1, width), np.tile(by, 8), out=out[:n].reshape(-1, width))
    np.multiply(rows[n:], by, out=out[n:])
    return out


def _row_max(x: np.ndarray) -> np.ndarray:
    """The largest value of every row, by halves: many times faster than a maximum along short rows."""
    while x.shape[1] > 1:
        half = (x.shape[1] + 1) // 2
        x = np.maximum(x[:, :half], x[:, -half:])
    return x


def _exponentials(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(logit of the target, sum of the exponentials) of every row; the logits become the exponentials.

    Rows are shifted by their largest logit only if it may be beyond what float32 holds: it is not below that of the target.
    """
    rows = np.arange(len(target))
    own = logits[rows, target]
    if len(rows) and not (logits.max() < REACH and own.min() > -REACH):
        logits -= _row_max(logits)
        own = logits[rows, target]
    np.exp(logits, out=logits)
    return own, logits @ np.ones(logits.shape[1], np.float32)


def _log_softmax(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of one target in each row; the logits are overwritten."""
    own, sums = _exponentials(logits, target)
    return own - np.log(sums)


def _softmax_error(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gradient of the log probability of the targets by the logits."""
    logits *= (-1 / _exponentials(logits, target)[1])[:, None]
    logits[np.arange(len(target)), target] += 1
    return logits


class Trainer:
    """Steps up the mean log probability with a rate for every parameter that falls with the gradients it has seen."""

    def __init__(self, network: Network) -> None:
        self.network = network
        self.seen = {name: np.full(getattr(network, name).shape[:1] if name == "vectors" else getattr(network, name).shape, 1e-6, np.float32) for name in network.LEARNT}

    def _move(self, name: str, at, gradient: np.ndarray) -> None:
        seen, own = self.seen[name], getattr(self.network, name)
        if name == "vectors":
            seen[at] += np.einsum("ij,ij->i", gradient, gradient) / HIDDEN
            own[at] += gradient * (RATE / np.sqrt(seen[at]))[:, None]
            return
        scale = gradient * gradient
        seen += scale
        np.sqrt(seen, out=scale)
        np.divide(gradient, scale, out=scale)
        scale *= RATE
        own += scale

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        net, n = self.network, len(target)
        hidden = net.hidden(context)
        error = _softmax_error(net.outer(hidden), net.group[target])
        back = error @ net.out.T
        words = np.zeros((len(net.words), HIDDEN + 1, CLASS_WORDS), np.float32)
        rows, members, runs = net.by_class(target)
        own = hidden.take(rows, axis=0)
        within = _softmax_error(net.within(own, runs), members)
        inner = np.empty((len(rows), HIDDEN), np.float32)
        for c, a, b in runs:
            np.matmul(within[a:b], net.words[c].T, out=inner[a:b])
            np.matmul(own[a:b].T, within[a:b], out=words[c])
        back[rows] += inner
        words /= n
        self._move("words", ..., words[:, :HIDDEN])
        self._move("word_bias", ..., words[:, HIDDEN])
        out = hidden.T @ error
        out /= n
        self._move("out", ..., out[:HIDDEN])
        self._move("bias", ..., out[HIDDEN])
        slope = hidden[:, :HIDDEN]
        back *= (1 - slope * slope) / n
        self._move("inner", ..., np.ones(n, np.float32) @ back)
        near = np.stack([np.einsum("ij,ij->j", back, net.vectors.take(context[:, p], axis=0)) for p in range(len(_OFFSETS))])
        flat = context.T.reshape(-1).astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        sums = np.empty((len(_OFFSETS), n, HIDDEN), np.float32)
        for p in range(len(_OFFSETS)):
            _times(back, net.near[p], out=sums[p])
        # two values at a time: complex numbers add up as pairs
        sums = np.add.reduceat(sums.reshape(-1, HIDDEN).take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
        self._move("vectors", flat[first].astype(np.int64), sums)
        self._move("near", ..., near)


def _digests(words: Words, hashes: np.ndarray) -> list[bytes]:
    raw = hashes.tobytes()
    return [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]


def distinct_texts(texts: DataFrame, lexicon, shards: int) -> DataFrame:
    """(shard, key, tokens, rare) of every distinct sequence of words, in the order of keys within the shards; pinned.

    ``rare`` holds the hashes of its words that the tasks do not know.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        seen: set[bytes] = set()
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column(0)):
                words = find_words(buf, offsets, lower=True)
                hashes = word_hashes(words)
                tokens, n = lexicon.value.tokens(words, hashes)
                keys, rows, rare = [], [], []
                for key, a, b in zip(_digests(words, hashes), words.first[:-1].tolist(), words.first[1:].tolist()):
                    if b > a and key not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(key)
                        keys.append(key)
                        rows.append(tokens[a:b].tobytes())
                        rare.append(hashes[a:b][n[a:b] == 0].tobytes())
                shard = [int.from_bytes(k[:8], "little") % shards for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int64()), pa.array(keys, pa.binary()), pa.array(rows, pa.binary()), pa.array(rare, pa.binary())], names=["shard", "key", "tokens", "rare"])

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            take = []
            for i, key in enumerate(batch.column(1).to_pylist()):
                if key != last:
                    take.append(i)
                last = key
            yield batch.take(pa.array(take, pa.int64()))

    schema = "shard long, key binary, tokens binary, rare binary"
    return pin(texts.mapInArrow(run, schema).repartition("shard").sortWithinPartitions("shard", "key").mapInArrow(once, schema))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, tokens, first token of each text) of runs of whole texts of one shard, CHUNK tokens or one text more."""
    shard, held, size = None, [], 0
    for batch in batches:
        for own, raw in zip(batch.column(0).to_pylist(), batch.column(2)):
            tokens = np.frombuffer(raw.as_buffer(), np.uint16)
            if held and (own != shard or size >= CHUNK):
                yield shard, np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])
                held, size = [], 0
            shard = own
            held.append(tokens)
            size += len(tokens)
    if held:
        yield shard, np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])


def train(distinct: DataFrame, network: Network, border: int, seed: int) -> Network:
    """Rounds of steps within the shards and averaging; a task adds up its shards, and sums meet in a streaming step."""
    sc = distinct.sparkSession.sparkContext
    parts = 64
    for number in range(ROUNDS):
        shared = sc.broadcast(network)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            one_thread()
            keep_memory()
            total, weight = None, 0
            shard, own, targets = None, None, 0

            def close() -> None:
                nonlocal total, weight
                if targets:
                    found = own.network.pack() * targets
                    total = found if total is None else total + found
                    weight += targets

            for at, tokens, first in _chunks(batches):
                if at != shard:
                    close()
                    shard, targets, own = at, 0, Trainer(shared.value.unpack(shared.value.pack()))
                    rng = np.random.default_rng([seed, number, at])
                row, place = padded(tokens, first, border)
                position = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
                chosen = np.flatnonzero((position + number) % ROUNDS == 0)
                rng.shuffle(chosen)
                for i in range(0, len(chosen), BATCH):
                    rows = chosen[i:i + BATCH]
                    own.step(row[place[rows][:, None] + _OFFSETS], tokens[rows])
                targets += len(chosen)
            close()
            release()
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(parts), pa.int32()), pa.array([float(weight)] * parts), pa.array([x.tobytes() for x in np.array_split(total, parts)], pa.binary())],
                    names=["part", "weight", "total"])

        dealt = distinct.select("shard", "key", "tokens").repartition("shard").sortWithinPartitions("shard", "key")
        found = _added(dealt.mapInArrow(run, "part int, weight double, total binary"), np.float64)
        if found:
            network = network.unpack(np.concatenate([found[p][1] / found[p][0] for p in range(parts)]))
    return network


# ---- scores

def _runs(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of one occurrence, number of occurrences) of the words of each document."""
    # numpy sorts short integers by their digits, in linear time
    doc = doc.astype(np.uint16 if not len(doc) or doc.max() < 1 << 16 else np.int64)
    order = np.argsort(hashes)
    order = order.take(np.argsort(doc.take(order), kind="stable"))
    d, h = doc.take(order), hashes.take(order)
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (h[1:] != h[:-1])])[:len(d)])
    return order[first], np.diff(np.append(first, len(d)))


def _rare_rows(distinct: DataFrame) -> DataFrame:
    """(h, key, c) of the words that the tasks do not know, once per distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(raw.as_buffer(), np.uint64) for raw in batch.column(1)]
            if found:
                doc, hashes = np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found)
                one, c = _runs(doc, hashes)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[one].view(np.int64)), batch.column(0).take(pa.array(doc[one])), pa.array(c, pa.int64())], names=["h", "key", "c"])

    return distinct.where(F.length("rare") > 0).select("key", "rare").mapInArrow(run, "h long, key binary, c long")


def _rare_sums(distinct: DataFrame, counts: DataFrame, shape_n: list[int], shape_words: list[int]) -> DataFrame:
    """Per text (key): log shares and number of unseen words among those that tasks do not know, from the table.

    No word of it is hot: each is rarer than every one of the KNOWN words.
    """
    rows = _rare_rows(distinct)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("shape") + 1)
    logs = F.col("c") * F.log(share(F.col("n"), F.col("c"), pick(shape_n), pick(shape_words)))
    return rows.join(counts, "h").groupBy("key").agg(
        F.sum(logs).alias("_rare"), F.sum(F.when(F.col("n") == F.col("c"), F.col("c")).otherwise(0)).alias("_unseen"))


def pseudo_likelihood(
    docs: DataFrame, text: str = "text", carry: list[str] | None = None, seed: int = 9, head: int = HEAD, known: int = KNOWN, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """The columns ``carry`` (None: all) of ``docs`` with ``n_words``, ``n_unseen`` (words no other row has), ``pseudo_log_likelihood``
    (natural log, summed over the words), ``mean_log_probability`` and ``unseen_share``.

    The model is trained on all rows of ``docs`` while the plan is built.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(text)
    counts = pin(word_counts(texts))
    own = Lexicon.of(counts, head, known)
    lexicon = spark.sparkContext.broadcast(own)
    total = int(own.head_n.sum() + own.shape_n.sum())
    distinct = distinct_texts(texts, lexicon, max(1, total // shard_tokens))
    classes = classes_of(company(distinct, own.head, own.border)) if own.head else []
    network = train(distinct, Network.start(classes, own, seed), own.border, seed)
    shared = spark.sparkContext.broadcast(network)

    new = ("n_words", "n_unseen", "pseudo_log_likelihood", "mean_log_probability", "unseen_share")
    names = docs.columns if carry is None else carry
    keep = [c for c in names if c.lower() not in new]
    kept = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*kept, T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("seen", T.LongType()), T.StructField("logs", T.DoubleType())])
    rows = docs.select(F.col(text).alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_thread()
        keep_memory()
        lex, net = lexicon.value, shared.value
        for batch in batches:
            for i, j, buf, offsets in slices(batch.column(0)):
                words = find_words(buf, offsets, lower=True)
                hashes = word_hashes(words)
                tokens, n = lex.tokens(words, hashes)
                row, place = padded(tokens, words.first, lex.border)
                logs = np.zeros(len(tokens))
                for a in range(0, len(tokens), BATCH):
                    b = min(a + BATCH, len(tokens))
                    logs[a:b] = net.logs(row[place[a:b, None] + _OFFSETS], tokens[a:b])
                # shares of the words of shapes, without the document's own occurrences
                shaped = np.flatnonzero((tokens >= lex.head) & (n > 0))
                doc = words.doc()[shaped]
                one, c = _runs(doc, hashes[shaped])
                at = shaped[one]
                shape = tokens[at].astype(np.int64) - lex.head
                more = c * np.log(share(n[at], c, lex.shape_n[shape], lex.shape_words[shape]))
                size = len(words.counts)
                known_logs = np.bincount(doc[one], more, size)
                unseen = np.bincount(doc[one], np.where(n[at] == c, c, 0), size).astype(np.int64)
                ends = np.concatenate([[0.0], np.cumsum(logs)])
                sums = np.where(words.counts > 0, ends[words.first[1:]] - ends[words.first[:-1]], 0.0) + known_logs
                # only texts with words beyond the known ones have a key
                rare = np.bincount(words.doc()[n == 0], minlength=size) > 0
                keys = [k if r else None for k, r in zip(_digests(words, hashes), rare.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k + 1).slice(i, j - i) for k in range(len(keep))]
                    + [pa.array(keys, pa.binary()), pa.array(words.counts), pa.array(unseen), pa.array(sums)], names=schema.fieldNames())

    scored = pin(rows.mapInArrow(run, schema).withColumn("nonce", F.monotonically_increasing_id()))
    rare = pin(_rare_sums(distinct, counts, own.shape_n.tolist(), own.shape_words.tolist()))
    plain, joined = scored.where("key is null"), scored.where("key is not null")
    none = plain.select("*", F.lit(0.0).alias("_rare"), F.lit(0).cast("long").alias("_unseen"))
    whole = none.unionByName(spread_join(joined, rare, "key", floor=FLOOR).select(none.columns))
    words, logs = F.col("n"), F.col("logs") + F.col("_rare")
    unseen = F.col("seen") + F.col("_unseen")
    return whole.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
        words.alias(new[0]), unseen.alias(new[1]), logs.alias(new[2]),
        F.when(words > 0, logs / words).alias(new[3]), F.when(words > 0, unseen / words).alias(new[4]))
