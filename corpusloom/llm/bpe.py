"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is split by the tokenizer's pattern into pieces; each piece is merged on its own. Over the
byte positions of a piece stands a segment tree whose leaf i holds the rank of the pair made of the
live token at i and its live right neighbour, joined with i, so that the root is the leftmost
minimum. A merge replaces the token at the root's position, unlinks the right neighbour and
updates three leaves (merged position, vanished neighbour, left neighbour) and their ancestors: a
logarithmic number of nodes. Short pieces of a batch are merged side by side in numpy, one merge of
each piece per step; long pieces one at a time on the same tree.

Tokens of distinct pieces are kept in a cache of bounded size per Python worker.

Defined cases: NULL and empty texts have no tokens (an empty list); a repeated row is encoded again;
other columns, of any name, stay as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.words import slices

#: distinct pieces a Python worker remembers; then it starts afresh
CACHE_PIECES = 400_000
#: bytes of a piece up to which pieces are merged side by side
SIDE_BY_SIDE = 64
_NONE = np.int64(1) << np.int64(62)


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of every token, from a file of base64 tokens and decimal ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Encode and decode with the ranks of one vocabulary; token ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size + 1, np.int64)
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
            lengths[rank + 1] = len(token)
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.cumsum(lengths)
        pairs = {
            (ranks[token[:i]] << 32 | ranks[token[i:]]): rank
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        }
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)
        self.pairs = pairs
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.n = np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, np.int32)
        self.used = 0

    # merging

    def _leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and position of pairs as one number; no number below _NONE where the pair has no rank."""
        key = left << np.int64(32) | right
        i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[i] == key, self.pair_rank[i] << np.int64(32) | at, _NONE)

    def merge_many(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Tokens of pieces of 2 to ``width`` bytes (a power of two)."""
        m = len(pieces)
        size = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
        at = np.arange(width, dtype=np.int64)
        live = at[None, :] < size[:, None]
        token = np.where(live, self.of_byte[raw], -1)
        # one column more on the right: the end of the piece, a token that pairs with nothing
        token = np.concatenate([token, np.full((m, 1), -1, np.int64)], axis=1)
        follow = np.minimum(at[None, :] + 1, size[:, None])
        follow = np.where(at[None, :] + 1 < size[:, None], follow, width)
        before = np.tile(np.append(at - 1, 0), (m, 1))
        tree = np.full((m, 2 * width), _NONE, np.int64)
        pair = live[:, 1:]
        r, c = np.nonzero(pair)
        tree[r, width + c] = self._leaf(token[r, c], token[r, c + 1], c)
        level = width
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            root = tree[rows, 1]
            here = root & np.int64(0xFFFFFFFF)
            merged = root >> np.int64(32)
            gone = follow[rows, here]
            after = follow[rows, gone]
            left = before[rows, here]
            token[rows, here] = merged
            token[rows, gone] = -1
            follow[rows, here] = after
            before[rows, after] = here
            tree[rows, width + here] = self._leaf(merged, token[rows, after], here)
            tree[rows, width + gone] = _NONE
            some = left >= 0
            lrows, left = rows[some], left[some]
            tree[lrows, width + left] = self._leaf(token[lrows, left], merged[some], left)
            nodes = np.concatenate([width + here, width + gone, width + left])
            of = np.concatenate([rows, rows, lrows])
            step = width
            while step > 1:
                nodes = nodes >> 1
                tree[of, nodes] = np.minimum(tree[of, 2 * nodes], tree[of, 2 * nodes + 1])
                step //= 2
            rows = rows[tree[rows, 1] < _NONE]
        token = token[:, :width]
        keep = token >= 0
        return np.split(token[keep].astype(np.int32), np.cumsum(keep.sum(axis=1))[:-1])

    def merge_one(self, piece: bytes) -> list[int]:
        """Tokens of one piece of any length."""
        n = len(piece)
        width = 1 << max(0, (n - 1).bit_length())
        none, pairs = int(_NONE), self.pairs
        token = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        follow, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)

        def leaf(i: int) -> int:
            if i < 0 or follow[i] >= n:
                return none
            rank = pairs.get(token[i] << 32 | token[follow[i]])
            return none if rank is None else rank << 32 | i

        for i in range(n):
            tree[width + i] = leaf(i)
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while n > 1 and tree[1] < none:
            here, merged = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            gone = follow[here]
            token[here], token[gone] = merged, -1
            follow[here] = follow[gone]
            if follow[here] < n:
                before[follow[here]] = here
            for i, value in ((here, leaf(here)), (gone, none), (before[here], leaf(before[here]))):
                if i < 0:
                    continue
                node = width + i
                tree[node] = value
                while node > 1:
                    node >>= 1
                    tree[node] = min(tree[2 * node], tree[2 * node + 1])
        return [t for t in token if t >= 0]

    # cache of pieces

    def _add(self, pieces: list[str]) -> None:
        """Put pieces into the cache."""
        whole, groups = [], {}
        for piece in pieces:
            raw = piece.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                whole.append((piece, [rank]))
            elif len(raw) > SIDE_BY_SIDE:
                whole.append((piece, self.merge_one(raw)))
            else:
                groups.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for width, found in groups.items():
            for i in range(0, len(found), 8192):
                part = found[i:i + 8192]
                whole.extend(zip([p for p, _ in part], self.merge_many([raw for _, raw in part], width)))
        lengths = np.fromiter((len(ids) for _, ids in whole), np.int64, len(whole))
        total, first = int(lengths.sum()), len(self.slot)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while first + len(whole) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.n = np.concatenate([self.n, np.zeros_like(self.n)])
        if whole:
            self.pool[self.used:self.used + total] = np.concatenate([np.asarray(ids, np.int32) for _, ids in whole])
            self.n[first:first + len(whole)] = lengths
            self.at[first:first + len(whole)] = self.used + np.cumsum(lengths) - lengths
        self.used += total
        self.slot.update(zip([p for p, _ in whole], range(first, first + len(whole))))

    # whole texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the texts in one array, and the number of tokens of each text."""
        if len(self.slot) > CACHE_PIECES:
            self._forget()
        pieces, per_text = [], []
        for text in texts:
            found = self.split(text)
            pieces += found
            per_text.append(len(found))
        missing = list(set(pieces).difference(self.slot))
        if missing:
            self._add(missing)
        slots = np.fromiter(map(self.slot.__getitem__, pieces), np.int64, len(pieces))
        ids = gather(self.pool, self.at[slots], self.n[slots])
        ends = np.concatenate([[0], np.cumsum(self.n[slots], dtype=np.int64)])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(per_text, dtype=np.int64)])])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens in one array, and the number of bytes of each token."""
        ids = ids.astype(np.int64)
        lengths = self.token_at[ids + 1] - self.token_at[ids]
        return gather(self.token_bytes, self.token_at[ids], lengths), lengths


def gather(values: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that start at ``at``, one after another."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    index = np.repeat(at - (ends - lengths), lengths)
    index += np.arange(total)
    return values[index]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file; tasks of one Python worker share it."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front while a column has that name."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted


def bpe_encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
               decoded: str | None = None) -> DataFrame:
    """Add the column ``ids`` (array of token ids) of the whole texts; existing columns of that name are replaced.

    With ``decoded`` the ids are decoded again in the same pass into that binary column. A narrow step: no shuffle.
    ``path`` is the rank file, which every executor must have at that place.
    """
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        added.append(T.StructField(decoded, T.BinaryType(), False))
    new = {f.name.lower() for f in added}
    source = df.columns.index(text)
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in new]
    schema = T.StructType([df.schema[i] for i in keep] + added)
    positions = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            column = batch.column(source)
            for i, j, _, _ in slices(column):
                texts = [x or "" for x in column.slice(i, j - i).to_pylist()]
                tokens, counts = enc.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = [batch.column(k).slice(i, j - i) for k in keep]
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens)))
                if decoded:
                    raw, lengths = enc.decode(tokens)
                    ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].astype(np.int32)
                    out.append(pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(raw)]))
                yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return positions.mapInArrow(run, schema)


def bpe_decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the binary column ``decoded``: the bytes of the tokens in the array column ``ids``; NULL arrays give no bytes."""
    source = df.columns.index(ids)
    keep = [i for i, c in enumerate(df.columns) if c.lower() != decoded.lower()]
    schema = T.StructType([df.schema[i] for i in keep] + [T.StructField(decoded, T.BinaryType(), False)])
    positions = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for batch in batches:
            lists = [np.asarray(x or [], np.int64) for x in batch.column(source).to_pylist()]
            raw = [enc.decode(x)[0].tobytes() for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(raw, pa.binary())], names=schema.fieldNames())

    return positions.mapInArrow(run, schema)
