"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file is read here; no tokenizer library takes part. A text gets the dummy blank in front, blanks become
U+2581, and what lies between two places where no piece of the vocabulary can cross is a *word*. The characters of
all distinct new words of a slice of texts stand in one flat numpy array of symbols. In each round

1. a segmented minimum gives each word the best rank of its pairs of neighbours (a pair has the rank of the piece
   its joined text is; equal scores share a rank),
2. the leftmost pairs of that rank are merged in all words at once,
3. the arrays are compacted, the ranks next to a merge looked up again, and words without a pair leave.

Within a word one pair at a time counts as merged, from the left. Several can be merged in one round where that cannot
be told apart: if no pair with the merged piece is as good as the merge itself (known per piece from the
vocabulary), all that do not overlap; else the leftmost of each group of pairs that lies further from the next group than
pieces can reach. So rounds are few but for long runs of one repeated sign whose merges allow no second one at once: such a word of
n signs takes about n rounds over its own symbols.

Symbols that are no piece become their bytes. Ids of distinct words are kept per Python worker; when the store is full, the
words of the last slice stay.

Defined cases: NULL and empty texts have no ids and decode to the empty text; a repeated row is encoded again; other
columns, of any name, stay as they are; an empty table gives an empty table. U+2581 in a text is a blank, as in the
library. Decoding takes any ids: control pieces give nothing, bytes that are no UTF-8 give U+FFFD each, NULL arrays the
empty text, and ids outside the vocabulary fail.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.bpe import gather
from corpusloom.llm.words import slices

#: distinct words a Python worker remembers
CACHE_WORDS = 400_000
#: characters of new words that are merged side by side
MERGE_CHARS = 1 << 20

BLANK = "▁"
# kinds of pieces in the model file (fixed values of the format)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_NONE = np.int32(2**31 - 1)

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, raw[at:at + size]
        at += size


class PieceModel:
    """Vocabulary and settings of a model file, as far as BPE needs them."""

    def __init__(self, path: str):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.dummy_prefix, self.byte_fallback, self.unknown_surface = True, False, " ⁇ "
        plain, kind, escape = True, 1, 1
        with open(path, "rb") as file:
            raw = file.read()
        for number, value in _fields(raw):
            if number == 1:
                found = dict(_fields(value))
                self.pieces.append(found[1].decode())
                self.scores.append(struct.unpack("<f", found[2])[0] if 2 in found else 0.0)
                self.kinds.append(found.get(3, NORMAL))
            elif number == 2:
                spec = dict(_fields(value))
                kind = spec.get(3, 1)
                self.byte_fallback = bool(spec.get(35, 0)) or self.byte_fallback
                self.unknown_surface = spec[44].decode() if 44 in spec else self.unknown_surface
                plain = plain and not spec.get(24, 0)
            elif number == 3:
                spec = dict(_fields(value))
                self.dummy_prefix = bool(spec.get(3, 1))
                escape = spec.get(5, 1)
                plain = plain and not spec.get(2) and not spec.get(4, 1)
        if kind != 2 or not plain or not escape or {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError(f"{path}: only BPE models without normalisation, user-defined and unused pieces are supported")


class PieceEncoder:
    """Encode and decode with one model."""

    def __init__(self, path: str):
        model = self.model = PieceModel(path)
        normal = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        self.n_pieces = len(model.pieces)
        self.unknown = model.kinds.index(UNKNOWN)
        self.bytes = np.zeros(256, np.int32)
        for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
            if kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
        # characters that only occur inside pieces are symbols too, behind the pieces
        chars = sorted({c for p in normal for c in p})
        symbols = dict(normal)
        for c in chars:
            symbols.setdefault(c, self.n_pieces + len(symbols) - len(normal))
        self.of_char = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.of_char[ord(c)] = symbols[c]
        self.longest = max(map(len, normal), default=1)

        order = {s: r for r, s in enumerate(sorted({model.scores[i] for i in normal.values()}, reverse=True))}
        rank = {p: order[model.scores[i]] for p, i in normal.items()}
        pairs = {
            symbols[p[:k]] << 32 | symbols[p[k:]]: i
            for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols
        }
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_to = np.array([pairs[k] for k in self.pair_key.tolist()], np.int32)
        rank_of = np.full(self.n_pieces, _NONE, np.int32)
        rank_of[list(normal.values())] = [rank[p] for p in normal]
        self.pair_rank = rank_of[self.pair_to]
        # pieces after which a pair as good as the merge itself can appear beside them
        part = np.concatenate([self.pair_key >> 32, self.pair_key & 0xFFFFFFFF])
        whole = np.concatenate([self.pair_rank, self.pair_rank])
        inside = part < self.n_pieces
        better = np.zeros(self.n_pieces, bool)
        part, whole = part[inside], whole[inside]
        better[part[whole <= rank_of[part]]] = True
        self.risky = better

        crossing = any(BLANK in p.lstrip(BLANK) for p in normal)
        joined = {c for p in normal if len(p) > 1 for c in p}
        alone = re.escape("".join(chr(c) for c in range(128) if chr(c) not in joined))
        self.split = (lambda t: [t]) if crossing else re.compile(
            (f"[{alone}]|" if alone else "") + f"{BLANK}*[^{BLANK}{alone}]+|{BLANK}+").findall

        # decoding
        shown = {UNKNOWN: lambda p: model.unknown_surface, CONTROL: lambda p: "", BYTE: lambda p: ""}
        raw = [shown.get(k, lambda p: p.replace(BLANK, " "))(p).encode() for p, k in zip(model.pieces, model.kinds)]
        for b, i in enumerate(self.bytes.tolist()):
            if model.kinds[i] == BYTE:
                raw[i] = bytes([b])
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.leading_blank = np.array([p.startswith(BLANK) and k == NORMAL for p, k in zip(model.pieces, model.kinds)])
        self.shows = np.array([k != CONTROL for k in model.kinds])

        self.slot: dict[str, int] = {}
        self.at, self.n, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    # merging

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of pairs of symbols, and the piece they merge to."""
        if not len(self.pair_key):
            return np.full(len(left), _NONE, np.int32), np.zeros(len(left), np.int32)
        key = left.astype(np.int64) << 32 | right
        i = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[i] == key, self.pair_rank[i], _NONE), self.pair_to[i]

    def merge(self, char: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and the number of ids of each.

        ``char`` holds the code points of the words in one array, ``sizes`` their lengths (at least 1).
        """
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        symbol, pos = self.of_char[char], np.arange(len(char))
        rank, to = np.full(len(char), _NONE, np.int32), np.zeros(len(char), np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], to[inner] = self._look_up(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.minimum.reduceat(rank, begin)
            length = np.diff(np.append(begin, len(word)))
            if (best == _NONE).any():
                out = np.repeat(best == _NONE, length)
                done.append((word[out], symbol[out], pos[out]))
                stay = ~out
                word, symbol, pos, rank, to = word[stay], symbol[stay], pos[stay], rank[stay], to[stay]
                best, length = best[best < _NONE], length[best < _NONE]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(best, length))
            at = at[self._together(at, word[at], pos[at], to[at])]
            # merge, drop the right partners, look up the pairs on both sides
            symbol[at] = to[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            word, symbol, pos, rank, to = word[keep], symbol[keep], pos[keep], rank[keep], to[keep]
            at = at - np.arange(len(at))
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            last = changed + 1 >= len(word)
            follows = np.zeros(len(changed), bool)
            follows[~last] = word[changed[~last] + 1] == word[changed[~last]]
            rank[changed] = _NONE
            changed = changed[follows]
            rank[changed], to[changed] = self._look_up(symbol[changed], symbol[changed + 1])
        if not done:
            return np.zeros(0, np.int32), np.zeros(len(sizes), np.int64)
        word, symbol, pos = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return self._with_bytes(word[order], symbol[order], char[pos[order]], len(sizes))

    def _together(self, at: np.ndarray, word: np.ndarray, pos: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Which of the best pairs at ``at`` (ascending) can be merged in one round."""
        order = np.arange(len(at))
        new_word = np.concatenate([[True], word[1:] != word[:-1]])
        # overlapping pairs follow each other directly; from the left every second one is merged
        run = new_word | np.concatenate([[True], at[1:] != at[:-1] + 1])
        every_second = (order - np.maximum.accumulate(np.where(run, order, 0))) % 2 == 0
        begin = np.flatnonzero(new_word)
        careful = np.repeat(np.logical_or.reduceat(self.risky[to], begin), np.diff(np.append(begin, len(at))))
        far = np.concatenate([[True], np.diff(pos) > 3 * self.longest])
        return np.where(careful, new_word | far, every_second)

    def _with_bytes(self, word: np.ndarray, symbol: np.ndarray, char: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Put bytes, or the unknown piece once for a run, in the place of symbols that are no piece."""
        odd = (symbol < 0) | (symbol >= self.n_pieces)
        if odd.any():
            if self.model.byte_fallback:
                raw = [chr(c).encode("utf-8", "surrogatepass") for c in char[odd].tolist()]
                times = np.ones(len(symbol), np.int64)
                times[odd] = [len(x) for x in raw]
                filled = np.repeat(symbol, times)
                filled[np.repeat(odd, times)] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
                word, symbol = np.repeat(word, times), filled
            else:
                again = np.concatenate([[False], odd[1:] & odd[:-1] & (word[1:] == word[:-1])])
                symbol = np.where(odd, self.unknown, symbol)[~again]
                word = word[~again]
        return symbol.astype(np.int32), np.bincount(word, minlength=n)

    # words that are known

    def _add(self, words: list[str]) -> None:
        ids, counts = [self.pool], [self.n]
        i = 0
        while i < len(words):
            j, chars = i, 0
            while j < len(words) and (j == i or chars + len(words[j]) <= MERGE_CHARS):
                chars += len(words[j])
                j += 1
            flat = np.frombuffer("".join(words[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32)
            found, n = self.merge(flat, np.fromiter(map(len, words[i:j]), np.int64, j - i))
            ids.append(found)
            counts.append(n.astype(np.int32))
            i = j
        self.slot.update(zip(words, range(len(self.slot), len(self.slot) + len(words))))
        self.pool, self.n = np.concatenate(ids), np.concatenate(counts)
        ends = np.cumsum(self.n, dtype=np.int64)
        self.at = ends - self.n

    def _keep_only(self, words: set[str]) -> None:
        """Forget all words but those in ``words``."""
        kept = [w for w in words if w in self.slot]
        slots = np.fromiter(map(self.slot.__getitem__, kept), np.int64, len(kept))
        self.pool, self.n = gather(self.pool, self.at[slots], self.n[slots]), self.n[slots]
        self.at = np.cumsum(self.n, dtype=np.int64) - self.n
        self.slot = dict(zip(kept, range(len(kept))))

    # whole texts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the number of ids of each text."""
        words: list[str] = []
        per_text = []
        prefix = BLANK if self.model.dummy_prefix else ""
        for text in texts:
            found = self.split(prefix + text.replace(" ", BLANK)) if text else []
            words += found
            per_text.append(len(found))
        distinct = set(words)
        if len(self.slot) > CACHE_WORDS:
            self._keep_only(distinct)
        missing = list(distinct.difference(self.slot))
        if missing:
            self._add(missing)
        slots = np.fromiter(map(self.slot.__getitem__, words), np.int64, len(words))
        ids = gather(self.pool, self.at[slots], self.n[slots])
        ends = np.concatenate([[0], np.cumsum(self.n[slots], dtype=np.int64)])
        counts = np.diff(ends[np.concatenate([[0], np.cumsum(per_text, dtype=np.int64)])])
        if not self.model.byte_fallback:
            ids, counts = self._fold_unknown(ids, counts)
        return ids, counts

    def _fold_unknown(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One unknown piece for a run of them, also across words."""
        text = np.repeat(np.arange(len(counts)), counts)
        again = np.zeros(len(ids), bool)
        again[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text[1:] == text[:-1])
        return ids[~again], np.bincount(text[~again], minlength=len(counts))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of ids; ``counts`` are their lengths."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.n_pieces):
            raise ValueError(f"ids outside 0 to {self.n_pieces - 1}")
        lengths = self.token_at[ids + 1] - self.token_at[ids]
        raw = gather(self.token_bytes, self.token_at[ids], lengths).tobytes()
        byte_end = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.concatenate([[0], np.cumsum(counts)])
        # the first piece that shows anything loses the dummy blank
        shown = np.append(np.flatnonzero(self.shows[ids]), len(ids))
        first = shown[np.searchsorted(shown, ends[:-1])]
        has = first < ends[1:]
        strip = np.zeros(len(counts), bool)
        if self.model.dummy_prefix:
            strip[has] = self.leading_blank[ids[first[has]]]
        begin, end = byte_end[ends[:-1]] + strip, byte_end[ends[1:]]
        texts = [raw[a:b].decode("utf-8", "each_byte") for a, b in zip(begin.tolist(), end.tolist())]
        # bytes on both sides of a control piece never make one character
        cuts = byte_end[np.flatnonzero(~self.shows[ids])]
        if len(cuts):
            low, high = np.searchsorted(cuts, begin, "right"), np.searchsorted(cuts, end)
            for d in np.flatnonzero(low < high).tolist():
                edges = [begin[d], *cuts[low[d]:high[d]], end[d]]
                texts[d] = "".join(raw[a:b].decode("utf-8", "each_byte") for a, b in zip(edges[:-1], edges[1:]))
        return texts


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a model file; tasks of one Python worker share it."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _added(df: DataFrame, source: str, fields: list[T.StructField]) -> tuple[int, list[int], T.StructType]:
    """Position of the input column, positions of the columns that stay, and the schema of the output."""
    new = {f.name.lower() for f in fields}
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in new]
    return df.columns.index(source), keep, T.StructType([df.schema[i] for i in keep] + fields)


def piece_encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the column ``ids`` (array of piece ids) of the whole texts; existing columns of that name are replaced.

    With ``decoded`` the ids are decoded again in the same pass into that string column. A narrow step: no shuffle.
    ``path`` is the model file, which every executor must have at that place.
    """
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType(), False))
    source, keep, schema = _added(df, text, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(path)
        for batch in batches:
            column = batch.column(source)
            for i, j, _, _ in slices(column):
                found, counts = enc.encode([x or "" for x in column.slice(i, j - i).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                out = [batch.column(k).slice(i, j - i) for k in keep]
                out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(found)))
                if decoded:
                    out.append(pa.array(enc.decode(found, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)


def piece_decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the string column ``decoded``, the text of the ids in the array column ``ids``."""
    source, keep, schema = _added(df, ids, [T.StructField(decoded, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = piece_encoder(path)
        for batch in batches:
            lists = [x or [] for x in batch.column(source).to_pylist()]
            flat = np.array([i for x in lists for i in x], np.int64)
            texts = enc.decode(flat, np.fromiter(map(len, lists), np.int64, len(lists)))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(texts, pa.string())], names=schema.fieldNames())

    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(run, schema)
