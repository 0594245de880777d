"""Exact token counts of every prefix of a text by dynamic programming.

For every byte position i of a piece there is one token that ends the piece's encoding up to i. It
is the token t, ending at i, for which the last token of the encoding up to i - len(t) followed by t
stays as it is when the two are encoded together; its count is one more than that prefix's. The
table filled that way from left to right holds the exact count of every prefix, so that lengths,
truncation points and budgets are looked up and never encoded again.

Whether two neighbours stay apart needs no merging either: only the tokens that end at the border while
the left one grows, and those that start there while the right one grows, can meet. Both chains are stored with
the ranks at which they grow, and are walked in the order of these ranks.

Between pieces counts add up. Two ends of a prefix differ from the pieces of the whole text and have
their own rule: blanks at the end of a prefix form one piece (inside the text the last of them
joins the next word), and a contraction such as ``'ll`` cut after its first letter is two pieces.

Defined cases: NULL and empty texts count 0; a repeated row is counted again; other columns, of any
name, stay as they are; an empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.words import slices

#: distinct pieces, and pairs of tokens, a Python worker remembers, twice: the store before stays until the next is full
CACHE_PIECES = 300_000
CACHE_PAIRS = 500_000
#: bytes at the end of a token that tell how long it can be
ENDING = 4
_NEVER = 1 << 40


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file: printable Latin-1
    bytes stand for themselves, the others in order for the characters from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts of prefixes for one byte-level BPE vocabulary file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_alphabet()
        raw = lambda token: bytes(letters[c] for c in token)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.merge_rank = {(raw(a), raw(b)): i for i, (a, b) in reversed(list(enumerate(merges)))}
        self.special = sorted((t["content"] for t in spec.get("added_tokens") or []), key=len, reverse=True)
        self.find_special = regex.compile("|".join(map(regex.escape, self.special))).finditer if self.special else None
        self.split = regex.compile(pattern).findall
        # by token: its number and the chains of (rank at which the next one arises, number); a token that its own
        # bytes do not encode to can never end a prefix and is left out
        self.number: dict[bytes, int] = {}
        self.grows_right: list[list[tuple[int, int]]] = []  # tokens that start the token, shortest first
        self.grows_left: list[list[tuple[int, int]]] = []  # tokens that end it
        self.pair_rank: dict[int, int] = {}
        for token in [bytes([b]) for b in range(256)] + [a + b for a, b in self.merge_rank]:
            self._learn(token)
        for (a, b), rank in self.merge_rank.items():
            if a in self.number and b in self.number:
                self.pair_rank[self.number[a] << 32 | self.number[b]] = rank
        self.longest: dict[bytes, int] = {}  # token length by the last ENDING bytes, where there are as many
        for token in self.number:
            if len(token) >= ENDING:
                self.longest[token[-ENDING:]] = max(self.longest.get(token[-ENDING:], 0), len(token))
        self.total: dict[str, int] = {}
        self.total_before: dict[str, int] = {}
        self.pair: dict[int, bool] = {}
        self.pair_before: dict[int, bool] = {}

    def _learn(self, token: bytes) -> bool:
        """Number a token and store its chains, from those of the two it is merged from last; False if it is none."""
        if token in self.number:
            return True
        left, right = [], []
        if len(token) > 1:
            parts, pair = self.merge(token)
            if len(parts) > 1 or not (self._learn(pair[0]) and self._learn(pair[1])):
                return False
            rank = self.merge_rank[pair]
            left, right = self.grows_left[self.number[pair[1]]], self.grows_right[self.number[pair[0]]]
            left, right = [*left[:-1], (rank, left[-1][1])], [*right[:-1], (rank, right[-1][1])]
        self.number[token] = n = len(self.number)
        self.grows_left.append([*left, (_NEVER, n)])
        self.grows_right.append([*right, (_NEVER, n)])
        return True

    def merge(self, piece: bytes) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
        """Plain merging of the bytes of a token: what they encode to, and the last pair merged."""
        parts, pair = [piece[i:i + 1] for i in range(len(piece))], None
        rank = self.merge_rank
        while len(parts) > 1:
            best, at = min((rank.get((parts[i], parts[i + 1]), _NEVER), i) for i in range(len(parts) - 1))
            if best == _NEVER:
                break
            pair = (parts[at], parts[at + 1])
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts, pair

    def stays(self, left: int, right: int) -> bool:
        """True if token ``left`` then token ``right`` is what their joined bytes encode to."""
        key = left << 32 | right
        found = self.pair.get(key)
        if found is None:
            found = self.pair_before.get(key)
            if found is None:
                found = self._apart(self.grows_left[left], self.grows_right[right])
            if len(self.pair) >= CACHE_PAIRS:
                self.pair_before, self.pair = self.pair, {}
            self.pair[key] = found
        return found

    def _apart(self, lefts: list[tuple[int, int]], rights: list[tuple[int, int]]) -> bool:
        i = j = 0
        while True:
            (next_left, a), (next_right, b) = lefts[i], rights[j]
            rank = self.pair_rank.get(a << 32 | b, _NEVER)
            # of equal ranks the leftmost pair is merged first: growth on the left, the border, growth on the right
            if rank < next_left and rank <= next_right and rank < _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def counts(self, piece: bytes) -> list[int]:
        """Exact number of tokens of the first 0, 1, ... bytes of a piece."""
        n, number, longest, pair, stays = len(piece), self.number.get, self.longest.get, self.pair, self.stays
        count, last = [0] * (n + 1), [0] * (n + 1)
        for i in range(1, n + 1):
            j = i - longest(piece[i - ENDING:i], ENDING - 1) if i >= ENDING else 0
            if j <= 0:
                token = number(piece[:i])
                if token is not None:
                    count[i], last[i] = 1, token
                    continue
                j = 1
            while True:
                token = number(piece[j:i])
                if token is not None:
                    known = pair.get(last[j] << 32 | token)
                    if known or (known is None and stays(last[j], token)):
                        count[i], last[i] = count[j] + 1, token
                        break
                j += 1
        return count

    def of(self, piece: str) -> int:
        """Number of tokens of a piece: the last entry of its table."""
        n = self.total.get(piece)
        if n is None:
            n = self.total_before.get(piece)
            if n is None:
                raw = piece.encode("utf-8", "surrogatepass")
                n = 1 if raw in self.number else self.counts(raw)[-1]
            if len(self.total) >= CACHE_PIECES:
                self.total_before, self.total = self.total, {}
            self.total[piece] = n
        return n

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Runs of ordinary text and the special strings between them."""
        at = 0
        if self.find_special and any(s in text for s in self.special):
            for m in self.find_special(text):
                if m.start() > at:
                    yield text[at:m.start()], False
                yield m.group(), True
                at = m.end()
        if at < len(text):
            yield text[at:], False

    def pieces(self, text: str) -> tuple[list[str], list[int]]:
        """The pieces of a text in order and their numbers of tokens; a special string is one token."""
        pieces: list[str] = []
        counts: list[int] = []
        for part, special in self.segments(text):
            found = [part] if special else self.split(part)
            pieces += found
            if special:
                counts.append(1)
                continue
            try:
                counts += map(self.total.__getitem__, found)
            except KeyError:
                del counts[len(pieces) - len(found):]
                counts += map(self.of, found)
        return pieces, counts

    def prefix_counts(self, text: str) -> list[int]:
        """Exact number of tokens of the first 0, 1, ... characters of ``text``."""
        out = [0]
        before = 0
        for part, special in self.segments(text):
            if special:
                # a special string cut short is ordinary text that continues what stands before it
                tail = text[:len(out) - 1]
                for k in range(1, len(part)):
                    out.append(self._whole(tail + part[:k]))
                out.append(before + 1)
            else:
                out += [before + n for n in self._of_segment(part)]
            before = out[-1]
        return out

    def _whole(self, text: str) -> int:
        return sum(self.pieces(text)[1])

    def _of_segment(self, part: str) -> list[int]:
        out: list[int] = []
        base, blanks, blanks_base = 0, "", 0
        for piece in self.split(part):
            inner = self.counts(piece.encode("utf-8", "surrogatepass"))
            at = 0
            contraction = len(piece) == 3 and piece[0] == "'" and piece[1:] in ("re", "ve", "ll")
            for k, char in enumerate(piece):
                at += len(char.encode("utf-8", "surrogatepass"))
                if char.isspace() and char not in "\x1c\x1d\x1e\x1f":
                    if not blanks:
                        blanks_base = base
                    blanks += char
                    out.append(blanks_base + self.of(blanks))
                else:
                    blanks = ""
                    out.append(base + (2 if contraction and k == 1 else inner[at]))
            base += inner[-1]
        return out

    def fitting(self, text: str, pieces: list[str], counts: list[int], limit: int) -> int:
        """Characters of the longest prefix that has at most ``limit`` tokens, read off the tables."""
        if sum(counts) <= limit:
            return len(text)
        ends = np.cumsum(counts)
        k = int(np.searchsorted(ends, limit, "right"))  # the piece that exceeds the budget
        chars = sum(map(len, pieces[:k]))
        # A prefix of the text is tokenised like the text before the piece; blanks at its end are one piece,
        # which reach back into the pieces of blanks before.
        first = k
        while first and pieces[first - 1].isspace():
            first -= 1
        first = max(0, first - 1)
        start = sum(map(len, pieces[:first]))
        base = int(ends[first - 1]) if first else 0
        window = text[start:chars + len(pieces[k])]
        table = self.prefix_counts(window)
        fits = [i for i, n in enumerate(table) if base + n <= limit]
        return start + fits[-1]


_COUNTERS: dict[tuple[str, str], PrefixCounter] = {}


def counter(path: str, pattern: str) -> PrefixCounter:
    """The worker's counter for a vocabulary file; tasks of one Python worker share it."""
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = PrefixCounter(path, pattern)
    return _COUNTERS[path, pattern]


def count_tokens(df: DataFrame, path: str, pattern: str, limit: int, text: str = "text", prefix_table: bool = False) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens``, ``over_limit`` and ``fit_chars`` (characters of the longest prefix within ``limit`` tokens).

    ``prefix_table`` adds the array ``prefix_tokens``: the exact count of every prefix by characters, from 0 to
    the whole text. Existing columns of these names are replaced. A narrow step: no shuffle.
    """
    added = [T.StructField("n_bytes", T.LongType(), False), T.StructField("n_tokens", T.LongType(), False),
             T.StructField("over_limit", T.BooleanType(), False), T.StructField("fit_chars", T.LongType(), False)]
    if prefix_table:
        added.append(T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), False), False))
    new = {f.name for f in added}
    source = df.columns.index(text)
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in new]
    schema = T.StructType([df.schema[i] for i in keep] + added)
    positions = df.toDF(*[f"c{i}" for i in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, pattern)
        for batch in batches:
            column = batch.column(source)
            for i, j, _, offsets in slices(column):
                texts = [x or "" for x in column.slice(i, j - i).to_pylist()]
                totals, fits = [], []
                for x in texts:
                    pieces, counts = count.pieces(x)
                    totals.append(sum(counts))
                    fits.append(count.fitting(x, pieces, counts, limit))
                n = np.array(totals, np.int64)
                out = [batch.column(k).slice(i, j - i) for k in keep]
                out += [pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit), pa.array(fits, pa.int64())]
                if prefix_table:
                    out.append(pa.array([count.prefix_counts(x) for x in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return positions.mapInArrow(run, schema)
