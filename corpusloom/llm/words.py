"""Words, word hashes and sequence hashes of whole text columns as flat numpy arrays.

Tasks of several operators read a text column as Arrow batches. Working on the UTF-8 bytes of a
whole slice of documents at once keeps the cost at a few numpy passes per byte and no Python
object per word. A word is a maximal run of bytes other than blank, tab, line feed, vertical tab,
form feed and carriage return. NULL texts count as empty.
"""

from __future__ import annotations

import ctypes
import glob
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: text bytes worked on at a time; a longer document is a slice of its own
SLICE_BYTES = 512 << 10

#: rows with texts in one Arrow batch
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: bytes hashed at a time, so that what is made on the way stays in the core's cache
_BLOCK = 1 << 15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the output (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            filled = 1
            while filled < size:
                step = np.uint64(pow(base, filled, 1 << 64))
                out[filled:2 * filled] = out[:filled] * step
                filled *= 2
            _POWERS[name] = out
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Words:
    """Words of a slice of documents: byte spans in ``buf``, and per document its range of words."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # first[d]..first[d + 1] are the words of document d

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int, j: int) -> bytes:
        """Words i to j joined by single blanks."""
        return b" ".join(self.buf[a:b].tobytes() for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist()))


def small_batches(spark: SparkSession) -> None:
    """Let this session send BATCH_ROWS rows at a time to Python, unless it was set to another number than Spark's default.

    Spark counts rows only, so the default of 10,000 holds whatever their texts weigh on both sides of the pipe.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where there is one
_OPTION = getattr(ctypes.CDLL(None), "mallopt", None) if _TRIM is not None else None
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3  # in malloc.h

#: freed memory that a worker keeps for its next arrays, until it is told to release it
KEPT_BYTES = 32 << 20


def keep_memory() -> None:
    """Let this Python worker use the memory of freed arrays again, up to KEPT_BYTES, where the C library can.

    Else arrays of a megabyte are handed to the system and fetched from it, page by page, at every step.
    """
    if _OPTION is not None:
        _OPTION(_MMAP_THRESHOLD, KEPT_BYTES // 2)
        _OPTION(_TRIM_THRESHOLD, KEPT_BYTES)


def release() -> None:
    """Give memory freed by this Python worker back to the system: workers live on, with what their largest batch took."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def one_thread() -> None:
    """Let this Python worker's matrix products run on the core of its task alone, where numpy brings OpenBLAS along.

    Its further threads wait busily for products this small, on cores that belong to other tasks.
    """
    for path in glob.glob(f"{np.__path__[0]}.libs/*openblas*"):
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts with about ``limit`` bytes each; then ``release``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    kind = pa.large_string() if column.type in (pa.large_string(), pa.string()) else column.type
    column = column.cast(kind)
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j
    release()


def find_words(buf: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Spans of all words; no word crosses the border of two documents."""
    # arithmetic of bytes is many times faster than tables; it wraps, so one comparison tells a range
    if lower:
        buf = buf + ((buf - np.uint8(65) < 26).view(np.uint8) << 5)
    n = len(buf)
    solid = np.zeros(n + 1, dtype=bool)
    space = buf == 0x20
    space |= buf - np.uint8(0x09) < 5
    np.logical_not(space, out=solid[:n])
    begins = solid[:n].copy()
    begins[1:] &= ~solid[:n - 1] if n else begins[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = solid[inner]
    ends = solid[:n] & ~solid[1:]
    ends[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(buf, start, end, np.searchsorted(start, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of every word, the same in every slice, task and run."""
    n = len(words.buf)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    for a in range(0, n, _BLOCK):
        own = _BYTE.take(words.buf[a:a + _BLOCK].astype(np.intp))
        own *= up[a:a + len(own)]
        own[:1] += total[a:a + 1]
        np.cumsum(own, out=total[a + 1:a + 1 + len(own)])
    length = (words.end - words.start).astype(np.uint64)
    return mix((total.take(words.end) - total.take(words.start)) * down.take(words.start) + length * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` words; entry i covers words i to i + k - 1 (runs may cross documents)."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1)), np.uint64)
    for j in range(k):
        out += hashes[j:j + n] * np.uint64((2 * j + 1) * 0xC2B2AE3D27D4EB4F & (2**64 - 1) | 1)
        out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
    return mix(out)


def run_starts(words: Words, k: int) -> np.ndarray:
    """Indices of the words at which a run of ``k`` words of one document starts."""
    n = len(words.start)
    ok = np.zeros(n + 1, np.int32)
    counts = words.counts
    some = counts >= k
    np.add.at(ok, words.first[:-1][some], 1)
    np.add.at(ok, words.first[:-1][some] + counts[some] - k + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]))
