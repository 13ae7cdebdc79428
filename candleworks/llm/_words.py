"""Words of a whole Arrow batch at once: positions and 64-bit hashes, by numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D, which for UTF-8
is the word pattern ``[^\\x20\\x09-\\x0D]+``. Texts are handled in chunks of whole
documents, so memory follows the longest text and never a partition.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def release() -> None:
    """Give memory that a batch no longer needs back to the system: workers live on and share
    an executor's memory with the tasks to come."""
    pa.default_memory_pool().release_unused()
    if (trim := _trim()) is not None:
        trim(0)


#: How to drop what an operator keeps in this worker between its tasks.
_KEPT: dict[str, Callable[[], None]] = {}


def make_room(owner: str, drop: Callable[[], None] | None = None) -> None:
    """Drop what other operators than ``owner`` keep in this worker: it serves the tasks of later
    operators too, beside an executor whose heap has grown meanwhile. ``drop`` frees what ``owner`` keeps."""
    others = [name for name in _KEPT if name != owner]
    for name in others:
        _KEPT.pop(name)()
    if others:
        gc.collect()
        release()
    if drop is not None:
        _KEPT[owner] = drop


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim  # of the GNU C library
    except (OSError, AttributeError):
        return None


class _Powers:
    """Powers of an odd number modulo 2**64, grown to the longest word seen."""

    def __init__(self) -> None:
        self.table = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            self.table = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, _U(0xD6E8FEB86659FD93))]))
        return self.table


_POWERS = _Powers()


@dataclass
class Words:
    """Words of some documents. ``start``/``end`` are byte offsets into ``data``;
    document ``i`` has the words ``first[i]`` up to ``first[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray
    rows: slice

    def text(self, a: int, b: int) -> str:
        """Words ``a`` to ``b - 1`` joined by one space."""
        d = self.data
        return b" ".join(d[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b])).decode("utf-8")


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (one more than there are rows) and data; nulls are empty."""
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, raw


def text_groups(column: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of about ``most`` bytes together (nulls as empty texts), each
    group with the row that it starts at."""
    n = len(column)
    if n == 0:
        return
    off, _ = _buffers(column)
    a = 0
    while a < n:
        b = min(n, max(int(np.searchsorted(off, off[a] + most, side="right")) - 1, a + 1))
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]
        a = b
    release()


def chunks(column: pa.Array, lower: bool = False, most: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column, in chunks of whole rows and about ``most`` bytes."""
    make_room("words")
    n = len(column)
    if n == 0:
        return
    off, raw = _buffers(column)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + most, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield _words(raw[off[a]:off[b]], off[a:b + 1] - off[a], lower, slice(a, b))
        a = b
    release()


def _words(data: np.ndarray, off: np.ndarray, lower: bool, rows: slice) -> Words:
    docs = len(off) - 1
    none = np.zeros(0, np.int64)
    if len(data) == 0:
        return Words(data, none, none, np.zeros(docs + 1, np.int64), np.zeros(0, np.uint64), rows)
    if lower:
        data = _LOWER[data]
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    first = np.searchsorted(start, off).astype(np.int64)
    if len(start) == 0:
        return Words(data, none, none, first, np.zeros(0, np.uint64), rows)
    length = end - start
    # Word bytes only, laid end to end: hash = sum of byte value * power of its place.
    at = np.flatnonzero(solid)
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    place = np.arange(len(at)) - np.repeat(begin, length)
    value = _BYTE_VALUE[data[at]] * _POWERS.upto(int(length.max()) + 1)[place]
    h = mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * _ODD)
    return Words(data, start, end, first, h, rows)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every ``n`` consecutive word hashes (``len(h) - n + 1`` of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, dtype=np.uint64)
    k = 1
    for i in range(n):
        k = (k * 0xC6A4A7935BD1E995 + 2 * i + 1) % (1 << 64)
        total += h[i:i + m] * _U(k | 1)
    return mix(total)


def packed_words(words: Words, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray]:
    """The (kept) words, each followed by one space, and where each word starts in
    them (one more offset than there are kept words)."""
    start, end = (words.start, words.end) if keep is None else (words.start[keep], words.end[keep])
    length = end - start
    at = np.concatenate([[0], np.cumsum(length + 1)]).astype(np.int64)
    out = np.full(int(at[-1]), 0x20, dtype=np.uint8)
    if len(length):
        shift = np.repeat(at[:-1], length)
        place = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
        out[shift + place] = words.data[np.repeat(start, length) + place]
    return out.tobytes(), at


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` consecutive values."""
    if len(x) < n:
        return x[:0]
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = n - width
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x
