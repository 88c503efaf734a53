"""Whole-batch text work in numpy: words of many texts at once, their hashes, ragged gathers.

Arrow hands a batch of texts over as one UTF-8 buffer with offsets. Words are spans
``[start, end)`` of that buffer, so a batch of thousands of documents is split and
hashed by a fixed number of vector operations instead of a Python loop per word.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

_STEP = 1 << 18  # bytes hashed per vector operation
_LONG = 4096  # longer spans are hashed one by one


class Texts(NamedTuple):
    """``data[offsets[i]:offsets[i+1]]`` is the UTF-8 of text i (null texts are empty)."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """The texts of an Arrow string (or binary) column without copying them."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if offs is None or len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[o[0]:o[-1]], o - o[0])


def words(texts: Texts, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): spans of all maximal runs outside ``white``, and the index of each
    text's first word (``first[i]:first[i+1]`` are the words of text i). A text boundary ends a word."""
    data, offs = texts
    inside = ~white[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = offs[1:-1]
    edge = edge[edge < len(data)]
    begins[edge] = inside[edge]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    cut = edge[edge > 0] - 1
    stops[cut] = inside[cut]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offs)


def odd(seed: int) -> int:
    x = (seed * 0x9E3779B97F4A7C15 + 0xD1342543DE82EF95) & (2**64 - 1)
    x ^= x >> 29
    return ((x * 0xBF58476D1CE4E5B9) & (2**64 - 1) & ~7) | 5


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (base odd); those of four bases are remembered."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(n, b, dtype=U64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=U64))
    return out[0], out[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each span's bytes (spans in ascending order). Depends on the bytes alone."""
    out = np.empty(len(starts), dtype=U64)
    base = odd(seed)
    pw, ip = powers(base, _STEP + _LONG)
    lens = (ends - starts).astype(U64)
    long_ = ends - starts > _LONG
    i, n = 0, len(starts)
    while i < n:
        lo = starts[i]
        j = int(np.searchsorted(starts, lo + _STEP))
        a, b = starts[i:j] - lo, np.minimum(ends[i:j] - lo, _STEP + _LONG - 1)
        region = data[lo:lo + int(b.max())].astype(U64)
        region += U64(1)
        region *= pw[:len(region)]
        c = np.empty(len(region) + 1, dtype=U64)
        c[0] = 0
        np.cumsum(region, out=c[1:])
        out[i:j] = (c[b] - c[a]) * ip[a]
        i = j
    for k in np.flatnonzero(long_):
        import xxhash

        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]].tobytes(), seed)
    return mix(out ^ (lens * U64(0x9E3779B97F4A7C15)))


def order_of(values: np.ndarray, bits: int = 64) -> np.ndarray:
    """Positions of ``values`` (uint64, below 2**bits) such that equal values are neighbours, in ascending
    order. The leading bits are sorted together with the positions in one machine word, several times as
    fast as an argsort; if dropped low bits matter, an argsort decides."""
    need = max(1, (len(values) - 1).bit_length())
    low = max(0, bits + need - 64)  # bits that do not fit beside the position
    s = np.sort(((values >> U64(low)) << U64(need)) | np.arange(len(values), dtype=U64))
    s &= U64((1 << need) - 1)
    order = s.astype(np.int32 if need <= 31 else np.int64)
    if low:
        s = values[order]
        if not (s[1:] >= s[:-1]).all():
            order = np.argsort(values, kind="stable")
    return order


def group(values: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unique sorted values, index of each value in them, counts)."""
    n = len(values)
    if n == 0:
        return values, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = order_of(values, bits)
    s = values[order]
    new = np.empty(n, dtype=bool)
    new[0] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    at = np.flatnonzero(new)
    s = s[at]
    run = np.cumsum(new, dtype=order.dtype)
    run -= 1
    inverse = np.empty(n, dtype=order.dtype)
    inverse[order] = run
    return s, inverse, np.diff(at, append=n)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions ``starts[i], starts[i]+1, ...`` (``lens[i]`` of them) for all i, one after the other."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)
