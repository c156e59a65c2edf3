"""Whole-batch text arithmetic in numpy: word bounds and 64-bit hashes straight from UTF-8 bytes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 1 << 64)
#: Bytes of text hashed at once.
PIECE = 1 << 21

_pow = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_pow[0]) < n:
        n_new = max(n, 1 << 16)
        for k, b in enumerate((BASE, _INV)):
            x = np.full(n_new, b, U)
            x[0] = 1
            _pow[k] = np.multiply.accumulate(x)
    return _pow[0][:n], _pow[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of col (null: empty), and where each begins, with the end last."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, pa.scalar("", col.type))
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def groups(col: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about `limit` bytes, one row at least: first row, row after the last, their bytes, their bounds."""
    buf, at = utf8(col)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j, buf[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def separators(chars: str | None = None) -> np.ndarray:
    """Which bytes separate words: the given ASCII characters, or all ASCII but letters and digits. Bytes of other characters never do."""
    t = np.zeros(256, bool)
    if chars is not None:
        t[[ord(c) for c in chars]] = True
    else:
        t[:128] = [not chr(i).isalnum() for i in range(128)]
    return t


@lru_cache(maxsize=2)
def _beyond_ascii(kind: str) -> np.ndarray:
    """By code point: whether a character separates."""
    of = str.isalnum if kind == "word" else (lambda c: not c.isspace())
    return np.fromiter((not of(chr(i)) for i in range(0x110000)), bool, 0x110000)


def separating(raw: np.ndarray, kind: str) -> np.ndarray:
    """Which bytes of UTF-8 texts are of characters that separate. kind 'word': all but letters and digits of any script; 'token': white space."""
    out = (SYMBOLS if kind == "word" else _BLANKS)[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    if len(lead):
        b = raw[lead]
        size = 2 + (b >= 0xE0).astype(np.int64) + (b >= 0xF0)
        point = np.where(b >= 0xF0, b & 0x07, np.where(b >= 0xE0, b & 0x0F, b & 0x1F)).astype(np.int64)
        for k in range(1, 4):
            more = np.flatnonzero(size > k)
            point[more] = point[more] << 6 | (raw[lead[more] + k] & 0x3F)
        cut = _beyond_ascii(kind)[np.minimum(point, 0x10FFFF)]
        out[slices(lead[cut], size[cut])] = True
    return out


SPACES = separators(" \t\n\x0b\x0c\r")
SYMBOLS = separators()
_BLANKS = separators(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f")


def word_bounds(buf: np.ndarray, bounds: np.ndarray, sep: np.ndarray, flags: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that don't separate, never across bounds: starts, ends, and index of the text each is in.

    sep: which byte values separate, or (flags) which bytes of buf do."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~(sep if flags else sep[buf])
    cut = bounds[1:-1]
    cut = cut[cut < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def words(buf: np.ndarray, bounds: np.ndarray, sep: np.ndarray, flags: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As word_bounds, with 64-bit hashes of the words: starts, ends, hashes, and index of the text each is in."""
    starts, ends, row = word_bounds(buf, bounds, sep, flags)
    return starts, ends, spans_hash(buf, starts, ends), row


def spans_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-overlapping ascending spans of buf: equal bytes, equal hash."""
    out = np.empty(len(starts), U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        p, q = powers(hi - lo + 1)
        s = np.zeros(hi - lo + 1, U)
        np.cumsum((buf[lo:hi].astype(U) + U(1)) * p[: hi - lo], out=s[1:])
        out[i:j] = (s[ends[i:j] - lo] - s[starts[i:j] - lo]) * q[starts[i:j] - lo]
        i = j
    return mix(out)


def sequence_keys(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each of `rows` texts, the place of each word in its text, and two 64-bit hashes of each text's words in order (0 without words)."""
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    place = np.arange(len(h)) - first[row]
    some = np.flatnonzero(count)
    keys = np.zeros((2, rows), U)
    if len(some):
        p, _ = powers(int(count.max()) + 1)
        for k, salt in enumerate((U(1), U(0xD6E8FEB86659FD93))):
            keys[k, some] = mix(np.add.reduceat(mix(h ^ salt) * p[place + 1], first[some]) + count[some].astype(U))
    return count, place, keys


def slices(i: np.ndarray, size: np.ndarray) -> np.ndarray:
    """i[0] .. i[0]+size[0]-1, i[1] .. and so on, in one array."""
    total = int(size.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.cumsum(size) - size
    return np.arange(total) - np.repeat(first - i, size)


def list_of(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A list column: the next sizes[k] of values for row k."""
    at = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))
