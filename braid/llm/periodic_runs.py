"""Periodic run detection: maximal repetitions of words, from the Lyndon words at every place under both orders of words (Bannai et al. 2017).

A stack of Lyndon factors is scanned right to left, once with the words' order and once with its reverse. Two suffixes are compared by their longest
common extension (LCE): binary search on rolling hashes, and what the hashes call equal is compared word by word, so no hash decides a result. The
longest Lyndon word at a place is the root of at most one run; the LCE to the right is known from the comparison, the one to the left completes the run.

Only stretches that can hold a run are scanned: a run of period q has 24 and 3 q words at least, so 16 words in a row occur again q words further on,
and the whole run is covered by such 16-word windows that the text has twice. Texts without one have no run.

Definitions, for every text, whole:
  word         a maximal run of characters other than space and the five ASCII controls \\t \\n \\x0B \\f \\r; words are equal if their bytes are
  run          a stretch of words with smallest period q, at least LEAST words and TIMES periods long, that no neighbouring word extends
  collapsed    words that are in a run but not in its first q words go, for every run; the others stay, joined by one space
  null text    the empty text: no words, no runs
  ties         of equally great exponents the smallest start, then the smallest period
Repeated rows and ids are treated each by itself. Only doc_id and text are read, whatever other columns there are; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import numtext as nt
from .common import ship

#: Words and periods that a run has at least; words of a window (LEAST - q of a period q under GRAM / 2, and 2 q of others, are not less).
LEAST, TIMES, GRAM = 24, 3, 16
_MOD, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E687 % ((1 << 61) - 1)
_POWERS = [1]


class _Extensions:
    """Longest common extensions of places of one list of numbers. Equal stretches are verified, each distance between places only where it wasn't before."""

    def __init__(self, x: list[int]):
        self.x, n = x, len(x)
        while len(_POWERS) <= n:
            _POWERS.append(_POWERS[-1] * _BASE % _MOD)
        self.h, h = [0], 0
        for v in x:
            h = (h * _BASE + v + 1) % _MOD
            self.h.append(h)
        self.known: dict[int, tuple[int, int]] = {}

    def _equal(self, i: int, j: int, size: int) -> bool:
        h, p = self.h, _POWERS[size]
        return (h[i + size] - h[i] * p - h[j + size] + h[j] * p) % _MOD == 0

    def _differs(self, i: int, j: int, size: int) -> int:
        """The first k < size with x[i + k] != x[j + k], or size. i < j."""
        lo, hi = self.known.get(j - i, (0, 0))
        start, end = i, i + size
        if lo <= start < hi:  # known in front
            start = min(hi, end)
        if lo < end <= hi:  # known behind
            end = max(lo, start)
        x, d = self.x, j - i
        if x[start:end] != x[start + d : end + d]:
            return next(k for k in range(start, end) if x[k] != x[k + d]) - i
        if i <= hi and lo <= i + size:
            self.known[d] = (min(lo, i), max(hi, i + size))
        elif size > hi - lo:
            self.known[d] = (i, i + size)
        return size

    def _search(self, most: int, equal: Callable[[int], bool]) -> int:
        """The greatest size up to most that is equal: doubled, then halved."""
        lo, hi = 0, 1
        while hi <= most and equal(hi):
            lo, hi = hi, 2 * hi
        hi = min(hi, most + 1)
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if equal(mid) else (lo, mid)
        return lo

    def right(self, i: int, j: int) -> int:
        """How many words from i on equal those from j on. i < j."""
        x, d = self.x, j - i
        if j >= len(x) or x[i] != x[j]:
            return 0
        lo, hi = self.known.get(d, (0, 0))
        if lo <= i + 1 <= hi and (hi + d >= len(x) or x[hi] != x[hi + d]):  # what was verified ends there for good
            self.known[d] = (min(lo, i), hi)
            return hi - i
        return self._differs(i, j, self._search(len(x) - j, lambda size: self._equal(i, j, size)))

    def left(self, i: int, j: int) -> int:
        """How many words before i equal those before j. i < j."""
        x = self.x
        if i == 0 or x[i - 1] != x[j - 1]:
            return 0
        size = self._search(i, lambda s: self._equal(i - s, j - s, s))
        if self._differs(i - size, j - size, size) == size:
            return size
        return next(s for s in range(size) if x[i - s - 1] != x[j - s - 1])


def runs(x: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of x that have at least `least` numbers and `times` (2 or more) periods, sorted."""
    n, lce = len(x), _Extensions(x)
    found: set[tuple[int, int, int]] = set()
    for falling in (False, True):
        stack: list[int] = []  # where the Lyndon factors of the suffix begin, the nearest last
        seen: dict[int, int] = {}  # by period, the start of the last run found
        for i in range(n - 1, -1, -1):
            size = 0
            while stack:
                j = stack[-1]
                size = lce.right(i, j)
                if j + size < n and (x[i + size] < x[j + size]) is not falling:
                    stack.pop()  # the factor at i goes on over the one at j
                else:
                    break
            period = (stack[-1] if stack else n) - i
            stack.append(i)
            if i + period < n and size >= max(least - 2 * period, (times - 2) * period) and seen.get(period, n) > i:
                start = i - lce.left(i, i + period)
                seen[period] = start
                length = i + period + size - start
                if length >= max(least, times * period):
                    found.add((start, length, period))
    return sorted(found)


def _stretches(h: np.ndarray, row: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches of words covered by GRAM-word windows that their text has twice, of LEAST words or more."""
    n = len(h)
    if n < LEAST:
        return []
    p, q = nt.powers(n + 1)
    s = np.zeros(n + 1, nt.U)
    np.cumsum(h * p[:n], out=s[1:])
    whole = np.flatnonzero(row[: n - GRAM + 1] == row[GRAM - 1 :])
    key = nt.mix(((s[whole + GRAM] - s[whole]) * q[whole]) ^ (row[whole].astype(nt.U) * nt.U(nt.BASE)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(n + 1, np.int64)
    at = whole[order[np.flatnonzero(np.append(same, False) | np.append(False, same))]]
    twice[at] += 1
    np.subtract.at(twice, at + GRAM, 1)
    inside = np.cumsum(twice[:n]) > 0
    new = np.append(True, row[1:] != row[:-1])
    starts = np.flatnonzero(inside & (new | ~np.append(False, inside[:-1])))
    ends = np.flatnonzero(inside & (np.append(new[1:], True) | ~np.append(inside[1:], False))) + 1
    return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= LEAST]


def looped(n: int, crc: int) -> np.ndarray | None:
    """The test's loops: for which words of a text of n words others stand, in texts whose id has a crc32 that ends in 0; None if each stands for itself."""
    if crc % 10 or not n:
        return None
    g = crc // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    out = np.arange(n)
    out[a:] = a + (out[a:] - a) % p
    return out


def crc_of(doc_id: object) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())


def _batch(ids: pa.Array, texts: pa.Array, altered: Callable[[int, int], np.ndarray | None] | None) -> Iterator[dict]:
    """For each text in turn: n_runs, the greatest run, the two digests, and the collapsed text as bytes."""
    for i, j, buf, bounds in nt.groups(texts):
        starts, ends, h, row = nt.words(buf, bounds, nt.SPACES)
        count = np.bincount(row, minlength=j - i)
        first = np.cumsum(count) - count
        moved: dict[int, np.ndarray] = {}
        for k in range(j - i) if altered is not None else ():
            crc = crc_of(ids[i + k].as_py())
            order = altered(int(count[k]), crc) if crc is not None else None
            if order is not None:
                moved[k] = first[k] + order
        if moved:
            pick = np.arange(len(h))
            for k, order in moved.items():
                pick[first[k] : first[k] + count[k]] = order
            h, starts, ends = h[pick], starts[pick], ends[pick]
        raw = buf.tobytes()
        found: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in _stretches(h, row):
            names: dict[bytes, int] = {}
            x = [names.setdefault(raw[s:e], len(names)) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
            if got := runs(x):
                k = int(row[a])
                found.setdefault(k, []).extend((s + a - int(first[k]), size, q) for s, size, q in got)
        for k in range(j - i):
            lo, n = int(first[k]), int(count[k])
            some = sorted(found.get(k, ()))
            if not some and k not in moved:
                text = b" ".join(raw[bounds[k] : bounds[k + 1]].split())
            else:
                over = np.zeros(n + 1, np.int64)
                for s, size, q in some:
                    over[s + q] += 1
                    over[s + size] -= 1
                rest = lo + np.flatnonzero(np.cumsum(over[:n]) == 0)
                text = b" ".join([raw[s:e] for s, e in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)])
            yield {"runs": some, "text": text}


def _greatest(some: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for r in some:  # by start, then period: the first of equals stays
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def detected(docs: DataFrame, altered: Callable[[int, int], np.ndarray | None] | None = None, texts: bool = True) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli; nulls without a run), runs_sha256 of `start,length,period` lines
    of all runs, collapsed_sha256, and (texts) the collapsed text. altered(n, crc32 of the id) gives places of words to stand in each other's place."""
    ship(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    whole = "n_runs", "start", "length", "period", "exponent_milli"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: dict[str, list] = {c: [] for c in (*whole, "runs_sha256", "collapsed_sha256", "collapsed")}
            for got in _batch(batch.column("doc_id"), batch.column("text"), altered):
                some, best = got["runs"], _greatest(got["runs"])
                cols["n_runs"].append(len(some))
                for c, v in zip(whole[1:], (*best, 1000 * best[1] // best[2]) if best else (None,) * 4, strict=True):
                    cols[c].append(v)
                cols["runs_sha256"].append(hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in some).encode()).hexdigest())
                cols["collapsed_sha256"].append(hashlib.sha256(got["text"]).hexdigest())
                if texts:
                    cols["collapsed"].append(got["text"])
            out = {"doc_id": batch.column("doc_id")} | {c: pa.array(cols[c], pa.int64()) for c in whole} | {c: pa.array(cols[c], pa.string()) for c in ("runs_sha256", "collapsed_sha256")}
            if texts:
                out["collapsed"] = pa.array(cols["collapsed"], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", collapsed string" * texts)
