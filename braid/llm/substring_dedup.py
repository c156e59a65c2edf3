"""Suffix-array dedup: every byte covered by a LENGTH-byte string that also starts earlier goes (smaller doc_id, or same document and earlier).

Three steps, exact together:

1. Routing. Each possible start of such a string belongs to the least of the GRAM-byte hashes within the string (leftmost among equals), so
   equal strings belong to equal anchors at equal distance. Neighbouring starts share an anchor; an anchor with its starts and the bytes they
   reach is a segment. Equal segments (by a 64-bit hash, within equal anchors) are one variant: all but its first occurrence are covered whole.
   That is found within each task before the shuffle, so a hot segment leaves a task once, and then among tasks. Anchors with one variant
   are settled by that.
2. Where an anchor has several variants (edits, edges of a repeated passage), their first occurrences meet: a Burrows-Wheeler transform of the
   concatenated segments is searched breadth first by backward extension from the empty string. Extending an interval of strings of length l
   settles the right edges of its children not settled yet as common prefixes of exactly l, and only those children go on (Beller et al. 2013,
   prefix values in increasing order). After LENGTH rounds the edges still open are those of suffixes that share LENGTH bytes or more: the search
   stops there. In each such run the first start stays, the others are covered.
3. Covered ranges meet their text again and are cut out.

Anchors with more than MOST variants (a passage in that many surroundings) don't go to one task: their starts are exploded as LENGTH-byte strings
and grouped with aggregation before the shuffle, which is exact as well.

Null text: empty. Texts under LENGTH bytes lose nothing. Rows that share a doc_id count as one document whose positions coincide: neither is
earlier than the other, and what is cut from one is cut from all. A null doc_id comes before all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, small, stored, text_column
from .numtext import BASE, U, groups, mix, powers, slices, utf8

LENGTH, GRAM, MOST = 100, 32, 20_000
#: Anchors that a task gathers before it hands them on; bytes of text hashed at once.
FLUSH, PIECE = 1_500_000, 1 << 22
_LOW = U((1 << 24) - 1)
_NULL = -(1 << 63)
_RECORD = (("ah", np.int64), ("sh", np.int64), ("doc", np.int64), ("lo", np.uint32), ("span", np.uint8))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w consecutive values."""
    step = 1
    while step * 2 <= w:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = w - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(buf: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Segments of texts of under 2**24 bytes together: text, anchor hash, segment hash, first start (in buf), and last start less first."""
    n, none = len(buf), np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    p, q = powers(n + 1)
    s = np.zeros(n + 1, U)
    np.cumsum((buf.astype(U) + U(1)) * p[:n], out=s[1:])
    g = mix((s[gram:] - s[:-gram]) * q[: n - gram + 1])
    least = _sliding_min((g & ~_LOW) | np.arange(len(g), dtype=U), length - gram + 1)
    at = (least & _LOW).astype(np.int64)
    size = np.diff(bounds)
    valid = slices(bounds[:-1], np.maximum(0, size - length + 1))
    if not len(valid):
        return none, none, none, none, none
    text = np.repeat(np.arange(len(size)), np.maximum(0, size - length + 1))
    a = at[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    lo, hi, a, text = valid[first], valid[last], a[first], text[first]
    segment = mix((s[hi + length] - s[lo]) * q[lo] + ((a - lo) * 256 + (hi - lo)).astype(U) * U(BASE))
    return text, g[a].view(np.int64), segment.view(np.int64), lo, hi - lo


def _pack(rec: dict[str, np.ndarray], rows: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(rec[k][rows], t).tobytes() for k, t in _RECORD)


def _unpack(blobs: list[bytes]) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in _RECORD)
    parts: dict[str, list] = {k: [np.zeros(0, t)] for k, t in _RECORD}
    for b in blobs:
        n, at = len(b) // width, 0
        for k, t in _RECORD:
            parts[k].append(np.frombuffer(b, t, n, at))
            at += n * np.dtype(t).itemsize
    return {k: np.concatenate(v) for k, v in parts.items()}


def _firsts(rec: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of records, sorted as variants: which are the first of theirs, and which are later; records of the same place aren't later."""
    o = np.lexsort((rec["lo"], rec["doc"], rec["sh"], rec["ah"]))
    ah, sh, doc, lo = (rec[k][o] for k in ("ah", "sh", "doc", "lo"))
    new = np.ones(len(o), bool)
    new[1:] = (ah[1:] != ah[:-1]) | (sh[1:] != sh[:-1])
    start = np.flatnonzero(new)
    head = np.repeat(start, np.diff(np.append(start, len(o))))
    later = (doc != doc[head]) | (lo != lo[head])
    return o[new], o[later]


def _route(docs: DataFrame, buckets: int) -> DataFrame:
    """p, kind, blob: kind 0 has segments to compare, kind 1 segments already covered."""

    def flush(recs: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        rec = {k: np.concatenate([r[i] for r in recs]).astype(t) for i, (k, t) in enumerate(_RECORD)}
        first, later = _firsts(rec)
        p, kind, blob = [], [], []
        for rows, what in ((first, 0), (later, 1)):
            b = rec["ah"][rows].view(U) % U(buckets)
            o = np.argsort(b, kind="stable")
            rows, b = rows[o], b[o]
            if not len(b):
                continue
            cut = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
            for i, j in zip(cut, np.append(cut[1:], len(b)), strict=True):
                p.append(int(b[i])), kind.append(what), blob.append(_pack(rec, rows[i:j]))
                if len(p) >= 256:
                    yield pa.RecordBatch.from_pydict({"p": p, "kind": kind, "blob": blob}, _ROUTED)
                    p, kind, blob = [], [], []
        yield pa.RecordBatch.from_pydict({"p": p, "kind": kind, "blob": blob}, _ROUTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recs, held = [], 0
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(_NULL)).astype(np.int64)
            for i, j, raw, bounds in groups(batch.column("text"), PIECE):
                # a text that is longer is cut into pieces that share LENGTH - 1 bytes
                pieces = [(0, raw, bounds)] if j - i > 1 or len(raw) <= 2 * PIECE else [(k, raw[k : k + PIECE + LENGTH - 1], None) for k in range(0, len(raw), PIECE)]
                for offset, part, at in pieces:
                    text, ah, sh, lo, span = anchors(part, np.array([0, len(part)]) if at is None else at)
                    base = np.zeros(1, np.int64) if at is None else at
                    recs.append((ah, sh, ids[i + text], lo - base[text] + offset, span))
                    held += len(ah)
            if held >= FLUSH:
                yield from flush(recs)
                recs, held = [], 0
        if recs:
            yield from flush(recs)

    return mapped(docs, run, "p bigint, kind int, blob binary")


_ROUTED = pa.schema([("p", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
_FOUND = "kind int, doc bigint, lo bigint, hi bigint, ah bigint"


def _compare(key: tuple, t: pa.Table) -> pa.Table:
    """Segments of a bucket of anchors: kind 1 rows are covered from lo to the end of the string that starts at hi; kind 0 rows are to be looked at."""
    kind = np.asarray(t.column("kind"))
    blobs = t.column("blob").to_pylist()
    rec = _unpack([b for b, k in zip(blobs, kind, strict=True) if k == 0])
    done = _unpack([b for b, k in zip(blobs, kind, strict=True) if k == 1])
    o = np.argsort(rec["ah"], kind="stable")
    same = np.zeros(len(o) + 1, bool)
    same[1:-1] = rec["ah"][o][1:] == rec["ah"][o][:-1]
    rows = o[same[1:] | same[:-1]]
    rec = {k: v[rows] for k, v in rec.items()}
    first, later = _firsts(rec)
    ah = rec["ah"][first]  # sorted
    same = np.zeros(len(ah) + 1, bool)
    same[1:-1] = ah[1:] == ah[:-1]
    ask = first[same[1:] | same[:-1]]
    out = {k: np.concatenate([done[k], rec[k][later], rec[k][ask]]) for k in ("doc", "lo", "span", "ah")}
    kinds = np.concatenate([np.ones(len(done["lo"]) + len(later), np.int32), np.zeros(len(ask), np.int32)])
    lo = out["lo"].astype(np.int64)
    return pa.table({"kind": kinds, "doc": out["doc"], "lo": lo, "hi": lo + out["span"], "ah": out["ah"]})


def suffix_order(t: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of t by their first `depth` bytes or more (0xFF after the end), and their inverse; by doubling from eight bytes."""
    n = len(t)
    wide = np.concatenate([t, np.full(8, 0xFF, np.uint8)]).astype(U)
    key = np.zeros(n, U)
    for k in range(8):
        key = (key << U(8)) | wide[k : k + n]
    h = 8
    while True:
        sa = np.argsort(key, kind="stable")
        k = key[sa]
        rank = np.empty(n, np.int64)
        rank[sa] = np.cumsum(np.append(0, k[1:] != k[:-1]))
        if h >= depth or rank[sa[-1]] == n - 1:
            break
        beyond = np.full(n, n, np.int64)
        beyond[: max(0, n - h)] = rank[h:]
        key = (rank.astype(U) << U(32)) | beyond.astype(U)
        h *= 2
    inverse = np.empty(n, np.int64)
    inverse[sa] = np.arange(n)
    return sa, inverse


def open_edges(t: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order of t, and for each place whether its suffix shares `length` bytes or more with the one before."""
    n = len(t)
    sa, inverse = suffix_order(t, length + 1)
    before = sa - 1
    bwt = np.where(before >= 0, t[before], 0xFF).astype(np.int64)
    to = inverse[before]
    settled = np.zeros(n + 1, bool)
    settled[[0, n]] = True
    lb, rb = np.array([0]), np.array([n - 1])
    for _ in range(length):
        if not len(lb):
            break
        pos = slices(lb, rb - lb + 1)
        key = (np.repeat(np.arange(len(lb)), rb - lb + 1) << 8) | bwt[pos]
        some = sa[pos] > 0
        key, dest = key[some], to[pos[some]]
        o = np.argsort(key, kind="stable")
        key, dest = key[o], dest[o]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        if not len(first):
            break
        low, high = np.minimum.reduceat(dest, first), np.maximum.reduceat(dest, first)
        go = ~settled[high + 1]
        lb, rb = low[go], high[go]
        settled[rb + 1] = True
    return sa, ~settled[:n]


def covered_starts(segments: list[bytes], doc: np.ndarray, lo: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For the possible starts of all segments, in order: whether an equal string starts earlier among them."""
    sizes = np.array([len(s) for s in segments])
    starts = sizes - length + 1
    t = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    base = np.cumsum(sizes + 1) - sizes - 1
    at = slices(base, starts)
    seg = np.repeat(np.arange(len(segments)), starts)
    sa, is_open = open_edges(t, length)
    run = np.cumsum(~is_open)
    of = np.empty(len(t), np.int64)
    of[sa] = run
    group = of[at]
    d, s = doc[seg], lo[seg] + at - base[seg]
    o = np.lexsort((s, d, group))
    g, d, s = group[o], d[o], s[o]
    head = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    head = np.repeat(head, np.diff(np.append(head, len(g))))
    out = np.zeros(len(at), bool)
    out[o] = (d != d[head]) | (s != s[head])
    return out


def _expand(key: tuple, t: pa.Table) -> pa.Table:
    """Ranges that the interval expansion finds covered among the segments of a bin."""
    doc, lo = np.asarray(t.column("doc")), np.asarray(t.column("lo"))
    segments = t.column("seg").to_pylist()
    cover = covered_starts(segments, doc, lo)
    starts = np.array([len(s) for s in segments]) - LENGTH + 1
    seg = np.repeat(np.arange(len(segments)), starts)
    pos = slices(lo, starts)
    keep = np.flatnonzero(cover)
    seg, pos = seg[keep], pos[keep]
    new = np.ones(len(keep), bool)
    new[1:] = (seg[1:] != seg[:-1]) | (pos[1:] != pos[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(keep)) - 1 if len(keep) else first
    return pa.table({"doc": doc[seg[first]], "lo": pos[first], "hi": pos[last]})


def covered(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc (doc_id, the least bigint for null), lo, hi: LENGTH-byte strings starting from lo to hi start earlier as well. Ranges may overlap."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
    buckets = 1 << max(4, min(22, (docs.count() // 2000).bit_length()))
    found = stored(_route(d, buckets).groupBy("p").applyInArrow(_compare, _FOUND))
    ask = found.where("kind = 0")
    per = ask.groupBy("ah").agg(F.count("*").alias("n"))
    hot = stored(per.where(F.col("n") > most).select("ah"))
    cut = F.expr(f"substring(cast(text as binary), cast(lo + 1 as int), cast(hi - lo + {LENGTH} as int))")
    # texts meet their requests by shuffle at every size: requests grow with the input, and so would a broadcast
    segments = d.withColumn("doc", F.coalesce("doc_id", F.lit(_NULL))).join(ask.select("doc", "lo", "hi", "ah"), "doc").select("ah", "doc", "lo", "hi", cut.alias("seg")).where(f"octet_length(seg) = hi - lo + {LENGTH}")
    segments = stored(segments)
    bins = 1 << max(0, (segments.count() // 12_000).bit_length())
    cool = segments.join(small(hot), "ah", "left_anti")
    expanded = cool.withColumn("bin", F.pmod(F.xxhash64("ah"), F.lit(bins))).groupBy("bin").applyInArrow(_expand, "doc bigint, lo bigint, hi bigint")
    out = found.where("kind = 1").select("doc", "lo", "hi").unionByName(expanded)
    if hot.count():
        one = segments.join(small(hot), "ah", "left_semi").select("doc", "lo", "seg", F.explode(F.expr("sequence(0, cast(hi - lo as int))")).alias("k"))
        one = stored(one.select("doc", (F.col("lo") + F.col("k")).alias("lo"), F.md5(F.expr(f"substring(seg, k + 1, {LENGTH})")).alias("h")))
        least = one.groupBy("h").agg(F.min(F.struct("doc", "lo")).alias("m"))
        out = out.unionByName(one.join(least, "h").where("struct(doc, lo) <> m").select("doc", "lo", F.col("lo").alias("hi")))
    return out


def cut_out(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes): a row for each row of docs."""
    packed = (F.col("lo") * F.lit(1 << 31) + F.col("hi")).alias("x")
    ranges = stored(covered(docs, most).select("doc", packed).groupBy("doc").agg(F.sort_array(F.collect_set("x")).alias("ranges")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                raw, at = utf8(part.column("text"))
                lists = part.column("ranges").to_pylist()
                removed, spans, digest, kept = [], [], [], []
                for k, x in enumerate(lists):
                    text = raw[at[k] : at[k + 1]].tobytes()
                    pieces, end, n_spans = [], 0, 0
                    stop = None
                    for v in x or ():
                        lo, hi = v >> 31, (v & ((1 << 31) - 1)) + LENGTH
                        hi = min(hi, len(text))
                        if stop is None or lo > stop:
                            pieces.append(text[end:lo])
                            n_spans += 1
                            stop = hi
                        stop = max(stop, hi)
                        end = stop
                    pieces.append(text[end:])
                    left = b"".join(pieces)
                    removed.append(len(text) - len(left)), spans.append(n_spans), digest.append(hashlib.sha256(left).hexdigest()), kept.append(left)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_bytes": np.diff(at), "n_removed": removed, "n_spans": spans, "kept_sha256": digest, "kept": pa.array(kept, pa.binary())})

    rows = docs.select("doc_id", text_column().alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL)).alias("doc")).join(ranges, "doc", "left").select("doc_id", "text", "ranges")
    return mapped(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
