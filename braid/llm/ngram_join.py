"""N-gram Jaccard join: MinHash banding, shuffled on band hashes, verified on full shingle sets.

Words are what ASCII white space separates, lower case; a shingle is WORDS consecutive words (a shorter text is one shingle), known by a 64-bit
hash. Two documents are linked if the Jaccard similarity of their shingle sets is at least THRESHOLD. Bands and rows follow from the recall
wanted at the threshold, with as many rows as MOST_HASHES allow, since more rows mean fewer false candidates.

Texts of the same words are one text: of a group of copies only the first is banded, and a copy counts as a link without being paired. Band
buckets become candidate groups (components of the bucket graph), whose members' sets meet in bounded pairs of blocks, where size and exact overlap
alone decide; rows out follow the members, not the pairs, and no link is dropped. A hot group is more blocks, not a larger task.

One row per distinct doc_id: class_id (the least doc_id that links lead to, its own if none) and n_links. Documents without a word link to
nothing, not even each other. Rows that share a doc_id are one node with all their links. Null ids: class_id null, n_links 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, small, stored
from .graph import components, linked
from .numtext import BASE, SPACES, U, groups, list_of, mix, sequence_keys, words

WORDS, THRESHOLD, RECALL, MOST_HASHES = 5, 0.8, 0.999, 96


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which bands enough for the recall at the threshold fit."""
    best = None
    for r in range(1, most + 1):
        b = math.ceil(math.log(1 - recall) / math.log(1 - threshold**r))
        if b * r <= most:
            best = (b, r)
    if best is None:
        raise ValueError("no plan fits")
    return best


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=U) * U(BASE))
    return x[:n] | U(1), x[n:]


def shingles(raw: np.ndarray, bounds: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in lower case: all shingles, how many each text has, and two hashes of each text's words (0 without words)."""
    _, _, h, row = words(raw, bounds, SPACES)
    rows = len(bounds) - 1
    count, place, keys = sequence_keys(h, row, rows)
    window = np.zeros(max(0, len(h) - n + 1), U)
    for k in range(n):
        window = (window + h[k : k + len(window)]) * U(BASE)
    window = mix(window)
    size = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    out = np.empty(int(size.sum()), U)
    at = np.cumsum(size) - size
    long = count[row] >= n
    ok = np.flatnonzero(long & (place <= count[row] - n))
    out[at[row[ok]] + place[ok]] = window[ok]
    short = np.flatnonzero((count > 0) & (count < n))
    out[at[short]] = keys[0, short]
    return out, size, keys[0], keys[1]


def band_hashes(sh: np.ndarray, size: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts with shingles) x bands."""
    some = np.flatnonzero(size)
    out = np.zeros((len(some), bands), U)
    if not len(some):
        return out
    first = (np.cumsum(size) - size)[some]
    a, b = _permutations(bands * rows)
    for k in range(bands):
        h = np.full(len(some), k + 1, U)
        for r in range(k * rows, (k + 1) * rows):
            h = mix(h * U(BASE) + np.minimum.reduceat(sh * a[r] + b[r], first))
        out[:, k] = h
    return out


def sketched(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, k1, k2 (together the text's identity) and bands, empty without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pc.utf8_lower(pc.fill_null(b.column("text"), ""))
            for i, j, raw, bounds in groups(text):
                sh, size, k1, k2 = shingles(raw, bounds)
                h = band_hashes(sh, size, bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[i:j], pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), list_of(h.view(np.int64).ravel(), np.where(size > 0, bands, 0))], ["doc_id", "k1", "k2", "bands"]
                )

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 bigint, k2 bigint, bands array<bigint>")


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, sh (sorted distinct shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, raw, bounds in groups(pc.utf8_lower(pc.fill_null(b.column("text"), ""))):
                sh, size, _, _ = shingles(raw, bounds)
                at = np.cumsum(size) - size
                parts = [np.unique(sh[s : s + n].view(np.int64)) for s, n in zip(at, size, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[i:j], list_of(np.concatenate(parts), np.array([len(x) for x in parts]))], ["doc_id", "sh"])

    return mapped(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, sh array<bigint>")


def _matcher(threshold: float):
    state: dict = {}

    def match(t: pa.Table, i: int, j: np.ndarray) -> np.ndarray:
        if state.get("of") is not t:
            sh = t.column("sh").combine_chunks()
            sh = sh if isinstance(sh, pa.ListArray) else pa.concat_arrays(sh.chunks)
            at = np.asarray(sh.offsets)
            # shingles numbered within the bin: what row i shares with a run of rows is one lookup and one sum over the run
            number = np.unique(np.asarray(sh.flatten()), return_inverse=True)[1]
            state.update(of=t, at=at - at[0], size=np.diff(at), number=number, mark=np.zeros(len(number), bool))
        at, size, number, mark = state["at"], state["size"], state["number"], state["mark"]
        ok = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        if ok.any():
            own = number[at[i] : at[i + 1]]
            mark[own] = True
            lo, hi = int(j[0]), int(j[-1]) + 1
            both = np.add.reduceat(mark[number[at[lo] : at[hi]]], at[lo:hi] - at[lo], dtype=np.int64)[j - lo]
            mark[own] = False
            ok &= both >= threshold * (size[i] + size[j] - both) - 1e-9
        return ok

    return match


def joined(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, n_links."""
    bands, rows = band_plan(threshold, recall)
    sk = stored(sketched(docs.where("doc_id is not null"), bands, rows))
    reps = stored(sk.where("size(bands) > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count_distinct("doc_id").alias("copies"), F.any_value("bands").alias("bands")))
    members = stored(reps.select("rep", F.explode("bands").alias("bucket")))
    full = members.groupBy("bucket").agg(F.min("rep").alias("b"), F.max("rep").alias("_m")).where("b < _m").select("bucket", "b")
    cand = stored(components(members.join(full, "bucket").select(F.col("rep").alias("a"), "b").distinct()))
    cand = small(cand)
    sets = _sets(docs.join(cand.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")).where("size(sh) > 0")
    weight = reps.groupBy("rep").agg(F.max("copies").alias("copies"))
    nodes = stored(sets.join(cand.select(F.col("node").alias("doc_id"), F.col("root").alias("cluster")), "doc_id").join(weight, F.col("doc_id") == F.col("rep")).select("cluster", "doc_id", "copies", "sh"))
    checked = stored(linked(nodes, "cluster", "doc_id", "copies", _matcher(threshold), nodes.count()))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_rep = stored(reps.select("rep").distinct().join(links, F.col("rep") == F.col("node"), "left").drop("node").join(classes, F.col("rep") == F.col("node"), "left").select("rep", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))
    text = reps.select("k1", "k2", "rep", "copies").join(of_rep, "rep").select("k1", "k2", "root", (F.col("links") + F.col("copies") - 1).alias("links"))
    out = sk.select("doc_id", "k1", "k2").join(text, ["k1", "k2"], "left").groupBy("doc_id").agg(F.coalesce(F.min("root"), F.min("doc_id")).alias("class_id"), F.coalesce(F.max("links"), F.lit(0)).cast("bigint").alias("n_links"))
    nulls = docs.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return out.unionByName(nulls)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those in whose class another document comes first; all columns kept."""
    gone = stored(joined(docs, threshold).where("doc_id <> class_id").select("doc_id"))
    return docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)


def oracle(threshold: float = THRESHOLD, n: int = WORDS) -> str:
    """All pairs that share a shingle, compared on shingles as lists of words; for small tables."""
    ws = r"[ \t\n\x0B\f\r]"
    return f"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '{ws}+'), lambda x: x <> '') as w from documents),
s as (
  select distinct doc_id, list_slice(w, i, i + {n - 1}) as g from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - {n - 1}))) as i from w where len(w) > 0)),
c as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as n2 from s a join s b using (g) where a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from p join c ca on x = ca.doc_id join c cb on y = cb.doc_id where n2 >= {threshold} * (ca.n + cb.n - n2) - 1e-9),
r(x, y) as (select x, y from l union select r.x, l.y from r join l on r.y = l.x),
k as (select x, min(y) as y from r group by 1)
select d.doc_id, least(d.doc_id, coalesce(k.y, d.doc_id)) as class_id, coalesce((select count(*) from l where l.x = d.doc_id), 0)::bigint as n_links from documents d left join k on k.x = d.doc_id
"""
