"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(bias + sum of weights + sum over pairs of terms of the inner product of their factors), terms being the distinct words of a text
(letters and digits, lower case) hashed to 2**BITS buckets. The pair term lets two words count together as no sum of their own weights can.

Learned on at most about ROWS labelled rows. Buckets whose share among toxic and other rows differs by Z standard errors take part (TERMS of
them at most, the farthest apart), and so do both buckets of a pair that tells the classes apart by being together (`interactions`), whether or not
either does by itself. The rest score nothing, so the many words that occur once add no noise.

Empty and null texts score the bias. Several labels of a document: toxic if any says so. Null labels teach nothing. Without labels of both
kinds every score is the share of toxic labels (0 without any). Repeated rows are scored each by itself; ids and other columns are no inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, crc_mod, mapped
from .numtext import SYMBOLS, U, groups, list_of, words

BITS, ROWS, TERMS, FACTORS, Z = 18, 12_000, 1024, 8, 5.0
#: Pairs are looked for among at most PAIR_TERMS buckets, the most evenly spread over rows; a pair's contrast is PAIR_Z standard errors or more, and each of
#: its four cells has CELL rows or more. PAIRS of them at most, the strongest, take part. STEPS: gradient steps at least, however few the rows.
PAIR_TERMS, PAIR_Z, CELL, PAIRS, STEPS = 1536, 7.0, 20, 64, 1500


def _terms(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows i to j, and the row (from 0) and bucket of each word of theirs."""
    for i, j, raw, bounds in groups(pc.utf8_lower(pc.fill_null(text, ""))):
        _, _, h, row = words(raw, bounds, SYMBOLS)
        yield i, j, row, (h >> U(64 - BITS)).astype(np.int64)


def term_lists(rows: DataFrame) -> DataFrame:
    """toxic and the distinct buckets of text, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, sizes = [np.zeros(0, np.int32)], []
            for i, j, row, bucket in _terms(b.column("text")):
                u = np.unique((row << BITS) | bucket)
                parts.append((u & ((1 << BITS) - 1)).astype(np.int32))
                sizes.append(np.bincount(u >> BITS, minlength=j - i))
            yield pa.RecordBatch.from_arrays([b.column("toxic"), list_of(np.concatenate(parts), np.concatenate(sizes) if sizes else np.zeros(0, int))], ["toxic", "terms"])

    return mapped(rows.select("toxic", "text"), run, "toxic int, terms array<int>")


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> dict:
    """Learn from labels of documents whose crc32 of doc_id modulo 5 isn't 0."""
    known = labels.where(F.col("toxic").isNotNull() & (crc_mod("doc_id", 5) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    some = bounded_sample(known, rows, "toxic")
    # at most about `rows` rows of two numbers, so a broadcast is bounded
    got = term_lists(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("toxic", "text")).toArrow()
    y = got.column("toxic").to_numpy().astype(np.float64)
    lists = got.column("terms").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    return train(y, np.asarray(lists.flatten()).astype(np.int64), np.diff(np.asarray(lists.offsets)).astype(np.int64))


def interactions(y: np.ndarray, row: np.ndarray, terms: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Buckets of pairs whose toxic shares aren't a sum of the two: |s11 - s10 - s01 + s00| in standard errors, over the four cells of with and
    without. Pairs of `known` buckets are left out, as those take part anyway."""
    n = np.bincount(terms, minlength=1 << BITS).astype(np.float64)
    spread = np.minimum(n, len(y) - n)
    top = np.argsort(-spread, kind="stable")[:PAIR_TERMS]
    top = np.sort(top[spread[top] >= 2 * CELL])
    if len(top) < 2:
        return top[:0]
    at = np.full(1 << BITS, -1, np.int32)
    at[top] = np.arange(len(top))
    col = at[terms]
    x = np.zeros((len(y), len(top)), np.float32)
    x[row[col >= 0], col[col >= 0]] = 1
    toxic = x[y > 0]
    n1, t1, share = x.sum(0, dtype=np.float64), toxic.sum(0, dtype=np.float64), y.mean()
    old, found = np.isin(top, known), []
    for a in range(0, len(top), 256):  # 256 buckets against all
        n11 = (x[:, a : a + 256].T @ x).astype(np.float64)
        t11 = (toxic[:, a : a + 256].T @ toxic).astype(np.float64)
        na, ta = n1[a : a + 256, None], t1[a : a + 256, None]
        cells = [(t11, n11, 1), (ta - t11, na - n11, -1), (t1 - t11, n1 - n11, -1), (y.sum() - ta - t1 + t11, len(y) - na - n1 + n11, 1)]
        contrast = sum(sign * t / np.maximum(m, 1) for t, m, sign in cells)
        error = np.sqrt(share * (1 - share) * sum(1 / np.maximum(m, 1) for _, m, _ in cells))
        z = np.abs(contrast) / error
        z[np.minimum.reduce([m for _, m, _ in cells]) < CELL] = 0
        z[old[a : a + 256, None] & old] = 0
        z[np.arange(a, a + len(z))[:, None] >= np.arange(len(top))] = 0
        i, j = np.nonzero(z >= PAIR_Z)
        found += zip(-z[i, j], i + a, j, strict=True)
    return np.unique([top[k] for _, i, j in sorted(found)[:PAIRS] for k in (i, j)]).astype(np.int64)


def train(y: np.ndarray, terms: np.ndarray, sizes: np.ndarray, seed: int = 11, epochs: int = 40) -> dict:
    index = np.full(1 << BITS, -1, np.int32)
    share = float(y.mean()) if len(y) else 0.0
    none = {"bias": float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), "index": index, "w": np.zeros(0), "v": np.zeros((0, FACTORS))}
    if not 0 < share < 1:
        return none
    row = np.repeat(np.arange(len(y)), sizes)
    pos = np.bincount(terms, y[row], 1 << BITS)
    neg = np.bincount(terms, 1 - y[row], 1 << BITS)
    n1, n0 = y.sum(), len(y) - y.sum()
    p = (pos + neg) / len(y)
    z = np.abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    z[pos + neg < 5] = 0
    chosen = np.argsort(-z, kind="stable")[:TERMS]
    chosen = chosen[z[chosen] >= Z]
    chosen = np.union1d(chosen, interactions(y, row, terms, chosen))
    if not len(chosen):
        return none
    index[chosen] = np.arange(len(chosen))
    x = np.zeros((len(y), len(chosen)), np.float32)
    col = index[terms]
    x[row[col >= 0], col[col >= 0]] = 1
    rng = np.random.default_rng(seed)
    par = [np.array([none["bias"]]), np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), FACTORS))]
    m, s, t = [np.zeros_like(q) for q in par], [np.zeros_like(q) for q in par], 0
    for _ in range(max(epochs, -(-STEPS // -(-len(y) // 512)))):
        order = rng.permutation(len(y))
        for k in range(0, len(order), 512):
            xb, yb = x[order[k : k + 512]], y[order[k : k + 512]]
            xv = xb @ par[2]
            out = par[0] + xb @ par[1] + 0.5 * ((xv**2).sum(1) - xb @ (par[2] ** 2).sum(1))
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - yb) / len(yb)
            grads = [np.array([g.sum()]), xb.T @ g + 1e-4 * par[1], xb.T @ (g[:, None] * xv) - par[2] * (xb.T @ g)[:, None] + 1e-4 * par[2]]
            t += 1
            for i in range(3):
                m[i] = 0.9 * m[i] + 0.1 * grads[i]
                s[i] = 0.999 * s[i] + 0.001 * grads[i] ** 2
                par[i] = par[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.999**t)) + 1e-8)
    return {"bias": float(par[0][0]), "index": index, "w": par[1], "v": par[2]}


def score_batch(text: pa.Array, model: dict) -> np.ndarray:
    out = np.full(len(text), model["bias"])
    f = len(model["w"])
    for i, j, row, bucket in _terms(text):
        col = model["index"][bucket]
        u = np.unique(row[col >= 0] * max(f, 1) + col[col >= 0])
        r, c = u // max(f, 1), u % max(f, 1)
        n = j - i
        out[i:j] += np.bincount(r, model["w"][c], n)
        for k in range(model["v"].shape[1]):
            v = model["v"][c, k]
            out[i:j] += 0.5 * (np.bincount(r, v, n) ** 2 - np.bincount(r, v * v, n))
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out (crc32 of doc_id modulo 5 is 0), score, predicted: a row for each row of docs, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = score_batch(b.column("text"), shared.value)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": score, "predicted": (score >= 0.5).astype(np.int32)})

    rows = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return mapped(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: dict) -> DataFrame:
    """docs without those that score 0.5 or more, all columns kept, in one pass. Only texts go to Python and only verdicts come back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def stays(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            yield pa.array(score_batch(text, shared.value) < 0.5)

    return docs.where(stays("text"))
