"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language tells how far a text matches it from any place. A text is parsed into phrases, each the
longest match from where it starts (a symbol that never occurs is a phrase by itself); the language that needs fewest phrases, times log2 of
its training length and over the text's length, wins.

Symbols: the LETTERS most frequent training letters in lower case, others by a residue of their code point, and one symbol for any run of
other characters. Texts are parsed in stretches of STRETCH symbols, each from the automaton's root, all of a batch in step: a phrase ends at a
stretch's end, for every language alike. All of every text is parsed.

Training: at most about ROWS rows and SYMBOLS symbols of text for each language.

`und` with score 0 for null texts, texts without a letter, or when nothing was learned; ties go to the least language name. score is
1 - (entropy of the winner) / (entropy of the next): 0 for a tie, 1 if one language was learned. Repeated rows are scored each by itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, crc_mod, mapped
from .numtext import groups

LETTERS, RESIDUES, STRETCH, ROWS, SYMBOLS = 96, 24, 512, 80, 20_000
SEP, PAD = 0, 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def alphabet(texts: list[str]) -> str:
    count = Counter(c for t in texts for c in t.lower() if c.isalpha())
    return "".join(sorted(sorted(count, key=lambda c: (-count[c], c))[:LETTERS]))


@lru_cache(maxsize=4)
def symbol_table(letters: str) -> np.ndarray:
    """Code point to symbol: separator, pad (never), residues, letters."""
    t = np.where(_letters(), 2 + np.arange(0x110000) % RESIDUES, SEP).astype(np.uint8)
    for k, c in enumerate(letters):
        for form in {c, c.upper(), c.title()}:
            if len(form) == 1:
                t[ord(form)] = 2 + RESIDUES + k
    return t


def symbols(points: np.ndarray, table: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with runs of separators merged within each text, and the new bounds."""
    s = table[points]
    sep = s == SEP
    again = np.zeros(len(s), bool)
    again[1:] = sep[1:] & sep[:-1]
    inner = bounds[1:-1]
    again[inner[inner < len(s)]] = False
    keep = np.concatenate([[0], np.cumsum(~again)])
    return s[~again], keep[bounds]


def automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of seq; state 0 is the root."""
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                new = len(nxt)
                nxt.append(dict(nxt[q])), link.append(link[q]), length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = new
                    p = link[p]
                link[q] = link[cur] = new
        last = cur
    return nxt


@lru_cache(maxsize=2)
def parser(letters: str, training: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """One table for all languages: entry (root + state) * width + symbol holds the next such row and whether a phrase starts; and the roots."""
    width = 2 + RESIDUES + len(letters)
    parts, roots, at = [], [], 0
    for text in training:
        nxt = automaton(list(text))
        t = np.full((len(nxt), width), -1, np.int64)
        for s, row in enumerate(nxt):
            t[s, list(row)] = list(row.values())
        missing = t < 0
        t = np.where(missing, np.where(t[:1] < 0, 0, t[:1]), t)
        starts = missing.copy()
        starts[0] = True
        t[:, PAD], starts[:, PAD] = np.arange(len(nxt)), False
        parts.append((((t + at) * width) << 1 | starts).astype(np.int32).ravel())
        roots.append(at * width)
        at += len(nxt)
    return np.concatenate(parts), np.array(roots, np.int32)


def phrases(s: np.ndarray, bounds: np.ndarray, table: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Phrases (languages x texts)."""
    size = np.diff(bounds)
    n_str = -(-size // STRETCH)
    text = np.repeat(np.arange(len(size)), n_str)
    k = np.arange(len(text)) - np.repeat(np.cumsum(n_str) - n_str, n_str)
    start = bounds[:-1][text] + k * STRETCH
    length = np.minimum(STRETCH, bounds[1:][text] - start)
    order = np.argsort(-length, kind="stable")
    start, length, text = start[order], length[order], text[order]
    padded = np.concatenate([s, np.full(STRETCH, PAD, np.uint8)])
    state = np.repeat(roots[:, None], len(text), 1)
    count = np.zeros(state.shape, np.int32)
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(1, steps + 1), "right")
    for i in range(steps):
        m = alive[i]
        v = table[state[:, :m] + padded[start[:m] + i]]
        count[:, :m] += v & 1
        state[:, :m] = v >> 1
    return np.stack([np.bincount(text, c, len(size)) for c in count]) if len(text) else np.zeros((len(roots), len(size)))


def fit(docs: DataFrame, rows: int = ROWS, most: int = SYMBOLS) -> dict:
    """Languages, alphabet and training symbols from labelled rows (text and lang not null)."""
    some = bounded_sample(docs.where("text is not null and lang is not null").select("doc_id", "text", "lang"), rows, "lang", "lang")
    by: dict[str, list[str]] = {}
    for r in some.orderBy(F.xxhash64("doc_id", F.lit("lang")), "text").collect():
        by.setdefault(r["lang"], []).append(r["text"])
    langs = sorted(k for k, v in by.items() if any(c.isalpha() for t in v for c in t))
    letters = alphabet([t for k in langs for t in by[k]])
    table, training = symbol_table(letters), []
    for k in langs:
        points = np.frombuffer(" ".join(by[k]).encode("utf-32-le", "replace"), np.uint32)
        training.append(symbols(points, table, np.array([0, len(points)]))[0][:most].tobytes())
    return {"langs": langs, "letters": letters, "training": tuple(training)}


def predict_batch(text: pa.Array, model: dict) -> tuple[list[str], np.ndarray]:
    langs = model["langs"]
    pred, score = ["und"] * len(text), np.zeros(len(text))
    if not langs:
        return pred, score
    table, roots = parser(model["letters"], model["training"])
    code = symbol_table(model["letters"])
    weight = np.log2(np.maximum(2, [len(t) for t in model["training"]]))[:, None]
    lengths = np.asarray(pc.fill_null(pc.utf8_length(text), 0))
    for i, j, raw, _ in groups(text):
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum(lengths[i:j])])
        s, at = symbols(points, code, bounds)
        letters = np.concatenate([[0], np.cumsum(s != SEP)])[at]
        h = phrases(s, at, table, roots) * weight / np.maximum(1, np.diff(at))
        best = h.argmin(0)
        top = h[best, np.arange(j - i)]
        h[best, np.arange(j - i)] = np.inf
        second = h.min(0)
        sure = np.where(np.isinf(second), 1.0, 1 - top / np.maximum(second, 1e-300))
        for k in np.flatnonzero(np.diff(letters) > 0):
            pred[i + k], score[i + k] = langs[best[k]], min(1.0, max(0.0, float(sure[k])))
    return pred, score


def predicted(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out (crc32 of doc_id modulo 3 is 1), lang_pred, score: a row for each row of docs, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score = predict_batch(b.column("text"), shared.value)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": pred, "score": score})

    rows = docs.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "text")
    return mapped(rows, run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")
