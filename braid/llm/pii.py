"""PII: base patterns, and a skip-chain conditional random field that carries their labels to tokens the patterns miss.

Units are the spans of a text that could be personal data: runs around an `@`, groups of digits with single separators (at its spaces, where a group
is too long for any number and its parts aren't), and runs of 16 or more letters, digits, `_` and `-` that mix letters and digits. Each unit is a variable with the labels none, email, ip, card, phone, secret. Node potentials come from its shape, chain potentials tie it to the unit before it, and
skip potentials tie units of the same document with equal normal form or equal last digits, however far apart. Units that a base pattern covers are
observed, and so are mixed runs that a word such as `token` or `password` introduces, as secrets. Each copy of an observed unit is tied to one itself (the last before it, else the first); where none is observed, to the next copy: k
copies have k - 1 ties. Loopy sum-product passes messages between the others until they settle; a unit whose marginal reaches SURE, for a label its form allows, becomes a span, and so a number written once with its country code and elsewhere without it is found twice.

Weights are learned by pseudo-likelihood (softmax regression on shape, neighbour label and tied labels, with shapes dropped at random so that
ties have to explain) on a sample of at most SAMPLE rows that have a digit or `@`, with what is observed as labels: a form that is nearly always introduced as a secret
is one without the word, too.

Null and empty texts have no spans. Repeated rows are treated each by itself; only doc_id and text are read. Texts without digit or `@` can't
hold a unit and stay in the JVM. Every pattern is matched in time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, mapped

KINDS = ("email", "ip", "card", "phone")
#: What a unit can be: the base kinds, and credentials, which only the field finds.
LABELS = (*KINDS, "secret")
#: PRIOR: what a tie weighs for agreement before data speak: equal identifiers of a document are nearly always of one kind.
SAMPLE, SURE, PRIOR = 2000, 0.9, 10.0
#: Messages have settled if none moves by more; the rounds only end what would never settle.
SETTLED, ROUNDS = 1e-4, 2000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
#: A match starts where a run of digits does: what fails there fails further on as well.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"\+?[0-9](?:[ ().-]{0,3}[0-9])*+")
_AFTER = re.compile(r"[A-Za-z0-9.-]*+")
_PART = re.compile(r"[^ ]+")
_MIXED = re.compile(r"[A-Za-z0-9_-]{16,}+")
#: Words that introduce a credential, with what may stand between them and it. BEFORE characters are looked at.
_SECRET = re.compile(r"""(?i)(?:token|secret|passw(?:or)?d|passphrase|credentials?|bearer|(?:api|access|private|auth)[ _-]?key)["']?[ \t]{0,2}[=:]?[ \t]{0,2}["']?\Z""")
BEFORE = 32


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _around_at(text: str) -> Iterator[tuple[int, int]]:
    """Start of the local part before each `@`, and its position."""
    at = text.find("@")
    while at >= 0:
        i = at
        while i and text[i - 1] in _LOCAL:
            i -= 1
        yield i, at
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, sorted."""
    out, last = [], 0
    for i, at in _around_at(text):
        i = max(i, last)
        if i < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((i, 0, m.end()))
            last = m.end()
    for m in _IP.finditer(text):
        if all(int(x) <= 255 if len(x) < 10 else not x.strip("0") or int(x[-9:]) <= 255 and not x[:-9].strip("0") for x in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _mixed(u: str) -> bool:
    return any(c.isdigit() for c in u) and any(c.isalpha() for c in u)


def _units(text: str) -> list[tuple[int, int]]:
    found, last = [], 0
    for i, at in _around_at(text):
        if at >= last:
            end = _AFTER.match(text, at + 1).end()
            found.append((max(i, last), end))
            last = end
    for m in _NUMBER.finditer(text):
        if sum(c.isdigit() for c in m.group()) > 19 and all(sum(c.isdigit() for c in part) <= 19 for part in m.group().split(" ")):
            found += [(m.start() + part.start(), m.start() + part.end()) for part in _PART.finditer(m.group())]
        else:
            found.append(m.span())
    found += [m.span() for m in _MIXED.finditer(text) if _mixed(m.group())]
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int]] = []
    for s, e in found:
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


N_SHAPE = 26


def _allowed(u: str) -> list[bool]:
    """Labels that a unit may get at all."""
    digits = "".join(c for c in u if c.isdigit())
    mail = "@" in u
    quad = u.count(".") == 3 and u.replace(".", "").isdigit()
    if not mail and _mixed(u):
        return [True, False, False, False, False, len(u) >= 16]
    return [True, mail, quad, not mail and not quad and 14 <= len(digits) <= 19 and luhn(digits), not mail and not quad and 7 <= len(digits) <= 15, False]


def _shape(text: str, s: int, e: int) -> list[int]:
    u = text[s:e]
    digits = sum(c.isdigit() for c in u)
    f = [0, 1 + min(6, (digits + 2) // 3)]
    f += [8] * ("@" in u) + [9] * u.startswith("+") + [10] * ("." in u) + [11] * (u.count(".") == 3) + [12] * ("-" in u) + [13] * ("(" in u) + [14] * (" " in u)
    if "@" not in u and _mixed(u):
        turns = sum(a.isdigit() != b.isdigit() for a, b in pairwise(u))
        f += [20 + min(2, 8 * turns // len(u))] + [23] * (not u.strip("0123456789abcdefABCDEF")) + [24] * (len(u) >= 32) + [25] * ("_" in u or "-" in u)
    f += [15] * any(c.isalpha() for c in u) + [16] * (s > 0 and text[s - 1].isalnum()) + [17] * (e < len(text) and text[e].isalnum()) + [18] * u.isdigit() + [19] * (digits >= 14)
    return f


def _graph(texts: list[str]) -> dict[str, np.ndarray]:
    """Units of all texts, their shapes, base labels, and the chain and skip ties between them."""
    doc, start, end, label, covered, shapes, allowed, chain, skip = [], [], [], [], [], [], [], [], []
    for d, text in enumerate(texts):
        base, k, copies = base_spans(text), 0, {}
        first = len(doc)
        for s, e in _units(text):
            while k < len(base) and base[k][2] <= s:
                k += 1
            cover = next((b for b in base[k : k + 4] if b[0] < e and b[2] > s), None)
            i = len(doc)
            doc.append(d), start.append(s), end.append(e), covered.append(cover is not None)
            if cover is None:
                may = _allowed(text[s:e])[-1]
                label.append(len(LABELS) if may and _SECRET.search(text[max(0, s - BEFORE) : s]) else 0)
            else:
                label.append(cover[1] + 1)
            shapes.append(_shape(text, s, e)), allowed.append(_allowed(text[s:e]))
            if i > first:
                chain.append((i - 1, i))
            u = text[s:e].lower()
            digits = "".join(c for c in u if c.isdigit())
            for key in {u, digits[-7:] if "@" not in u and len(digits) >= 7 else u}:
                copies.setdefault(key, []).append(i)
        for same in copies.values():
            anchor = next((i for i in same if label[i]), None)
            for j, i in enumerate(same):
                if anchor is None:
                    skip.extend([(same[j - 1], i)] if j else [])
                elif i != anchor:
                    skip.append((anchor, i))
                if label[i]:
                    anchor = i
    x = np.zeros((len(doc), N_SHAPE), np.float32)
    for i, f in enumerate(shapes):
        x[i, f] = 1
    pairs = lambda p: np.array(p, np.int64).reshape(-1, 2)
    return {"doc": np.array(doc, np.int64), "start": np.array(start, np.int64), "end": np.array(end, np.int64), "label": np.array(label, np.int64), "covered": np.array(covered, bool), "x": x, "allowed": np.array(allowed, bool).reshape(-1, len(LABELS) + 1), "chain": pairs(chain), "skip": pairs(skip)}


def train(texts: list[str], seed: int = 7, steps: int = 400) -> dict[str, np.ndarray]:
    """Weights: node (shapes x labels), chain (labels x labels), skip (one for agreement)."""
    g, n_lab, rng = _graph(texts), len(LABELS) + 1, np.random.default_rng(seed)
    node, chain, skip = np.zeros((N_SHAPE, n_lab)), np.zeros((n_lab, n_lab)), np.full(1, PRIOR)
    y, n = np.eye(n_lab)[g["label"]], max(1, len(g["label"]))
    before, after, tied = np.zeros((n, n_lab)), np.zeros((n, n_lab)), np.zeros((n, n_lab))
    if len(g["label"]):
        a, b = g["chain"].T
        before[b], after[a] = y[a], y[b]
        for i, j in (g["skip"].T, g["skip"].T[::-1]):
            np.add.at(tied, i, y[j])
        for _ in range(steps):
            x = g["x"] * (rng.random(g["x"].shape) < 0.5)
            z = x @ node + before @ chain + after @ chain.T + tied * skip
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            r = y - p
            node += 2.0 * (x.T @ r / n - 1e-4 * node)
            chain += 2.0 * ((before.T @ r + r.T @ after) / n - 1e-4 * chain)
            skip += 2.0 * ((tied * r).sum() / n - 1e-2 * (skip - PRIOR))
    return {"node": node, "chain": chain, "skip": np.maximum(skip, 0.0)}


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


def marginals(g: dict[str, np.ndarray], w: dict[str, np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product over all documents of a batch at once, in log space; observed units are clamped."""
    n_lab = w["node"].shape[1]
    phi = np.where(g["allowed"], g["x"] @ w["node"], -1e3)
    seen = g["label"] > 0
    phi[seen] = -1e9  # whatever the number of copies that say otherwise
    phi[seen, g["label"][seen]] = 0
    edges = np.concatenate([g["chain"], g["skip"]])
    psi = np.concatenate([np.repeat(w["chain"][None], len(g["chain"]), 0), np.repeat(np.eye(n_lab)[None] * w["skip"], len(g["skip"]), 0)])
    a, b = edges.T
    right, left = np.zeros((len(edges), n_lab)), np.zeros((len(edges), n_lab))  # messages a to b, b to a
    belief = phi.copy()
    for _ in range(rounds if len(edges) else 0):
        new_right = _lse((belief[a] - left)[:, :, None] + psi, 1)
        new_left = _lse((belief[b] - right)[:, None, :] + psi, 2)
        new_right = 0.5 * right + 0.5 * (new_right - new_right.max(1, keepdims=True))
        new_left = 0.5 * left + 0.5 * (new_left - new_left.max(1, keepdims=True))
        moved = max(np.abs(new_right - right).max(), np.abs(new_left - left).max())
        right, left = new_right, new_left
        belief = phi.copy()
        np.add.at(belief, b, right)
        np.add.at(belief, a, left)
        if moved <= SETTLED:
            break
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def spans(texts: list[str], w: dict[str, np.ndarray]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """For each text its base spans, and those that the field adds: (start, kind index, end)."""
    g = _graph(texts)
    out = [(base_spans(t), []) for t in texts]
    if len(g["doc"]):
        p = marginals(g, w)
        best = p.argmax(1)
        for i in np.flatnonzero(~g["covered"] & (best > 0) & (p.max(1) >= SURE)):
            out[g["doc"][i]][1].append((int(g["start"][i]), int(best[i]) - 1, int(g["end"][i])))
    return out


def _text(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{LABELS[k]}:{s}:{e}" for s, k, e in sorted(found))


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Learn on at most about `sample` rows; no rows give weights under which only ties decide."""
    rows = bounded_sample(docs.select("doc_id", "text").where("text rlike '[0-9@]'"), sample, "pii").select("doc_id", "text").orderBy("doc_id", "text").collect()
    return train([r["text"] for r in rows])


def found(docs: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, counts of base spans, base_sha256, spans, n_added, n_spans (base and added): a row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            texts = batch.column("text")
            counts, digest, all_spans, added = np.zeros((4, n), np.int64), [empty] * n, [""] * n, np.zeros(n, np.int64)
            some = np.flatnonzero(np.asarray(texts.is_valid()))
            for part in range(0, len(some), 256):
                rows = some[part : part + 256]
                for i, (base, more) in zip(rows, spans([texts[int(i)].as_py() for i in rows], shared.value), strict=True):
                    for _, k, _ in base:
                        counts[k, i] += 1
                    digest[i] = hashlib.sha256(_text(base).encode()).hexdigest()
                    all_spans[i] = _text(base + more)
                    added[i] = len(more)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{f"n_{k}": counts[j] for j, k in enumerate(KINDS)}, "base_sha256": digest, "spans": all_spans, "n_added": added, "n_spans": counts.sum(0) + added})

    some = docs.select("doc_id", F.when(F.col("text").rlike("[0-9@]"), F.col("text")).alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    return mapped(some, run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, n_spans bigint")
