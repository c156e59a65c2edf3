"""The operators against brute force, on small fixtures with nulls, empty and long texts, ties, repeated rows and columns of clashing names."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from braid.llm import catalog, chat_tree, decontamination, graph, language_id, line_dedup, mixing, ngram_join, numtext, pii, quality_rules, substring_dedup, toxicity
from braid.llm.common import table

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, h string, root bigint, kept string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", None if k % 5 == 4 else f"s{k % 3}", None if t is None else len(t), 1, "x", 2, "y") for k, (i, t) in enumerate(zip(ids, texts))], SCHEMA)


def prose(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


EMPTY = [None, "", " \n\t ", "x", "?!", "ß ǆ 東京 ١٢", "\u0000a\u0085b"]


# --- arithmetic


def test_word_hashes_follow_equality():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n.") for _ in range(rng.randrange(40))) for _ in range(300)] + ["", "a" * 5000]
    buf, at = numtext.utf8(pa.array(texts))
    for sep, pattern in ((numtext.SPACES, r"[^ \t\n\x0b\x0c\r]+"), (numtext.SYMBOLS, r"[^\x00-/:-@\[-`{-\x7f]+")):
        s, e, h, row = numtext.words(buf, at, sep)
        got = [bytes(buf[a:b]).decode() for a, b in zip(s, e)]
        assert got == [w for t in texts for w in re.findall(pattern, t)]
        assert list(row) == [i for i, t in enumerate(texts) for _ in re.findall(pattern, t)]
        assert len(set(zip(got, h.tolist()))) == len(set(got)) == len(set(h.tolist()))


def test_hash_is_the_same_in_any_piece(monkeypatch):
    texts = [prose(random.Random(2), 300)]
    buf, at = numtext.utf8(pa.array(texts))
    whole = numtext.words(buf, at, numtext.SPACES)[2]
    monkeypatch.setattr(numtext, "PIECE", 64)
    assert (numtext.words(buf, at, numtext.SPACES)[2] == whole).all()


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- 1


def brute_pii(text):
    text = text or ""
    out = []
    for k, (kind, p) in enumerate((("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_is_the_contract(spark, data):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a1.@+-( )%９\n") for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["1" * 5000, "a" * 5000 + "@b", "a@" * 300 + "b.c", "1." * 2000, "+" * 2000 + "1 2 3 4 5 6 7 8 9 0", "é 4539578763621486 x 10.0.0.256 10.0.0.255 a@b.co.. +1 (372) 555-7739"]
    for t in texts:
        assert pii.base_spans(t) == brute_pii(t), t[:100]
    docs = table(spark, data, "documents")
    got = {r.doc_id: r for r in catalog.op1_pii(spark, data).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        base = brute_pii(r.text)
        want = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (g.n_email, g.n_ip, g.n_card, g.n_phone) == tuple(sum(k == x for _, k, _ in base) for x in range(4))
        assert not want or set(want.split(",")) <= set(g.spans.split(","))


def test_pii_ties_carry_labels(spark):
    rng = random.Random(5)
    tel = lambda: f"{rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    prose = lambda rng, n: " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(n))
    train = [f"{prose(rng, 30)} +1 ({tel()} {prose(rng, 30)} mail a{i}@b.org version {rng.randrange(9)}.{rng.randrange(9)} of {rng.randrange(10**6)}" for i in range(200)]
    w = pii.train(train)
    text = f"{prose(rng, 200)} +1 (372) 555-7739 {prose(rng, 2000)} (372) 555-7739 {prose(rng, 100)} 372-555-7739 and 20240101"
    (base, added), (none, nothing) = pii.spans([text, "on 2024-01-01 he paid 1234567 twice, 1234567 in all"], w)
    assert len(base) == 1 and none == [] and nothing == []
    assert [text[s:e] for s, _, e in added] == ["372) 555-7739", "372-555-7739"] and all(k == 3 for _, k, _ in added)
    r = pii.found(frame(spark, EMPTY + [text, text]), w).collect()
    assert len(r) == len(EMPTY) + 2 and all(x.spans == "" for x in r[: len(EMPTY)])
    assert pii.found(frame(spark, []), w).count() == 0
    assert pii.train([])["node"].shape == (pii.N_SHAPE, 6)


# --- 2


def brute_phrases(text, training):
    n = i = 0
    while i < len(text):
        j = i
        while j < len(text) and text[i : j + 1] in training:
            j += 1
        i = max(j, i + 1)
        n += 1
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(6)
    train = tuple(bytes(rng.choice(b"\x1a\x1b\x1c\x00\x02") for _ in range(200)) for _ in range(3))
    table_, roots = language_id.parser("abc", train)
    texts = [bytes(rng.choice(b"\x1a\x1b\x1c\x1c\x00\x03") for _ in range(rng.randrange(0, 1300))) for _ in range(30)] + [b""]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = language_id.phrases(np.frombuffer(b"".join(texts), np.uint8), at, table_, roots)
    for k, t in enumerate(texts):
        for lang, tr in enumerate(train):
            assert got[lang, k] == sum(brute_phrases(t[i : i + language_id.STRETCH], tr) for i in range(0, len(t), language_id.STRETCH))


def test_language(spark, data):
    docs = table(spark, data, "documents")
    got = catalog.op2_language_id(spark, data).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got) and len(got) == docs.count()
    m = language_id.fit(docs)
    rows = language_id.predicted(frame(spark, EMPTY + ["A" * 70_000]), m).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in rows] == [True, True, True, False, True, False, False, False]
    none = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.predicted(frame(spark, ["abc"]), none).collect()} == {"und"}


# --- 3


def brute_contained(texts, items):
    def sh(t):
        w = re.sub(r"[^\w]|_", " ", (t or "").lower()).split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    out = set()
    for i, x in items:
        a = sh(x)
        for d, t in texts:
            n = len(a & sh(t))
            if a and n >= 0.8 * len(a) - 1e-9:
                out.add((d, i, len(a), n))
    return out


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_contained(spark, monkeypatch, rows):
    """The same with sides broadcast and shuffled."""
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", rows)
    rng = random.Random(7)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 5, 6, 9, 20, 40, 80, 200])] + [(90, None), (91, "")]
    texts = []
    for d in range(60):
        words = prose(rng, rng.randrange(0, 3000)).split()
        for _ in range(rng.randrange(3)):
            part = (items[rng.randrange(8)][1]).upper().split()
            for _ in range(rng.randrange(4)):
                if rng.random() < 0.5:
                    part[rng.randrange(len(part))] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        texts.append(", ".join(words))
    texts += EMPTY + [texts[0]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {tuple(r) for r in decontamination.contained(frame(spark, texts), bench).collect()}
    assert got == brute_contained(list(enumerate(texts)), items) and len(got) > 10
    left = decontamination.decontaminated(frame(spark, texts), bench)
    assert left.columns == frame(spark, []).columns
    assert {r.doc_id for r in left.collect()} == set(range(len(texts))) - {d for d, *_ in got}


def test_contained_of_shared_and_null_ids(spark):
    """Rows of an id with different texts are searched one by one; a match of an id is of one text and one item; null ids match as well."""
    rng = random.Random(21)
    a, b = prose(rng, 20), prose(rng, 40)
    docs = spark.createDataFrame([(1, a), (1, b), (None, f"{a} more"), (2, "clean " * 30), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, a), (7, b), (None, a), (None, None)], "item_id bigint, text string")
    got = {tuple(r) for r in decontamination.contained(docs, items).collect()}
    assert got == {(1, 7, 36, 36), (1, None, 16, 16), (None, 7, 16, 16), (None, None, 16, 16)}
    assert [tuple(r) for r in decontamination.decontaminated(docs, items).orderBy("doc_id").collect()] == [(2, "clean " * 30), (3, None)]
    assert decontamination.contained(docs.where("false"), items).count() == decontamination.contained(docs, items.where("false")).count() == 0


# --- 4


def test_chat_round_trip(spark):
    rng = random.Random(8)
    bits = ["<|im_end|>", "<|im_start|>", "\\", "\n", "<", "|", "hello", "é", "\\n", "<|"]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 6)):
            seed = random.Random(f"{t}:{rng.randrange(3)}")
            rows.append((c, t, ("user", "assistant", "sys\ntem")[t % 3], None if rng.random() < 0.05 else "".join(seed.choice(bits) for _ in range(seed.randrange(6)))))
    rows += [(7, 0, "user", "twice"), (7, 0, "user", "twice"), (None, 0, None, None), (500, None, "assistant", "x" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    convs, packs = chat_tree.formatted(df, pack=300)
    got = {r.conv_id: r for r in convs.join(chat_tree.read_back(packs), "path_id").collect()}
    by = {}
    for c, t, r, x in sorted(rows, key=lambda q: (q[0] is not None, q[0] or 0, q[1] is not None, q[1] or 0, q[2] or "", q[3] or "")):
        by.setdefault(c, []).append((r or "", x or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == sum(len(chat_tree.piece(r, x)[0]) for r, x in turns)
    for p in packs.collect():
        seen = set()
        for k, n in enumerate(p.nodes):
            way, up = [], n.parent
            while up >= 0:
                way.append(p.nodes[up])
                up = p.nodes[up].parent
            assert n.parent < k and n.pos == sum(w.end - w.start for w in way)
            covered = sorted(i for a in n.attn for i in range(a.start, a.end)) if n.end < 5000 else None
            assert covered is None or covered == sorted(i for w in way for i in range(w.start, w.end))
            key = (n.parent, p.text[n.start : n.end])
            assert key not in seen  # shared turns once
            seen.add(key)
    total = sum(len(p.text) for p in packs.collect())
    assert total < sum(r.formatted_chars for r in got.values())


# --- 5


def test_toxicity_pairs_without_margins():
    """Toxic is one of two words without the other: neither has a share of its own, and only their pair tells."""
    rng = np.random.default_rng(3)

    def made(n):
        texts, y = [], []
        for _ in range(n):
            a, b = (int(k) for k in rng.integers(0, 2, 2))
            texts.append(" ".join([f"w{k}" for k in rng.integers(0, 300, 20)] + ["insult"] * a + ["group"] * b))
            y.append(float(a != b))
        return texts, np.array(y)

    texts, y = made(4000)
    terms, sizes = [], []
    for i, j, row, bucket in toxicity._terms(pa.array(texts)):
        u = np.unique((row << toxicity.BITS) | bucket)
        terms.append(u & ((1 << toxicity.BITS) - 1)), sizes.append(np.bincount(u >> toxicity.BITS, minlength=j - i))
    m = toxicity.train(y, np.concatenate(terms), np.concatenate(sizes))
    texts, y = made(1000)
    assert ((toxicity.score_batch(pa.array(texts), m) >= 0.5) == (y > 0)).mean() >= 0.95


def test_toxicity_pairs_and_held_out(spark, data):
    rng = np.random.default_rng(9)
    y, terms, sizes = [], [], []
    for _ in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        t = sorted({*([10] if a else []), *([20] if b else []), *rng.integers(100, 5000, 8)})
        y.append(float(a and b)), terms.extend(t), sizes.append(len(t))
    m = toxicity.train(np.array(y), np.array(terms), np.array(sizes), epochs=60)
    i, j = m["index"][10], m["index"][20]
    assert m["bias"] + m["w"][i] < 0 and m["bias"] + m["w"][j] < 0
    assert m["bias"] + m["w"][i] + m["w"][j] + m["v"][i] @ m["v"][j] > 0 and m["v"][i] @ m["v"][j] > 0
    lone = toxicity.train(np.zeros(0), np.zeros(0, int), np.zeros(0, int))
    assert (toxicity.score_batch(pa.array(["a", None]), lone) < 1e-6).all()

    vocab = ["good", "day", "we", "they", "run", "tree", "sky"] + [f"x{i}" for i in range(300)]
    rows, labels = [], []
    r = random.Random(10)
    for d in range(2000):
        bad = r.random() < 0.2
        rows.append(" ".join(r.choice(vocab) for _ in range(40)) + (" idiot, clown!" if bad else ""))
        labels.append((d, int(bad)))
    labels += [(3, None), (3, labels[3][1]), (10**6, 1)]
    docs, lab = frame(spark, rows + EMPTY), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    m = toxicity.fit(docs, lab)
    got = {x.doc_id: x for x in toxicity.scored(docs, m).collect()}
    assert len(got) == 2000 + len(EMPTY) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got.values())
    held = [d for d in range(2000) if got[d].held_out]
    assert len(held) > 300 and sum(got[d].predicted == labels[d][1] for d in held) >= 0.99 * len(held)
    kept = toxicity.clean(docs, m)
    assert kept.columns == docs.columns and {x.doc_id for x in kept.collect()} == {d for d, x in got.items() if not x.predicted}
    assert toxicity.scored(docs, toxicity.fit(docs, lab.where("false"))).where("predicted = 1").count() == 0


# --- 6


def brute_cut(rows):
    seen, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for s in range(len(b) - 99):
            if seen.setdefault(b[s : s + 100], (d, s)) != (d, s):
                cover[s] += 1
                cover[s + 100] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        n = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), n, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [substring_dedup.MOST, 1])
def test_substrings(spark, monkeypatch, most):
    rng = random.Random(11)
    passages = [prose(rng, 60) for _ in range(4)] + ["ab" * 150, "é" * 200, "x" * 99, "y" * 100]
    texts = []
    for _ in range(80):
        parts = [prose(rng, rng.randrange(30), 30) for _ in range(4)]
        for p in rng.sample(passages, rng.randrange(3)):
            p = list(p)
            if rng.random() < 0.4:
                p[rng.randrange(len(p))] = "#"
            parts.insert(rng.randrange(4), "".join(p))
        texts.append(" ".join(parts))
    texts += EMPTY + texts[:5] + ["z" * 1000, "z" * 1000, "q" * 300]
    got = sorted(tuple(r)[:5] for r in substring_dedup.cut_out(frame(spark, texts), most).collect())
    assert got == sorted(brute_cut(list(enumerate(texts))))
    assert sum(r[2] for r in got) > 5000


def test_substrings_odd_rows(spark):
    text = prose(random.Random(12), 200)
    rows = spark.createDataFrame([(3, text), (3, text), (None, text), (9, None), (5, text[:150])], "doc_id bigint, text string")
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.cut_out(rows).collect()}
    n = len(text.encode())
    assert got == {(None, 0), (3, n), (9, 0), (5, 150)}
    assert substring_dedup.cut_out(rows.where("false")).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(13)
    text = prose(rng, 3000, 5000)
    text = text + text[1000:1400] + prose(rng, 500, 5000)
    want = brute_cut([(0, text)])[0]
    import braid.llm.substring_dedup as sd

    whole = sd.anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    parts = [sd.anchors(np.frombuffer(text.encode()[k : k + 1000 + 99], np.uint8), np.array([0, min(1099, len(text) - k)])) for k in range(0, len(text), 1000)]
    starts = lambda lo, span: {s for a, n in zip(lo, span) for s in range(a, a + n + 1)}
    assert starts(whole[3], whole[4]) == set().union(*[{s + 1000 * k for s in starts(p[3], p[4])} for k, p in enumerate(parts)])
    assert tuple(substring_dedup.cut_out(frame(spark, [text])).first())[:5] == want


# --- 7


def test_mixing(spark):
    docs = frame(spark, [f"t{i}" for i in range(4000)] + EMPTY)
    r = {x["source"]: x for x in mixing.rates(docs).collect()}
    assert set(r) == {"", "s0", "s1", "s2"} and abs(sum(x.n * x.rate for x in r.values()) - docs.count()) < 1
    out = mixing.mixed(docs)
    n = {x["source"] or "": x["count"] for x in out.groupBy("source").count().collect()}
    for s, x in r.items():
        assert abs(n[s] - x.n * x.rate) < 6 * (x.n * x.rate) ** 0.5
    assert out.columns == [*docs.columns, "copy"]
    again = sorted(map(tuple, out.select("doc_id", "copy").collect()))
    assert again == sorted(map(tuple, mixing.mixed(docs.repartition(3)).select("doc_id", "copy").collect()))
    only = mixing.mixed(docs, {"s1": 1.0}, total=20)
    assert {x["source"] for x in only.select("source").distinct().collect()} <= {"s1"}
    few = mixing.mixed(frame(spark, ["a"]), total=3000)  # a rate over a piece's
    assert 2700 < few.count() < 3300
    assert mixing.mixed(frame(spark, [])).count() == 0
    clash = docs
    for c in ("copy", "n", "rate", "times", "source_", "key", "pieces", "cdf", "_rate", "_key"):
        clash = clash.withColumn(c, clash["root"])
    assert mixing.mixed(clash).columns == [*clash.columns, "_copy"] and mixing.mixed(clash).count() == out.count()


# --- 8


def brute_join(rows, t=0.8):
    def sh(x):
        w = re.findall(r"[^ \t\n\x0b\x0c\r]+", (x or "").lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    s = [sh(x) for _, x in rows]
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and both >= t * len(s[i] | s[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return {(rows[i][0], rows[root[i]][0], links[i]) for i in range(len(rows))}


def test_ngram_join(spark, monkeypatch):
    rng = random.Random(14)
    texts = []
    for _ in range(25):
        base = prose(rng, rng.choice([3, 8, 60, 200])).split()
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            texts.append(rng.choice([" ", "\n"]).join(w))
    texts += texts[:6] + EMPTY
    got = ngram_join.joined(frame(spark, texts))
    assert {tuple(r) for r in got.collect()} == brute_join(list(enumerate(texts)))
    one = ngram_join.one_of_each(frame(spark, texts))
    assert one.columns == frame(spark, []).columns
    assert {r.doc_id for r in one.collect()} == {r.class_id for r in got.collect()}
    assert ngram_join.joined(frame(spark, [])).count() == 0


def test_ngram_join_in_blocks(spark):
    """A group larger than a block loses no link."""
    rng = random.Random(15)
    base = prose(rng, 120).split()
    texts = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    sets = [(0, d, 1, sorted({hash(tuple(t.split()[i : i + 5])) for i in range(116)})) for d, t in rows]
    members = spark.createDataFrame(sets, "cluster bigint, doc_id bigint, copies bigint, sh array<bigint>")
    got = graph.linked(members, "cluster", "doc_id", "copies", ngram_join._matcher(0.8), 60, size=7)
    links = {r.node: r.n for r in got.groupBy("node").agg({"links": "sum"}).withColumnRenamed("sum(links)", "n").collect()}
    assert {(d, 0, links[d]) for d, _ in rows} == brute_join(rows)
    assert max(r["count"] for r in got.groupBy("node").count().collect()) >= 9


def test_band_plan():
    b, r = ngram_join.band_plan(0.8, 0.999, 96)
    assert b * r <= 96 and 1 - (1 - 0.8**r) ** b >= 0.999


# --- 9


def test_quality_edges(spark, data):
    docs = frame(spark, EMPTY + ["a b c d e f g h " * 30, "the " + prose(random.Random(16), 50) + " and of it"] + ["the same words here in this line and that\n" * 5])
    got = {r.doc_id: r for r in quality_rules.judged(docs).collect()}
    assert [got[i].n_words for i in range(7)] == [0, 0, 0, 1, 1, 4, 1]
    assert all(got[i].base_failed and not got[i].kept for i in range(7))
    assert got[7].n_repeat_words == 240 and got[7].base_failed and got[9].n_dup_lines == 4
    assert not got[8].base_failed
    plan = quality_rules.judged(table(spark, data, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


# --- 10


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diag + (x != y))
    return row[-1]


def test_levenshtein():
    rng = random.Random(17)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab é") for _ in range(rng.randrange(90))) for _ in range(2))
        b = a[: rng.randrange(90)] + b[: rng.randrange(30)] if rng.random() < 0.5 else b
        want = edit_distance(a, b)
        assert line_dedup.levenshtein(a, b) == want
        for least in (0.8, 0.5, 0.3):
            most = (1 - least) * max(len(a), len(b)) + 1e-9
            low, high = line_dedup.distance(a, b, most)
            assert low <= max(want, most + 1e-6) and high >= want and line_dedup.similar(a, b, least) == (want <= most)


def normal(line):
    return tuple("".join(c if c.isalnum() else " " for c in line.lower()).split())


def brute_lines(rows):
    """Places that lose by edit similarity alone, without SimHash or keys."""
    first, norm, where = {}, {}, []
    for d, t in rows:
        for k, s in enumerate((t or "").split("\n")):
            w = normal(s)
            key = w if len(w) >= line_dedup.MIN_WORDS else ("few", *s.lower().split())
            if key != ("few",):
                where.append(((d, k), key))
                first.setdefault(key, (d, k))
                if len(w) >= line_dedup.MIN_WORDS or sum(map(len, w)) >= line_dedup.MIN_CHARS:
                    norm[key] = " ".join(w)
    root = {w: w for w in first}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    keys = list(norm)
    size = np.array([len(norm[k]) for k in keys])
    counts = np.stack([line_dedup._profile(norm[k])[0] for k in keys]) if keys else np.zeros((0, 64))
    for i, a in enumerate(keys):
        most = 0.2 * np.maximum(size[:i], size[i]) + 1e-9
        more = counts[:i] - counts[i]
        for j in np.flatnonzero((np.abs(size[:i] - size[i]) <= most) & (np.maximum(np.maximum(more, 0).sum(1), np.maximum(-more, 0).sum(1)) <= most)):
            p, q = find(a), find(keys[j])
            if p != q and line_dedup.similar(norm[a], norm[keys[j]]):
                lo, hi = sorted((p, q), key=lambda w: first[w])
                root[hi] = lo
    return {p for p, w in where if p != first[find(w)]}


def test_lines(spark):
    rng = random.Random(18)
    base = [prose(rng, n) for n in (3, 10, 40, 40, 80)]
    texts = []
    for _ in range(40):
        lines = []
        for _ in range(rng.randrange(6)):
            w = rng.choice(base).split()
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] += rng.choice(["", "!", "x"])
            lines.append(rng.choice(["  ", ""]) + rng.choice([str.upper, str.lower])(" ".join(w)))
        texts.append("\n".join([*lines, "short one", ""]))
    texts += [*EMPTY, "a\u0085b", texts[0], "hello \u201cworld\u201d of lines", "Hello world \u2014 of lines", "one " * 30_000]
    rows = list(enumerate(texts))
    got = {(r.doc_id, r.line_no) for r in line_dedup.losing_lines(frame(spark, texts)).collect()}
    every = brute_lines(rows)
    assert got <= every and len(got) >= 0.97 * len(every) and len(got) > 40
    out, n, gone = line_dedup.without_lines(frame(spark, texts))
    assert out.select(n, gone).count() == len(texts)
    out = {r.doc_id: r for r in out.select(frame(spark, []).columns).collect()}
    for d, t in rows:
        want = None if t is None else "\n".join(s for k, s in enumerate(t.split("\n")) if (d, k) not in got)
        assert out[d].text == want and out[d].n_chars == (None if t is None else len(want))
    assert line_dedup.without_lines(frame(spark, []))[0].count() == 0
    # a key on many lines is dealt out in blocks, with the same result
    hot = {(r.doc_id, r.line_no) for r in line_dedup.losing_lines(frame(spark, texts), hot=2, part=1, size=3).collect()}
    assert hot <= every and len(hot) >= 0.97 * len(every)


def test_lines_of_shared_and_null_ids(spark):
    """Rows of a doc_id with different texts are documents of their own; repeated rows are one."""
    a, b = "the first line of some text here\nanother line that is only here", "nothing in common with it at all\nthe first line of some text here"
    rows = [(1, a), (1, b), (1, b), (None, a), (None, b), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = line_dedup.without_lines(docs)[0].select("doc_id", "text").collect()
    assert len(out) == len(rows)
    kept = {}
    for r in out:
        kept.setdefault(r.doc_id, []).append(r.text)
    assert kept[2] == [None] and set(kept[1]) == {""}
    assert sorted(x for t in kept[None] for x in t.split("\n") if x) == sorted({*a.split("\n"), *b.split("\n")})


def test_simhash_of_long_lines():
    h = numtext.mix(np.arange(70_000, dtype=np.uint64))
    want = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    assert int(line_dedup.simhash(h, np.array([0, 70_000]))[1]) == want
    assert int(line_dedup.simhash(h[:60_000], np.array([60_000]))[0]) == sum(1 << b for b in range(64) if 2 * int(((h[:60_000] >> np.uint64(b)) & np.uint64(1)).sum()) > 60_000)
