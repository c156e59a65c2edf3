"""op13: against brute force on lists of numbers, on whole tables, and on texts made for the purpose."""

import hashlib
import random
import re
from fractions import Fraction

import pytest

from braid.llm import catalog, periodic_runs
from braid.llm.common import table
from braid.llm.periodic_runs import crc_of, looped, runs


def brute(x, least=24, times=3):
    """All stretches that keep a period, by trying each; those with a smaller period go."""
    n, out = len(x), []
    for q in range(1, n // times + 1):
        k = 0
        while k < n - q:
            if x[k] == x[k + q]:
                s = k
                while k < n - q and x[k] == x[k + q]:
                    k += 1
                if k + q - s >= max(least, times * q):
                    out.append((s, k + q - s, q))
            k += 1
    return sorted((s, m, q) for s, m, q in out if not any(x[s : s + m - p] == x[s + p : s + m] for p in range(1, q)))


def made(rng, n, letters):
    x = []
    while len(x) < n:
        x += [rng.randrange(letters) for _ in range(rng.randrange(1, 14))] * rng.choice([1, 1, 2, 3, 5, 9])
    return x


@pytest.mark.parametrize("least, times", [(24, 3), (4, 2), (6, 3)])
def test_runs_are_those_of_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(400):
        x = made(rng, rng.randrange(0, 130), rng.choice([1, 2, 3, 5]))
        assert runs(x, least, times) == brute(x, least, times), x


def test_hashes_that_say_equal_of_everything_decide_nothing(monkeypatch):
    monkeypatch.setattr(periodic_runs._Extensions, "_equal", lambda self, i, j, size: True)
    rng = random.Random(3)
    for _ in range(200):
        x = made(rng, rng.randrange(0, 110), rng.choice([1, 2, 3]))
        assert runs(x) == brute(x), x


def expected(text, crc, least=24):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    order = looped(len(w), crc) if crc is not None else None
    w = [w[k] for k in order] if order is not None else w
    found = brute(w)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    return (
        len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(v for k, v in enumerate(w) if k not in gone).encode()).hexdigest(),
    )


def test_whole_table(spark, data):
    got = {r.doc_id: tuple(r)[1:] for r in catalog.op13_periodic_runs(spark, data).collect()}
    rows = table(spark, data, "documents").select("doc_id", "text").collect()
    assert len(got) == len(rows) and sum(v[0] for v in got.values()) > 0
    for r in rows:
        if len(r.text or "") < 12_000:  # brute force is quadratic
            assert got[r.doc_id] == expected(r.text, crc_of(r.doc_id)), r.doc_id


def test_loops():
    n = 50
    for crc in (10, 70, 1230, 4294967290):
        g = crc // 10
        a, out = g % n, looped(n, crc)
        p = 1 + (n - a) // (3 + g % 8)
        assert [a + (i - a) % p if i >= a else i for i in range(n)] == out.tolist()
    assert looped(0, 10) is None and looped(5, 11) is None


def test_edges(spark):
    seven = " ".join(f"w{i}" for i in range(7))
    texts = [
        None, "", " \t\n\x0b\f\r ", "one", "a " * 23, "a " * 24, f"{seven} " * 3 + seven.split()[0], f"{seven} " * 3, f"{seven} " * 4,
        "x\ty\n" * 12, "a b " * 30, "é " * 40 + "tail " + "é " * 40, f"p q {'r s ' * 20} end {'t u v ' * 9}", "\U0001f600 " * 25,
    ]
    rows = [(None if i == 3 else i // 2, t, "n", 1, None) for i, t in enumerate(texts * 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_runs string, start int, runs_sha256 string")
    got = sorted((tuple(r) for r in periodic_runs.detected(df).drop("collapsed").collect()), key=repr)
    assert got == sorted(((r[0], *expected(r[1], None)) for r in rows), key=repr)
    assert periodic_runs.detected(df.limit(0)).collect() == []
    looped_ids = df.selectExpr("cast(doc_id + 100 as string) as doc_id", "text")
    got = sorted((tuple(r) for r in periodic_runs.detected(looped_ids, looped, texts=False).collect()), key=repr)
    assert got == sorted(((r.doc_id, *expected(r.text, crc_of(r.doc_id))) for r in looped_ids.collect()), key=repr)


def test_collapsed_text_and_ties(spark):
    two = "a b c d " * 8 + "| " + "e f g h " * 8
    row = periodic_runs.detected(spark.createDataFrame([(1, two)], "doc_id int, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 0, 32, 4, 8000)
    assert row.collapsed == "a b c d | e f g h"


def test_a_million_words(spark):
    text = "start " + "a b c " * 333_333 + "end"
    row = periodic_runs.detected(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.collapsed) == (1, 1, 999_999, 3, "start a b c end")
