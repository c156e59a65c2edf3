"""op11: against its SQL, whole tables and made ones."""

import random

import numpy as np
import pyarrow as pa
import pytest

from braid.llm import divergence

from ..conftest import duck, same

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n bigint, docs string, bucket int, of_term boolean, kept bigint, rows string, head string, rank int"


def frame(spark, rows):
    """Rows of (text, lang, source), with columns named as the operator names its own."""
    return spark.createDataFrame([(i // 2, *r, "x", None, "y", 1, None, 7, "z", None, 3) for i, r in enumerate(rows)], SCHEMA)


def against_sql(df, out, least):
    con = duck()
    con.register("made", df.toArrow())
    con.execute("create or replace view documents as select * from made")
    same(out, divergence.oracle(least), con)


def made(n, seed):
    rng = random.Random(seed)
    words = ["Apple", "apple", "BÄR", "bär", "naïve", "straße", "日本語", "don't", "x1y", "Ünder_score", "zeta", "Eta", "th"] + [f"w{chr(97 + i)}" for i in range(20)]
    text = lambda: rng.choice([None, "", "123 ... !", " ".join(rng.choices(words, k=rng.randrange(1, 60)))])
    return [(text(), rng.choice(["en", "en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", None, "", "é"])) for _ in range(n)]


@pytest.mark.parametrize("least, seed", [(1, 1), (3, 2), (30, 3)])
def test_against_sql(spark, least, seed):
    df = frame(spark, made(300, seed)).repartition(5)
    against_sql(df, divergence.audited(df, least), least)


def test_buckets_batches_and_blocks_change_nothing(spark, monkeypatch):
    df = frame(spark, made(400, 5)).repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        against_sql(df, divergence.audited(df, 2, bucket=10), 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_held_rows_are_let_go(monkeypatch):
    """A task that holds few rows, blocks of one term and pairs let go at once give the same sums."""
    rng = random.Random(9)
    rows = [("en", rng.choice("ab"), " ".join(rng.choices(["one", "two", "three", "four"], k=9))) for _ in range(50)]
    batch = pa.RecordBatch.from_pydict(dict(zip(("lang", "source", "text"), zip(*rows, strict=True), strict=True)))
    whole = divergence._added_up([pa.Table.from_batches(divergence._counted([batch]))]).sort_by([("term", "ascending"), ("source", "ascending")])
    monkeypatch.setattr(divergence, "HELD", 1)
    parts = list(divergence._counted([batch.slice(i, 10) for i in range(0, 50, 10)]))
    assert sum(p.num_rows for p in parts) > len(whole)
    assert divergence._added_up([pa.Table.from_batches(parts)]).sort_by([("term", "ascending"), ("source", "ascending")]).equals(whole)


def test_pairs_beyond_a_block(monkeypatch):
    head = pa.table({"source": ["a", "b", "c"], "n": [5, 9, 0], "in_lang": [14, 14, 14], "kept": [3, 3, 3]})
    rows = pa.table({"term": ["x", "x", "y", "z"], "source": ["a", "b", "b", "a"], "n": [2, 4, 5, 3], "in_lang": [6, 6, 5, 3]})

    def sums():
        b = divergence._Bucket("en", head)
        out = [*b.add(rows), *b.pairs()]
        return pa.Table.from_batches(out).group_by(["source", "item"]).aggregate([("value", "sum")]).sort_by([("source", "ascending"), ("item", "ascending")]), b.terms()

    whole, terms = sums()
    monkeypatch.setattr(divergence, "CELLS", 1)
    monkeypatch.setattr(divergence, "PAIRS", 1)
    again, terms_again = sums()
    assert whole.equals(again) and terms.equals(terms_again)


def test_share_is_exact_for_large_counts():
    rng = random.Random(4)
    total = [rng.randrange(1, 2 * 10**14) for _ in range(2000)]
    count = [rng.randrange(0, t + 1) for t in total]
    got = divergence.share(np.array(count), np.array(total))
    assert got.tolist() == [1 + 10**9 * c // t for c, t in zip(count, total, strict=True)]


def test_no_rows_and_no_kept_terms(spark):
    assert divergence.audited(frame(spark, [])).collect() == []
    df = frame(spark, [(None, None, None), ("word", "en", "a"), ("word", "en", "b")])
    assert sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in divergence.audited(df).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_long_text_and_ties(spark):
    long = "alpha beta " * 300_000
    df = frame(spark, [(long, "en", "a"), ("alpha", "en", "b"), ("beta", "en", "c"), ("alpha beta", "en", "d")])
    against_sql(df, divergence.audited(df, 1), 1)
