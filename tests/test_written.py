"""What writes and reads back: published sets, numbered lines, ranks over all rows, conflict-free rounds, casefolded text."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from braid.functions import columns as c
from braid.operators import ranking
from braid.sources import lines
from braid.sources.publication import Incomplete, PublishedSet, read_file, write_file


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def read(s, name):
    return sorted(r.v for r in s.read(name).collect())


# --- publication


def test_a_set_changes_as_one(spark, tmp_path):
    s = PublishedSet(spark, str(tmp_path / "set"))
    assert s.version == 0 and s.tables == []
    with pytest.raises(KeyError):
        s.read("a")
    assert s.publish({"a": rows(spark, "1"), "b": rows(spark, "x")}) == 1
    held = s.read("a")
    assert s.publish({"a": rows(spark, "2", "3"), "b": rows(spark, "y")}, kinds={"b": "csv"}) == 2
    assert read(s, "a") == ["2", "3"] and read(s, "b") == ["y"] and s.tables == ["a", "b"]
    assert [r.v for r in held.collect()] == ["1"]  # a reader of the version before
    assert s.vacuum() == 1 and s.vacuum() == 0 and read(s, "a") == ["2", "3"]


@pytest.mark.parametrize("at", ["second writer", "report", "pointer"])
def test_a_writer_that_fails_leaves_readers_on_the_old_set(spark, tmp_path, monkeypatch, at):
    s = PublishedSet(spark, str(tmp_path / "set"))
    s.publish({"a": rows(spark, "old"), "b": rows(spark, "old")})
    bad = rows(spark, "new").select(F.raise_error(F.lit("injected")).cast("string").alias("v"))
    outputs = {"a": rows(spark, "new"), "b": bad if at == "second writer" else rows(spark, "new")}
    if at == "pointer":
        from braid.sources import publication

        def fails(*_):
            raise OSError("injected")

        monkeypatch.setattr(publication, "write_file", fails)
    with pytest.raises(Exception, match="injected"):
        s.publish(outputs, report=(lambda made: bad) if at == "report" else None)
    assert s.version == 1 and read(s, "a") == ["old"] and read(s, "b") == ["old"]
    assert len(list((tmp_path / "set" / "data").iterdir())) == 1  # nothing half-written is left


def test_rows_to_retry_refuse_the_outputs_and_empty_the_queues(spark, tmp_path):
    s = PublishedSet(spark, str(tmp_path / "set"))
    s.publish({"merged": rows(spark, "m1"), "queue": rows(spark, "q1")}, retry=rows(spark))
    report = lambda made: made["merged"].agg(F.count("*").alias("n"))
    with pytest.raises(Incomplete, match="2 rows .*r1"):
        s.publish({"merged": rows(spark, "m1", "m2"), "queue": rows(spark, "q2")}, retry=rows(spark, "r1", "r2"), emptied=["queue"], report=report)
    assert s.version == 2 and read(s, "merged") == ["m1"] and read(s, "queue") == [] and read(s, "retry_queue") == ["r1", "r2"]
    assert [r.n for r in s.read("report").collect()] == [2]  # written in either case
    s.vacuum()
    assert read(s, "merged") == ["m1"]  # of the version before, still in use
    s.publish({"merged": rows(spark, "m1", "m2"), "queue": rows(spark)}, retry=rows(spark), report=report)
    assert read(s, "merged") == ["m1", "m2"] and read(s, "retry_queue") == []


def test_another_writer_is_noticed(spark, tmp_path):
    s = PublishedSet(spark, str(tmp_path / "set"))
    s.publish({"a": rows(spark, "1")})

    def meanwhile(made):
        PublishedSet(spark, s.root).publish({"a": rows(spark, "other")})
        return made["a"]

    with pytest.raises(RuntimeError, match="another writer"):
        s.publish({"a": rows(spark, "mine")}, report=meanwhile)
    assert read(s, "a") == ["other"]


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "x")
    assert read_file(spark, path) is None
    for text in ("one", "zwei ß", ""):
        write_file(spark, path, text)
        assert read_file(spark, path) == text
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["x"]


# --- lines


@pytest.fixture
def split_small(spark):
    for k, v in (("spark.sql.files.maxPartitionBytes", "300"), ("spark.sql.files.openCostInBytes", "1")):
        spark.conf.set(k, v)
    yield
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(k)


def test_lines_are_numbered_across_splits(spark, tmp_path, split_small):
    rng = random.Random(1)
    want = {}
    for name in ("a", "b", "empty"):
        text = ["x" * rng.randrange(0, 120) for _ in range(0 if name == "empty" else 200)]
        (tmp_path / name).write_text("".join(t + rng.choice(["\n", "\r\n"]) for t in text))
        want |= {(name, i + 1): t for i, t in enumerate(text)}
    got = lines.numbered(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert {(r.file.rsplit("/", 1)[1], r.line): r.value for r in got.collect()} == want


def test_a_bad_line_is_named(spark, tmp_path, split_small):
    good = [f'{{"k": {i}, "s": "v{i}"}}' for i in range(300)]
    (tmp_path / "good.jsonl").write_text("\n\n".join(good))
    got = lines.strict_jsonl(spark, str(tmp_path / "good.jsonl"), "k int, s string").collect()
    assert sorted((r.line, r.k, r.s) for r in got) == [(2 * i + 1, i, f"v{i}") for i in range(300)]
    (tmp_path / "bad.jsonl").write_text("\n".join([*good[:250], '{"k": 1', *good[:20], "[1]"]))
    with pytest.raises(ValueError, match=r"bad.jsonl:251 \(malformed\), .*bad.jsonl:272 \(not_an_object\)$"):
        lines.strict_jsonl(spark, str(tmp_path / "bad.jsonl"), "k int, s string")


def test_order_in_a_file(spark, tmp_path):
    files = {"ok": [("p", "1"), ("p", "2"), ("", "3")], "gap": [("p", "1"), ("p", "3"), ("p", "2")], "blank": [("p", ""), ("p", "2")], "two": [("p", "1"), ("q", "2")], "none": [("", "1")]}
    for name, content in files.items():
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"p": "{p}", "o": "{o}"}}\n' for p, o in content))
    got = lines.manifest_violations(lines.strict_jsonl(spark, str(tmp_path), "p string, o string"), "p", "o").collect()
    assert sorted((r.file.rsplit("/", 1)[1][:-6], r.code, r.line) for r in got if r.line) == [("blank", "order", 1), ("gap", "order", 2)]
    assert sorted(r.file.rsplit("/", 1)[1][:-6] for r in got if r.code == "participants") == ["none", "two"]


# --- ranks, choice, text


def test_global_ranks(spark):
    rng = random.Random(3)
    values = [(rng.choice([None, rng.randrange(5), rng.randrange(1000)]), i) for i in range(3000)]
    df = spark.createDataFrame(values, "v int, i int").repartition(9)
    got = ranking.ranked(df, [F.desc_nulls_last("v"), F.col("i")], "n").collect()
    want = sorted(values, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.v, r.i) for r in sorted(got, key=lambda r: r.n)] == want and sorted(r.n for r in got) == list(range(1, 3001))
    same = ranking.ranked(spark.range(500).select(F.lit(1).alias("v")), [F.col("v")], "n")  # one value: any order, each number once
    assert sorted(r.n for r in same.collect()) == list(range(1, 501))
    assert ranking.ranked(df.limit(0), [F.col("i")], "n").collect() == []
    assert "rangepartitioning" not in ranking.shard(df, [F.col("i")], 4)._jdf.queryExecution().toString()  # stored
    assert sorted((r.i, r.shard) for r in ranking.shard(df, [F.col("i")], 4).collect()) == [(i, i % 4) for i in range(3000)]


@pytest.mark.parametrize("fold", [0, 5, 10_000])
def test_conflict_free_by_rounds(spark, fold):
    """A hot group with chains of conflicts, small groups, empty and null sets, repeated ids."""
    rng = random.Random(7)
    data = [("hot", i, [rng.randrange(400) for _ in range(rng.randrange(1, 4))]) for i in range(600)] + [("chain", i, [i, i + 1]) for i in range(12)]
    data += [(f"g{g}", i, rng.choice([None, [], [1, 1], [1, 2], [2, 3, 4], [9]])) for g in range(20) for i in range(6)]
    rng.shuffle(data)
    got = ranking.conflict_free_rows(spark.createDataFrame(data, "g string, i int, s array<bigint>"), ["g"], "i", "s", fold=fold)
    used, want = {}, []
    for g, i, s in sorted(data, key=lambda r: (r[0], r[1])):
        if not used.setdefault(g, set()) & set(s or ()):
            used[g] |= set(s or ())
            want.append((g, i))
    assert sorted((r.g, r.i) for r in got.collect()) == want



@pytest.mark.parametrize("fold", [0, 100])
def test_conflict_free_null_ids_meet_no_other(spark, fold):
    """A null id is no id, by rounds as in a fold: rows that have nothing else are kept, and the rounds end."""
    data = [("a", 1, [None]), ("a", 2, [None, 5]), ("a", 3, [5]), ("a", 4, [None]), ("a", 5, [6, None])]
    got = ranking.conflict_free_rows(spark.createDataFrame(data, "g string, i int, s array<bigint>"), ["g"], "i", "s", fold=fold)
    assert sorted(r.i for r in got.collect()) == [1, 2, 4, 5]


def test_conflict_free_rounds_keep_a_row_for_each_row(spark, monkeypatch):
    """No round stores what remains as a row for each id: ids go with their row, and the firsts are as many as ids."""
    sizes = []
    real = ranking.kept
    monkeypatch.setattr(ranking, "kept", lambda df: sizes.append((real(df), df.columns)) or sizes[-1][0])
    data = [("g", i, [(i + k) % 50 for k in range(8)]) for i in range(300)]
    assert ranking.conflict_free_rows(spark.createDataFrame(data, "g string, i int, s array<bigint>"), ["g"], "i", "s", fold=0).count() == 6
    assert max(t.count() for t, _ in sizes) == 300


def test_casefolded_text(spark):
    texts = [chr(i) for i in range(0x3000) if unicodedata.category(chr(i))[0] == "L"] + ["Straße", "ΣΊΣΥΦΟΣ", "ﬁne", "İstanbul", "ǅ", "ŉ", "", "ΐ", "plain ASCII", "ſ"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    got = {r.i: r.f for r in df.select("i", c.casefolded("t").alias("f")).collect()}
    assert got.pop(len(texts)) is None
    odd = [(t, got[i], t.casefold()) for i, t in enumerate(texts) if got[i] != t.casefold()]
    assert not odd, odd[:10]
