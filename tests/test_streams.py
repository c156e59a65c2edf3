"""Streams: retries as keyed state, restarts, late rows."""

import pytest
from pyspark.sql import functions as F

from braid.sources.workspace import folder
from braid.streaming import incremental, retries


def records(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "record_id string")


def test_three_attempts_with_escalation_and_archive(spark):
    asked = []

    def answer(ask):
        asked.append(sorted((r.record_id, r.attempt, r.max_tokens, r.message) for r in ask.collect()))
        good = (F.col("record_id") == "first") | ((F.col("record_id") == "last") & (F.col("attempt") == 3))
        return ask.select("record_id", "attempt", good.alias("accepted"), F.concat_ws("-", "record_id", F.col("attempt").cast("string")).alias("answer"), F.when(~good, F.concat(F.lit("bad "), F.col("attempt").cast("string"))).alias("message"))

    steps = retries.until_accepted(records(spark, "first", "last", "never"), answer, attempts=3, usual=100, last=250)
    assert asked == [
        [("first", 1, 100, ""), ("last", 1, 100, ""), ("never", 1, 100, "")],
        [("last", 2, 100, "bad 1"), ("never", 2, 100, "bad 1")],
        [("last", 3, 250, "bad 2"), ("never", 3, 250, "bad 2")],
    ]
    got = {r.record_id: (r.attempts, r.status, r.answer, r.archived) for r in retries.outcome(steps).collect()}
    assert got == {
        "first": (1, "accepted", "first-1", []),
        "last": (3, "accepted", "last-3", ["last-1", "last-2"]),
        "never": (3, "exhausted", "never-3", ["never-1", "never-2", "never-3"]),
    }
    assert steps.count() == 1 + 3 + 3


def test_a_job_goes_on_where_it_ended(spark):
    """Copies of answers, answers nobody waits for, and a start in a folder that holds the first round."""
    root = folder(spark)
    rows = [("a", 1, False, "a1", "x"), ("a", 1, False, "a1", "x"), ("a", 3, True, "early", None), ("b", 1, True, "b1", None), ("b", 1, False, "b1 again", "y"), ("b", 2, True, "b2", None)]
    spark.createDataFrame(rows, retries.ANSWERS).write.parquet(f"{root}/answers/1")
    run = lambda: retries._run(spark, f"{root}/answers", f"{root}/steps", f"{root}/checkpoint", 2)
    read = lambda: sorted((r.record_id, r.attempt, r.status, r.answer) for r in spark.read.schema(retries.STEPS).parquet(f"{root}/steps").collect())
    run()
    run()  # nothing new
    assert read() == [("a", 1, "retry", "a1"), ("b", 1, "accepted", "b1")]
    spark.createDataFrame([("a", 2, False, None, "z"), ("b", 2, False, "late", None)], retries.ANSWERS).write.parquet(f"{root}/answers/2")
    run()
    assert read() == [("a", 1, "retry", "a1"), ("a", 2, "exhausted", None), ("b", 1, "accepted", "b1")]
    out = {r.record_id: r.archived for r in retries.outcome(spark.read.schema(retries.STEPS).parquet(f"{root}/steps")).collect()}
    assert out == {"a": ["a1", ""], "b": []}


def test_nothing_to_ask(spark):
    steps = retries.until_accepted(records(spark, "x").limit(0), lambda ask: pytest.fail("nobody asks"), 3, 1, 2)
    assert steps.collect() == [] and retries.outcome(steps).collect() == []


SCHEMA = "id int, ts timestamp, v int"


def land(spark, path, name, rows):
    spark.createDataFrame(rows, "id int, ts string, v int").select("id", F.to_timestamp("ts").alias("ts"), "v").coalesce(1).write.parquet(f"{path}/{name}")


def test_windows_over_a_restart_drop_late_rows(spark):
    path, out, checkpoint = folder(spark), folder(spark), folder(spark)

    def run():
        w = incremental.tumbling(incremental.arrivals(spark, f"{path}/*", SCHEMA), "ts", "10 minutes", ["id"], "5 minutes", "v")
        incremental.append(w, out, checkpoint).awaitTermination()
        return sorted((str(r.start)[11:16], r.id, r.n, r.total) for r in spark.read.parquet(out).collect())

    land(spark, path, "1", [(1, "2024-01-01 00:01:00", 1), (1, "2024-01-01 00:09:00", 2), (2, "2024-01-01 00:31:00", 5)])
    first = run()
    assert first == [("00:00", 1, 2, 3)]  # closed by 00:31 less 5 minutes
    land(spark, path, "2", [(1, "2024-01-01 00:02:00", 100), (2, "2024-01-01 00:27:00", 7), (2, "2024-01-01 01:00:00", 0)])
    assert run() == [("00:00", 1, 2, 3), ("00:20", 2, 1, 7), ("00:30", 2, 1, 5)]  # 00:02 came too late, 00:27 in time
    assert run() == [("00:00", 1, 2, 3), ("00:20", 2, 1, 7), ("00:30", 2, 1, 5)]


def test_snapshot_over_a_restart_keeps_the_latest(spark):
    path, out, checkpoint = folder(spark), folder(spark), folder(spark)

    def run():
        incremental.snapshot(incremental.arrivals(spark, f"{path}/*", SCHEMA), out, checkpoint, ["id"], ["ts"]).awaitTermination()
        return sorted((r.id, r.v) for r in spark.read.schema(SCHEMA).parquet(out).collect())

    land(spark, path, "1", [(1, "2024-01-01 00:05:00", 1), (2, "2024-01-01 00:00:00", 2)])
    assert run() == [(1, 1), (2, 2)]
    land(spark, path, "2", [(1, "2024-01-01 00:01:00", 9), (2, "2024-01-01 00:01:00", 3), (3, "2024-01-01 00:00:00", 4)])
    assert run() == [(1, 1), (2, 3), (3, 4)] and run() == [(1, 1), (2, 3), (3, 4)]


def test_attempts_touch_state_as_little_as_can_be():
    """A record's state is read once and written once a batch, and not written by answers that change nothing."""
    calls = []

    class State:
        value = None

        def exists(self):
            calls.append("exists")
            return self.value is not None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

    x = retries._Attempts(2)
    x.state = State()
    row = lambda attempt, accepted: {"attempt": attempt, "accepted": accepted, "answer": "a", "message": None}
    assert [r["status"] for r in x.handleInputRows(("r",), iter([row(1, False)]), None)] == ["retry"]
    assert [r["status"] for r in x.handleInputRows(("r",), iter([row(1, True)]), None)] == []
    assert [r["status"] for r in x.handleInputRows(("r",), iter([row(2, True)]), None)] == ["accepted"]
    assert [r["status"] for r in x.handleInputRows(("r",), iter([row(2, False)]), None)] == []
    assert calls == ["get", "update", "get", "get", "update", "get"]
