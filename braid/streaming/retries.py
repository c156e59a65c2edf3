"""Bounded retries as keyed state on a stream: what was asked of each record, how often, and the answers that were not good enough."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.lookups import token_limit
from ..session import ship
from ..sources.workspace import folder, kept

#: State in files beside the checkpoint, not in the memory of executors.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ANSWERS = "record_id string, attempt int, accepted boolean, answer string, message string"
STEPS = "record_id string, attempt int, status string, answer string, message string, archived array<string>"


class _Attempts(StatefulProcessor):
    """Of each record: the attempt that is awaited, the answers archived, and whether it is over. Answers to other attempts than the awaited one (late copies,
    replays) change nothing."""

    def __init__(self, attempts: int):
        self.attempts = attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "awaited int, over boolean, archived array<string>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803  (named by Spark)
        # each call of the state is a trip to the JVM and back: it is read once, and written only if something has changed
        x = self.state.get() or (1, False, ())
        awaited, over, archived = x[0], x[1], list(x[2])
        before = awaited, over
        for r in sorted(rows, key=lambda r: (r["attempt"], not r["accepted"], r["answer"] or "")):
            if over or r["attempt"] != awaited:
                continue
            if r["accepted"]:
                over = True
                status = "accepted"
            else:
                archived.append(r["answer"] or "")
                over = awaited >= self.attempts
                status = "exhausted" if over else "retry"
            yield Row(record_id=key[0], attempt=awaited, status=status, answer=r["answer"], message=r["message"], archived=list(archived))
            awaited += not over
        if (awaited, over) != before:
            self.state.update((awaited, over, archived))

    def close(self) -> None:
        pass


def judged(answers: DataFrame, attempts: int) -> DataFrame:
    """A stream of answers (record_id, attempt, accepted, answer, message) to steps: each awaited answer once, with what becomes of the record (accepted; retry;
    exhausted, if none of `attempts` was accepted) and the answers archived so far."""
    ship(answers.sparkSession)
    answers.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    return answers.groupBy("record_id").transformWithState(statefulProcessor=_Attempts(attempts), outputStructType=STEPS, outputMode="Append", timeMode="None")


def requests(steps: DataFrame, attempts: int, usual: int, last: int) -> DataFrame:
    """What to ask again: record_id, attempt, max_tokens (more on the last attempt), message (why the last answer was refused)."""
    again = steps.where("status = 'retry'")
    return again.select("record_id", (F.col("attempt") + 1).alias("attempt"), token_limit(F.col("attempt") + 1, attempts, usual, last).alias("max_tokens"), "message")


def _run(spark: SparkSession, answers: str, steps: str, checkpoint: str, attempts: int) -> StreamingQuery:
    stream = judged(spark.readStream.schema(ANSWERS).parquet(f"{answers}/*"), attempts)
    q = stream.writeStream.format("parquet").option("path", steps).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def until_accepted(records: DataFrame, answer: Callable[[DataFrame], DataFrame], attempts: int, usual: int, last: int, root: str | None = None) -> DataFrame:
    """Ask for all records (record_id), and again for those whose answer was refused, `attempts` times at most; the steps of all records.

    answer takes requests (record_id, attempt, max_tokens, message) and gives the columns of ANSWERS. Each round lands its answers as files, and the stream
    takes up where it stopped, so a job that ends early goes on from its folder without asking twice what was judged."""
    spark = records.sparkSession
    root = root or folder(spark)
    first = token_limit(F.lit(1), attempts, usual, last)
    ask = records.select(F.col("record_id").cast("string").alias("record_id"), F.lit(1).alias("attempt"), first.alias("max_tokens"), F.lit("").alias("message"))
    steps = spark.createDataFrame([], STEPS)
    for attempt in range(1, attempts + 1):
        ask = kept(ask)
        if ask.isEmpty():
            break
        answer(ask).select("record_id", F.col("attempt").cast("int").alias("attempt"), "accepted", "answer", "message").write.mode("overwrite").parquet(f"{root}/answers/{attempt}")
        _run(spark, f"{root}/answers", f"{root}/steps", f"{root}/checkpoint", attempts)
        steps = spark.read.schema(STEPS).parquet(f"{root}/steps")
        ask = requests(steps.where(F.col("attempt") == attempt), attempts, usual, last)
    return steps


def outcome(steps: DataFrame) -> DataFrame:
    """record_id, attempts, status, answer (of the last step), archived answers."""
    last = F.max_by(F.struct("status", "answer", "archived"), "attempt").alias("s")
    return steps.groupBy("record_id").agg(F.max("attempt").alias("attempts"), last).select("record_id", "attempts", "s.status", "s.answer", "s.archived")
