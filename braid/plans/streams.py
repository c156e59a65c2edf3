"""Queries that run their streams to the end of what has arrived and return the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import folder
from ..streaming import incremental, retries
from .catalog import query
from .tables import micros, table


@query("""
with d as (select doc_id::varchar as record_id, doc_id % 5 as k, n_chars from documents group by all),
x as (select record_id, least(k + 1, 3) as attempts, k < 3 as good from d)
select record_id, attempts::int as attempts, case when good then 'accepted' else 'exhausted' end as status, 'answer ' || attempts || ' of ' || case when attempts = 3 then 900 else 400 end as answer,
  concat_ws('|', case when attempts > 1 or not good then 'answer 1 of 400' end, case when attempts > 2 or not good then 'answer 2 of 400' end, case when not good then 'answer 3 of 900' end) as archived
from x""")
def q69_retry_rounds(spark, sf_dir):
    """Every document is asked for until its answer is accepted, three times at most, with more tokens the last time; refused answers are archived."""

    def answer(ask: DataFrame) -> DataFrame:
        good = F.col("record_id").cast("bigint") % 5 < F.col("attempt")
        return ask.select("record_id", "attempt", good.alias("accepted"), F.format_string("answer %d of %d", "attempt", "max_tokens").alias("answer"), F.when(~good, "missing field").alias("message"))

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id")).distinct()
    out = retries.outcome(retries.until_accepted(docs, answer, attempts=3, usual=400, last=900))
    return out.withColumn("archived", F.array_join("archived", "|"))


def _landed(df: DataFrame, parts: int, by: str) -> tuple[str, list]:
    """A folder, and functions that each let a part of df arrive in it: the rows whose number modulo `parts` is theirs."""
    path = folder(df.sparkSession)
    return path, [lambda k=k: df.where(F.pmod(F.col(by), F.lit(parts)) == k).write.parquet(f"{path}/{k}") for k in range(parts)]


@query("select user_id, count(*)::bigint as n, count(distinct event_id)::bigint as events, sum(event_id)::bigint as ids from events group by user_id")
def q70_stream_append(spark, sf_dir):
    """Events that arrive in three parts, appended to a log by a query that is started again after each part: every row once."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path, arrive = _landed(events, 3, "event_id")
    log, checkpoint = folder(spark), folder(spark)
    schema = ", ".join(f"{k} {t}" for k, t in events.dtypes)
    for part in arrive:
        part()
        for _ in range(2):  # a start with nothing new adds nothing
            incremental.append(incremental.arrivals(spark, f"{path}/*", schema), log, checkpoint).awaitTermination()
    rows = spark.read.schema(schema).parquet(log)
    return rows.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"), F.sum("event_id").cast("bigint").alias("ids"))


@query("select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by event_id desc) = 1")
def q71_stream_snapshot(spark, sf_dir):
    """The latest event of each user, kept up to date while events arrive in three parts, older ones after newer ones too."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    path, arrive = _landed(events, 3, "event_id")
    kept_at, checkpoint = folder(spark), folder(spark)
    schema = ", ".join(f"{k} {t}" for k, t in events.dtypes)
    for part in reversed(arrive):
        part()
        incremental.snapshot(incremental.arrivals(spark, f"{path}/*", schema), kept_at, checkpoint, ["user_id"], ["event_id"]).awaitTermination()
    return spark.read.schema(schema).parquet(kept_at)


@query("""
with e as (select *, epoch_us(ts) // 3600000000 as hour, round(value * 100)::bigint as cents from events),
first as (select * from e where event_id % 2 = 0), mark as (select max(epoch_us(ts)) - 7200000000 as at from first),
seen as (select * from first union all select e.* from e, mark where event_id % 2 = 1 and (hour + 1) * 3600000000 > mark.at),
last as (select max(epoch_us(ts)) - 7200000000 as at from e)
select seen.hour::bigint as hour, event_type, count(*)::bigint as n, sum(cents)::bigint as total from seen, last where (seen.hour + 1) * 3600000000 <= last.at group by 1, 2""")
def q72_stream_windows(spark, sf_dir):
    """Events by hour, two hours late at most: half of them arrive, then the other half, of which those for windows that are closed are dropped. Windows are
    given out once they close."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    e = e.withColumn("ts", F.timestamp_micros(micros("ts")))
    path, arrive = _landed(e, 2, "event_id")
    out, checkpoint = folder(spark), folder(spark)
    schema = ", ".join(f"{k} {t}" for k, t in e.dtypes)
    for part in arrive:
        part()
        windows = incremental.tumbling(incremental.arrivals(spark, f"{path}/*", schema), "ts", "1 hour", ["event_type"], "2 hours", "cents")
        incremental.append(windows, out, checkpoint).awaitTermination()
    hour = F.floor(F.unix_micros("start") / 3_600_000_000).cast("bigint").alias("hour")
    return spark.read.parquet(out).select(hour, "event_type", "n", "total")
