"""Lookups and joins by derived keys: small tables as columns, storage addresses, the union of what several tables hold, choice and order of videos."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c
from . import constraints


def lookup(df: DataFrame, small: DataFrame, keys: list[str], value: str) -> DataFrame:
    """df with `value` of a table of keys: null where there is none. Blank values are absent; of a key's several values the greatest counts, so df keeps its rows."""
    one = small.select(*keys, c.blank_to_null(value).alias(value)).where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(one, keys, "left")


def video_sequence(video: str | Column, default: int | None = 0) -> Column:
    """The number after the first `_`; `default` where there is none."""
    v = F.col(video) if isinstance(video, str) else video
    return F.coalesce(F.regexp_extract(v, r"^[^_]*_(.*)$", 1).try_cast("bigint"), F.lit(default).cast("bigint"))


def remote_object(video: str | Column, split: str | Column) -> Column:
    """version and key of a raw video: three digits after the participant are of the later collection, others lie under their split; nulls without one."""
    v, s = (F.col(x) if isinstance(x, str) else x for x in (video, split))
    person, later = c.before_first(v), F.length(F.regexp_extract(v, r"^[^_]*_(.*)$", 1)) == 3
    version = F.when(later, "100").when(s.isNotNull(), "55")
    key = F.when(later, F.concat(person, F.lit("/videos/"), v, F.lit(".MP4"))).otherwise(F.concat(F.lit("videos/"), s, F.lit("/"), person, F.lit("/"), v, F.lit(".MP4")))
    return F.struct(version.alias("version"), key.alias("key"))


def digest_verdict(actual: str | Column, expected: str | Column) -> Column:
    """Whether a digest is the expected one; null where none is expected."""
    a, e = (F.col(x) if isinstance(x, str) else x for x in (actual, expected))
    return F.when(c.blank_to_null(e).isNotNull(), a.eqNullSafe(e))


def union_by_stem(tables: Mapping[str, tuple[DataFrame, Iterable[str]]], path: str, value: str) -> DataFrame:
    """video_id and a column for each table: `value` of its row whose file name without the given endings is that id, empty where it has none.

    One shuffle of all tables instead of an outer join for each; of rows with one stem the greatest value counts."""
    parts = []
    for name, (df, endings) in tables.items():
        stem = c.file_name(path)
        for e in endings:
            stem = F.regexp_replace(stem, re.escape(e) + r"\z", "")
        parts.append(df.select(stem.alias("video_id"), F.lit(name).alias("_table"), F.col(value).alias("_value")))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("video_id").agg(*[F.coalesce(F.max(F.when(F.col("_table") == name, F.col("_value"))), F.lit("")).alias(name) for name in tables])


def must_match(df: DataFrame, other: DataFrame, keys: list[str], code: str) -> tuple[DataFrame, DataFrame]:
    """The inner join, and the keys of df that found nothing, with a code: for `constraints.enforce` before the join is used."""
    return df.join(other, keys), df.join(other, keys, "left_anti").select(*keys, F.lit(code).alias("code"))


def reused(specs: DataFrame, made: DataFrame, keys: list[str], url: str) -> DataFrame:
    """specs with the address of what was made before, and `needed` where there is none yet."""
    return lookup(specs, made, keys, url).withColumn("needed", F.col(url).isNull())


def chosen(df: DataFrame, video: str, ids: Iterable[str] | None, participant: str, participants: Iterable[str] | None) -> DataFrame:
    """Rows by video ids if any are given, else by participants; neither selects all."""
    return df.where(c.listed(video, ids) if ids is not None else c.listed(participant, participants))


def unknown_ids(df: DataFrame, column: str, wanted: Iterable[str]) -> DataFrame:
    """Wanted ids that df doesn't hold."""
    asked = df.sparkSession.createDataFrame([(w,) for w in sorted(set(wanted))], f"{column} string")
    return asked.join(df.select(F.col(column).cast("string").alias(column)), column, "left_anti")


def first_rows(df: DataFrame, order: list[str | Column], limit: int | None) -> DataFrame:
    """df in order, its first `limit` rows if that is given: a limit never comes before the order."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def video_order(participant: str = "participant_id", sequence: str = "video_sequence", duration: str = "duration_min") -> list[Column]:
    """By participant and sequence, the longer first."""
    return [F.col(participant).asc(), F.col(sequence).cast("bigint").asc(), F.col(duration).cast("double").desc()]


def participant_order(spark: SparkSession, mode: str, every: DataFrame, candidates: DataFrame) -> DataFrame:
    """participant_id and position: `all` and `all-candidates` take a table's own, anything else is a list of names in order."""
    if mode in ("all", "all-candidates"):
        return (every if mode == "all" else candidates).select("participant_id", F.col("position").cast("bigint").alias("position"))
    return spark.createDataFrame(list(enumerate(c.parse_list(mode) or [])), "position bigint, participant_id string").select("participant_id", "position")


def address_violations(rows: DataFrame, bucket: str, region: str) -> DataFrame:
    """Stored objects that can't be signed: bucket, key and a code. Blank buckets and regions mean the given ones."""
    b, k = F.coalesce(c.blank_to_null("bucket"), c.blank_to_null(F.lit(bucket))), c.blank_to_null("key")
    r = c.blank_to_null("region")
    x = rows.select(b.alias("bucket"), k.alias("key"), r.alias("region"))
    checks = [
        constraints.Check("missing_key", "blocking", F.col("key").isNull()),
        constraints.Check("missing_bucket", "blocking", F.col("key").isNotNull() & F.col("bucket").isNull()),
        constraints.Check("region_differs", "blocking", F.lit(bool(region)) & F.coalesce(F.col("region") != region, F.lit(False))),
    ]
    twice = x.where("key is not null").groupBy("bucket", "key").agg(F.count("*").alias("n")).where("n > 1").select("bucket", "key", F.lit("duplicate_object").alias("code"))
    return constraints.issues(x, ["bucket", "key"], checks).select("bucket", "key", "code").unionByName(twice)


def refreshed(rows: DataFrame, sign: Callable[[Column, Column], Column], bucket: str, region: str) -> DataFrame:
    """rows with bucket and region filled in and signed_url anew; see `address_violations` for rows that can't be signed."""
    out = rows.withColumn("bucket", F.coalesce(c.blank_to_null("bucket"), F.lit(bucket))).withColumn("region", F.coalesce(c.blank_to_null("region"), F.lit(region)))
    return out.withColumn("signed_url", sign(F.col("bucket"), F.col("key")))


def describe(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """count, min, p25, median, mean, p75, max of finite values, for each group."""
    v = c.safe_double(column)
    p = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    got = df.groupBy(*by).agg(F.count(v).alias("count"), F.min(v).alias("min"), p.alias("_p"), F.avg(v).alias("mean"), F.max(v).alias("max"))
    return got.select(*by, "count", "min", *[F.get("_p", F.lit(i)).alias(k) for i, k in enumerate(("p25", "median", "p75"))], "mean", "max")


def bundle_report(sessions: DataFrame, candidates: str) -> DataFrame:
    """participant_id, sources, candidates of sessions (participant_id, source_video_id, an array of candidates); participant null: of all."""
    size = F.when(F.col(candidates).isNotNull(), F.size(candidates)).otherwise(0)
    return sessions.select("participant_id", "source_video_id", size.cast("bigint").alias("_n")).rollup("participant_id").agg(F.count_distinct("source_video_id").alias("sources"), F.sum("_n").alias("candidates"))


def status_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows of each status, absent ones as `unknown`."""
    return df.groupBy(F.coalesce(c.blank_to_null(column), F.lit("unknown")).alias(column)).agg(F.count("*").alias("n"))


def submittable(inputs: DataFrame, jobs: DataFrame, keys: list[str], forced: bool = False) -> DataFrame:
    """Inputs without a job that has a batch id; `forced` submits them again."""
    return inputs if forced else inputs.join(jobs.where(c.blank_to_null("batch_id").isNotNull()), keys, "left_anti")


def token_limit(attempt: str | Column, attempts: int, usual: int, last: int) -> Column:
    """Tokens that an answer may have: more on the last attempt, for answers that were cut off."""
    a = F.col(attempt) if isinstance(attempt, str) else attempt
    return F.when(a >= attempts, F.lit(last)).otherwise(F.lit(usual))
