"""Requests from several tables: what has to match is looked up once, and what is wrong comes out as rows of the same join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import ranking


def elements(items: DataFrame, key: str, array: str, targets: DataFrame, target: str) -> DataFrame:
    """key, position, target and the columns of `targets` (a row for each target), for every element of an array; a target that isn't there leaves them null and
    `known` false. Elements, not arrays, are joined, so an item with many elements is no single row's work."""
    spread = items.select(*[x for x in items.columns if x != array], F.posexplode(array).alias("position", target))
    return spread.join(targets.withColumn("known", F.lit(True)), target, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def element_violation(source: str | Column, target_source: str | Column, url: str | Column | None = None) -> Column:
    """What is wrong with an element: `missing_target`, `other_source`, `no_url`, or null."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (source, target_source))
    found = F.when(~F.col("known"), "missing_target").when(~a.eqNullSafe(b), "other_source")
    return found if url is None else found.when(c.blank_to_null(url).isNull(), "no_url")


def resolved(items: DataFrame, key: str, array: str, targets: DataFrame, target: str, value: str, source: str, target_source: str, url: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Of each item whose elements are all right, key and the targets' values in the order of the array (none for an empty one); and the violations of the
    others: key, position, target, code. Both come from one join."""
    bad = element_violation(source, target_source, url)
    j = elements(items.select(key, source, array), key, array, targets, target).withColumn("code", bad)
    per = j.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("position", value))).alias("v"), F.count("code").alias("n"))
    values = F.transform("v", lambda x: x[value])
    none = F.array().cast(f"array<{dict(targets.dtypes)[value]}>")
    whole = items.select(key).join(per, key, "left").where(F.coalesce("n", F.lit(0)) == 0).select(key, F.coalesce(values, none).alias(array))
    return whole, j.where("code is not null").select(key, "position", target, "code")


def session_requests(sessions: DataFrame, inputs: DataFrame, proxies: DataFrame, key: str, proxy_key: str, proxy: str, needed: Column) -> DataFrame:
    """Sessions with their inputs and proxies, and `code`: `missing_input`; `missing_proxy` where there is none and `needed` (of sessions and inputs) says that
    the request can't do without; null for requests that can go out."""
    j = sessions.join(inputs.withColumn("_input", F.lit(True)), key, "left").join(proxies.select(proxy_key, c.blank_to_null(proxy).alias(proxy)), proxy_key, "left")
    code = F.when(F.col("_input").isNull(), "missing_input").when(needed & F.col(proxy).isNull(), "missing_proxy")
    return j.withColumn("code", code).drop("_input")


def unfinished(manifest: DataFrame, statuses: DataFrame, keys: list[str], order: list[str], status: str = "status", good: str = "ok") -> DataFrame:
    """keys and code of manifest rows that can't go on: `missing_status`, or `not_ok` where the latest status is another."""
    last = ranking.latest(statuses.select(*keys, *order, status), keys, order).select(*keys, F.col(status).alias("_status"), F.lit(True).alias("_seen"))
    j = manifest.select(*keys).join(last, keys, "left")
    return j.select(*keys, F.when(F.col("_seen").isNull(), "missing_status").when(~F.col("_status").eqNullSafe(good), "not_ok").alias("code")).where("code is not null")
