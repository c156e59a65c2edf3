"""Records of any depth: VARIANT values walked level by level, until nothing nests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import kept


def walked(df: DataFrame, keys: list[str], record: str) -> DataFrame:
    """keys, depth, path, name, value: every member and element of a VARIANT column, at any depth. name is null for elements.

    A level is exploded into the next and stored; a level without members and elements ends the walk. Only objects and arrays go on, so the work is that of
    the values there are, and a deep record costs one small job for each of its levels."""
    spark = df.sparkSession
    nests = F.schema_of_variant("value").startswith("OBJECT") | F.schema_of_variant("value").startswith("ARRAY")
    level = df.where(F.col(record).isNotNull()).select(*keys, F.lit(0).alias("depth"), F.lit("$").alias("path"), F.lit(None).cast("string").alias("name"), F.col(record).alias("value"))
    levels = []
    while True:
        spread = level.where(nests).lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("_pos", "_key", "_value"))
        step = F.when(F.col("_key").isNotNull(), F.concat(F.lit("."), F.col("_key"))).otherwise(F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]")))
        level = kept(spread.select(*keys, (F.col("depth") + 1).alias("depth"), F.concat("path", step).alias("path"), F.col("_key").alias("name"), F.col("_value").alias("value")))
        if level.isEmpty():
            break
        levels.append(level)
    out = levels[0] if levels else level
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def plain(value: str | Column) -> Column:
    """A VARIANT as text: strings as they are, everything else as JSON."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def present(value: str | Column) -> Column:
    """`plain`, but null for JSON's null."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(~F.is_variant_null(v), plain(v))


def distribution(df: DataFrame, keys: list[str], record: str, name: str) -> DataFrame:
    """keys, value, n: how often each value stands under `name`, at any depth of the record."""
    found = walked(df, keys, record).where(F.col("name") == name)
    return found.select(*keys, plain("value").alias("value")).groupBy(*keys, "value").agg(F.count("*").alias("n"))


def scalar_or_list(values: str | Column) -> Column:
    """Aggregate: the one distinct value as a VARIANT scalar, several as a sorted VARIANT list, none as null. The shape follows the group."""
    v = F.sort_array(F.collect_set(values))
    text = F.when(F.size(v) == 1, F.to_json(F.to_variant_object(F.array(F.get(v, F.lit(0)))))).when(F.size(v) > 1, F.to_json(F.to_variant_object(v)))
    whole = F.parse_json(text)
    return F.when(F.size(v) == 1, F.variant_get(whole, "$[0]", "variant")).when(F.size(v) > 1, whole)
