"""What queries share: tables, whole cents instead of sums of floats, and time without a session's time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(x: str | Column) -> Column:
    """Hundredths as a whole number: sums don't depend on order."""
    return F.round((F.col(x) if isinstance(x, str) else x) * 100).cast("bigint")


def micros(x: str) -> Column:
    """Microseconds of a time without zone since 1970."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {x})")


def joined(items: Column, sep: str = "|") -> Column:
    """An array as text, whatever its elements are."""
    return F.array_join(F.transform(items, lambda v: v.cast("string")), sep)
