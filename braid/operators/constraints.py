"""Data-quality operators: each returns its violations as rows; `enforce` turns them into an error on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A condition on a row that is a violation, with its code and severity."""

    code: str
    severity: str
    violated: Column
    message: str | Column = ""


def issues(df: DataFrame, keys: list[str], checks: list[Check]) -> DataFrame:
    """All checks in one projection, one row per violation: the table is scanned once, whatever the number of rules."""
    found = F.array(*[F.when(k.violated, F.struct(F.lit(k.code).alias("code"), F.lit(k.severity).alias("severity"), (k.message if isinstance(k.message, Column) else F.lit(k.message)).alias("message"))) for k in checks])
    return df.select(*keys, F.explode(F.filter(found, lambda x: x.isNotNull())).alias("_i")).select(*keys, "_i.*")


def enforce(violations: DataFrame, what: str, show: int = 10) -> None:
    """Raise with the first violations, if there are any."""
    rows = violations.limit(show).collect()
    if rows:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def duplicates(df: DataFrame, keys: list[str], blanks: bool = False) -> DataFrame:
    """Keys that occur more than once (or, with blanks, are null or empty), with n."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    bad = F.col("n") > 1
    if blanks:
        for k in keys:
            bad = bad | F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == "")
    return n.where(bad)


def unknown_references(df: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Values of a column that the known keys lack, with n; null and blank values refer to nothing. Aggregated before the join."""
    n = df.where(F.col(column).isNotNull() & (F.trim(F.col(column).cast("string")) != "")).groupBy(F.col(column).alias(key)).agg(F.count("*").alias("n"))
    return n.join(known.select(key), key, "left_anti")


def unknown_in_array(refs: Column, allowed: Column) -> Column:
    """References in an array that the allowed ids lack."""
    return F.array_except(F.filter(refs, lambda r: r.isNotNull() & (F.trim(r) != "")), F.coalesce(allowed, F.array().cast("array<string>")))


def missing(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """keys and the required columns that are null or blank there."""
    return issues(df, keys, [Check("missing_required_field", "blocking", F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == ""), k) for k in columns])


def coverage(left: DataFrame, right: DataFrame, key: str, only_left: str, only_right: str) -> DataFrame:
    """key, code, blocking: a full outer join that says on which side a key is missing."""
    a, b = left.select(F.col(key).alias("_a")), right.select(F.col(key).alias("_b"))
    j = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    code = F.when(F.col("_b").isNull(), only_left).when(F.col("_a").isNull(), only_right).otherwise("matched")
    return j.select(F.coalesce("_a", "_b").alias(key), code.alias("code"), (F.col("_a").isNull() | F.col("_b").isNull()).alias("blocking"))


def set_difference(left: DataFrame, right: DataFrame, group: list[str], key: str, examples: int = 10) -> DataFrame:
    """For each group: how many keys only one side has, whether the sets are equal, and the first differing keys as text."""
    both = left.select(*group, key, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*group, key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    k = both.groupBy(*group, key).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    n = k.groupBy(*group).agg(F.count_if((F.col("_l") == 1) & (F.col("_r") == 0)).alias("only_left"), F.count_if((F.col("_l") == 0) & (F.col("_r") == 1)).alias("only_right"))
    odd = k.where("_l <> _r")
    from pyspark.sql.window import Window

    first = odd.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy(key))).where(F.col("_i") <= examples)
    text = first.groupBy(*group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(key)), lambda x: x.cast("string")), "|").alias("examples"))
    out = n.withColumn("equal", (F.col("only_left") + F.col("only_right")) == 0).join(text, group, "left")
    return out.withColumn("examples", F.coalesce("examples", F.lit("")))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new rows, and old ones whose key isn't among them; columns that one side lacks are null."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def retain(df: DataFrame, keep: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is kept (in any case), and the rest."""
    k = keep.select(F.lower(F.col(key).cast("string")).alias("_k")).distinct()
    on = F.lower(df[key].cast("string")) == k["_k"]
    return df.join(k, on, "left_semi"), df.join(k, on, "left_anti")


def severity(code: Column, given: Column, layer: str, downgraded: list[str]) -> Column:
    """Reference codes are warnings in the micro and window layers."""
    return F.when(F.lit(layer in ("micro", "window")) & code.isin(downgraded), F.lit("warning")).otherwise(given)


def complete(df: DataFrame, expected: int) -> DataFrame:
    """One row: records, accepted, rejected, and whether nothing is missing or rejected. df has `accepted`."""
    n = df.agg(F.count("*").alias("records"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))
    return n.withColumn("complete", (F.col("records") == expected) & (F.col("rejected") == 0))
