"""Intervals on a media timeline: half-open for overlap, joined where they touch for union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def union_length(df: DataFrame, keys: list[str], start: str, end: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """keys and the length that a group's intervals cover together, within [low, high] where given.

    One shuffle: a running maximum of ends over the sorted intervals, then a sum of what each adds."""
    a, b = F.col(start), F.col(end)
    a = F.greatest(a, F.col(low)) if low else a
    b = F.least(b, F.col(high)) if high else b
    w = Window.partitionBy(*keys).orderBy("_a", "_b").rowsBetween(Window.unboundedPreceding, -1)
    clipped = df.select(*keys, a.alias("_a"), b.alias("_b")).where("_b > _a")
    reach = clipped.withColumn("_m", F.max("_b").over(w))
    return reach.groupBy(*keys).agg(F.sum(F.greatest(F.col("_b") - F.greatest("_a", F.coalesce("_m", "_a")), F.lit(0))).alias("covered"))


def array_union_length(intervals: Column, low: Column, high: Column) -> Column:
    """The same for an array of start_sec, end_sec in one row."""
    clipped = F.transform(intervals, lambda x: F.struct(F.greatest(x["start_sec"], low).alias("a"), F.least(x["end_sec"], high).alias("b")))
    real = F.sort_array(F.filter(clipped, lambda x: x["b"] > x["a"]))
    zero = F.struct(F.lit(0.0).alias("t"), F.lit(float("-inf")).alias("e"))
    step = lambda s, x: F.struct((s["t"] + F.greatest(x["b"] - F.greatest(x["a"], s["e"]), F.lit(0.0))).alias("t"), F.greatest(s["e"], x["b"]).alias("e"))
    return F.aggregate(real, zero, step, lambda s: s["t"])


def overlaps(a: Column, b: Column) -> Column:
    """Whether some interval of array a and some of array b share positive length; intervals without length never do."""
    real = lambda x: x["end_sec"] > x["start_sec"]
    meet = lambda x, y: F.greatest(x["start_sec"], y["start_sec"]) < F.least(x["end_sec"], y["end_sec"])
    return F.coalesce(F.exists(a, lambda x: real(x) & F.exists(b, lambda y: real(y) & meet(x, y))), F.lit(False))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str, bucket: float, how: str = "inner") -> DataFrame:
    """Pairs of rows with equal keys whose intervals [start, end) share positive length; how: inner, or left_semi (equal left rows stay as many as they are).

    Both sides are dealt to the buckets of a grid that they touch and joined there on keys and bucket, so no key is compared all against all.
    A pair is made in the one bucket where it starts."""
    spread = lambda df: df.where(F.col(end) > F.col(start)).withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.ceil(F.col(end) / bucket) - 1)))
    columns = [F.col(f"`{c}`") for c in left.columns]
    if how == "left_semi":
        # a row lies in several buckets, so matches are made distinct; equal rows are counted before
        left = left.groupBy(*columns).agg(F.count("*").alias("_copies"))
    a = spread(left).alias("a")
    b = spread(right.select(*keys, F.col(start).alias("_rs"), F.col(end).alias("_re"), *[F.col(c).alias(f"right_{c}") for c in right.columns if c not in keys]).withColumnsRenamed({"_rs": start, "_re": end}))
    b = b.withColumnsRenamed({start: "_rs", end: "_re"}).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a._bucket") == F.col("b._bucket"), F.greatest(F.col(f"a.{start}"), F.col("b._rs")) < F.least(F.col(f"a.{end}"), F.col("b._re"))]
    if how == "left_semi":
        return a.join(b, on, "left_semi").drop("_bucket").distinct().withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*columns)
    first = F.floor(F.greatest(F.col(f"a.{start}"), F.col("b._rs")) / bucket) == F.col("a._bucket")
    return a.join(b, on).where(first).select(*[F.col(f"a.{c}") for c in left.columns], *[F.col(f"b.right_{c}") for c in right.columns if c not in keys])


def grid_cells(ranges: Column, cell: float) -> Column:
    """Sorted distinct grid cells that an array of ranges touches."""
    real = F.filter(ranges, lambda x: x["end_sec"] > x["start_sec"])
    return F.sort_array(F.array_distinct(F.flatten(F.transform(real, lambda x: F.sequence(F.floor(x["start_sec"] / cell), F.ceil(x["end_sec"] / cell) - 1)))))


def uniform_sample(values: Column, most: int) -> Column:
    """At most that many elements of an array, evenly spread with both ends, positions rounded half to even; all if there are no more."""
    n = F.size(values)
    if most == 1:
        return F.when(n <= 1, values).otherwise(F.array(F.get(values, F.floor(n / 2).cast("int"))))
    place = lambda i: F.bround(i * (n - 1).cast("double") / F.lit(float(most - 1))).cast("int")
    return F.when(n <= most, values).otherwise(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.get(values, place(i))))


def pieces(duration: Column, length: float, least_tail: float) -> Column:
    """Array of index, start_sec, end_sec: a duration cut into pieces, a tail under least_tail joined to the piece before it."""
    if least_tail > length:
        raise ValueError("a tail can't have to be longer than a piece")
    whole = F.floor(duration / length)
    rest = duration - whole * length
    n = F.when(duration <= 0, 0).when(duration < length, 1).when((rest == 0) | (rest < least_tail), whole).otherwise(whole + 1).cast("int")
    piece = lambda i: F.struct(i.alias("index"), (i * F.lit(length)).alias("start_sec"), F.when(i == n - 1, duration).otherwise((i + 1) * F.lit(length)).cast("double").alias("end_sec"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), piece)).otherwise(F.array().cast("array<struct<index:int,start_sec:double,end_sec:double>>"))


def review_bounds(cell: Column, length: float, least_tail: float, duration: Column | None = None) -> Column:
    """start_sec and end_sec of a review clip: its grid cell, within the source, moved forward if what is left of it is under least_tail."""
    start = cell * F.lit(length)
    end = start + F.lit(length)
    if duration is None:
        return F.struct(start.alias("start_sec"), end.alias("end_sec"))
    stop = F.when(duration > 0, F.least(end, duration)).otherwise(end)
    begin = F.when((duration > 0) & (stop - start < least_tail), F.greatest(F.lit(0.0), stop - F.lit(length))).otherwise(start)
    return F.struct(begin.alias("start_sec"), stop.alias("end_sec"))
