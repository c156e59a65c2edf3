"""Orders, ranks and selections. Every order is total: the last key decides all ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.workspace import kept, small

#: Rows of a group that one fold takes.
FOLD = 4096


def numbered(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """1..N within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered_globally(df: DataFrame, order: list, name: str, buckets: list[str] | None = None) -> DataFrame:
    """1..N over all rows without sorting them in one task: rows are ranked within leading buckets, and the buckets' sizes are added up.

    buckets: leading columns of the order, few values: only these, with counts, meet in one task. Without them rows are dealt out by range; see `ranked`."""
    if not buckets:
        return ranked(df, order, name)
    lead = order[: len(buckets)]
    sizes = df.groupBy(*buckets).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(*lead).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*buckets).orderBy(*order)))
    return ranked.join(before, buckets).withColumn(name, (F.col("_rank") + F.col("_before")).cast("int")).drop("_rank", "_before")


def ranked(df: DataFrame, order: list, name: str, first: int = 1) -> DataFrame:
    """first, first + 1, .. over all rows in order. Rows are dealt out by range of the whole order and sorted where they are; a partition's rows are counted,
    and the counts of the partitions before it added to each row's place. Only those counts meet in one task. The dealt rows are stored, as ranges are cut by
    samples. Rows that the order doesn't tell apart are in one partition and numbered in any order."""
    p, at = (f"__{name}_{x}" for x in ("part", "at"))
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    t = kept(dealt.withColumns({p: F.spark_partition_id(), at: F.monotonically_increasing_id()}))
    before = F.sum("n").over(Window.orderBy(p).rowsBetween(Window.unboundedPreceding, -1))
    shift = t.groupBy(p).agg(F.min(at).alias("lo"), F.count("*").alias("n")).select(p, (F.coalesce(before, F.lit(0)) - F.col("lo")).alias("__shift"))
    return t.join(small(kept(shift)), p).withColumn(name, (F.col(at) + F.col("__shift") + first).cast("bigint")).drop(p, at, "__shift")


def group_size_at_least(df: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)) >= least)


def conflict_free(df: DataFrame, keys: list[str], order: str, sets: str) -> DataFrame:
    """keys and the order values kept: each group is read in order, and a row whose sets meet a kept row's is left out.

    The fold over a group's sorted array is sequential by nature, so a group is one row's work; groups (participants) are small."""
    item = F.struct(F.col(order).alias("k"), F.coalesce(F.col(sets), F.array().cast(dict(df.dtypes)[sets])).alias("s"))
    kinds = dict(df.dtypes)
    zero = F.struct(F.array().cast(f"array<{kinds[order]}>").alias("kept"), F.array().cast(kinds[sets]).alias("used"))
    step = lambda a, x: F.when(F.arrays_overlap(a["used"], x["s"]), a).otherwise(F.struct(F.array_append(a["kept"], x["k"]).alias("kept"), F.array_union(a["used"], x["s"]).alias("used")))
    return df.groupBy(*keys).agg(F.aggregate(F.sort_array(F.collect_list(item)), zero, step, lambda a: a["kept"]).alias("kept"))


def conflict_free_rows(df: DataFrame, keys: list[str], order: str, sets: str, fold: int = FOLD) -> DataFrame:
    """keys and order of the rows kept, as `conflict_free` keeps them, for groups of any size.

    By rounds: a row that is the first of its group for each of its ids is kept, every row that shares an id with it goes, and so on with the rest. This is the
    greedy choice, as no row before such a row can take one of its ids. Groups of no more than `fold` remaining rows are folded in one step. order is unique
    within a group; a row without ids meets no other, and a null id none.

    A round finds the first row of each id with how many ids it has: rows that are first as often are kept. Only these firsts, as many as ids, are joined with
    each other; the rest meets the ids taken, once, and stays one row for each of its rows."""
    ids = F.array_distinct(F.array_compact(F.coalesce(F.col(sets), F.array().cast(dict(df.dtypes)[sets]))))
    rows = kept(df.select(*keys, F.col(order), ids.alias("ids")))
    kept_rows = [rows.where("size(ids) = 0").select(*keys, order)]
    rest = rows.where("size(ids) > 0")
    while not rest.isEmpty():
        sizes = kept(rest.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") <= fold).select(*keys))
        if sizes.count():
            last = rest.join(small(sizes), keys, "left_semi")
            kept_rows.append(kept(conflict_free(last, keys, order, "ids").select(*keys, F.explode("kept").alias(order))))
            rest = kept(rest.join(small(sizes), keys, "left_anti"))
            if rest.isEmpty():
                break
        each = rest.select(*keys, F.struct(F.col(order).alias("at"), F.size("ids").alias("n")).alias("row"), F.explode("ids").alias("id"))
        first = kept(each.groupBy(*keys, "id").agg(F.min("row").alias("row")).select(*keys, "id", F.col("row.at").alias(order), "row.n"))
        won = kept(first.groupBy(*keys, order, "n").agg(F.count("*").alias("firsts")).where("firsts = n").select(*keys, order))
        used = kept(first.join(small(won), [*keys, order], "left_semi").select(*keys, "id"))
        gone = rest.select(*keys, order, F.explode("ids").alias("id")).join(small(used), [*keys, "id"], "left_semi").select(*keys, order).distinct()
        kept_rows.append(won)
        rest = kept(rest.join(gone, [*keys, order], "left_anti"))
    out = kept_rows[0]
    for k in kept_rows[1:]:
        out = out.unionByName(k)
    return out


def top_groups(df: DataFrame, key: str, weight: str, row_order: str, groups: int, rows: int) -> DataFrame:
    """The first `rows` rows of each of the `groups` groups with most rows (then weight, then key), with group_rank, row_rank, global_rank."""
    best = df.groupBy(key).agg(F.count("*").alias("_n"), F.sum(weight).alias("_w")).orderBy(F.desc("_n"), F.desc("_w"), key).limit(groups)
    best = best.withColumn("group_rank", F.row_number().over(Window.orderBy(F.desc("_n"), F.desc("_w"), key))).select(key, "group_rank")
    picked = df.join(F.broadcast(best), key)  # as many rows as `groups`
    picked = numbered(picked, [key], [F.col(row_order)], "row_rank").where(F.col("row_rank") <= rows)
    return picked.withColumn("global_rank", F.row_number().over(Window.orderBy("group_rank", "row_rank")))


def midpoint(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The row at place n // 2 (from 0) of each group."""
    w = Window.partitionBy(*keys)
    return df.withColumn("_i", F.row_number().over(w.orderBy(*order))).withColumn("_n", F.count("*").over(w)).where("_i = floor(_n / 2) + 1").drop("_i", "_n")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by the order columns: an aggregate of structs, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def shard(df: DataFrame, order: list, shards: int, name: str = "shard") -> DataFrame:
    """Round robin over the sorted rows."""
    return ranked(df, order, name, first=0).withColumn(name, F.pmod(F.col(name), F.lit(shards)).cast("int"))


def natural_key(x: str | Column) -> Column:
    """P numbers by value, then EGO4D_P numbers by value, then the rest as text."""
    c = F.col(x) if isinstance(x, str) else x
    short, long = F.regexp_extract(c, r"^P(\d+)$", 1).try_cast("bigint"), F.regexp_extract(c, r"^EGO4D_P(\d+)$", 1).try_cast("bigint")
    return F.struct(F.when(short.isNotNull(), 0).when(long.isNotNull(), 1).otherwise(2).alias("kind"), F.coalesce(short, long, F.lit(0)).alias("n"), c.alias("text"))


def contiguous(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys and whether the group's numbers are exactly 1..N."""
    return df.groupBy(*keys).agg(((F.min(order) == 1) & (F.max(order) == F.count("*")) & (F.count_distinct(order) == F.count("*"))).alias("contiguous"))


def frequencies(df: DataFrame, value: str, seen: str) -> DataFrame:
    """value, n, rank: most frequent first, ties by first appearance."""
    n = df.groupBy(value).agg(F.count("*").alias("n"), F.min(seen).alias("_first"))
    return ranked(n, [F.desc("n"), F.col("_first")], "rank").withColumn("rank", F.col("rank").cast("int")).drop("_first")
