"""Connected components, and exact checks within candidate groups that no single task gathers whole."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ..session import ship
from .common import small, stored

#: Members of a candidate group that are compared at once; larger groups are dealt out as pairs of such blocks.
BLOCK = 512


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links to (node, root), root the least node that can be reached; nodes without a link to another are left out.

    Large-star and small-star rounds (Kiveris et al. 2014), about the log of a component's diameter. Each round aggregates before it
    shuffles and joins on the node, so a hub with many links is split like any skewed key. Rounds are stored, so nothing is recomputed."""
    spark = edges.sparkSession
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(e)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a")
        new = stored(pairs.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a <> b").distinct())
        e, old, mark = new, mark, _mark(new)
        if mark == old:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()) if mark[0] else spark.createDataFrame([], roots.schema)


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def blocks(members: DataFrame, group: str, node: str, size: int = BLOCK) -> DataFrame:
    """members, each in all pairs of blocks (bi, bj) of its group that it takes part in; `left` and `right` say on which side, `nb` how many blocks the group has.

    A group of n members has (n / size) ** 2 / 2 pairs of blocks, and each is one bounded task: all pairs are compared, none is emitted. Only groups
    of more than a block are joined, by broadcast while they are few; the members of others stay where they are."""
    large = stored(members.groupBy(group).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias("nb")).where("nb > 1"))
    dealt = members.join(small(large), group, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(F.col(node)), F.col("nb")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return dealt.select(
        *members.columns, "nb", F.least("_own", "_other").alias("bi"), F.greatest("_own", "_other").alias("bj"), F.expr("_own <= _other").alias("left"), F.expr("_own >= _other").alias("right")
    )


def by_bin(dealt: DataFrame, group: str, bins: int) -> GroupedData:
    """The rows of `blocks`, grouped for a function: small groups share one of `bins` bins, each pair of blocks of a large group has one of its own."""
    key = F.when(F.col("nb") == 1, F.pmod(F.xxhash64(F.col(group)), F.lit(bins))).otherwise(F.xxhash64(F.col(group), "bi", "bj"))
    return dealt.withColumn("_bin", key).groupBy("_bin")


def runs(t: pa.Table, group: str) -> tuple[pa.Table, list[tuple[int, int]]]:
    """t sorted such that each pair of blocks is a run of rows, and the runs."""
    cols = [t.column(c).to_numpy() for c in ("bj", "bi", group)]
    order = np.lexsort([t.column("left").to_numpy(zero_copy_only=False), *cols])
    t = t.combine_chunks().take(pa.array(order))
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = np.any([c[order][1:] != c[order][:-1] for c in cols], axis=0)
    at = np.flatnonzero(new)
    return t, list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least of 0 .. n - 1 that each is connected to by the pairs x, y."""
    root = np.arange(n)
    while len(x):
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def linked(members: DataFrame, group: str, node: str, weight: str, match: Callable[[pa.Table, int, np.ndarray], np.ndarray], rows: int, size: int = BLOCK, forest: bool = False) -> DataFrame:
    """For each member and pair of blocks: node, links (sum of weight over the members that match it there), and root (a member it is connected to by matches there).

    match(t, i, js) tells which of the rows js of t match row i; js ascend, within a run of rows. rows: about how many members there are. Rows out are as
    many as members in blocks, whatever the number of links. forest: only what is connected counts, not how often, so pairs already connected aren't
    matched and links is no count."""
    ship(members.sparkSession)
    kind = dict(members.dtypes)[node]

    def check(key: tuple, t: pa.Table) -> pa.Table:
        t, parts = runs(t, group)
        ids = t.column(node).to_numpy()
        w = t.column(weight).to_numpy()
        left, right = t.column("left").to_numpy(zero_copy_only=False), t.column("right").to_numpy(zero_copy_only=False)
        n = len(ids)
        links, root = np.zeros(n, np.int64), np.arange(n)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for s, e in parts:
            li, ri = s + np.flatnonzero(left[s:e]), s + np.flatnonzero(right[s:e])
            same = bool(left[s] and right[s])
            for k, i in enumerate(li):
                j = ri[k + 1 :] if same else ri
                if forest:
                    # a few at a time: one match with a component settles all of it
                    j, step = j[root[j] != root[i]], 4
                    while len(j):
                        head, j = j[:step], j[step:]
                        head = head[match(t, i, head)]
                        if len(head):
                            joined = np.append(root[head], root[i])
                            part = root[s:e]
                            part[np.isin(part, joined)] = joined.min()
                            j = j[root[j] != root[i]]
                        step *= 4
                    continue
                if len(j):
                    j = j[match(t, i, j)]
                    links[i] += w[j].sum()
                    np.add.at(links, j, w[i])
                    if len(j):
                        found.append((np.full(len(j), i), j))
        if found:
            root = roots(n, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
        return pa.table({"node": ids, "links": links, "root": ids[root]})

    return by_bin(blocks(members, group, node, size), group, max(1, rows // size)).applyInArrow(check, f"node {kind}, links bigint, root {kind}")
