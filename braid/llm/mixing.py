"""Mixing sources to target weights [native]: Poisson replication.

A source's target share is its weight over the sum of weights; its rate is the mean number of copies that one of its rows needs for that
share of `total` rows. Each row inverts a Poisson distribution of that mean at a number in [0, 1) hashed from seed and doc_id, is exploded by
the count, and all copies are shuffled globally. A rate over PIECE_RATE is a sum of equal pieces with a number each, so exp(-rate) never
underflows. Only the sources (a row each) are joined to the rows, by broadcast while their bytes are few; a hot source therefore moves nowhere but
in the final shuffle, which deals out by a hash of doc_id and copy.

Null source: a source of its own, named ''. Null doc_id: hashed as the text `null`. Repeated rows get the same count. Without rows: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_bytes, stored

PIECE_RATE = 256.0


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, total: int | None = None) -> DataFrame:
    """source, n, rate, pieces, cdf: without weights a source weighs its row count to the power `temperature`. A source with no weight given gets none."""
    n = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))]) if weights else F.create_map(F.lit(""), F.lit(0.0))
        n = n.withColumn("weight", F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0)))
    n = stored(n)
    sums = n.agg(F.sum("n"), F.sum(F.round("weight", 9).cast("decimal(38,9)"))).first()
    rows, weight = sums[0] or 0, float(sums[1] or 0)
    rate = F.col("weight") / F.lit(weight or 1.0) * F.lit(float(rows if total is None else total)) / F.col("n")
    out = n.withColumn("rate", rate).withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE_RATE)).cast("int")).withColumn("_r", F.col("rate") / F.col("pieces"))
    steps = F.ceil(F.col("_r") + 12 * F.sqrt("_r") + 40).cast("int")
    cdf = F.expr(
        "aggregate(sequence(1, _k), named_struct('p', exp(-_r), 'c', exp(-_r), 'a', array(exp(-_r))),"
        " (s, k) -> named_struct('p', s.p * _r / k, 'c', s.c + s.p * _r / k, 'a', array_append(s.a, s.c + s.p * _r / k)), s -> s.a)"
    )
    return out.withColumn("_k", steps).withColumn("cdf", cdf).select("source", "n", "rate", "pieces", "cdf")


def _uniform(seed: str, j) -> str:
    """SQL for a number in [0, 1) of 52 hashed bits."""
    return f"cast(conv(substring(md5(concat('{seed}:', coalesce(cast(doc_id as string), 'null'), ':', {j})), 1, 13), 16, 10) as double) / 4503599627370496D"


def mixed(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, total: int | None = None, seed: str = "mix") -> DataFrame:
    """The rows of docs, each as often as its count, with `copy` numbered from 1, shuffled globally. Columns of docs stay, whatever their names: where
    there is a `copy`, ours has underscores before it."""
    if "'" in seed or "\\" in seed:
        raise ValueError("a seed has no quotes or backslashes")
    source, rate, times, key, copy = (fresh(docs, c) for c in ("source_", "rate", "times", "key", "copy"))
    r = stored(rates(docs, weights, temperature, total).select(F.col("source").alias(source), F.struct("pieces", "cdf").alias(rate)))
    r = small_bytes(r, F.size(F.col(rate)["cdf"]) * 8 + F.octet_length(source) + 64)
    count = F.expr(f"cast(aggregate(sequence(1, `{rate}`.pieces), 0, (a, j) -> a + size(filter(`{rate}`.cdf, c -> c <= {_uniform(seed, 'j')}))) as int)")
    one = docs.join(r, F.coalesce(F.col("source"), F.lit("")) == F.col(source)).withColumn(times, count).where(F.col(times) > 0)
    many = one.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(times))).alias(copy))
    many = many.withColumn(key, F.xxhash64(F.lit(seed), F.col("doc_id"), F.col(copy)))
    return many.repartition(key).sortWithinPartitions(key).drop(key)


def oracle(temperature: float = 0.5, seed: str = "mix") -> str:
    return f"""
with recursive n as (select coalesce(source, '') as s, count(*) as n, power(count(*)::double, {temperature}) as w from documents group by 1),
r as (select s, w / (select sum(round(w, 9)::decimal(38, 9))::double from n) * (select sum(n)::double from n) / n as rate from n),
q as (select s, greatest(1, ceil(rate / {PIECE_RATE}))::int as pieces, rate / greatest(1, ceil(rate / {PIECE_RATE}))::int as r from r),
cdf(s, k, p, c, r) as (
  select s, 0, exp(-r), exp(-r), r from q
  union all
  select s, k + 1, p * r / (k + 1), c + p * r / (k + 1), r from cdf where k < ceil(r + 12 * sqrt(r) + 40)),
l as (select s, list(c order by k) as cs from cdf group by s),
d as (
  select d.*, pieces, cs, list_transform(generate_series(1, pieces), lambda j: ('0x' || substr(md5(concat('{seed}:', coalesce(doc_id::varchar, 'null'), ':', j)), 1, 13))::bigint::double / 4503599627370496) as us
  from documents d join q on coalesce(d.source, '') = q.s join l on l.s = q.s),
e as (select *, list_sum(list_transform(us, lambda u: len(list_filter(cs, lambda c: c <= u))))::int as times from d)
select doc_id, text, lang, source, n_chars, unnest(generate_series(1, times))::int as copy from e where times > 0
"""
