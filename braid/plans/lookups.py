"""Queries on lookups: customers, suppliers and parts as videos, documents as candidates, orders as records to validate."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import lookups, qc, rules
from .catalog import query
from .review import _CAND, _second
from .tables import cents, table


@query("""
select c_custkey, case when length(c_custkey::varchar) = 3 then '100' when n_name is not null then '55' end as version,
  case when length(c_custkey::varchar) = 3 then 'P' || c_nationkey || '/videos/P' || c_nationkey || '_' || c_custkey || '.MP4' else 'videos/' || n_name || '/P' || c_nationkey || '/P' || c_nationkey || '_' || c_custkey || '.MP4' end as key
from customer left join nation on c_nationkey = n_nationkey""")
def q53_lookup_remote_key(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    j = lookups.lookup(cust, table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), ["n_nationkey"], "n_name")
    video = F.concat(F.lit("P"), F.col("n_nationkey").cast("string"), F.lit("_"), F.col("c_custkey").cast("string"))
    return j.withColumn("_o", lookups.remote_object(video, "n_name")).select("c_custkey", "_o.version", "_o.key")


@query("select s_suppkey, case when s_suppkey % 3 = 0 then null else s_suppkey % 5 <> 0 end as same_digest from supplier")
def q54_digest_verdict(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.md5("s_name").alias("actual"))
    expected = s.select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, " ").when(F.col("s_suppkey") % 5 == 0, F.md5(F.lit("x"))).otherwise(F.col("actual")).alias("expected"))
    return lookups.lookup(s, expected, ["s_suppkey"], "expected").select("s_suppkey", lookups.digest_verdict("actual", "expected").alias("same_digest"))


@query("""
select coalesce(c_custkey, s_suppkey, p_partkey)::varchar as video_id, coalesce('p/' || c_custkey || '_540p.mp4', '') as proxy, coalesce('r/' || s_suppkey || '.MP4', '') as raw, coalesce(p_partkey || '_contact.jpg', '') as contact
from customer full join supplier on c_custkey = s_suppkey full join part on coalesce(c_custkey, s_suppkey) = p_partkey""")
def q55_union_by_stem(spark, sf_dir):
    def files(name, key, pattern):
        return table(spark, sf_dir, name).select(F.format_string(pattern, F.col(key).cast("bigint")).alias("key"))

    return lookups.union_by_stem(
        {"proxy": (files("customer", "c_custkey", "p/%d_540p.mp4"), ["_540p.mp4"]), "raw": (files("supplier", "s_suppkey", "r/%d.MP4"), [".MP4"]), "contact": (files("part", "p_partkey", "%d_contact.jpg"), ["_contact.jpg"])}, "key", "key"
    )


@query("""
with k as (select doc_id, count(*) as n from documents group by 1), v as (select doc_id, count(*) as n from labels group by 1)
select k.doc_id, 'missing_verdict' as code from k where doc_id not in (select doc_id from v)
union all select doc_id, 'unrequested_verdict' from v where doc_id not in (select doc_id from k)
union all select doc_id, 'duplicate_verdict' from v where n > 1""")
def q56_verdict_coverage(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    return qc.verdict_coverage(docs, docs, labels, ["doc_id"])


@query("""
select l_returnflag, l_linestatus, count(*)::bigint as count, min(c) as min, quantile_cont(c, 0.25) as p25, quantile_cont(c, 0.5) as median, round(sum(c) / count(*), 6) as mean, quantile_cont(c, 0.75) as p75, max(c) as max
from (select l_returnflag, l_linestatus, round(l_quantity * 100)::bigint::double as c from lineitem) group by 1, 2""")
def q57_describe(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", cents("l_quantity").alias("c"))
    return lookups.describe(x, "c", ["l_returnflag", "l_linestatus"]).withColumn("mean", F.round("mean", 6))


@query("select o_orderpriority as participant_id, count(*)::bigint as sources, sum(n)::bigint as candidates from (select o_orderkey, o_orderpriority, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by 1, 2) group by grouping sets ((o_orderpriority), ())")
def q58_bundle_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list("l_linenumber").alias("lines"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("participant_id"))
    return lookups.bundle_report(orders.join(lines, "o_orderkey", "left").withColumnRenamed("o_orderkey", "source_video_id"), "lines")


@query(_CAND + """
select doc_id::varchar as candidate_id, coalesce(type, '') as candidate_type, 'claim ' || doc_id as claim, verdict as first_pass_verdict, case doc_id % 3 when 0 then 'entailed' when 1 then 'contradicted' else 'insufficient' end as local_verdict,
  case when blocking then '["long_term_overclaim"]' else '[]' end as quality_flags, '' as corrected_claim, 'seen ' || doc_id as reason, '' as human_decision
from s where qc_status = 'human_review_required'""")
def q59_human_review(spark, sf_dir):
    s = _second(spark, sf_dir).withColumns(
        {"source_video_id": F.lit("v"), "participant_id": F.lit("p"), "candidate_id": F.col("doc_id"), "reason": F.lit("first"), "local_reason": F.format_string("seen %d", "doc_id"), "fingerprint": qc.fingerprint(["doc_id", "claim"])}
    )
    return qc.human_review(s).select("candidate_id", "candidate_type", "claim", "first_pass_verdict", "local_verdict", "quality_flags", "corrected_claim", "reason", "human_decision")


@query("select c_custkey, row_number() over (partition by c_nationkey order by c_custkey // 10, round(c_acctbal * 100)::bigint desc, c_custkey)::int as place from customer")
def q60_video_order(spark, sf_dir):
    video = F.concat(F.lit("P_"), F.floor(F.col("c_custkey") / 10).cast("string"))
    x = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", lookups.video_sequence(video).alias("video_sequence"), cents("c_acctbal").alias("duration_min"))
    w = Window.partitionBy("c_nationkey").orderBy(*lookups.video_order("c_nationkey"), "c_custkey")
    return x.select("c_custkey", F.row_number().over(w).alias("place"))


@query("""
with x as (select case when c_custkey % 4 = 0 then 'other' else 'main' end as bucket, case when c_custkey % 50 = 0 then null else 'n/' || c_nationkey || '/' || c_custkey // 2 end as key, case when c_custkey % 7 = 0 then 'far' end as region from customer)
select bucket, key, 'missing_key' as code from x where key is null
union all select bucket, key, 'region_differs' from x where region = 'far'
union all select bucket, key, 'duplicate_object' from x where key is not null group by 1, 2 having count(*) > 1""")
def q61_address_violations(spark, sf_dir):
    k = F.col("c_custkey")
    key = F.when(k % 50 == 0, "").otherwise(F.concat(F.lit("n/"), F.col("c_nationkey").cast("string"), F.lit("/"), F.floor(k / 2).cast("string")))
    rows = table(spark, sf_dir, "customer").select(F.when(k % 4 == 0, "other").alias("bucket"), key.alias("key"), F.when(k % 7 == 0, "far").alias("region"))
    return lookups.address_violations(rows, "main", "near")


@query("""
with x as (select o_orderkey as k, o_orderkey % 5 as n, o_orderkey % 7 as p from orders)
select code, severity, count(*)::bigint as n from (
  select 'missing_required_field' as code, 'blocking' as severity from x where k % 13 = 0
  union all select 'count_limit_exceeded', 'warning' from x where n > 3
  union all select 'unknown_place_reference', 'warning' from x where p >= n
  union all select 'invalid_confidence', 'blocking' from x where k % 11 = 0
  union all select 'invalid_relative_time', 'blocking' from x where k % 17 = 0) group by 1, 2""")
def q62_validate_micro(spark, sf_dir):
    """Orders as records of clips: too many places, references to places that aren't there, odd confidences and times."""
    k = F.col("o_orderkey").cast("bigint")
    none = F.array().cast("array<string>")
    n = (k % 5).cast("int")
    places = F.transform(F.slice(F.array(*[F.lit(i) for i in range(5)]), F.lit(1), n), lambda i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("place_id")))
    event = F.struct(
        F.lit("e").alias("event_id"),
        F.concat(F.lit("p"), (k % 7).cast("string")).alias("place_id"),
        F.when(k % 11 == 0, "sure").otherwise("low").alias("confidence"),
        F.when(k % 17 == 0, "0:09-0:05").otherwise("0:05-0:09").alias("time_range"),
    )
    fields = {
        "clip_id": k.cast("string"),
        "source_video_id": F.lit("v"),
        "clip_time_range": F.struct(F.lit(0).alias("start_sec"), F.lit(100).alias("end_sec")),
        "clip_summary": F.when(k % 13 != 0, "s"),
        "places": places,
        "atomic_events": F.array(event),
        **{s: none for s in ("objects", "state_observations", "state_changes", "end_state", "uncertainties")},
    }
    parent = F.struct(k.cast("string").alias("clip_id"), F.lit("v").alias("source_video_id"), F.lit(0).alias("start_sec"), F.lit(100).alias("end_sec"))
    orders = table(spark, sf_dir, "orders")
    records = orders.select(k.alias("record_id"), F.parse_json(F.to_json(F.struct(*[v.alias(f) for f, v in fields.items()]))).alias("record"))
    checked = rules.validate("micro", records, orders.select(k.alias("record_id"), F.parse_json(F.to_json(parent)).alias("parent")))
    return rules.issue_log(checked, "micro").groupBy("code", "severity").agg(F.count("*").alias("n"))
