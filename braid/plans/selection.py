"""Selection, profile and ranking queries: benchmark choice, summaries, scores and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import columns as c
from ..operators import intervals, ranking
from .catalog import query
from .tables import cents, micros, table

# Benchmark choice: events as videos (event_id) of participants (user_id) with duration `value`.

_BENCH = """
with e as (
  select user_id, event_id, concat_ws('|', case when value <= 0 then 'invalid_duration' when value < 2 then 'duration_below_min' when value > 60 then 'duration_above_max' end,
    case when event_type = 'error' then 'scenario_filter_mismatch' end) as r from events),
n as (select user_id, event_id, r, count(*) filter (where r = '') over (partition by user_id) as n from e),
x as (select user_id, event_id, case when r <> '' then r when n < 3 then 'insufficient_independent_eligible_videos_for_participant' else '' end as reasons, n::bigint as eligible_count from n)
"""


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, event_id, reasons, eligible_count: every record with all reasons against it; one window shuffle by participant."""
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    why = c.reasons(
        (v <= 0, "invalid_duration"),
        ((v > 0) & (v < 2), "duration_below_min"),
        (v > 60, "duration_above_max"),
        (F.col("event_type") == "error", "scenario_filter_mismatch"),
    )
    n = F.count(F.when(F.size("why") == 0, 1)).over(Window.partitionBy("user_id"))
    few = (F.size("why") == 0) & (F.col("eligible_count") < 3)
    out = e.select("user_id", "event_id", why.alias("why")).withColumn("eligible_count", n)
    text = F.when(few, F.lit("insufficient_independent_eligible_videos_for_participant")).otherwise(F.array_join("why", "|"))
    return out.select("user_id", "event_id", text.alias("reasons"), "eligible_count")


@query(_BENCH + "select user_id, event_id, reasons, eligible_count, case when reasons = '' then (row_number() over (partition by user_id, reasons = '' order by event_id))::int end as benchmark_session_order, case when reasons = '' then eligible_count >= 2 end as cross_video from x")
def q01_benchmark_order(spark, sf_dir):
    b = benchmark(spark, sf_dir)
    ok = F.col("reasons") == ""
    order = F.when(ok, F.row_number().over(Window.partitionBy("user_id", ok).orderBy("event_id")))
    return b.select("*", order.alias("benchmark_session_order"), F.when(ok, F.col("eligible_count") >= 2).alias("cross_video"))


@query("""
select user_id, count(*)::bigint as videos, sum(round(value * 100)::bigint)::bigint as total_cents,
  string_agg(distinct event_type, '|' order by event_type) as types, count(*) filter (where event_type = 'error')::bigint as errors,
  bool_and(value > 0) as all_known, count(*) >= 2 as multi_video
from events group by user_id""")
def q02_participant_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(
        F.count("*").alias("videos"),
        F.sum(cents("value")).alias("total_cents"),
        F.array_join(F.sort_array(F.collect_set("event_type")), "|").alias("types"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.bool_and(F.col("value") > 0).alias("all_known"),
        (F.count("*") >= 2).alias("multi_video"),
    )


@query("""
with x as (select user_id, event_type, value from events)
select event_type as scenario, count(*)::bigint as videos, count(distinct user_id) filter (where user_id % 7 <> 0)::bigint as known_participants,
  sum(round(value * 100)::bigint)::bigint as total_cents, count(*) filter (where value >= 2)::bigint as long_enough
from (select user_id, value, unnest([event_type, 'all']) as event_type from x) group by 1""")
def q03_scenario_summary(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "value", F.explode(F.array("event_type", F.lit("all"))).alias("scenario"))
    known = F.when(F.col("user_id") % 7 != 0, F.col("user_id"))
    return e.groupBy("scenario").agg(F.count("*").alias("videos"), F.count_distinct(known).alias("known_participants"), F.sum(cents("value")).alias("total_cents"), F.count_if(F.col("value") >= 2).alias("long_enough"))


@query("""
select user_id, count(*)::bigint as videos, case when count(*) = 1 then 'not_applicable_single_video' else 'unknown' end as cross_video_order_status,
  null::int as cross_video_session_order, case when count(*) = 1 then 'one video' else 'capture order across videos is not recorded' end as note, 'uid|duration' as checked_fields
from events group by user_id""")
def q04_temporal_audit(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("videos"))
    one = F.col("videos") == 1
    return n.select(
        "user_id",
        "videos",
        F.when(one, "not_applicable_single_video").otherwise("unknown").alias("cross_video_order_status"),
        F.lit(None).cast("int").alias("cross_video_session_order"),
        F.when(one, "one video").otherwise("capture order across videos is not recorded").alias("note"),
        F.array_join(F.array(F.lit("uid"), F.lit("duration")), "|").alias("checked_fields"),
    )


@query("""
with e as (select user_id, (epoch_us(ts) // 86400000000)::bigint as day, epoch_us(ts) // 1000000 as s, value from events),
i as (select user_id, day, greatest(s - 600 - day * 86400, 0) as a, least(s + (value * 60)::bigint - day * 86400, 86400) as b from e),
m as (select *, max(b) over (partition by user_id, day order by a, b rows between unbounded preceding and 1 preceding) as p from i where b > a)
select user_id, day, sum(greatest(b - greatest(a, coalesce(p, a)), 0))::bigint as covered from m group by 1, 2""")
def q05_interval_union(spark, sf_dir):
    s = F.floor(micros("ts") / 1000000)
    e = table(spark, sf_dir, "events").select("user_id", F.floor(micros("ts") / 86400000000).alias("day"), s.alias("s"), "value")
    i = e.select("user_id", "day", (F.col("s") - 600 - F.col("day") * 86400).alias("a"), (F.col("s") + F.bround(F.col("value") * 60).cast("bigint") - F.col("day") * 86400).alias("b"), F.lit(0).cast("bigint").alias("low"), F.lit(86400).cast("bigint").alias("high"))
    return intervals.union_length(i, ["user_id", "day"], "a", "b", "low", "high")


@query("""
with l as (select l_orderkey, count(*) filter (where l_returnflag = 'R') as n, count(*) as total from lineitem group by 1)
select o_orderkey, case when o_orderstatus = 'F' and coalesce(n, 0) > 0 then 'measured' when coalesce(n, 0) > 0 then 'measured_flag_mismatch' when o_orderstatus = 'F' then 'missing_intervals' else 'none' end as redaction_status,
  case when coalesce(total, 0) > 0 and o_totalprice > 0 and n > 0 then least(greatest(n::double / total, 0), 1) end as ratio
from orders left join l on o_orderkey = l_orderkey""")
def q06_redaction_status(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("n"), F.count("*").alias("total"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    flag, some = F.col("o_orderstatus") == "F", F.coalesce("n", F.lit(0)) > 0
    status = F.when(flag & some, "measured").when(some, "measured_flag_mismatch").when(flag, "missing_intervals").otherwise("none")
    return o.select("o_orderkey", status.alias("redaction_status"), F.when(F.col("o_totalprice") > 0, c.share("n", "total")).alias("ratio"))


@query("""
select o_orderkey, concat_ws('|', case when o_orderstatus = 'P' then 'unknown_participant' end,
  case when o_totalprice <= 0 then 'invalid_duration' when o_totalprice < 50000 then 'duration_below_min' when o_totalprice > 400000 then 'duration_above_max' end,
  case when o_orderpriority = '5-LOW' then 'audio_required_but_missing' end, case when o_orderdate < timestamp '1995-01-01' then 'scenario_filter_mismatch' end) as reasons,
  o_orderstatus <> 'P' and o_totalprice between 50000 and 400000 and o_totalprice > 0 and o_orderpriority <> '5-LOW' and o_orderdate >= timestamp '1995-01-01' as eligible
from orders""")
def q07_exclusion_reasons(spark, sf_dir):
    p = F.col("o_totalprice")
    why = c.reasons(
        (F.col("o_orderstatus") == "P", "unknown_participant"),
        (p <= 0, "invalid_duration"),
        ((p > 0) & (p < 50000), "duration_below_min"),
        (p > 400000, "duration_above_max"),
        (F.col("o_orderpriority") == "5-LOW", "audio_required_but_missing"),
        (F.col("o_orderdate") < F.expr("timestamp_ntz'1995-01-01 00:00:00'"), "scenario_filter_mismatch"),
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", why.alias("why"))
    return o.select("o_orderkey", F.array_join("why", "|").alias("reasons"), (F.size("why") == 0).alias("eligible"))


@query("""
select user_id, string_agg(event_id::varchar, '|' order by event_id) as kept, count(*)::int as n_kept from (
  select user_id, min(event_id) as event_id from events group by user_id, epoch_us(ts) // 3600000000) group by user_id""")
def q08_greedy_dedup(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.array(F.floor(micros("ts") / 3600000000)).alias("sets"))
    kept = ranking.conflict_free(e, ["user_id"], "event_id", "sets")
    return kept.select("user_id", F.array_join(F.transform("kept", lambda x: x.cast("string")), "|").alias("kept"), F.size("kept").alias("n_kept"))


@query("""
with g as (select c_nationkey, count(*) as n, sum(round(c_acctbal * 100)::bigint) as w from customer group by 1),
t as (select c_nationkey, (row_number() over (order by n desc, w desc, c_nationkey))::int as group_rank from g qualify group_rank <= 5),
r as (select c_nationkey, c_custkey, group_rank, (row_number() over (partition by c_nationkey order by c_custkey))::int as row_rank from customer join t using (c_nationkey) qualify row_rank <= 3)
select *, (row_number() over (order by group_rank, row_rank))::int as global_rank from r""")
def q09_pilot_select(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", cents("c_acctbal").alias("w"))
    return ranking.top_groups(cust, "c_nationkey", "w", "c_custkey", 5, 3).select("c_nationkey", "c_custkey", "group_rank", "row_rank", "global_rank")


@query(_BENCH + ", o as (select user_id, event_id, (row_number() over (partition by user_id order by event_id))::int as k from x where reasons = '') select user_id, count(*)::bigint as videos, sum(round(value * 100)::bigint)::bigint as total_cents, min(k) as first_order, max(k) as last_order, 'EGO4D_P' || lpad(user_id::varchar, 6, '0') as participant_id from o join events using (user_id, event_id) group by user_id")
def q10_manifest_index(spark, sf_dir):
    picked = ranking.numbered(benchmark(spark, sf_dir).where("reasons = ''"), ["user_id"], ["event_id"], "k").select("event_id", "k")
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value").join(picked, "event_id")
    out = e.groupBy("user_id").agg(F.count("*").alias("videos"), F.sum(cents("value")).alias("total_cents"), F.min("k").alias("first_order"), F.max("k").alias("last_order"))
    return out.withColumn("participant_id", c.participant_key(F.col("user_id").cast("string"), F.lit("")))


@query("""
select lang, count(*)::bigint as n, min(n_chars) as min, quantile_cont(n_chars, 0.25) as p25, quantile_cont(n_chars, 0.5) as median, quantile_cont(n_chars, 0.75) as p75, quantile_cont(n_chars, 0.9) as p90, max(n_chars) as max,
  round(avg(n_chars), 6) as mean from documents group by lang""")
def q11_distribution(spark, sf_dir):
    p = F.percentile("n_chars", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.9)))
    d = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"), F.min("n_chars").alias("min"), p.alias("p"), F.max("n_chars").alias("max"), F.round(F.avg("n_chars"), 6).alias("mean"))
    return d.select("lang", "n", "min", *[F.get("p", F.lit(i)).alias(k) for i, k in enumerate(("p25", "median", "p75", "p90"))], "max", "mean")


@query("""
select (select count(*) from events)::bigint as videos, (select count(distinct user_id) from events)::bigint as participants, (select sum(round(value * 100)::bigint) from events)::bigint as total_cents,
  (select count(*) from (select user_id from events group by 1 having count(*) >= 2))::bigint as multi_video_participants, (select quantile_cont(value, 0.5) from events) as median_value,
  (select count(*) from documents)::bigint as documents, (select count(*) from labels where toxic = 1)::bigint as flagged, (select count(*) from conversations)::bigint as turns""")
def q12_global_report(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    one = e.agg(F.count("*").alias("videos"), F.sum(cents("value")).alias("total_cents"), F.percentile("value", F.lit(0.5)).alias("median_value"))
    per = e.groupBy("user_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("participants"), F.count_if(F.col("n") >= 2).alias("multi_video_participants"))
    # each side is a single row
    parts = [per, table(spark, sf_dir, "documents").agg(F.count("*").alias("documents")), table(spark, sf_dir, "labels").agg(F.count_if(F.col("toxic") == 1).alias("flagged")), table(spark, sf_dir, "conversations").agg(F.count("*").alias("turns"))]
    for p in parts:
        one = one.join(F.broadcast(p))
    return one.select("videos", "participants", "total_cents", "multi_video_participants", "median_value", "documents", "flagged", "turns")


_VIDEO = """
select l_orderkey, count(*) filter (where l_returnflag = 'A')::bigint as train, count(*) filter (where l_returnflag = 'N')::bigint as validation, count(*) filter (where l_returnflag = 'R')::bigint as test,
  count(distinct l_partkey)::bigint as nouns, count(distinct l_suppkey)::bigint as verbs, coalesce(sum(round(l_quantity * 100)::bigint) filter (where l_quantity >= 0), 0)::bigint as labelled_cents
from lineitem join orders on l_orderkey = o_orderkey group by 1"""


@query(_VIDEO)
def q13_video_action_profile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_partkey", "l_suppkey", "l_quantity").join(table(spark, sf_dir, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    flag = lambda x: F.count_if(F.col("l_returnflag") == x)
    return lines.groupBy("l_orderkey").agg(
        flag("A").alias("train"),
        flag("N").alias("validation"),
        flag("R").alias("test"),
        F.count_distinct("l_partkey").alias("nouns"),
        F.count_distinct("l_suppkey").alias("verbs"),
        F.coalesce(F.sum(F.when(F.col("l_quantity") >= 0, cents("l_quantity"))), F.lit(0)).alias("labelled_cents"),
    )


@query("""
with o as (select o_custkey, count(*) as videos, sum(round(o_totalprice * 100)::bigint) as total, sum(round(o_totalprice * 100)::bigint) // count(*) as mean, quantile_cont(o_totalprice, 0.5) as median from orders group by 1),
l as (select o_custkey, count(*) as actions, count(distinct l_partkey) as nouns, count(distinct l_suppkey) as verbs from lineitem join orders on l_orderkey = o_orderkey group by 1)
select o_custkey, videos::bigint as videos, total::bigint as total_cents, mean::bigint as mean_cents, median, coalesce(actions, 0)::bigint as actions, coalesce(nouns, 0)::bigint as nouns, coalesce(verbs, 0)::bigint as verbs from o left join l using (o_custkey)""")
def q14_participant_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    per = o.groupBy("o_custkey").agg(F.count("*").alias("videos"), F.sum(cents("o_totalprice")).alias("total_cents"), F.percentile("o_totalprice", F.lit(0.5)).alias("median")).withColumn("mean_cents", F.expr("total_cents div videos"))
    # distinct over the union of a participant's actions, so from the actions, not from per-video counts
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    acts = lines.groupBy("o_custkey").agg(F.count("*").alias("actions"), F.count_distinct("l_partkey").alias("nouns"), F.count_distinct("l_suppkey").alias("verbs"))
    return per.join(acts, "o_custkey", "left").na.fill(0, ["actions", "nouns", "verbs"])


@query("""
select p_type, count(*)::bigint as n, (row_number() over (order by count(*) desc, min(l_orderkey * 100 + l_linenumber)))::int as rank from lineitem join part on l_partkey = p_partkey group by 1""")
def q15_frequency_table(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    x = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("seen")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return ranking.frequencies(x, "p_type", "seen")


@query("""
with v as (select c_nationkey as k, count(*) as videos, round(sum(round(c_acctbal * 100)::bigint) / 360000.0, 2) as hours, count(distinct c_mktsegment) as verbs from customer group by 1),
s as (select *, round(4 * hours + 0.4 * videos + 0.03 * verbs, 3) as score from v where videos >= 8 and hours >= 1.0)
select k::int as nation, videos::bigint as videos, hours, verbs::bigint as verbs, score, (row_number() over (order by score desc, hours desc, videos desc, k))::int as rank from s qualify rank <= 15""")
def q16_score_rank_filter(spark, sf_dir):
    v = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("videos"), F.round(F.sum(cents("c_acctbal")) / 360000.0, 2).alias("hours"), F.count_distinct("c_mktsegment").alias("verbs"))
    s = v.where("videos >= 8 and hours >= 1.0").withColumn("score", F.round(c.linear_score({"hours": 4.0, "videos": 0.4, "verbs": 0.03}), 3))
    order = [F.desc("score"), F.desc("hours"), F.desc("videos"), F.col("nation")]
    return s.withColumn("rank", F.row_number().over(Window.orderBy(*order))).where("rank <= 15")


@query("""
with n as (select l_orderkey, count(*) as actions, sum(l_quantity) as minutes from lineitem group by 1)
select l_orderkey, actions::bigint as actions, minutes, case when minutes between 3 and 60 and actions >= 4 then 'direct_session' when minutes > 120 and actions >= 4 then 'cut_session' when actions >= 2 then 'short_support_session' else 'low_density' end as suggested_use,
  case when minutes between 3 and 60 and actions >= 4 then 0 when minutes > 120 and actions >= 4 then 1 when actions >= 2 then 2 else 3 end as priority_rank
from n where actions > 0 and minutes >= 3""")
def q17_suggested_use(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("actions"), F.sum("l_quantity").alias("minutes")).where("actions > 0 and minutes >= 3")
    many, m = F.col("actions") >= 4, F.col("minutes")
    use = F.when(m.between(3, 60) & many, "direct_session").when((m > 120) & many, "cut_session").when(F.col("actions") >= 2, "short_support_session").otherwise("low_density")
    ranks = {"direct_session": 0, "cut_session": 1, "short_support_session": 2, "low_density": 3}
    return n.withColumn("suggested_use", use).withColumn("priority_rank", c.case_map("suggested_use", ranks, 9))


@query("""
with x as (
  select o_orderkey, coalesce(c_name, '') as c_name, coalesce(c_mktsegment, '') as segment, case when length(o_orderkey::varchar) = 3 then 'extension' else 'base' end as subset,
    case when o_orderstatus = 'F' then 'train' when o_orderstatus = 'O' then 'validation' when o_orderstatus = 'P' then 'test' else 'unknown' end as split,
    case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2 when '4-NOT SPECIFIED' then 3 else 9 end as use_rank
  from orders left join customer on o_custkey = c_custkey and c_acctbal > 0 where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW'))
select *, (row_number() over (order by use_rank, split, o_orderkey))::int as priority from x""")
def q18_manifest_priority(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    o = table(spark, sf_dir, "orders").where(c.listed("o_orderpriority", c.parse_list("1-URGENT, 2-HIGH, 5-LOW"))).join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
    x = o.select(
        "o_orderkey",
        F.coalesce("c_name", F.lit("")).alias("c_name"),
        F.coalesce("c_mktsegment", F.lit("")).alias("segment"),
        F.when(F.length(F.col("o_orderkey").cast("string")) == 3, "extension").otherwise("base").alias("subset"),
        c.case_map("o_orderstatus", {"F": "train", "O": "validation", "P": "test"}, "unknown").alias("split"),
        c.case_map("o_orderpriority", {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2, "4-NOT SPECIFIED": 3}, 9).alias("use_rank"),
    )
    first = ranking.ranked(x, [F.col("use_rank"), F.col("split"), F.col("o_orderkey")], "priority").withColumn("priority", F.col("priority").cast("int"))
    return first.select("o_orderkey", "c_name", "segment", "subset", "split", "use_rank", "priority")


@query("""
with g as (select o_orderstatus, count(*) as videos, sum(round(o_totalprice * 100)::bigint) as cents from orders group by 1)
select o_orderstatus, metric, amount::bigint as amount, round(100.0 * amount / sum(amount) over (partition by metric), 6) as percent from (
  select o_orderstatus, unnest(['videos', 'cents']) as metric, unnest([videos::bigint, cents::bigint]) as amount from g)""")
def q19_source_composition(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("videos"), F.sum(cents("o_totalprice")).alias("cents"))
    long = g.unpivot("o_orderstatus", ["videos", "cents"], "metric", "amount")
    return long.withColumn("percent", F.round(F.lit(100.0) * F.col("amount") / F.sum("amount").over(Window.partitionBy("metric")), 6))


@query("""
select p_brand, count(*)::bigint as n, sum(round(l_extendedprice * 100)::bigint)::bigint as cents, (row_number() over (order by count(*) desc, p_brand))::int as rank from lineitem left join part on l_partkey = p_partkey group by 1 qualify rank <= 12""")
def q20_topk_with_lookup(spark, sf_dir):
    # aggregated by key before the lookup, so the label joins to keys, not to actions
    n = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.sum(cents("l_extendedprice")).alias("cents"))
    x = n.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left").groupBy("p_brand").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents"))
    top = x.orderBy(F.desc("n"), "p_brand").limit(12)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "p_brand")))


@query("select floor(l_quantity / 3)::bigint as bin, count(*)::bigint as n, (floor(l_quantity / 3) * 3)::bigint as low from lineitem where l_quantity >= 0 and l_quantity < 63 group by 1, 3")
def q21_histogram(spark, sf_dir):
    b = F.floor(F.col("l_quantity") / 3)
    return table(spark, sf_dir, "lineitem").where("l_quantity >= 0 and l_quantity < 63").groupBy(b.alias("bin")).agg(F.count("*").alias("n")).withColumn("low", F.col("bin") * 3)
