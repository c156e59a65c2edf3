"""Queries on nested records: walks, validation across levels, references by element, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import levels, nested, requests, rules
from .catalog import query
from .tables import joined, table


@query("""
select k, ['high', 'medium', 'low', 'null', '0.5'][((k + level) % 5 + 1)::int] as value, count(*)::bigint as n
from (select o_orderkey::bigint as k, unnest(generate_series(0, o_orderkey % 6)) as level from orders) group by 1, 2""")
def q73_confidence_walk(spark, sf_dir):
    """Orders as records nested one to six deep, in members and in elements, with a confidence on each level: how often each is given."""
    k = F.col("o_orderkey").cast("bigint")
    value = lambda level: F.get(F.array(*[F.lit(x) for x in ('"high"', '"medium"', '"low"', "null", "0.5")]), ((k + level) % 5).cast("int"))
    text = F.concat(F.lit('{"confidence": '), value(0), F.lit("}"))
    deep = text
    for level in range(1, 6):
        inner = F.concat(F.lit('[1, {"deeper": '), deep, F.lit("}]")) if level % 2 else deep
        deep = F.when(k % 6 >= level, F.concat(F.lit('{"note": "confidence", "confidence": '), value(level), F.lit(', "child": '), inner, F.lit("}"))).otherwise(deep)
    records = table(spark, sf_dir, "orders").select(k.alias("k"), F.parse_json(deep).alias("record"))
    return nested.distribution(records, ["k"], "record", "confidence")


def _when(cond: str, yes: str, no: str = "''") -> str:
    return f"case when {cond} then {yes} else {no} end"


#: JSON of a window (clips are the lines of an order) as SQL over k; what is wrong with it follows from k.
_WINDOW = " || ".join([
    "'{\"window_id\": \"' || " + _when("k % 31 = 0", "'x'", "cast(k as string)"), "'\", \"source_video_id\": \"v\", \"time_range\": {}, '",
    _when("k % 13 <> 0", "'\"window_summary\": \"s\", '"),
    "'\"entity_map\": [{\"entity_id\": \"e0\", \"confidence\": \"' || " + _when("k % 11 = 0", "'sure'", "'low'"),
    "'\", \"supporting_clip_ids\": [' || array_join(transform(sequence(1, 1 + cast(k % 7 as int)), i -> '\"' || i || '\"'), ',') || ']}, {\"entity_id\": \"' || " + _when("k % 17 = 0", "'e0'", "'e1'") + " || '\"}], '",
    "'\"local_event_chain\": [{\"event_id\": \"ev0\", \"entity_ids\": [\"e0\", \"' || " + _when("k % 5 = 0", "'e9'", "''") + " || '\"]}], '",
    "'\"state_changes\": [{\"entity_id\": \"e0\", \"supporting_event_ids\": [\"ev0\", \"' || " + _when("k % 6 = 0", "'ev9'", "''") + " || '\"]}], '",
    "'\"window_end_state\": ' || " + _when("k % 19 = 0", "'\"none\"'", "'[]'"),
    "', \"open_threads\": ' || " + _when("k % 37 = 0", "'[{}, {}, {}, {}, {}]'", _when("k % 23 = 0", "'[\"text\"]'", "'[]'")),
    "', \"evidence_facts\": [{\"fact_id\": \"' || " + _when("k % 29 = 0", "''", "'f0'") + " || '\"}], '",
    "'\"conflicts_or_uncertainties\": [{\"affected_fact_ids\": [\"f0\", \"' || " + _when("k % 8 = 0", "'f9'", "''") + " || '\"]}]}'",
])


@query("""
with o as (select o_orderkey::bigint as k, count(l_orderkey) as lines, list(l_linenumber) as have from orders left join lineitem on l_orderkey = o_orderkey group by 1),
x as (select * from o where k % 41 <> 0 and k % 43 <> 0)
select code, severity, sum(n)::bigint as n from (
  select 'missing_parent_metadata' as code, 'blocking' as severity, count(*) as n from o where k % 41 = 0 and k % 43 <> 0
  union all select 'missing_model_output', 'blocking', count(*) from o where k % 43 = 0 and k % 41 <> 0
  union all select 'identity_field_normalized', 'warning', count(*) from x where k % 31 = 0
  union all select 'missing_required_field', 'blocking', count(*) from x where k % 13 = 0
  union all select 'invalid_confidence', 'blocking', count(*) from x where k % 11 = 0
  union all select 'unknown_clip_reference', 'warning', count(*) from (select k, have, unnest(generate_series(1, 1 + k % 7)) as clip from x) where not list_contains(have, clip)
  union all select 'duplicate_local_id', 'blocking', count(*) from x where k % 17 = 0
  union all select 'unknown_entity_reference', 'warning', count(*) from x where k % 5 = 0
  union all select 'unknown_event_reference', 'warning', count(*) from x where k % 6 = 0
  union all select 'invalid_field_type', 'blocking', count(*) from x where k % 19 = 0
  union all select 'count_limit_exceeded', 'warning', count(*) from x where k % 37 = 0
  union all select 'invalid_item', 'blocking', count(*) from x where k % 23 = 0 and k % 37 <> 0
  union all select 'missing_local_id', 'blocking', count(*) from x where k % 29 = 0
  union all select 'unknown_fact_reference', 'warning', count(*) filter (where k % 29 = 0) + count(*) filter (where k % 8 = 0) from x) group by 1, 2 having sum(n) > 0""")
def q74_validate_windows(spark, sf_dir):
    """Orders as windows, their lines as clips: every issue a window can have, by code."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("bigint").alias("k")).agg(F.collect_list(F.col("l_linenumber").cast("string")).alias("micro_clip_ids"))
    parent = F.struct(F.col("k").cast("string").alias("window_id"), F.lit("v").alias("source_video_id"), F.coalesce("micro_clip_ids", F.array().cast("array<string>")).alias("micro_clip_ids"))
    parents = orders.join(lines, "k", "left").where("k % 41 <> 0").select(F.col("k").alias("record_id"), F.parse_json(F.to_json(parent)).alias("parent"))
    records = orders.where("k % 43 <> 0").select(F.col("k").alias("record_id"), F.parse_json(F.expr(_WINDOW)).alias("record"))
    log = rules.issue_log(levels.validate("window", records, parents), "window")
    return log.groupBy("code", "severity").agg(F.count("*").alias("n"))


_SESSION = " || ".join([
    "'{\"session_id\": \"' || k || '\", \"source_video_id\": \"v\", \"participant_id\": \"p\", \"time_range\": {}, \"session_summary\": \"s\", \"session_timeline\": [], '",
    "'\"session_entities\": [{\"entity_id\": \"e0\"}], \"state_update_timeline\": [{\"entity_id\": \"' || " + _when("k % 4 = 0", "'e8'", "'e0'") + " || '\"}], '",
    "'\"session_final_state\": [], \"open_tasks_or_unresolved_states\": [], '",
    "'\"cross_session_evidence_candidates\": [{\"candidate_id\": \"q0\", \"type\": \"stable_layout\", \"confidence\": \"high\", \"claim\": \"' || " + _when("k % 7 = 0", "'the pan is always here'", "'the pan is here'"),
    "'\", \"supporting_window_ids\": [\"w1\", \"w' || (k % 30) || '\"], \"entity_ids\": [\"e0\", \"' || " + _when("k % 9 = 0", "'e9'", "''") + " || '\"]}], '",
    "'\"contradictions_or_uncertainties\": ' || " + _when("k % 5 = 0", "'[{\"affected_candidate_ids\": [\"q0\"]}]'", _when("k % 5 = 1", "'[{\"affected_candidate_ids\": [\"q9\"]}]'", "'[]'")) + " || '}'",
])


@query("""
with c as (select c_custkey::bigint as k, count(o_orderkey) as have from customer left join orders on o_custkey = c_custkey group by 1),
x as (select *, (have < 1)::int + (k % 30 < 1 or k % 30 > have)::int as windows from c)
select code, severity, sum(n)::bigint as n from (
  select 'unknown_window_reference' as code, 'candidate_blocking' as severity, sum(windows) as n from x
  union all select 'unknown_entity_reference', 'warning', count(*) from x where k % 4 = 0
  union all select 'unknown_entity_reference', 'candidate_blocking', count(*) from x where k % 9 = 0
  union all select 'unknown_candidate_reference', 'warning', count(*) from x where k % 5 = 1
  union all select 'long_term_overclaim', 'warning', count(*) from x where k % 7 = 0
  union all select 'affected_by_uncertainty', 'warning', count(*) from x where k % 5 = 0
  union all select 'single_window_support', 'warning', count(*) from x where k % 30 = 1
  union all select case when windows > 0 or k % 9 = 0 then 'schema_failed' else 'schema_passed' end, case when k % 5 = 0 then 'medium' else 'high' end, count(*) from x group by 1, 2
  ) group by 1, 2 having sum(n) > 0""")
def q75_validate_sessions(spark, sf_dir):
    """Customers as sessions, their orders as windows: every issue of references and candidates by code, and the candidates' status by confidence."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("k"))
    have = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("bigint").alias("k")).agg(F.count("*").alias("n"))
    windows = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1).cast("bigint"), "n"), lambda i: F.concat(F.lit("w"), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    parent = F.struct(F.col("k").cast("string").alias("session_id"), F.lit("v").alias("source_video_id"), F.lit("p").alias("participant_id"), windows.alias("window_ids"))
    parents = cust.join(have, "k", "left").select(F.col("k").alias("record_id"), F.parse_json(F.to_json(parent)).alias("parent"))
    records = cust.select(F.col("k").alias("record_id"), F.parse_json(F.expr(_SESSION)).alias("record"))
    checked = levels.validate("session", records, parents)
    said = rules.issue_log(checked, "session").select("code", "severity")
    states = checked.select(F.explode("candidates").alias("c")).select(F.col("c.qc_status").alias("code"), F.col("c.normalized_confidence").alias("severity"))
    return said.unionByName(states).groupBy("code", "severity").agg(F.count("*").alias("n"))


@query("""
select o_custkey, case when count(distinct o_orderstatus) = 1 then '"' || min(o_orderstatus) || '"' else '["' || string_agg(distinct o_orderstatus, '","' order by o_orderstatus) || '"]' end as statuses from orders group by 1""")
def q76_scalar_or_list(spark, sf_dir):
    """The statuses of a customer's orders: one as it is, several as a list."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(nested.scalar_or_list("o_orderstatus").alias("v")).select("o_custkey", F.to_json("v").alias("statuses"))


@query("""
with s as (select s_suppkey, s_suppkey % 3 as source, case when s_suppkey % 10 <> 0 then 'u' || s_suppkey end as url from supplier),
i as (select o_orderkey, o_custkey % 3 as source, l_linenumber, case when l_linenumber = 7 then -l_suppkey else l_suppkey end as suppkey from orders left join lineitem on l_orderkey = o_orderkey),
j as (select o_orderkey, l_linenumber, i.suppkey, s.url, case when i.suppkey is null then null when s.s_suppkey is null then 'missing_target' when s.source <> i.source then 'other_source' when s.url is null then 'no_url' end as code
  from i left join s on s.s_suppkey = i.suppkey)
select o_orderkey, 'whole' as code, count(suppkey)::bigint as n, coalesce(string_agg(url, '|' order by l_linenumber, suppkey), '') as urls from j group by 1 having count(code) = 0
union all select o_orderkey, code, count(*), '' from j where code is not null group by 1, 2""")
def q77_element_lookup(spark, sf_dir):
    """The suppliers of an order's lines, looked up by element: addresses in the order of the lines, or what is wrong."""
    lines = table(spark, sf_dir, "lineitem")
    supplier = F.when(F.col("l_linenumber") == 7, -F.col("l_suppkey")).otherwise(F.col("l_suppkey")).cast("bigint")
    ids = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", supplier.alias("s")))).alias("a")).select("o_orderkey", F.transform("a", lambda x: x["s"]).alias("ids"))
    items = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("source")).join(ids, "o_orderkey", "left")
    k = F.col("s_suppkey").cast("bigint")
    targets = table(spark, sf_dir, "supplier").select(k.alias("suppkey"), (k % 3).alias("target_source"), F.when(k % 10 != 0, F.concat(F.lit("u"), k.cast("string"))).alias("url"))
    whole, bad = requests.resolved(items, "o_orderkey", "ids", targets, "suppkey", "url", "source", "target_source", "url")
    a = whole.select("o_orderkey", F.lit("whole").alias("code"), F.size("ids").cast("bigint").alias("n"), joined(F.col("ids")).alias("urls"))
    return a.unionByName(bad.groupBy("o_orderkey", "code").agg(F.count("*").alias("n")).withColumn("urls", F.lit("")))


@query("""
with i as (select o_custkey, count(*) as n from orders group by 1)
select c_custkey, case when n is null then 'missing_input' when n > 12 and (n_name is null or c_nationkey % 4 = 0) then 'missing_proxy' end as code
from customer left join i on o_custkey = c_custkey left join nation on n_nationkey = c_nationkey""")
def q78_session_requests(spark, sf_dir):
    """Customers as sessions, their orders as inputs (required), nations as proxies (required for sessions of many inputs)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    inputs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    proxies = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, " ").otherwise(F.col("n_name")).alias("proxy"))
    return requests.session_requests(cust, inputs, proxies, "c_custkey", "n_nationkey", "proxy", F.col("n") > 12).select("c_custkey", "code")


@query("""
with last as (select user_id, event_type from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
select c_custkey, case when user_id is null then 'missing_status' else 'not_ok' end as code from customer left join last on user_id = c_custkey where user_id is null or event_type <> 'view'""")
def q79_unfinished(spark, sf_dir):
    """Customers whose latest event isn't a view, or who have none."""
    manifest = table(spark, sf_dir, "customer").select("c_custkey")
    statuses = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "ts", "event_id", "event_type")
    return requests.unfinished(manifest, statuses, ["c_custkey"], ["ts", "event_id"], "event_type", "view")
