"""Windows, joins and state: evidence assembly, coverage, upserts, texts and time."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import columns as c
from ..operators import constraints, intervals, ranking
from .catalog import query
from .tables import cents, joined, micros, table


@query("""
with k as (select doc_id, n_chars::double as d, case when n_chars <= 0 then 0 when n_chars < 300 then 1 when n_chars % 300 < 60 then n_chars // 300 else n_chars // 300 + 1 end as k from documents)
select doc_id, i::int as index, (i * 300)::double as start_sec, case when i = k - 1 then d else (i + 1) * 300 end::double as end_sec from (select *, unnest(range(k)) as i from k)""")
def q22_split_sequence(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(intervals.pieces(F.col("n_chars").cast("double"), 300.0, 60.0)).alias("p"))
    return d.select("doc_id", "p.index", "p.start_sec", "p.end_sec")


_WINDOWS = """
with e as (select user_id, epoch_us(ts) // 86400000000 as day, epoch_us(ts) // 1000000 % 86400 as s, event_id, event_type from events),
w as (select user_id, day::bigint as day, (s // 7200)::bigint as w, min(s)::bigint as start_sec, max(s + 30)::bigint as end_sec, string_agg(event_id::varchar, '|' order by s, event_id) as clip_ids, count(*)::int as clips,
  arg_min(event_type, (s, event_id)) as first_type from e group by 1, 2, 3)
"""


def windows(spark, sf_dir):
    """Clips of a user's day in windows of two hours by their start, in order."""
    sec = F.floor(micros("ts") / 1000000)
    e = table(spark, sf_dir, "events").select("user_id", F.floor(micros("ts") / 86400000000).alias("day"), (sec % 86400).alias("s"), "event_id", "event_type")
    g = e.groupBy("user_id", "day", F.floor(F.col("s") / 7200).alias("w"))
    clips = F.sort_array(F.collect_list(F.struct("s", "event_id")))
    return g.agg(F.min("s").alias("start_sec"), F.max(F.col("s") + 30).alias("end_sec"), joined(F.transform(clips, lambda x: x["event_id"])).alias("clip_ids"), F.count("*").cast("int").alias("clips"), F.min_by("event_type", F.struct("s", "event_id")).alias("first_type"))


@query(_WINDOWS + "select user_id, day, user_id || '_w' || lpad(w::varchar, 3, '0') as window_id, start_sec, end_sec, clip_ids, clips, first_type from w")
def q23_window_build(spark, sf_dir):
    w = windows(spark, sf_dir)
    return w.select("user_id", "day", c.numbered(F.col("user_id").cast("string"), "w", "w").alias("window_id"), "start_sec", "end_sec", "clip_ids", "clips", "first_type")


@query(_WINDOWS + "select user_id, day, min(start_sec) as start_sec, max(end_sec) as end_sec, string_agg(w::varchar || ':' || start_sec || '-' || end_sec, ';' order by w) as window_ranges, count(*)::int as windows, sum(clips)::bigint as clips from w group by 1, 2")
def q24_session_build(spark, sf_dir):
    w = windows(spark, sf_dir)
    ranges = F.sort_array(F.collect_list(F.struct("w", F.concat_ws("", "w", F.lit(":"), "start_sec", F.lit("-"), "end_sec").alias("t"))))
    return w.groupBy("user_id", "day").agg(F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), F.array_join(F.transform(ranges, lambda x: x["t"]), ";").alias("window_ranges"), F.count("*").cast("int").alias("windows"), F.sum("clips").alias("clips"))


@query("select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as i, count(*) over (partition by user_id) as n from events) where i = n // 2 + 1")
def q25_midpoint(spark, sf_dir):
    return ranking.midpoint(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


@query("select c_custkey, c_mktsegment, ((row_number() over (partition by c_mktsegment order by c_custkey) - 1) % 4)::int as shard from customer")
def q26_shard_assign(spark, sf_dir):
    x = ranking.numbered(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], ["c_custkey"], "i")
    return x.select("c_custkey", "c_mktsegment", F.pmod(F.col("i") - 1, F.lit(4)).alias("shard"))


@query("""
with e as (select user_id, list(event_id order by event_id) as ids from events group by 1)
select user_id, case when len(ids) <= 5 then array_to_string(ids, '|') else array_to_string([ids[round_even(i * (len(ids) - 1)::double / 4, 0)::int + 1] for i in range(5)], '|') end as sample from e""")
def q27_uniform_sample(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_list("event_id")).alias("ids"))
    return e.select("user_id", joined(intervals.uniform_sample(F.col("ids"), 5)).alias("sample"))


@query("""
with e as (select user_id, event_id, epoch_us(ts) // 1000000 as a, epoch_us(ts) // 1000000 + ceil(value * 60)::bigint as b from events where value > 0),
x as (select user_id, event_id, unnest(generate_series(a // 1800, (b + 1799) // 1800 - 1)) as cell from e)
select user_id, cell::bigint as cell, string_agg(event_id::varchar, '|' order by event_id) as candidate_ids, count(*)::bigint as n from x group by 1, 2""")
def q28_grid_cover(spark, sf_dir):
    a = F.floor(micros("ts") / 1000000)
    e = table(spark, sf_dir, "events").where("value > 0").select("user_id", "event_id", F.array(F.struct(a.alias("start_sec"), (a + F.ceil(F.col("value") * 60)).alias("end_sec"))).alias("r"))
    x = e.select("user_id", "event_id", F.explode(intervals.grid_cells(F.col("r"), 1800)).alias("cell"))
    return x.groupBy("user_id", "cell").agg(joined(F.sort_array(F.collect_set("event_id"))).alias("candidate_ids"), F.count("*").alias("n"))


@query("""
with x as (select doc_id, n_chars::double as d, (n_chars // 1000) * 1000.0::double as s from documents)
select doc_id, case when d > 0 and least(s + 1000, d) - s < 400 then greatest(0, least(s + 1000, d) - 1000) else s end::double as start_sec, case when d > 0 then least(s + 1000, d) else s + 1000 end::double as end_sec from x""")
def q29_tail_shift(spark, sf_dir):
    d = F.col("n_chars").cast("double")
    b = intervals.review_bounds(F.floor(d / 1000), 1000.0, 400.0, d)
    return table(spark, sf_dir, "documents").select("doc_id", b.alias("b")).select("doc_id", "b.start_sec", "b.end_sec")


@query("""
with e as (select event_id, user_id, event_type, epoch_us(ts) // 1000000 as a, epoch_us(ts) // 1000000 + (value * 60)::bigint as b from events)
select event_id, user_id from e x where event_type = 'click' and exists (select 1 from e y where y.user_id = x.user_id and y.event_type = 'error' and y.b > y.a and x.b > x.a and greatest(x.a, y.a) < least(x.b, y.b))""")
def q30_overlap_semi(spark, sf_dir):
    a = F.floor(micros("ts") / 1000000)
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", a.alias("a"), (a + F.bround(F.col("value") * 60).cast("bigint")).alias("b"))
    click, error = (e.where(F.col("event_type") == t).select("event_id", "user_id", "a", "b") for t in ("click", "error"))
    return intervals.overlap_join(click, error.select("user_id", "a", "b"), ["user_id"], "a", "b", 3600.0, "left_semi").select("event_id", "user_id")


@query("""
select coalesce(d.doc_id, l.doc_id) as doc_id, case when l.doc_id is null then 'missing_model_output' when d.doc_id is null then 'missing_parent_metadata' else 'matched' end as code, l.doc_id is null or d.doc_id is null as blocking
from documents d full join labels l on d.doc_id = l.doc_id""")
def q31_coverage_full_outer(spark, sf_dir):
    return constraints.coverage(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "missing_model_output", "missing_parent_metadata")


@query("""
with o as (select year(o_orderdate) as y, o_orderkey as k from orders), l as (select distinct year(o_orderdate) as y, l_orderkey as k from lineitem join orders on o_orderkey = l_orderkey),
j as (select coalesce(o.y, l.y) as y, o.k as a, l.k as b from o full join l on o.k = l.k and o.y = l.y)
select y::int as year, count(*) filter (where b is null)::bigint as only_left, count(*) filter (where a is null)::bigint as only_right, count(*) filter (where a is null or b is null) = 0 as equal,
  coalesce(array_to_string(list_slice(list(coalesce(a, b) order by coalesce(a, b)) filter (where a is null or b is null), 1, 10), '|'), '') as examples from j group by 1""")
def q32_set_equality(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("k"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")).distinct().join(o, "k").select("year", "k")  # noqa: E741
    return constraints.set_difference(o, l, ["year"], "k", examples=10)


@query("select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def q33_resume_anti(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("select distinct o_custkey from (select o_custkey from orders where o_orderstatus = 'F' intersect select o_custkey from orders where o_orderstatus = 'O')")
def q34_completed_intersect(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("f"), F.bool_or(F.col("o_orderstatus") == "O").alias("o"))
    return o.where("f and o").select("o_custkey")


@query("select user_id, event_id, event_type, epoch_us(ts)::bigint as at from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def q35_latest_status(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", micros("ts").alias("at"))
    return ranking.latest(e, ["user_id"], ["at", "event_id"])


@query("""
with b as (select o_custkey as k, o_orderkey as v, o_orderstatus as s, row_number() over (partition by o_custkey order by o_orderkey desc) as r, o_orderdate from orders),
old as (select k, v, s from (select *, row_number() over (partition by k order by v desc) as q from b where o_orderdate < timestamp '1997-01-01') where q = 1),
new as (select k, v, s from (select *, row_number() over (partition by k order by v desc) as q from b where o_orderdate >= timestamp '1997-01-01') where q = 1)
select * from new union all select * from old where k not in (select k from new)""")
def q36_upsert_snapshot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderstatus").alias("s"), "o_orderdate")
    cut = F.expr("timestamp_ntz'1997-01-01 00:00:00'")
    old, new = (ranking.latest(o.where(w).drop("o_orderdate"), ["k"], ["v"]) for w in (F.col("o_orderdate") < cut, F.col("o_orderdate") >= cut))
    return constraints.upsert(old, new, ["k"]).select("k", "v", "s")


@query("select event_id, json_extract(props, '$.k')::bigint as k, json_valid(props) as valid from events")
def q37_json_props(spark, sf_dir):
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), v.isNotNull().alias("valid"))


_ANSWER = "case doc_id % 4 when 0 then 'Here:' || chr(10) || '```json' || chr(10) || '{\"id\": ' || doc_id || '}' || chr(10) || '```' when 1 then '{\"id\": ' || doc_id || '}' when 2 then 'so {\"id\": ' || doc_id || '} it is' else 'none' end"


@query(f"""
with x as (select doc_id, {_ANSWER} as t from documents),
j as (select doc_id, case when t like '%```%' then trim(regexp_extract(t, '(?s)```json(.*?)```', 1), ' ' || chr(10)) when t like '{{%}}' then t when t like '%{{%}}%' then regexp_extract(t, '(?s)(\\{{.*\\}})', 1) end as j from x)
select doc_id, j as json_text, json_extract(j, '$.id')::bigint as id, case when j is null then 'no_json_object' else 'ok' end as status from j""")
def q38_llm_json_extract(spark, sf_dir):
    x = table(spark, sf_dir, "documents").select("doc_id", F.expr(_ANSWER.replace("chr(10)", "char(10)")).alias("t"))
    j = x.select("doc_id", c.json_block("t").alias("json_text"))
    return j.select("doc_id", "json_text", F.try_variant_get(F.try_parse_json("json_text"), "$.id", "bigint").alias("id"), F.when(F.col("json_text").isNull(), "no_json_object").otherwise("ok").alias("status"))


@query("select page_id, regexp_extract(path, '([^/]*)$', 1) as stem, path from (select page_id, regexp_replace(regexp_extract(url, '^([^?#]*)', 1), '^https?://[^/]*', '') as path from pages)")
def q39_url_stem(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", c.url_path("url").alias("path"))
    return p.select("page_id", c.file_name("path").alias("stem"), "path")


@query("""
select event_id, (epoch_us(ts) // 1000000 % 86400)::double as clock, (epoch_us(ts) // 1000000 % 3600)::double as relative, null::double as bad from events""")
def q40_time_parse(spark, sf_dir):
    s = F.floor(micros("ts") / 1000000) % 86400
    clock = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    relative = F.format_string("%d:%02d", F.floor(s / 60) % 60, s % 60)
    return table(spark, sf_dir, "events").select("event_id", c.clock_seconds(clock).alias("clock"), c.relative_seconds(relative).alias("relative"), c.relative_seconds(F.lit("1:75")).alias("bad"))


_ISSUES = """
with d as (select d.doc_id, text, lang, n_chars, l.quality, l.toxic from documents d left join labels l using (doc_id)),
i as (
  select doc_id, unnest(list_filter([
    case when quality is null then 'missing_required_field' end, case when n_chars > 10000 then 'count_limit_exceeded' end, case when n_chars < 20 then 'zero_duration_range' end,
    case when toxic = 1 then 'invalid_confidence' end, case when lang not in ('en', 'de') then 'inconsistent_object_category' end], lambda x: x is not null)) as code from d)
"""


@query(_ISSUES + "select code, case when code in ('missing_required_field', 'invalid_confidence') then 'blocking' else 'warning' end as severity, count(*)::bigint as n, min(doc_id) as first_doc from i group by 1, 2")
def q41_issue_catalogue(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    rules = [
        constraints.Check("missing_required_field", "blocking", F.col("quality").isNull()),
        constraints.Check("count_limit_exceeded", "warning", F.col("n_chars") > 10000),
        constraints.Check("zero_duration_range", "warning", F.col("n_chars") < 20),
        constraints.Check("invalid_confidence", "blocking", F.col("toxic") == 1),
        constraints.Check("inconsistent_object_category", "warning", ~F.col("lang").isin("en", "de")),
    ]
    return constraints.issues(d, ["doc_id"], rules).groupBy("code", "severity").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("""
with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem)
select 'duplicate_local_id' as code, l_orderkey as k, count(*)::bigint as n from x group by l_orderkey, l_linenumber having count(*) > 1
union all select 'unknown_object_reference', l_partkey, count(*)::bigint from x where l_partkey not in (select p_partkey from part where p_size > 2) group by 2
union all select 'unknown_entity_reference', l_suppkey, count(*)::bigint from x where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0) group by 2""")
def q42_ref_integrity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dup = constraints.duplicates(lines, ["l_orderkey", "l_linenumber"]).select(F.lit("duplicate_local_id").alias("code"), F.col("l_orderkey").alias("k"), "n")
    part = table(spark, sf_dir, "part").where("p_size > 2").select(F.col("p_partkey").alias("k"))
    supp = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("k"))
    out = dup
    for code, col, known in (("unknown_object_reference", "l_partkey", part), ("unknown_entity_reference", "l_suppkey", supp)):
        out = out.unionByName(constraints.unknown_references(lines, col, known, "k").select(F.lit(code).alias("code"), "k", "n"))
    return out


@query("select source, string_agg(q || ':' || n, '|' order by q) as distribution, sum(n)::bigint as labelled from (select source, quality as q, count(*) as n from documents join labels using (doc_id) group by 1, 2) group by 1")
def q43_confidence_dist(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    n = d.groupBy("source", "quality").agg(F.count("*").alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct("quality", "n")))
    return n.groupBy("source").agg(F.array_join(F.transform(pairs, lambda p: F.concat_ws(":", p["quality"], p["n"])), "|").alias("distribution"), F.sum("n").alias("labelled"))


@query("select doc_id, sha256(to_json({doc_id: doc_id, lang: lang, n_chars: n_chars, source: source})) as fingerprint from documents")
def q48_fingerprint(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.sha2(F.to_json(F.struct("doc_id", "lang", "n_chars", "source"), {"ignoreNullFields": "false"}), 256).alias("fingerprint"))


@query("""
select c_custkey, trim(lower(regexp_replace(c_name, '[^A-Za-z0-9_.-]+', '_', 'g')), '_.-') as slug, 'EGO4D_P' || lpad(c_custkey::varchar, 6, '0') as by_number,
  'EGO4D_P_' || trim(regexp_replace(c_name, '[^A-Za-z0-9]+', '_', 'g'), '_') as by_name, case when c_custkey < 100 then 'P' || lpad(c_custkey::varchar, 2, '0') else 'P' || c_custkey end as canonical from customer""")
def q49_slug_normalise(spark, sf_dir):
    k = F.col("c_custkey").cast("string")
    return table(spark, sf_dir, "customer").select("c_custkey", c.slug("c_name").alias("slug"), c.participant_key(k, k).alias("by_number"), c.participant_key("c_name", k).alias("by_name"), c.canonical_participant(F.concat(F.lit("p"), k)).alias("canonical"))


@query("select event_id, user_id, (count(*) over (partition by user_id order by epoch_us(ts) range between 3600000000 preceding and current row))::bigint as in_last_hour from events")
def q50_rolling_rate(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", micros("ts").alias("t"))
    w = Window.partitionBy("user_id").orderBy("t").rangeBetween(-3_600_000_000, Window.currentRow)
    return e.select("event_id", "user_id", F.count("*").over(w).alias("in_last_hour"))


@query("select event_type, (epoch_us(ts) // 86400000000)::bigint as day, count(*)::bigint as n, sum(round(value * 100)::bigint)::bigint as cents from events group by 1, 2")
def q51_tumbling(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type", F.floor(micros("ts") / 86400000000).alias("day")).agg(F.count("*").alias("n"), F.sum(cents("value")).alias("cents"))


@query("""
with e as (select user_id, epoch_us(ts) as t, event_id from events),
g as (select *, case when t - lag(t) over (partition by user_id order by t, event_id) < 43200000000 then 0 else 1 end as new from e),
s as (select *, sum(new) over (partition by user_id order by t, event_id) as k from g)
select user_id, min(t)::bigint as start_us, max(t)::bigint as last_us, count(*)::bigint as n from s group by user_id, k""")
def q52_session(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", micros("ts").alias("t"))
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    new = F.when(F.col("t") - F.lag("t").over(w) < 43_200_000_000, 0).otherwise(1)
    s = e.withColumn("new", new).withColumn("k", F.sum("new").over(w))
    return s.groupBy("user_id", "k").agg(F.min("t").alias("start_us"), F.max("t").alias("last_us"), F.count("*").alias("n")).drop("k")
