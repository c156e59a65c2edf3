"""Queries that write tables of their own and read them back: published sets, numbered lines, orders over all rows, conflict-free choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import ranking
from ..sources import io, lines
from ..sources.publication import Incomplete, PublishedSet
from ..sources.workspace import folder
from .catalog import query
from .tables import table

_MERGED = """
with m as (select doc_id, l.quality, case when l.quality = 0 then 'queue' else '' end as next from documents left join labels l using (doc_id)),
part as (select * from m where quality is not null)
"""


@query(_MERGED + """
select 'first' as state, 'merged' as name, count(*)::bigint as n, coalesce(sum(doc_id), 0)::bigint as ids from part
union all select 'first', 'queue', count(*), coalesce(sum(doc_id), 0) from part where next = 'queue'
union all select 'refused', 'merged', count(*), coalesce(sum(doc_id), 0) from part
union all select 'refused', 'queue', 0, 0
union all select 'refused', 'retry_queue', count(*), coalesce(sum(doc_id), 0) from m where quality is null
union all select 'whole', 'merged', count(*), coalesce(sum(doc_id), 0) from m
union all select 'whole', 'queue', count(*), coalesce(sum(doc_id), 0) from m where next = 'queue'
union all select 'whole', 'retry_queue', 0, 0""")
def q63_published_set(spark, sf_dir):
    """Documents with what labels say of them, published three times: the labelled ones; all, where those without an answer have to be asked again and
    nothing but the queues changes; all again, with the answers that came. What readers saw after each."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    merged = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").withColumn("next", F.when(F.col("quality") == 0, "queue").otherwise(""))
    out = PublishedSet(spark, folder(spark))
    seen = []

    def look(state):
        for name in ("merged", "queue", "retry_queue"):
            if name in out.tables:
                seen.append(out.read(name).agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_id"), F.lit(0)).cast("bigint").alias("ids")).select(F.lit(state).alias("state"), F.lit(name).alias("name"), "n", "ids"))

    def publish(rows, retry):
        out.publish({"merged": rows, "queue": rows.where("next = 'queue'")}, retry, emptied=["queue"])

    publish(merged.where("quality is not null"), None)
    look("first")
    try:
        publish(merged, merged.where("quality is null").select("doc_id"))
    except Incomplete:
        look("refused")
    publish(merged.fillna({"quality": 1}), merged.limit(0).select("doc_id"))
    look("whole")
    return _union(seen)


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("""
select c_mktsegment as segment, row_number() over (partition by c_mktsegment order by c_custkey)::bigint as line, c_custkey, round(c_acctbal * 100)::bigint as cents from customer""")
def q64_lines_in_file_order(spark, sf_dir):
    """Customers written as JSON lines, a file for each segment, and read strictly with the number of each line."""
    path = folder(spark)
    cust = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"))
    rows = cust.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey")
    rows.select("c_mktsegment", F.to_json(F.struct("c_custkey", "cents")).alias("value")).write.partitionBy("c_mktsegment").text(path)
    segment = F.url_decode(F.regexp_extract("file", "c_mktsegment=([^/]*)/", 1))
    return lines.strict_jsonl(spark, path, "c_custkey bigint, cents bigint").select(segment.alias("segment"), "line", "c_custkey", "cents")


@query("""
with x as (select c_nationkey, c_custkey, case when c_custkey % 97 = 0 then 0 else row_number() over (partition by c_nationkey order by c_custkey) end as found,
  row_number() over (partition by c_nationkey order by c_custkey) as expected from customer)
select c_nationkey::varchar as participant, min(expected)::bigint as line from x where found <> expected group by 1""")
def q65_manifest_order(spark, sf_dir):
    """A manifest a nation, written as lines; some customers have a blank order. The first line of each manifest that is not 1..N in file order."""
    path = folder(spark)
    cust = ranking.numbered(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.col("c_custkey")], "at")
    order = F.when(F.col("c_custkey") % 97 == 0, "").otherwise(F.col("at").cast("string"))
    rows = cust.select("c_nationkey", "c_custkey", F.struct(F.col("c_nationkey").cast("string").alias("participant_id"), order.alias("benchmark_session_order")).alias("r"))
    rows = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    rows.select("c_nationkey", F.to_json("r").alias("value")).write.partitionBy("c_nationkey").text(path)
    got = lines.strict_jsonl(spark, path, "participant_id string, benchmark_session_order string")
    bad = lines.manifest_violations(got, "participant_id", "benchmark_session_order").where("code = 'order'")
    return bad.select(F.regexp_extract("file", "c_nationkey=([^/]*)/", 1).alias("participant"), "line")


@query("select l_orderkey, l_linenumber, (row_number() over (order by round(l_extendedprice * 100)::bigint desc, l_orderkey, l_linenumber))::bigint as place from lineitem")
def q66_global_rank(spark, sf_dir):
    """Every line item's place by price."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    return ranking.ranked(x, [F.desc("cents"), F.col("l_orderkey"), F.col("l_linenumber")], "place").select("l_orderkey", "l_linenumber", "place")


@query("""
with recursive s as (
  select o_custkey % 25 as participant, o_orderkey, list_distinct(list(l_suppkey)) as ids from orders left join lineitem on l_orderkey = o_orderkey group by 1, 2),
n as (select participant, o_orderkey, list_filter(ids, lambda x: x is not null) as ids, row_number() over (partition by participant order by o_orderkey) as i from s),
r as (
  select participant, 0::bigint as i, []::bigint[] as used, null::bigint as o_orderkey, false as won from n group by 1
  union all
  select n.participant, n.i, case when list_has_any(r.used, n.ids) then r.used else list_concat(r.used, n.ids) end, n.o_orderkey, not list_has_any(r.used, n.ids)
  from r join n on n.participant = r.participant and n.i = r.i + 1)
select participant::bigint as participant, o_orderkey::bigint as o_orderkey from r where won""")
def q67_conflict_free_sets(spark, sf_dir):
    """Orders of a group in turn, each with the suppliers of its lines: one is kept if no kept one before it has any of them."""
    suppliers = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.col("l_suppkey").cast("bigint")).alias("ids"))
    orders = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 25).cast("bigint").alias("participant"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"))
    return ranking.conflict_free_rows(orders.join(suppliers, "o_orderkey", "left"), ["participant"], "o_orderkey", "ids", fold=16)


_FOLDED = "replace(replace(replace(lower(w), 'ß', 'ss'), 'ς', 'σ'), 'ﬁ', 'fi')"


@query(f"""
with w as (select distinct unnest(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+')) as w from documents),
v as (select w, {_FOLDED} as folded from w where w <> '')
select folded, list(w order by w)[1] as first, count(*)::bigint as spellings, (row_number() over (order by folded))::bigint as place from v group by folded""")
def q68_casefolded_order(spark, sf_dir):
    """Words of all documents, brought together whatever their case, in casefolded order."""
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[ \\t\\n\\x0B\\f\\r]+")).alias("w")).where("w <> ''").distinct()
    per = words.withColumn("folded", c.casefolded("w")).groupBy("folded").agg(F.min("w").alias("first"), F.count("*").alias("spellings"))
    return ranking.ranked(per, [F.col("folded")], "place").select("folded", "first", "spellings", "place")
