"""Whole flows as queries: the metadata audit, extraction through three layers, and verification to a reference set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..flows import extraction, metadata_audit, reference_set
from ..operators import audit
from ..sources.publication import PublishedSet
from ..sources.workspace import folder
from . import metadata, review
from .catalog import query
from .tables import table

# Candidates of the audit over the videos of `metadata`: reasons, the choice without concurrent videos, the order of the benchmark.
_AUDIT = metadata._ROWS + """,
n as (select participant_id, count(*) as videos from w group by 1),
r as (
  select w.*, videos, concat_ws('|',
    case when k % 9 = 4 then 'unavailable_in_download_access_audit' end, case when fb is null then 'unknown_participant' end,
    case when fb is not null and videos < 2 then 'not_enough_videos_for_cross_video_consistency' end, case when duration <= 0 then 'invalid_duration' end,
    case when duration > 0 and duration < 20 then 'duration_below_min' end, case when duration > 900 then 'duration_above_max' end,
    case when declared and not cut then 'redaction_extent_unknown' end, case when duration > 0 and not (declared and not cut) and least(redacted / duration, 1.0) > 0.1 then 'redaction_ratio_above_max' end,
    case when seg not in ('BUILDING', 'MACHINERY', 'FURNITURE') then 'scenario_filter_mismatch' end) as why
  from w join n using (participant_id)),
free as (
  select *, case when k % 3 = 0 then (k // 9)::varchar end as grp, row_number() over (partition by participant_id, case when k % 3 = 0 then (k // 9)::varchar else 'own' || k end order by video_uid) = 1 as apart
  from r where why = ''),
m as (select participant_id, count(*) as eligible, count(*) filter (apart) as independent from free group by 1),
cand as (
  select r.video_uid, r.participant_id, r.duration, coalesce(eligible, 0) as eligible, coalesce(independent, 0) as independent,
    case when r.why <> '' then r.why when independent < 2 then 'insufficient_independent_eligible_videos_for_participant' else '' end as why, coalesce(apart, false) as apart
  from r left join m using (participant_id) left join free using (video_uid)),
bench as (select *, row_number() over (partition by participant_id order by video_uid) as place, count(*) over (partition by participant_id) >= 2 as evolves from cand where why = '' and apart),
best as (select participant_id, row_number() over (order by count(*) desc, sum(duration) desc, participant_id) as pr from bench group by 1 order by pr limit 5)
"""


def _audited(spark, sf_dir):
    """The audit over customers as videos, published and read back."""
    videos, sets = metadata.nested_videos(spark, sf_dir)
    k = F.col("c_custkey").cast("bigint")
    accessible = table(spark, sf_dir, "customer").where(k % 9 != 4).select(F.concat(F.lit("u"), k.cast("string")).alias("video_uid"))
    filters = audit.Filters(min_duration_sec=20, max_duration_sec=900, max_redaction_ratio=0.1, min_videos_per_participant=2, scenarios=("building", "machinery", "furniture"))
    out = PublishedSet(spark, folder(spark))
    metadata_audit.publish(out, videos, sets, filters, accessible)
    return out


@query(_AUDIT + """
select c.video_uid, c.participant_id, c.why as reasons, c.eligible::int as eligible_videos, c.independent::int as independent_eligible_videos, b.place::int as benchmark_session_order, b.evolves as benchmark_temporal_evolution_eligible,
  case when b.place <= 3 then pr end::int as group_rank
from cand c left join bench b using (video_uid) left join best on best.participant_id = b.participant_id""")
def q82_audit_flow(spark, sf_dir):
    """Nested records through the whole audit: of each video the reasons against it, its place in the benchmark, and its group in the pilot."""
    out = _audited(spark, sf_dir)
    bench = out.read("benchmark_manifest").select("video_uid", "benchmark_session_order", "benchmark_temporal_evolution_eligible")
    pilot = out.read("pilot_manifest").select("video_uid", "group_rank")
    cand = out.read("candidate_videos").select("video_uid", "participant_id", F.array_join("exclusion_reasons", "|").alias("reasons"), "eligible_videos", "independent_eligible_videos")
    return cand.join(bench, "video_uid", "left").join(pilot, "video_uid", "left")


@query(_AUDIT + """
select participant_id, count(*)::bigint as video_count, sum(duration)::double as total_duration_sec, min(place)::int as first_benchmark_session_order, max(place)::int as last_benchmark_session_order, lower(participant_id) || '_all_videos.csv' as manifest_file from bench group by 1""")
def q83_audit_index(spark, sf_dir):
    """The index of participants' manifests that the audit publishes."""
    return _audited(spark, sf_dir).read("participant_manifest_index")


#: What is answered for a record: a layer's required fields, an id that isn't the parent's, confidences that don't go up.
_ANSWERS = {
    "micro": '{"clip_id": "?", "source_video_id": "?", "clip_time_range": "0:00-0:01", "clip_summary": "s", "confidence": "high", "places": [{"place_id": "p"}], "objects": [], "atomic_events": [], "state_observations": [], "state_changes": [], "end_state": [], "uncertainties": []}',
    "window": '{"window_id": "?", "source_video_id": "?", "time_range": {}, "window_summary": "s", "entity_map": [], "local_event_chain": [], "state_changes": [], "window_end_state": [], "open_threads": [], "evidence_facts": [], "conflicts_or_uncertainties": []}',
    "session": '{"session_id": "?", "source_video_id": "?", "participant_id": "?", "time_range": {}, "session_summary": "s", "session_timeline": [], "session_entities": [], "state_update_timeline": [], "session_final_state": [], "open_tasks_or_unresolved_states": [], "cross_session_evidence_candidates": [], "contradictions_or_uncertainties": []}',
}


def answered(layer, requests):
    """Some clips are answered right at the second or third time only: a text that was cut off, then a record that lacks its summary."""
    part = lambda p: F.coalesce(F.regexp_extract("record_id", p, 1).try_cast("bigint"), F.lit(0))
    k, i = part(r"^v(\d+)"), part(r"_[sw](\d+)$")
    late = {"micro": ((k + i) % 7 == 0).cast("int") + ((k + i) % 35 == 0).cast("int"), "window": F.lit(0), "session": F.lit(0)}[layer]
    whole = F.lit(_ANSWERS[layer])
    cut, lacking = F.substring(whole, 1, 40), F.regexp_replace(whole, '"[a-z]+_summary": "s", ', "")
    short = F.col("attempt") <= late
    return requests.select("record_id", "attempt", F.when(short, F.when(F.col("attempt") == 1, cut).otherwise(lacking)).otherwise(whole).alias("content"), F.when(short & (F.col("attempt") == 1), "length").otherwise("stop").alias("finish_reason"))


@query("""
with s as (select s_suppkey::bigint as k, 20 + (s_suppkey * 37) % 400 as d from supplier),
n as (select *, case when d < 30 then 1 when d % 30 < 10 then d // 30 else d // 30 + 1 end as n from s),
c as (select k, i, 30.0 * i as a, case when i = n - 1 then d else 30.0 * (i + 1) end as b from (select *, unnest(generate_series(0, n - 1)) as i from n)),
w as (select k, i // 4 as i, min(a) as a, max(b) as b, count(*) as children from c group by 1, 2)
select 'micro' as layer, 'v' || k || '_s' || lpad(i::varchar, 3, '0') as record_id, 'v' || k as source_video_id, 1 + ((k + i) % 7 = 0)::int + ((k + i) % 35 = 0)::int as attempts, 0 as children, a::double as start_sec, b::double as end_sec from c
union all select 'window', 'v' || k || '_w' || lpad(i::varchar, 3, '0'), 'v' || k, 1, children::int, a::double, b::double from w
union all select 'session', 'v' || k, 'v' || k, 1, count(*)::int, min(a)::double, max(b)::double from w group by k""")
def q84_extraction_flow(spark, sf_dir):
    """Suppliers as videos through clips, windows and sessions: of each record accepted, how often it was asked about, what it was built of and where it lies."""
    k = F.col("s_suppkey").cast("bigint")
    videos = table(spark, sf_dir, "supplier").select(F.concat(F.lit("v"), k.cast("string")).alias("source_video_id"), F.concat(F.lit("p"), (k % 9).cast("string")).alias("participant_id"), (20 + (k * 37) % 400).cast("double").alias("duration_sec"))
    out = None
    for name, x in extraction.extract(videos, answered).items():
        below = {"micro": F.lit(0), "window": F.size(F.from_json(F.get_json_object("parent", "$.micro_clip_ids"), "array<string>")), "session": F.size(F.from_json(F.get_json_object("parent", "$.window_ids"), "array<string>"))}[name]
        at = lambda f: F.get_json_object("parent", f"$.{f}").cast("double").alias(f)
        parents = x.parents.select("record_id", below.alias("children"), at("start_sec"), at("end_sec"))
        rows = x.accepted.join(parents, "record_id").join(x.records.select("record_id", "attempts"), "record_id")
        rows = rows.select(F.lit(name).alias("layer"), "record_id", F.get_json_object("evidence", "$.source_video_id").alias("source_video_id"), "attempts", "children", "start_sec", "end_sec")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(review._CAND.replace("s as (", """s as (select *, first_status as qc_status from f), unused as (""", 1) + """
select 's' || (doc_id // 8) || ':c' || doc_id as reference_id, coalesce(type, 'unknown') as type, first_status, final_status, outcome, case when decision = 'accept_corrected' then 'approved ' || doc_id else 'claim ' || doc_id end as claim,
  first_status in ('verification_disputed', 'verification_uncertain') as queued, case when decision is not null then 'note ' || doc_id end as human_notes from o""")
def q85_reference_flow(spark, sf_dir):
    """Documents as candidates of sources of eight: a service's lines merged and published, people's decisions on the published sheet, the finished set."""
    n, none = F.col("doc_id"), F.array().cast("array<string>")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    ids = [text("s", F.floor(n / 8).cast("bigint")).alias("source_video_id"), text("c", n).alias("candidate_id")]
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", *ids)
    span = lambda a, b: F.array(F.struct(a.cast("double").alias("start_sec"), b.cast("double").alias("end_sec")))
    flags = F.when(n % 17 == 0, F.array(F.lit("long_term_overclaim"))).otherwise(none).alias("flags")
    candidates = docs.select("source_video_id", "candidate_id", F.lit("p").alias("participant_id"), F.col("lang").alias("type"), text("claim ", n).alias("claim"), F.lit("").alias("observed_value"), none.alias("supporting_window_ids"), span(F.lit(0), F.lit(300)).alias("support"), flags)
    asked = docs.where("doc_id % 13 <> 0").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    verdict = F.when(F.col("quality").isNull(), "insufficient").when(F.col("quality") == 0, "contradicted").otherwise("entailed")
    evidence = F.when((F.col("n_chars") > 300) & (n % 11 != 0), span(F.lit(200), F.col("n_chars"))).otherwise(span(F.lit(300), F.col("n_chars") + 300))
    result = F.struct("candidate_id", verdict.alias("verdict"), evidence.alias("evidence_time_ranges"), F.when(n % 19 == 0, "better").alias("corrected_claim"))
    answers = asked.groupBy("source_video_id").agg(F.to_json(F.struct(F.collect_list(result).alias("verification_results"))).alias("content"))
    message = F.array(F.struct(F.struct("content").alias("message")))
    response = F.struct(F.lit(200).alias("status_code"), F.struct(message.alias("choices")).alias("body"))
    lines = answers.select(F.to_json(F.struct(F.col("source_video_id").alias("custom_id"), response.alias("response"))).alias("value"))
    out, final = PublishedSet(spark, folder(spark)), PublishedSet(spark, folder(spark))
    reference_set.first_pass(out, candidates, asked.select("source_video_id", "candidate_id"), lines)
    number = F.substring("candidate_id", 2, 20).cast("bigint")
    choice = F.get(F.array(F.lit("accept"), F.lit("接受修正"), F.lit(" reject "), F.lit("")), (number % 4).cast("int"))
    sheet = out.read("human_review").select("source_video_id", "candidate_id", choice.alias("decision"), text("approved ", number).alias("approved_claim"), F.col("review_fingerprint").alias("fingerprint"), "claim", text("note ", number).alias("human_notes"))
    reference_set.finalise(final, out.read("merged"), sheet)
    queued = out.read("local_review_queue").select("source_video_id", "candidate_id", F.lit(True).alias("queued"))
    rows = None
    for name, outcome in (("reference_ready", "ready"), ("rejected", "rejected"), ("unresolved", "unresolved")):
        part = final.read(name).withColumn("outcome", F.lit(outcome))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.join(queued, ["source_video_id", "candidate_id"], "left")
    return rows.select("reference_id", F.coalesce("type", F.lit("unknown")).alias("type"), F.col("qc_status").alias("first_status"), "final_status", "outcome", "claim", F.coalesce("queued", F.lit(False)).alias("queued"), "human_notes")
