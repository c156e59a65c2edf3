"""Queries on flat rows of nested metadata: customers as videos, nations as participants, their orders as components and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metadata
from .catalog import query
from .tables import joined, table

# What is in a record follows from the customer's key: durations as numbers, texts or in another place, participants as numbers, texts or missing.
_ROWS = """
with c as (select c_custkey::bigint as k, c_nationkey::bigint as nation, c_mktsegment as seg from customer),
o as (select o_custkey::bigint as k, count(*) as n, list_sort(list(o_orderkey::bigint)) as keys from orders group by 1),
v as (
  select k, 'u' || k as video_uid, nation, seg, coalesce(n, 0) as n, coalesce(keys, []) as keys,
    case k % 5 when 0 then null when 1 then nation::varchar when 2 then nation::varchar else 'No. ' || nation end as fb,
    case k % 4 when 0 then 60.0 + k when 1 then 12.5 when 2 then 30.0 else 0.0 end as duration, k % 6 as aud, k % 7 in (0, 1) as declared, k % 7 in (1, 2) as cut from c left join o using (k)),
w as (
  select *, case when fb is null then 'EGO4D_UNKNOWN_' || video_uid when k % 5 in (1, 2) then 'EGO4D_P' || lpad(fb, 6, '0') else 'EGO4D_P_No_' || nation end as participant_id,
    case when cut then greatest(least(duration, 9.0) - 5.0, 0.0) + greatest(least(duration, 2.0) - 1.0, 0.0) when not declared then 0.0 end as redacted from v)
"""


def nested_videos(spark, sf_dir):
    """Videos (record VARIANT) and the sets that they are in."""
    cust = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("k"), F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_mktsegment").alias("seg"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("bigint").alias("k")).agg(F.collect_list(F.col("o_orderkey").cast("bigint")).alias("keys"))
    k = F.col("k")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    at = lambda n, *options: F.get(F.array(*[F.lit(x) if isinstance(x, str) else x for x in options]), (k % n).cast("int"))
    record = F.concat(
        text('{"video_uid": " u', k, '", '),
        at(5, "", text('"fb_participant_id": ', F.col("nation"), ", "), text('"fb_participant_id": "', F.col("nation"), '", '), *[text('"fb_participant_id": "No. ', F.col("nation"), '", ')] * 2),
        at(4, text('"duration_sec": ', 60.0 + k, ", "), '"duration_sec": "12.5", ', '"duration_sec": null, ', '"duration_sec": "?", '),
        text('"scenarios": [" ', F.col("seg"), '", "b", null, "", "', F.col("seg"), '", 7], "device": "d", "is_stereo": ', at(3, "true", "0", '"yes"'), ', "split_em": "train", '),
        text('"video_metadata": {"video_duration_sec": ', at(4, "1", "1", "30", '"nan"'), ', "fps": "29.97", "num_frames": ', at(2, "100.9", '"200"'), ', "audio_duration_sec": ', at(6, "null", "6", '"6.25"', "0", "-1", "1000000"), "}, "),
        text('"video_components": [', F.array_join(F.transform(F.coalesce("keys", F.array().cast("array<bigint>")), lambda x: F.concat(F.lit('{"component_idx": '), x.cast("string"), F.lit("}"))), ","), "], "),
        text('"has_redacted_regions": ', F.when((k % 7).isin(0, 1), "true").otherwise("false"), F.when((k % 7).isin(1, 2), ', "redacted_intervals": [{"start_sec": 5, "end_sec": 8}, {"start_sec": "7", "end_sec": 9}, {"start_sec": 1, "end_sec": 2}, {"start_sec": 4}]').otherwise(""), "}"),
    )
    videos = cust.join(orders, "k", "left").select(F.parse_json(record).alias("record"))
    sets = cust.where("k % 3 = 0").select(F.concat(F.lit("u"), k.cast("string")).alias("video_uid"), F.array(F.floor(k / 9).cast("bigint")).alias("concurrent_video_set_ids"))
    return videos, sets


def _videos(spark, sf_dir):
    return metadata.video_rows(*nested_videos(spark, sf_dir))


@query(_ROWS + """
select video_uid, participant_id, fb as fb_participant_id, fb is not null as participant_known, null::varchar as video_source, null::varchar as origin_video_id, duration::double as duration_sec, duration / 60.0 as duration_min,
  case when lower(seg) < 'b' then '7|' || seg || '|b' else '7|b|' || seg end as scenarios, 3 as scenario_count, 'd' as device, null::varchar as physical_setting_name, 29.97::double as fps, case when k % 2 = 0 then 100 else 200 end::bigint as num_frames, null::varchar as video_codec,
  null::bigint as display_resolution_width, null::bigint as display_resolution_height, null::bigint as sample_resolution_width, null::bigint as sample_resolution_height, null::double as audio_start_sec,
  case aud when 1 then 6.0 when 2 then 6.25 when 3 then 0.0 when 4 then -1.0 when 5 then 1000000.0 end::double as audio_duration_sec, aud in (1, 2, 5) as has_audio,
  case when duration > 0 then (case aud when 1 then least(6.0 / duration, 1.0) when 2 then least(6.25 / duration, 1.0) when 5 then 1.0 end)::double end as audio_coverage_ratio,
  'train' as split_em, null::varchar as split_av, null::varchar as split_fho, k % 3 in (0, 2) as is_stereo, false as has_imu, false as has_gaze, n::int as component_count, array_to_string(keys, '|') as component_indices,
  'verified_canonical_timeline' as within_video_order_status, declared or cut as has_redacted_regions, redacted::double as redacted_duration_sec, case when duration > 0 and redacted is not null then least(redacted / duration, 1.0)::double end as redacted_ratio,
  case when declared and cut then 'measured' when cut then 'measured_flag_mismatch' when declared then 'missing_intervals' else 'none' end as redaction_measurement_status,
  case when k % 3 = 0 then (k // 9)::varchar else '' end as concurrent_video_set_ids, (k % 3 = 0)::int as concurrent_video_set_count, 'canonical_video' as session_unit_type, null::varchar as s3_path
from w""")
def q80_video_rows(spark, sf_dir):
    """Nested records with fields of any type as flat rows of forty columns."""
    rows = _videos(spark, sf_dir)
    return rows.withColumns({"scenarios": F.array_join("scenarios", "|"), **{x: joined(F.col(x)) for x in ("component_indices", "concurrent_video_set_ids")}})


@query(_ROWS + """,
p as (select participant_id, count(*)::double as n from w where fb is not null group by 1),
ok as (select * from w where duration >= 30)
select (select count(*) from w) as video_count, (select sum(duration) from w) as total_duration_sec, (select sum(duration) / 3600 from w) as total_duration_hours,
  (select count(duration) || '|' || min(duration)::double || '|' || quantile_cont(duration::double, 0.25) || '|' || quantile_cont(duration::double, 0.5) || '|' || quantile_cont(duration::double, 0.75) || '|' || round(quantile_cont(duration::double, 0.9), 6) || '|' || max(duration)::double from w) as video_duration_sec_distribution,
  (select count(*) from w where fb is not null) as known_participant_video_count, (select count(*) from w where fb is null) as unknown_participant_video_count, (select count(*) from p) as known_participant_count,
  (select count(n) || '|' || min(n) || '|' || quantile_cont(n, 0.25) || '|' || quantile_cont(n, 0.5) || '|' || quantile_cont(n, 0.75) || '|' || round(quantile_cont(n, 0.9), 6) || '|' || max(n) from p) as known_participant_video_count_distribution,
  (select count(*) from p where n >= 2) as multi_video_known_participant_count, (select count(*) from p where n >= 3) as cross_video_consistency_eligible_participant_count,
  (select count(*) from w where aud in (1, 2, 5)) as audio_video_count, (select count(*) from w where declared or cut) as redacted_video_count, (select count(*) from w where declared and not cut) as redaction_extent_unknown_video_count,
  (select count(*) from w where k % 3 = 0) as concurrent_video_count, (select count(distinct seg) + 2 from w) as scenario_count, true as download_access_filter_applied,
  (select count(*) from w where k % 8 <> 0) as download_accessible_metadata_video_count, (select count(*) from w where k % 8 = 0) as download_inaccessible_metadata_video_count,
  (select count(*) from ok) as eligible_candidate_video_count, (select count(distinct participant_id) from ok) as eligible_candidate_participant_count,
  (select count(*) from ok where fb is not null) as benchmark_video_count, (select count(distinct participant_id) from ok where fb is not null) as benchmark_participant_count,
  (select sum(duration) from ok where fb is not null) as benchmark_total_duration_sec, (select sum(duration) / 3600 from ok where fb is not null) as benchmark_total_duration_hours,
  (select count(*) from w where k % 4 = 1) as pilot_video_count, (select count(distinct participant_id) from w where k % 4 = 1) as pilot_participant_count""")
def q81_metadata_report(spark, sf_dir):
    """All scalars of the report over those rows, in one row."""
    rows = _videos(spark, sf_dir)
    candidates = rows.select("video_uid", "participant_id", "duration_sec", "participant_known", F.when(F.col("duration_sec") >= 30, "eligible").otherwise("excluded").alias("candidate_status"))
    bench = candidates.where("candidate_status = 'eligible' and participant_known")
    pilot = rows.where(F.col("duration_sec") == 12.5)
    k = F.expr("cast(substr(video_uid, 2) as bigint)")
    out = metadata.report(rows, candidates, bench, pilot, rows.where(k % 8 != 0).select("video_uid"), least_videos=3)
    spread = lambda x: F.concat_ws("|", *[F.col(f"{x}.{f}").cast("string") if f != "p90" else F.round(f"{x}.{f}", 6).cast("string") for f in ("count", "min", "p25", "median", "p75", "p90", "max")])
    return out.withColumns({x: spread(x) for x in ("video_duration_sec_distribution", "known_participant_video_count_distribution")})
