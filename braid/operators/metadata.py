"""Flat rows of nested video metadata whose fields may be missing, null or of another type, and the report over them.

A video is a VARIANT, so a field that is text in one record and a number in the next does no harm. All columns of a row come from one projection; the report
takes three aggregates of the rows, which are stored once, and joins their one-row results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..sources.workspace import kept
from . import intervals
from .nested import plain, present


def _number(v: str, path: str) -> Column:
    """A number or a text that is one; null for anything else and for what isn't finite."""
    return c.safe_double(plain(F.try_variant_get(v, path, "variant")))


def _whole(v: str, path: str) -> Column:
    """A whole number, a float cut to one, or a text of digits."""
    x = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(x) == "STRING", c.safe_long(F.trim(plain(x)))).otherwise(plain(x).try_cast("double").try_cast("bigint"))


def _truth(v: str, path: str) -> Column:
    """Whether a field holds anything but false, zero, nothing or an empty text."""
    return ~F.coalesce(plain(F.try_variant_get(v, path, "variant")), F.lit("")).isin("", "false", "0", "0.0", "null", "[]", "{}")


def _words(v: str, path: str) -> Column:
    """Distinct trimmed texts of a list, sorted casefolded."""
    x = F.transform(F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>")), lambda t: F.nullif(F.trim(present(t)), F.lit("")))
    keyed = F.transform(F.array_distinct(F.filter(x, lambda t: t.isNotNull())), lambda t: F.struct(c.casefolded(t).alias("k"), t.alias("t")))
    return F.transform(F.sort_array(keyed), lambda s: s["t"])


# Columns of the format that are taken over as text, and the statuses of redaction.
TEXTS = ("video_source", "origin_video_id", "device", "physical_setting_name", "split_em", "split_av", "split_fho", "s3_path")


def video_rows(videos: DataFrame, sets: DataFrame, record: str = "record") -> DataFrame:
    """A flat row for each video (record VARIANT): identity, duration, media, audio, splits, sensors, components, redaction, and the concurrent sets it is in.

    sets: video_uid, concurrent_video_set_ids, a row for each video in any. A video without video_uid is left out; see `nameless`. The duration is the first
    that is a number of the video's own, its metadata's, and its proxy's. Intervals are cut to the duration and united, so none counts twice."""
    text = lambda path: present(F.try_variant_get(record, path, "variant"))
    one = videos.select(
        F.trim(F.coalesce(text("$.video_uid"), F.lit(""))).alias("video_uid"),
        text("$.fb_participant_id").alias("fb_participant_id"),
        F.coalesce(*[_number(record, f"$.{p}") for p in ("duration_sec", "video_metadata.video_duration_sec", "video_metadata.mp4_duration_sec")], F.lit(0.0)).alias("duration_sec"),
        *[text(f"$.{x}").alias(x) for x in TEXTS],
        _words(record, "$.scenarios").alias("scenarios"),
        _number(record, "$.video_metadata.fps").alias("fps"),
        text("$.video_metadata.video_codec").alias("video_codec"),
        *[_whole(record, f"$.video_metadata.{x}").alias(x) for x in ("num_frames", "display_resolution_width", "display_resolution_height", "sample_resolution_width", "sample_resolution_height")],
        *[_number(record, f"$.video_metadata.{x}").alias(x) for x in ("audio_start_sec", "audio_duration_sec")],
        *[_truth(record, f"$.{x}").alias(x) for x in ("is_stereo", "has_imu", "has_gaze")],
        F.coalesce(F.try_variant_get(record, "$.video_components", "array<variant>"), F.array().cast("array<variant>")).alias("_components"),
        _truth(record, "$.has_redacted_regions").alias("_declared"),
        F.coalesce(F.try_variant_get(record, "$.redacted_intervals", "array<variant>"), F.array().cast("array<variant>")).alias("_intervals"),
    ).where("video_uid <> ''")
    j = one.join(sets.select("video_uid", "concurrent_video_set_ids"), "video_uid", "left")
    d, known = F.col("duration_sec"), ~F.col("participant_id").startswith("EGO4D_UNKNOWN_")
    end = lambda x, f: c.safe_double(plain(F.try_variant_get(x, f"$.{f}", "variant")))
    spans = F.transform("_intervals", lambda x: F.struct(end(x, "start_sec").alias("start_sec"), end(x, "end_sec").alias("end_sec")))
    some, declared = F.size("_intervals") > 0, F.col("_declared")
    redacted = F.when(some, intervals.array_union_length(F.filter(spans, lambda s: s["start_sec"].isNotNull() & s["end_sec"].isNotNull()), F.lit(0.0), d)).when(~declared, F.lit(0.0))
    places = F.filter(F.transform("_components", lambda x: F.try_variant_get(x, "$.component_idx", "bigint")), lambda i: i.isNotNull())
    set_ids = F.coalesce("concurrent_video_set_ids", F.array().cast(dict(sets.dtypes)["concurrent_video_set_ids"]))
    rows = j.withColumns({"participant_id": c.participant_key("fb_participant_id", "video_uid"), "redacted_duration_sec": redacted})
    return rows.select(
        "video_uid", "participant_id", "fb_participant_id", known.alias("participant_known"), "video_source", "origin_video_id", "duration_sec", (d / 60.0).alias("duration_min"),
        "scenarios", F.size("scenarios").alias("scenario_count"), "device", "physical_setting_name", "fps", "num_frames", "video_codec",
        "display_resolution_width", "display_resolution_height", "sample_resolution_width", "sample_resolution_height", "audio_start_sec", "audio_duration_sec",
        F.coalesce(F.col("audio_duration_sec") > 0, F.lit(False)).alias("has_audio"), c.share("audio_duration_sec", "duration_sec").alias("audio_coverage_ratio"),
        "split_em", "split_av", "split_fho", "is_stereo", "has_imu", "has_gaze", F.size("_components").alias("component_count"), F.sort_array(places).alias("component_indices"),
        F.lit("verified_canonical_timeline").alias("within_video_order_status"), (declared | some).alias("has_redacted_regions"), "redacted_duration_sec",
        F.when((d > 0) & F.col("redacted_duration_sec").isNotNull(), F.least(F.greatest(F.col("redacted_duration_sec") / d, F.lit(0.0)), F.lit(1.0))).alias("redacted_ratio"),
        F.when(declared & some, "measured").when(some, "measured_flag_mismatch").when(declared, "missing_intervals").otherwise("none").alias("redaction_measurement_status"),
        set_ids.alias("concurrent_video_set_ids"), F.size(set_ids).alias("concurrent_video_set_count"), F.lit("canonical_video").alias("session_unit_type"), "s3_path",
    )


def nameless(videos: DataFrame, record: str = "record") -> DataFrame:
    """Videos without video_uid, for `constraints.enforce`."""
    return videos.where(F.trim(F.coalesce(present(F.try_variant_get(record, "$.video_uid", "variant")), F.lit(""))) == "")


def _spread(x: Column, name: str) -> list[Column]:
    """count, min, quartiles, p90 and max of x."""
    p = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.9)))
    return [F.struct(F.count(x).alias("count"), F.min(x).alias("min"), *[F.get(p, F.lit(i)).alias(k) for i, k in enumerate(("p25", "median", "p75", "p90"))], F.max(x).alias("max")).alias(name)]


def report(rows: DataFrame, candidates: DataFrame, benchmark: DataFrame, pilot: DataFrame, accessible: DataFrame | None = None, least_videos: int = 2) -> DataFrame:
    """One row of all scalars over `video_rows`, candidates (video_uid, participant_id, candidate_status), the benchmark (participant_id, duration_sec) and the
    pilot (participant_id). accessible: video_uid of those an access audit found; without it its columns are null."""
    seen = rows.select("video_uid", "participant_id", "participant_known", "duration_sec", "has_audio", "has_redacted_regions", "redaction_measurement_status", "concurrent_video_set_count", "scenarios")
    if accessible is not None:
        seen = seen.join(accessible.select("video_uid").distinct().withColumn("_here", F.lit(True)), "video_uid", "left").withColumn("_here", F.coalesce("_here", F.lit(False)))
    v = kept(seen)
    known = F.col("participant_known")
    here = [F.count_if("_here"), F.count_if(~F.col("_here"))] if accessible is not None else [F.lit(None).cast("bigint")] * 2
    videos = v.agg(
        F.count("*").alias("video_count"),
        F.coalesce(F.sum("duration_sec"), F.lit(0.0)).alias("total_duration_sec"),
        *_spread(F.col("duration_sec"), "video_duration_sec_distribution"),
        F.count_if(known).alias("known_participant_video_count"),
        F.count_if(~known).alias("unknown_participant_video_count"),
        F.count_if("has_audio").alias("audio_video_count"),
        F.count_if("has_redacted_regions").alias("redacted_video_count"),
        F.count_if(F.col("redaction_measurement_status") == "missing_intervals").alias("redaction_extent_unknown_video_count"),
        F.count_if(F.col("concurrent_video_set_count") > 0).alias("concurrent_video_count"),
        F.lit(accessible is not None).alias("download_access_filter_applied"),
        here[0].alias("download_accessible_metadata_video_count"),
        here[1].alias("download_inaccessible_metadata_video_count"),
    )
    per = v.groupBy("participant_id").agg(F.first("participant_known").alias("known"), F.count("*").cast("double").alias("n")).where("known")
    people = per.agg(
        F.count("*").alias("known_participant_count"),
        *_spread(F.col("n"), "known_participant_video_count_distribution"),
        F.count_if(F.col("n") >= 2).alias("multi_video_known_participant_count"),
        F.count_if(F.col("n") >= least_videos).alias("cross_video_consistency_eligible_participant_count"),
    )
    scenes = v.select(F.explode("scenarios").alias("s")).agg(F.count_distinct("s").alias("scenario_count"))
    ok = F.col("candidate_status") == "eligible"
    chosen = candidates.agg(F.count_if(ok).alias("eligible_candidate_video_count"), F.count_distinct(F.when(ok, F.col("participant_id"))).alias("eligible_candidate_participant_count"))
    bench = benchmark.agg(F.count("*").alias("benchmark_video_count"), F.count_distinct("participant_id").alias("benchmark_participant_count"), F.coalesce(F.sum("duration_sec"), F.lit(0.0)).alias("benchmark_total_duration_sec"))
    first = pilot.agg(F.count("*").alias("pilot_video_count"), F.count_distinct("participant_id").alias("pilot_participant_count"))
    out = videos
    for x in (people, scenes, chosen, bench, first):
        out = out.join(F.broadcast(x))  # one row each
    return out.withColumns({"total_duration_hours": F.col("total_duration_sec") / 3600.0, "benchmark_total_duration_hours": F.col("benchmark_total_duration_sec") / 3600.0})
