"""Metadata audit of nested video records: normalisation, summaries, reasons for exclusion, benchmark and pilot."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import intervals, ranking


@dataclass(frozen=True)
class Filters:
    """What a video needs to be chosen."""

    min_duration_sec: float = 300.0
    max_duration_sec: float = 7200.0
    max_redaction_ratio: float = 0.2
    min_videos_per_participant: int = 3
    require_audio: bool = False
    scenarios: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.min_duration_sec < 0 or self.max_duration_sec < self.min_duration_sec:
            raise ValueError("durations are out of order")
        if not 0 <= self.max_redaction_ratio <= 1:
            raise ValueError("a ratio is between 0 and 1")
        if self.min_videos_per_participant < 1:
            raise ValueError("a participant has a video at least")

    def as_dict(self) -> dict:
        return asdict(self)


def concurrent_sets(root: DataFrame) -> DataFrame:
    """video_uid and the sorted ids of the valid concurrent sets that it is in."""
    s = root.select(F.explode("concurrent_video_sets").alias("s")).where("s.valid")
    v = s.select(F.col("s.concurrent_video_set_id").alias("id"), F.explode("s.videos.video_uid").alias("video_uid"))
    return v.groupBy("video_uid").agg(F.sort_array(F.collect_set("id")).alias("concurrent_video_set_ids"))


def videos(root: DataFrame) -> DataFrame:
    """One flat row for each video of the root document."""
    v = root.select(F.explode("videos").alias("v")).select("v.*")
    m = F.col("video_metadata")
    positive = lambda x: F.when(x > 0, x)
    duration = F.coalesce(positive(F.col("duration_sec")), positive(m["video_duration_sec"]), positive(m["mp4_duration_sec"]), F.lit(0.0))
    raw = c.blank_to_null("fb_participant_id")
    some = F.coalesce(F.size("redacted_intervals"), F.lit(0)) > 0
    flag = F.coalesce("has_redacted_regions", F.lit(False))
    out = v.join(concurrent_sets(root), "video_uid", "left").withColumn("duration_sec", duration)
    redacted = F.when(some, intervals.array_union_length(F.col("redacted_intervals"), F.lit(0.0), F.col("duration_sec")))
    return out.select(
        "video_uid",
        c.participant_key(raw, "video_uid").alias("participant_id"),
        (raw.isNotNull() & ~c.participant_key(raw, "video_uid").startswith("EGO4D_UNKNOWN_")).alias("participant_known"),
        raw.alias("raw_participant_id"),
        "duration_sec",
        m["fps"].alias("fps"),
        m["num_frames"].alias("num_frames"),
        m["video_codec"].alias("video_codec"),
        F.coalesce(m["display_resolution_width"], m["sample_resolution_width"]).alias("width"),
        F.coalesce(m["display_resolution_height"], m["sample_resolution_height"]).alias("height"),
        m["audio_duration_sec"].alias("audio_duration_sec"),
        (F.coalesce(m["audio_duration_sec"], F.lit(0.0)) > 0).alias("has_audio"),
        c.share(m["audio_duration_sec"], F.col("duration_sec")).alias("audio_coverage"),
        F.coalesce("scenarios", F.array().cast("array<string>")).alias("scenarios"),
        "video_source",
        "device",
        "physical_setting_name",
        "origin_video_id",
        "s3_path",
        *[F.coalesce(x, F.lit(False)).alias(x) for x in ("is_stereo", "has_imu", "has_gaze")],
        F.sort_array(F.transform(F.coalesce("video_components", F.array().cast(dict(out.dtypes)["video_components"])), lambda x: x["component_idx"])).alias("component_indices"),
        flag.alias("has_redacted_regions"),
        redacted.alias("redacted_sec"),
        F.when(F.col("duration_sec") > 0, redacted / F.col("duration_sec")).alias("redaction_ratio"),
        F.when(flag & some, "measured").when(some, "measured_flag_mismatch").when(flag, "missing_intervals").otherwise("none").alias("redaction_status"),
        F.coalesce("concurrent_video_set_ids", F.array().cast("array<bigint>")).alias("concurrent_video_set_ids"),
        F.lit(None).cast("int").alias("cross_video_session_order"),
    )


def participants(v: DataFrame) -> DataFrame:
    """Counts, hours and distinct values of each participant."""
    n = lambda x: F.count_if(x)
    base = v.groupBy("participant_id").agg(
        F.count("*").alias("video_count"),
        F.sum("duration_sec").alias("total_duration_sec"),
        F.array_sort(F.collect_set("raw_participant_id")).alias("raw_participant_ids"),
        *[c.distinct_texts(x).alias(f"{x}s") for x in ("video_source", "device", "physical_setting_name")],
        n(F.col("has_audio")).alias("audio_videos"),
        n(F.col("has_imu")).alias("imu_videos"),
        n(F.col("has_gaze")).alias("gaze_videos"),
        n(F.col("is_stereo")).alias("stereo_videos"),
        n(F.col("redaction_status") != "none").alias("redacted_videos"),
        F.bool_and("participant_known").alias("participant_known"),
    )
    s = v.select("participant_id", F.explode_outer("scenarios").alias("scenario")).groupBy("participant_id").agg(c.distinct_texts("scenario").alias("scenarios"), F.count_distinct(F.lower(c.blank_to_null("scenario"))).alias("scenario_count"))
    out = base.join(s, "participant_id").withColumn("total_duration_h", F.col("total_duration_sec") / 3600)
    return out.withColumn("multi_video_eligible", F.col("participant_known") & (F.col("video_count") >= 2))


def scenarios(v: DataFrame) -> DataFrame:
    """Counts of each scenario; participants count only if they are known."""
    x = v.select("participant_id", "participant_known", "duration_sec", "has_audio", F.explode(F.array_distinct("scenarios")).alias("scenario"))
    known = F.when(F.col("participant_known"), F.col("participant_id"))
    return x.groupBy("scenario").agg(F.count("*").alias("video_count"), F.count_distinct(known).alias("known_participants"), F.sum("duration_sec").alias("total_duration_sec"), F.count_if("has_audio").alias("audio_videos"))


def order_audit(p: DataFrame) -> DataFrame:
    """What is known of the order of a participant's videos: nothing, or nothing to order."""
    one = F.col("video_count") == 1
    return p.select(
        "participant_id",
        "video_count",
        F.when(one, "not_applicable_single_video").otherwise("unknown").alias("cross_video_order_status"),
        F.lit(None).cast("string").alias("cross_video_order_basis"),
        F.lit(False).alias("benchmark_temporal_evolution_eligible"),
    )


def candidates(v: DataFrame, f: Filters, available: DataFrame | None = None) -> DataFrame:
    """Every video with all reasons against it; the participant's size of what is left is judged after concurrent videos are thinned out."""
    d = F.col("duration_sec")
    counted = v.join(v.groupBy("participant_id").agg(F.count("*").alias("_videos")), "participant_id")
    if available is not None:
        counted = counted.join(available.select("video_uid", F.lit(True).alias("_here")).distinct(), "video_uid", "left")
    gone = F.col("_here").isNull() if available is not None else F.lit(False)
    known, unknown_extent = F.col("participant_known"), F.col("redaction_status") == "missing_intervals"
    why = c.reasons(
        (gone, "unavailable_in_download_access_audit"),
        (~known, "unknown_participant"),
        (known & (F.col("_videos") < 2), "not_enough_videos_for_cross_video_consistency"),
        (d <= 0, "invalid_duration"),
        ((d > 0) & (d < f.min_duration_sec), "duration_below_min"),
        ((d > 0) & (d > f.max_duration_sec) & (d >= f.min_duration_sec), "duration_above_max"),
        (unknown_extent, "redaction_extent_unknown"),
        (~unknown_extent & F.coalesce(F.col("redaction_ratio") > f.max_redaction_ratio, F.lit(False)), "redaction_ratio_above_max"),
        (F.lit(f.require_audio) & ~F.col("has_audio"), "audio_required_but_missing"),
        (~c.matches_any("scenarios", f.scenarios), "scenario_filter_mismatch"),
    )
    judged = counted.withColumn("exclusion_reasons", why)
    free = judged.where(F.size("exclusion_reasons") == 0)
    free = free.select("participant_id", "video_uid", "concurrent_video_set_ids")
    apart = ranking.conflict_free_rows(free, ["participant_id"], "video_uid", "concurrent_video_set_ids").withColumn("_apart", F.lit(1))
    n = free.select("participant_id", F.lit(0).alias("_apart")).unionByName(apart.select("participant_id", "_apart")).groupBy("participant_id")
    n = n.agg(F.count_if(F.col("_apart") == 0).cast("int").alias("eligible_videos"), F.count_if(F.col("_apart") == 1).cast("int").alias("independent_eligible_videos"))
    out = judged.join(n, "participant_id", "left").fillna(0, ["eligible_videos", "independent_eligible_videos"])
    few = (F.size("exclusion_reasons") == 0) & (F.col("independent_eligible_videos") < f.min_videos_per_participant)
    out = out.withColumn("exclusion_reasons", F.when(few, F.array(F.lit("insufficient_independent_eligible_videos_for_participant"))).otherwise(F.col("exclusion_reasons")))
    return out.withColumn("candidate_status", F.when(F.size("exclusion_reasons") == 0, "eligible").otherwise("excluded")).drop("_videos", "_here")


def benchmark(cand: DataFrame) -> DataFrame:
    """Eligible videos without concurrent ones, with a presentation order of their participant's: it says nothing of when they were recorded."""
    ok = cand.where("candidate_status = 'eligible'")
    apart = ranking.conflict_free_rows(ok, ["participant_id"], "video_uid", "concurrent_video_set_ids")
    picked = ranking.numbered(ok.join(apart, ["participant_id", "video_uid"], "left_semi"), ["participant_id"], ["video_uid"], "benchmark_session_order")
    return ranking.group_size_at_least(picked, ["participant_id"], 2, "benchmark_temporal_evolution_eligible").withColumn("benchmark_order_basis", F.lit("synthetic_uid_order"))


def pilot(bench: DataFrame, groups: int = 5, rows: int = 3) -> DataFrame:
    """The first videos of the participants with most of them."""
    return ranking.top_groups(bench, "participant_id", "duration_sec", "video_uid", groups, rows)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """count, min, p25, median, p75, p90, max of finite values; nulls for none."""
    v = c.safe_double(column)
    p = F.percentile(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.9)))
    return df.agg(F.count(v).alias("count"), F.min(v).alias("min"), p.alias("_p"), F.max(v).alias("max")).select("count", "min", *[F.get("_p", F.lit(i)).alias(k) for i, k in enumerate(("p25", "median", "p75", "p90"))], "max")


def report(v: DataFrame, cand: DataFrame, bench: DataFrame) -> DataFrame:
    """One row of totals; each side is aggregated to a row before they are joined."""
    a = v.agg(F.count("*").alias("video_count"), F.count_distinct(F.when(F.col("participant_known"), F.col("participant_id"))).alias("known_participants"), F.sum("duration_sec").alias("total_duration_sec"), F.percentile("duration_sec", F.lit(0.5)).alias("duration_median"))
    b = v.where("participant_known").groupBy("participant_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") >= 2).alias("multi_video_participants"))
    k = cand.agg(F.count_if(F.col("candidate_status") == "eligible").alias("eligible_videos"))
    s = bench.agg(F.count("*").alias("benchmark_videos"), F.count_distinct("participant_id").alias("benchmark_participants"))
    return a.join(F.broadcast(b)).join(F.broadcast(k)).join(F.broadcast(s))


def download_access(wanted: DataFrame, manifest: DataFrame, heads: DataFrame) -> DataFrame:
    """wanted (video_uid, in order) against a download manifest (video_uid, url) and the answers to HEAD (video_uid, code, error): status.

    A manifest that lists a video twice is an error: see `repeated_in_manifest`."""
    j = wanted.join(manifest.select("video_uid", "url"), "video_uid", "left").join(heads, "video_uid", "left")
    e = F.lower(F.coalesce("error", F.lit("")))
    status = (
        F.when(F.col("url").isNull(), "not_in_download_manifest")
        .when(F.col("code") == 200, "available")
        .when((F.col("code") == 403) | F.contains(e, F.lit("forbidden")) | F.contains(e, F.lit("accessdenied")), "forbidden")
        .when((F.col("code") == 404) | F.contains(e, F.lit("not found")) | F.contains(e, F.lit("nosuchkey")), "not_found")
        .otherwise("error")
    )
    return j.select("video_uid", "url", status.alias("status"))


def repeated_in_manifest(manifest: DataFrame) -> DataFrame:
    """Videos that a download manifest lists more than once, for `constraints.enforce` before `download_access`."""
    return manifest.groupBy("video_uid").agg(F.count("*").alias("n")).where("n > 1")
