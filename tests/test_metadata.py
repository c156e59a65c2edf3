"""Flat metadata rows from odd records, and the report over none."""

import json

from pyspark.sql import functions as F

from braid.operators import metadata


def rows(spark, *records, sets=()):
    df = spark.createDataFrame([(None if r is None else json.dumps(r),) for r in records], "j string").select(F.parse_json("j").alias("record"))
    return df, metadata.video_rows(df, spark.createDataFrame(list(sets), "video_uid string, concurrent_video_set_ids array<string>"))


def test_odd_records(spark):
    records = [
        {"video_uid": "plain", "duration_sec": 100, "fb_participant_id": 7, "scenarios": ["B", "a", " a ", "ß", None, ""], "video_metadata": {"fps": "x", "num_frames": 3.0, "audio_duration_sec": 50}, "video_components": [{"component_idx": 2}, {"component_idx": 0}, 5, {}]},
        {"video_uid": "odd", "duration_sec": "nan", "video_metadata": "none", "scenarios": "no list", "video_components": {"a": 1}, "redacted_intervals": "no list", "has_redacted_regions": 1},
        {"video_uid": "cut", "video_metadata": {"mp4_duration_sec": "10"}, "redacted_intervals": [{"start_sec": 8, "end_sec": 30}, {"start_sec": 0, "end_sec": 1}, {"start_sec": None, "end_sec": 5}, 3], "fb_participant_id": "***"},
        {"video_uid": "  "}, {}, [1], None,
    ]
    df, got = rows(spark, *records, sets=[("plain", ["s1", "s2"])])
    assert len(got.columns) == 40 and metadata.nameless(df).count() == 4
    by = {r.video_uid: r for r in got.collect()}
    assert sorted(by) == ["cut", "odd", "plain"]
    p, o, c = by["plain"], by["odd"], by["cut"]
    assert (p.participant_id, p.participant_known, p.duration_min, p.scenarios, p.fps, p.num_frames, p.audio_coverage_ratio) == ("EGO4D_P000007", True, 100 / 60, ["a", "B", "ß"], None, 3, 0.5)
    assert (p.component_count, p.component_indices, p.concurrent_video_set_count, p.redacted_duration_sec, p.redacted_ratio, p.redaction_measurement_status) == (4, [0, 2], 2, 0.0, 0.0, "none")
    assert (o.participant_known, o.duration_sec, o.scenarios, o.component_count, o.redaction_measurement_status, o.redacted_duration_sec, o.redacted_ratio) == (False, 0.0, [], 0, "missing_intervals", None, None)
    assert (c.participant_id, c.duration_sec, c.redacted_duration_sec, c.redacted_ratio, c.redaction_measurement_status) == ("EGO4D_UNKNOWN_cut", 10.0, 3.0, 0.3, "measured_flag_mismatch")


def test_report_of_nothing(spark):
    _, none = rows(spark, {"video_uid": "x"})
    none = none.limit(0)
    cand = none.select("video_uid", "participant_id", "duration_sec", F.lit("eligible").alias("candidate_status"))
    r = metadata.report(none, cand, cand, cand).first().asDict(True)
    assert r["video_count"] == r["known_participant_count"] == r["pilot_video_count"] == 0 and r["total_duration_sec"] == 0.0
    assert r["video_duration_sec_distribution"] == {"count": 0, "min": None, "p25": None, "median": None, "p75": None, "p90": None, "max": None}
    assert r["download_accessible_metadata_video_count"] is None and r["download_access_filter_applied"] is False
