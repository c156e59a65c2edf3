"""Whole flows: what they make of small inputs, what they refuse, and how they go on."""

import json

import pytest
from pyspark.sql import functions as F

from braid.flows import extraction, metadata_audit, reference_set
from braid.operators import audit
from braid.plans.flows import answered
from braid.sources.publication import Incomplete, PublishedSet
from braid.sources.workspace import folder


def variants(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "j string").select(F.parse_json("j").alias("record"))


def video(uid, person, seconds, **more):
    return {"video_uid": uid, "fb_participant_id": person, "duration_sec": seconds, "scenarios": ["Cooking "]} | more


def test_audit_is_published_whole(spark):
    videos = variants(spark, [video("a", 7, 600), video("b", "7", 480), video("c", 7, 500), video("d", None, 300), video("e", 8, 240)])
    sets = metadata_audit.concurrent_sets(variants(spark, [
        {"concurrent_video_set_id": 42, "videos": [{"video_uid": " a "}, {"video_uid": "c"}, {"video_uid": ""}, 3]}, {"concurrent_video_set_id": 9, "valid": False, "videos": [{"video_uid": "b"}]},
        {"valid": True, "videos": [{"video_uid": "b"}]}, {"concurrent_video_set_id": 1}, {"concurrent_video_set_id": "x", "videos": [{"video_uid": "c"}]},
    ]))
    assert {r.video_uid: r.concurrent_video_set_ids for r in sets.collect()} == {"a": ["42"], "c": ["42", "x"]}
    out = PublishedSet(spark, folder(spark))
    assert metadata_audit.publish(out, videos, sets, audit.Filters(300, 900, 0.2, 2, scenarios=("cooking",))) == 1
    why = {r.video_uid: (list(r.exclusion_reasons), r.eligible_videos, r.independent_eligible_videos) for r in out.read("candidate_videos").collect()}
    assert why["a"] == why["c"] == ([], 3, 2) and why["d"] == (["unknown_participant"], 0, 0) and why["e"][0] == ["not_enough_videos_for_cross_video_consistency", "duration_below_min"]
    bench = metadata_audit.participant_manifest(out.read("benchmark_manifest"), "EGO4D_P000007").collect()
    assert [(r.video_uid, r.benchmark_session_order) for r in bench] == [("a", 1), ("b", 2)]
    assert [tuple(r) for r in out.read("participant_manifest_index").select("participant_id", "video_count", "total_duration_sec", "manifest_file").collect()] == [("EGO4D_P000007", 2, 1080.0, "ego4d_p000007_all_videos.csv")]
    r = out.read("metadata_report").first()
    assert (r.video_count, r.concurrent_video_count, r.benchmark_video_count, json.loads(r.candidate_filter)["scenarios"]) == (5, 2, 2, ["cooking"])
    with pytest.raises(ValueError, match="more than once"):
        metadata_audit.publish(out, videos.unionAll(videos), sets)
    with pytest.raises(ValueError, match="negative"):
        metadata_audit.tables(videos, sets, pilot_videos=-1)
    assert out.version == 1


def test_audit_of_nothing(spark):
    none = variants(spark, [video("a", 7, 600)]).limit(0)
    got = metadata_audit.tables(none, metadata_audit.concurrent_sets(none))
    assert got["metadata_report"].first().video_count == 0 and all(t.count() == 0 for n, t in got.items() if n != "metadata_report")


def videos_of(spark):
    return spark.createDataFrame([("v35", "p1", 65.0), ("v4", "p2", 130.0)], "source_video_id string, participant_id string, duration_sec double")


def test_layers_are_joined_without_broadcasts(spark):
    """Small as their files are, tables of records don't pass through the driver."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    clips = spark.range(50).select(F.concat(F.lit("v1_s"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("clip_id"), F.lit("v1").alias("source_video_id"))
    parents = extraction.parents_of("micro", clips)
    requests = parents.select("record_id", F.lit(3).alias("attempt"), F.lit(1).alias("max_tokens"), F.lit("").alias("message"))
    steps = extraction.judged("micro", answered("micro", requests), parents)
    assert "Broadcast" not in plan(steps) and steps.where("accepted").count() == 50
    got = extraction.extract(videos_of(spark), answered)
    for x in got.values():
        assert "Broadcast" not in plan(x.accepted.join(x.parents, "record_id").join(x.records, "record_id"))


def test_layers_go_on_where_they_ended(spark):
    asked = []

    def ask(layer, requests):
        asked.append((layer, sorted((r.record_id, r.attempt, r.max_tokens, (r.message or "").split(":")[0]) for r in requests.collect())))
        return answered(layer, requests)

    root = folder(spark)
    with pytest.raises(Incomplete, match="v35_s000"):  # refused twice: cut off, then lacking a field
        extraction.extract(videos_of(spark), ask, extraction.Options(attempts=2), root)
    assert [x for x, _ in asked] == ["micro", "micro"]
    assert asked[1][1] == [("v35_s000", 2, 8192, "truncated"), ("v4_s003", 2, 8192, "truncated")]
    asked.clear()
    got = extraction.extract(videos_of(spark), ask, extraction.Options(attempts=3), root)
    assert asked[0] == ("micro", [("v35_s000", 3, 8192, "missing_required_field")])  # what was judged isn't asked again
    assert [x for x, _ in asked][1:] == ["window", "session"]
    old = {r.record_id: len(r.archived) for r in got["micro"].records.collect()}
    assert old["v35_s000"] == 2 and old["v4_s003"] == 1 and sum(old.values()) == 3
    evidence = {r.record_id: json.loads(r.evidence) for r in got["micro"].accepted.collect()}
    assert evidence["v4_s001"]["clip_id"] == "v4_s001" and evidence["v4_s001"]["source_video_id"] == "v4" and evidence["v4_s001"]["confidence"] == "high"
    window = {r.record_id: json.loads(r.parent) for r in got["window"].parents.collect()}
    assert window["v4_w000"]["micro_clip_ids"] == ["v4_s000", "v4_s001", "v4_s002", "v4_s003"] and "confidence" not in str(window["v4_w000"]["evidence"])
    assert {r.record_id: json.loads(r.parent)["duration_sec"] for r in got["session"].parents.collect()} == {"v35": 65.0, "v4": 130.0}
    assert {r.layer: (r.records, r.accepted, r.requests, r.blocking_issues) for r in extraction.report(got).collect()} == {"micro": (7, 7, 10, 0), "window": (3, 3, 3, 0), "session": (2, 2, 2, 0)}


def test_gaps(spark):
    o = extraction.Options(attempts=1, allow_missing=True)
    clips = spark.createDataFrame([(f"v{k}_s00{i}", f"v{k}", 0.0, 30.0, 30.0) for k, i in ((35, 1), (4, 0), (4, 3))], "clip_id string, source_video_id string, start_sec double, end_sec double, duration_sec double")
    parents = extraction.parents_of("micro", clips)
    silent = lambda layer, requests: answered(layer, requests).where("record_id not like 'v35%'")
    got = extraction.run_layer("micro", parents, silent, o)
    assert {r.record_id for r in got.accepted.collect()} == {"v4_s000"}
    assert {(r.record_id, r.code) for r in got.issues.where("severity = 'blocking'").collect()} == {("v35_s001", "missing_model_output"), ("v4_s003", "missing_model_output")}
    with pytest.raises(ValueError, match="more than once"):
        extraction.run_layer("micro", parents, lambda layer, r: answered(layer, r).unionAll(answered(layer, r)), o)
    with pytest.raises(ValueError, match="an id of their own"):
        extraction.parents_of("micro", clips.withColumn("clip_id", F.lit(" ")))
    for bad in ({"attempts": 0}, {"clip_sec": 0}, {"least_tail_sec": 31}, {"tokens": (9000, 1, 1)}):
        with pytest.raises(ValueError):
            extraction.Options(**bad)


def test_reference_set(spark):
    ranges = "array<struct<start_sec:double,end_sec:double>>"
    rows = [("s1", "a", "claim a", []), ("s1", "b", "claim b", ["single_window_support"]), ("s2", "c", "claim c", [])]
    cand = spark.createDataFrame([(s, c, "p", "t", x, "", [], [(0.0, 10.0)], f) for s, c, x, f in rows], f"source_video_id string, candidate_id string, participant_id string, type string, claim string, observed_value string, supporting_window_ids array<string>, support {ranges}, flags array<string>")
    asked = cand.select("source_video_id", "candidate_id")

    def line(source, *results, code=200):
        body = {"verification_results": [{"candidate_id": c, "verdict": v, "evidence_time_ranges": [{"start_sec": 1, "end_sec": 2}]} for c, v in results]}
        return (json.dumps({"custom_id": source, "response": {"status_code": code, "body": {"choices": [{"message": {"content": json.dumps(body)}}]}}}),)

    lines = lambda *x: spark.createDataFrame(list(x), "value string")
    out = PublishedSet(spark, folder(spark))
    one = line("s1", ("a", "entailed"), ("b", "entailed"))
    with pytest.raises(Incomplete):
        reference_set.first_pass(out, cand, asked, lines(one, line("s2", ("c", "contradicted"), code=500)))
    assert [tuple(r) for r in out.read("retry_queue").collect()] == [("s2", "http_500")] and "merged" not in out.tables and out.read("human_review").count() == 0
    for bad in (line("s2"), line("s2", ("c", "maybe")), line("s2", ("c", "entailed"), ("z", "entailed"))):
        with pytest.raises(ValueError):
            reference_set.first_pass(out, cand, asked, lines(one, bad))
    with pytest.raises(ValueError, match="answered more than once"):
        reference_set.first_pass(out, cand, asked, lines(one, one))
    reference_set.first_pass(out, cand, asked, lines(one, line("s2", ("c", "contradicted"))))
    assert {r.candidate_id: r.qc_status for r in out.read("merged").collect()} == {"a": "verification_passed", "b": "human_review_required", "c": "verification_disputed"}
    sheet = out.read("human_review").selectExpr("source_video_id", "candidate_id", "'接受修正' as decision", "' better b' as approved_claim", "review_fingerprint as fingerprint", "claim", "'n' as human_notes")
    final = PublishedSet(spark, folder(spark))
    for bad in (sheet.withColumn("fingerprint", F.lit("old")), sheet.withColumn("claim", F.lit("other")), sheet.withColumn("candidate_id", F.lit("a")), sheet.unionAll(sheet), sheet.withColumn("approved_claim", F.lit(" "))):
        with pytest.raises(ValueError, match="can't stand"):
            reference_set.finalise(final, out.read("merged"), bad)
    assert final.version == 0
    reference_set.finalise(final, out.read("merged"), sheet)
    assert sorted((r.reference_id, r.claim, r.original_claim, r.human_notes) for r in final.read("reference_ready").collect()) == [("s1:a", "claim a", None, None), ("s1:b", "better b", "claim b", "n")]
    assert [r.reference_id for r in final.read("unresolved").collect()] == ["s2:c"] and final.read("rejected").count() == 0
