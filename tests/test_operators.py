"""Operators of the library: small fixtures with known results, and sequential models written here."""

import json
import random

import pytest
from pyspark.sql import functions as F

from braid.functions import columns as c
from braid.functions import jsontext
from braid.operators import audit, constraints, evidence, intervals, lookups, normalise, qc, ranking, rules
from braid.sources import adapters, io
from braid.streaming import incremental


def one(spark, **cols):
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first().asDict()


def span(pairs):
    return F.array(*[F.struct(F.lit(float(a)).alias("start_sec"), F.lit(float(b)).alias("end_sec")) for a, b in pairs]) if pairs else F.array().cast("array<struct<start_sec:double,end_sec:double>>")


# --- functions


def test_columns(spark):
    got = one(
        spark,
        number=c.participant_key(F.lit("7"), F.lit("v")),
        name=c.participant_key(F.lit("Ann B!"), F.lit("v")),
        unknown=c.participant_key(F.lit(" "), F.lit("v")),
        p=c.canonical_participant(F.lit("p4")),
        ego=c.canonical_participant(F.lit("ego4d_p10")),
        unsafe=c.canonical_participant(F.lit("a/b")),
        slug=c.slug(F.lit("_Ab c/D._")),
        wide=c.numbered(F.lit("v"), "s", F.lit(1000)),
        clock=c.clock_seconds(F.lit("01:02:03.5")),
        noclock=c.clock_seconds(F.lit("02:03")),
        rel=c.relative_seconds(F.lit("75:04.5")),
        norel=c.relative_seconds(F.lit("1:60")),
        trim=c.trimmed_number(F.lit(100.0)),
        trim2=c.trimmed_number(F.lit(12.5)),
        fps=c.frame_rate(F.lit("0/0")),
        stem=c.stem(F.lit("/a/b_540p16.mp4"), ["_540p16"]),
        url=c.url_path(F.lit("http://x.org/a%20b/c.mp4?z=1#t")),
        inf=c.safe_double(F.lit("inf")),
        seven=c.safe_long(F.lit("7.0")),
        marker=c.first_marker(F.lit("AWS: Token Expired"), ["denied", "token expired"], "aws"),
        log=c.log_duration(F.lit("x Duration: 00:01:02.50, start")),
    )
    assert got == {
        "number": "EGO4D_P000007", "name": "EGO4D_P_Ann_B", "unknown": "EGO4D_UNKNOWN_v", "p": "P04", "ego": "EGO4D_P000010", "unsafe": None, "slug": "ab_c_d", "wide": "v_s1000",
        "clock": 3723.5, "noclock": None, "rel": 4504.5, "norel": None, "trim": "100", "trim2": "12.5", "fps": 0.0, "stem": "b", "url": "/a b/c.mp4", "inf": None, "seven": None, "marker": "token expired", "log": 62.5,
    }


def test_json(spark):
    assert jsontext.minutes_to_seconds('{"start_sec": 4:55.0, "note": "4:55"}') == '{"start_sec": 295.0, "note": "4:55"}'
    rows = [("a", '```json\n{"x": 1}\n```', "stop"), ("b", 'so {"start_sec": 1:05} ok', "stop"), ("c", '{"x": [1, 2', "length"), ("d", "none", "stop")]
    got = {r.record_id: (r.status, r.json_text) for r in jsontext.cleaned(spark.createDataFrame(rows, "record_id string, content string, finish_reason string")).collect()}
    assert got == {"a": ("ok", '{"x": 1}'), "b": ("repaired", '{"start_sec": 65.0}'), "c": ("truncated", None), "d": ("invalid", None)}
    ok = {"custom_id": "1", "response": {"status_code": 200, "body": {"choices": [{"message": {"content": '{"a": 1}'}}]}}}
    lines = [json.dumps(ok), json.dumps(ok | {"error": {"code": 5}}), json.dumps({"custom_id": "2", "response": {"status_code": 500}}), "{", json.dumps({"custom_id": "3", "response": {"status_code": 200, "body": {"choices": []}}})]
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(jsontext.batch_response("line").alias("r")).select("r.*")
    got = [(r.payload, (r.error or "").split(":")[0]) for r in df.collect()]
    assert got == [('{"a": 1}', ""), (None, "error"), (None, "http_500"), (None, "malformed_line"), (None, "no_choices")]
    nested = spark.createDataFrame([('{"b":{"z":1,"a":[1e7,"é"]},"a":null}',)], "j string")
    import hashlib

    want = hashlib.sha256('{"a":null,"b":{"a":[10000000.0,"é"],"z":1}}'.encode()).hexdigest()
    assert jsontext.canonical_sha256(nested, "j").first().fingerprint == want


# --- intervals and ranking


def test_interval_union(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(100), rng.randrange(100)) for g in range(40) for _ in range(rng.randrange(12))]
    got = {r.g: r.covered for r in intervals.union_length(spark.createDataFrame(rows, "g int, a int, b int"), ["g"], "a", "b").collect()}
    for g in {g for g, a, b in rows if b > a}:
        assert got[g] == len({t for q, a, b in rows if q == g for t in range(a, b)})
    assert one(spark, x=intervals.array_union_length(span([(10, 20), (15, 25), (599, 620)]), F.lit(0.0), F.lit(600.0)))["x"] == 16.0


def test_overlap(spark):
    got = one(spark, a=intervals.overlaps(span([(0, 5)]), span([(5, 9)])), b=intervals.overlaps(span([(3, 3)]), span([(0, 9)])), c=intervals.overlaps(span([(0, 5), (8, 10)]), span([(9, 20)])), d=intervals.overlaps(span([]), span([(0, 1)])))
    assert got == {"a": False, "b": False, "c": True, "d": False}
    rng = random.Random(2)
    mk = lambda n: [(rng.randrange(3), i, float(rng.randrange(300)), float(rng.randrange(300))) for i in range(n)]
    a, b = mk(60), mk(60)
    df = lambda x: spark.createDataFrame(x, "k int, id int, s double, e double")
    want = {(x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[3] > x[2] and y[3] > y[2] and max(x[2], y[2]) < min(x[3], y[3])}
    j = intervals.overlap_join(df(a), df(b), ["k"], "s", "e", 40.0).collect()
    assert {(r.id, r.right_id) for r in j} == want and len(j) == len(want)
    semi = intervals.overlap_join(df(a), df(b), ["k"], "s", "e", 40.0, "left_semi").collect()
    twice = intervals.overlap_join(df(a).unionByName(df(a)), df(b), ["k"], "s", "e", 40.0, "left_semi").collect()
    assert sorted(map(tuple, twice)) == sorted(map(tuple, semi + semi))
    assert {r.id for r in semi} == {x for x, _ in want}


def split_model(d, length, tail):
    out, s = [], 0.0
    while s < d:
        e = min(s + length, d)
        if d - e < tail and d - e > 0:
            e = d
        if out and e - s < tail:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
        s = e
    return out


def test_split_sample_and_shift(spark):
    ds = [0.0, 5.0, 30.0, 31.0, 39.9, 40.0, 44.64, 60.0, 69.0, 70.5, 3599.0]
    got = spark.createDataFrame([(d,) for d in ds], "d double").select("d", intervals.pieces(F.col("d"), 30.0, 10.0).alias("p")).collect()
    for r in got:
        assert [(p.start_sec, p.end_sec) for p in r.p] == split_model(r.d, 30.0, 10.0), r.d
    with pytest.raises(ValueError):
        intervals.pieces(F.col("d"), 30.0, 60.0)
    for n, k in ((100, 16), (5, 16), (17, 16), (9, 1), (7, 3)):
        s = one(spark, s=intervals.uniform_sample(F.sequence(F.lit(0), F.lit(n - 1)), k))["s"]
        assert s == (list(range(n)) if n <= k else [n // 2] if k == 1 else [round(i * (n - 1) / (k - 1)) for i in range(k)])
    assert one(spark, g=intervals.grid_cells(span([(0, 30), (29, 61), (5, 5)]), 30))["g"] == [0, 1, 2]
    b = one(spark, b=intervals.review_bounds(F.lit(38.0), 30.0, 10.0, F.lit(1141.76)))["b"]
    assert (round(b.start_sec, 2), b.end_sec) == (1111.76, 1141.76)


def test_ranking(spark):
    rng = random.Random(3)
    rows = [(g, i, [rng.randrange(9) for _ in range(rng.randrange(3))]) for g in range(25) for i in range(rng.randrange(1, 9))]
    got = {r.g: r.kept for r in ranking.conflict_free(spark.createDataFrame(rows, "g int, i int, s array<bigint>"), ["g"], "i", "s").collect()}
    for g in {r[0] for r in rows}:
        used, kept = set(), []
        for _, i, s in sorted(r for r in rows if r[0] == g):
            if not used & set(s):
                kept.append(i)
                used |= set(s)
        assert got[g] == kept
    e = spark.createDataFrame([(x,) for x in ("P2", "EGO4D_P000010", "P10", "zed", "EGO4D_P000009")], "p string")
    assert [r.p for r in e.orderBy(ranking.natural_key("p")).collect()] == ["P2", "P10", "EGO4D_P000009", "EGO4D_P000010", "zed"]
    m = spark.createDataFrame([("a", 0, "a0"), ("a", 30, "a1"), ("a", 60, "a2"), ("b", 30, "b1"), ("b", 0, "b0")], "v string, s int, id string")
    assert {r.id for r in ranking.midpoint(m, ["v"], ["s", "id"]).collect()} == {"a1", "b1"}
    assert {r.v: r.contiguous for r in ranking.contiguous(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 3)], "v string, o int"), ["v"], "o").collect()} == {"a": True, "b": False}
    g = ranking.numbered_globally(m, [F.col("v"), F.col("s")], "n", ["v"])
    assert [r.n for r in g.orderBy("v", "s").collect()] == [1, 2, 3, 4, 5]


# --- constraints, sources


def test_constraints(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (" ", 5)], "k string, v int")
    assert {r.k for r in constraints.duplicates(df, ["k"], blanks=True).collect()} == {"a", None, " "}
    with pytest.raises(ValueError, match="keys: "):
        constraints.enforce(constraints.duplicates(df, ["k"]), "keys")
    constraints.enforce(df.where("false"), "nothing")
    up = constraints.upsert(df.where("k = 'a'"), spark.createDataFrame([("a", 9, "x")], "k string, v int, w string"), ["k"])
    assert [tuple(r) for r in up.select("k", "v", "w").collect()] == [("a", 9, "x")]
    keep, drop = constraints.retain(df, spark.createDataFrame([("A",)], "k string"), "k")
    assert keep.count() == 2 and drop.count() == 3
    ok = constraints.complete(spark.createDataFrame([(True,), (True,)], "accepted boolean"), 2).first()
    assert ok.complete and ok.rejected == 0


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("v1", 1.5, None, True, ["a", "b"]), ('q"x', 2.0, "é", False, [])], "id string, d double, t string, b boolean, l array<string>")
    p = str(tmp_path / "t.csv")
    io.write_csv(df, p, ["id", "d", "t", "b", "l", "extra"])
    back = io.csv(spark, p)
    assert back.columns == ["id", "d", "t", "b", "l", "extra"]
    assert {r.id: (r.d, r.b, r.l) for r in back.collect()} == {"v1": ("1.5", "true", "a|b"), 'q"x': ("2", "false", None)}
    assert io.csv(spark, str(tmp_path / "none.csv"), ["a"]).count() == 0
    j = str(tmp_path / "t.jsonl")
    io.write_jsonl(df, j, "id")
    with pytest.raises(ValueError, match="too long"):
        io.write_jsonl(df, j, "id", most=10)
    assert [r.d for r in io.jsonl(spark, j, "id string, d double").collect() if r._corrupt_record is None] in ([1.5, 2.0], [2.0, 1.5])
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "r1.clean.json").write_text('{"a": 1}')
    (tmp_path / "docs" / "r2.clean.json").write_text("{")
    d = {r.record_id: r.ok for r in io.documents(spark, str(tmp_path / "docs")).selectExpr("record_id", "record is not null as ok").collect()}
    assert d == {"r1": True, "r2": False}
    assert {r.record_id for r in io.document_ids(spark, str(tmp_path / "docs")).collect()} == {"r1", "r2"}
    with pytest.raises(ValueError):
        io.lookup(spark.createDataFrame([("r9",)], "record_id string"), io.documents(spark, str(tmp_path / "docs")))
    reqs = tmp_path / "req.jsonl"
    reqs.write_text('{"custom_id": "1", "method": "POST", "body": {}}\n\n{"custom_id": "1", "method": "GET", "body": []}\n')
    rows, bad = io.requests(spark, str(reqs))
    assert rows.count() == 2 and {r.code for r in bad.collect()} == {"bad_method", "bad_body", "bad_custom_id"}
    t = str(tmp_path / "table")
    for k in range(2):
        io.upsert_table(spark, t, spark.createDataFrame([("a", k), (f"n{k}", k)], "k string, v int"), ["k"])
    assert {tuple(r) for r in spark.read.parquet(t).collect()} == {("a", 1), ("n0", 0), ("n1", 1)}
    done = []
    assert not io.publish(df, {"x": lambda: done.append("x")}, lambda: done.append("report")) and done == ["report"]
    assert io.publish(df.where("false"), {"x": lambda: done.append("x")}, lambda: done.append("report")) and done == ["report", "x", "report"]
    for n, rows in (("a", "participant_id,video_uid\nP1,x\n"), ("b", "participant_id,video_uid\np1,y\n"), ("c", "participant_id,video_uid\nP2,z\nP3,w\n")):
        (tmp_path / f"{n}_all_videos.csv").write_text(rows)
    m = {r.file[-16:-15]: r.valid for r in io.manifests(spark, str(tmp_path / "*_all_videos.csv")).collect()}
    assert not any(m.values()) and len(m) == 3
    v = io.manifest_violations(spark.createDataFrame([("x",), ("x",), ("a/b",)], "video_uid string"), ["video_uid", "duration"])
    assert {r.code for r in v.collect()} == {"missing_column", "duplicate_id", "unsafe_id"}
    (tmp_path / "log").write_bytes(b"0123456789\xff")
    assert io.log_tail(str(tmp_path / "log"), 2, 5) == "6789�"
    io.bundle(str(tmp_path / "docs"), str(tmp_path / "o.tar.gz"))
    with pytest.raises(FileExistsError):
        io.bundle(str(tmp_path / "docs"), str(tmp_path / "o.tar.gz"))
    assert io.redacted(spark.createDataFrame([(1, 2)], "API_KEY int, x int")).columns == ["x"]


# --- audit


def root(spark):
    video = lambda uid, p, d, **k: {"video_uid": uid, "duration_sec": d, "scenarios": ["Cooking "], "fb_participant_id": p, "has_redacted_regions": False, "redacted_intervals": [], "video_metadata": {"audio_duration_sec": 590.0, "video_duration_sec": d}, "video_components": []} | k
    doc = {
        "videos": [
            video("video-a", "7", 600.0, has_redacted_regions=True, redacted_intervals=[{"start_sec": 10.0, "end_sec": 20.0}, {"start_sec": 15.0, "end_sec": 25.0}, {"start_sec": 599.0, "end_sec": 620.0}], video_components=[{"component_idx": 1}, {"component_idx": 0}]),
            video("video-b", "7", 480.0, video_metadata={"audio_duration_sec": None, "video_duration_sec": 480.0}),
            video("video-c", None, 300.0), video("video-d", None, 300.0), video("video-e", "8", 240.0),
        ],
        "concurrent_video_sets": [
            {"concurrent_video_set_id": 42, "valid": True, "videos": [{"video_uid": "video-a"}, {"video_uid": "video-c"}]},
            {"concurrent_video_set_id": 99, "valid": False, "videos": [{"video_uid": "video-b"}]},
        ],
    }
    schema = (
        "videos array<struct<video_uid string, duration_sec double, scenarios array<string>, video_metadata struct<fps double, num_frames bigint, video_codec string, display_resolution_width int, display_resolution_height int, "
        "sample_resolution_width int, sample_resolution_height int, mp4_duration_sec double, video_duration_sec double, audio_duration_sec double>, s3_path string, origin_video_id string, video_source string, device string, physical_setting_name string, "
        "fb_participant_id string, is_stereo boolean, has_imu boolean, has_gaze boolean, video_components array<struct<component_idx int>>, has_redacted_regions boolean, redacted_intervals array<struct<start_sec double, end_sec double>>>>, "
        "concurrent_video_sets array<struct<concurrent_video_set_id bigint, valid boolean, videos array<struct<video_uid string>>>>"
    )
    return spark.createDataFrame([(json.dumps(doc),)], "j string").select(F.from_json("j", schema).alias("r")).select("r.*")


def test_audit(spark):
    v = audit.videos(root(spark)).cache()
    a = {r.video_uid: r for r in v.collect()}
    x = a["video-a"]
    assert (x.participant_id, x.component_indices, round(x.audio_coverage, 6), x.redacted_sec, x.redaction_status, x.concurrent_video_set_ids) == ("EGO4D_P000007", [0, 1], round(590 / 600, 6), 16.0, "measured", [42])
    assert a["video-c"].audio_coverage == 1.0 and a["video-b"].concurrent_video_set_ids == []
    p = {r.participant_id: r for r in audit.participants(v).collect()}
    assert len(p) == 4 and p["EGO4D_P000007"].multi_video_eligible and not p["EGO4D_UNKNOWN_video-c"].multi_video_eligible
    f = audit.Filters(300, 900, 0.2, 2, scenarios=("cooking",))
    cand = audit.candidates(v, f).cache()
    why = {r.video_uid: list(r.exclusion_reasons) for r in cand.collect()}
    assert why == {"video-a": [], "video-b": [], "video-c": ["unknown_participant"], "video-d": ["unknown_participant"], "video-e": ["not_enough_videos_for_cross_video_consistency", "duration_below_min"]}
    b = audit.benchmark(cand)
    assert [(r.video_uid, r.benchmark_session_order, r.benchmark_temporal_evolution_eligible) for r in b.orderBy("video_uid").collect()] == [("video-a", 1, True), ("video-b", 2, True)]
    assert [r.video_uid for r in audit.pilot(b, 1, 2).orderBy("global_rank").collect()] == ["video-a", "video-b"]
    r = audit.report(v, cand, b).first()
    assert (r.video_count, r.known_participants, r.multi_video_participants, r.benchmark_videos, r.duration_median) == (5, 2, 1, 2, 300.0)
    gone = audit.candidates(v, f, spark.createDataFrame([("video-a",)], "video_uid string"))
    assert {r.video_uid: r.exclusion_reasons[0] for r in gone.collect()}["video-b"] == "unavailable_in_download_access_audit"
    with pytest.raises(ValueError):
        audit.Filters(900, 300)
    s = audit.scenarios(v).first()
    assert (s.video_count, s.known_participants) == (5, 2)


# --- evidence


def test_windows_and_sessions(spark):
    clips = spark.createDataFrame([(f"P30_01_s{i:03d}", "P30_01", "P30", a, b, json.dumps({"clip_id": f"s{i}", "confidence": "high", "nested": {"trackability": "high", "evidence": "画面可见"}}, ensure_ascii=False)) for i, (a, b) in enumerate([(0.0, 30.0), (30.0, 60.0), (60.0, 90.0), (90.0, 120.0), (120.0, 135.0)])], "clip_id string, source_video_id string, participant_id string, start_sec double, end_sec double, evidence string")
    plain = evidence.without_keys(clips, "evidence")
    w = evidence.windows(plain).orderBy("window_id").collect()
    assert [(r.window_id, r.start_sec, r.end_sec, len(r.micro_clip_ids)) for r in w] == [("P30_01_w000", 0.0, 120.0, 4), ("P30_01_w001", 120.0, 135.0, 1)]
    assert w[0].evidence[0] == '{"clip_id":"s0","nested":{"evidence":"画面可见"}}'
    s = evidence.sessions(evidence.windows(plain).withColumn("evidence", F.to_json("evidence"))).first()
    assert s.session_id == "P30_01" and s.window_ids == ["P30_01_w000", "P30_01_w001"]
    cut = evidence.cut(spark.createDataFrame([("v", 75.0)], "source_video_id string, duration_sec double"))
    assert [(r.clip_id, r.end_sec) for r in cut.orderBy("clip_id").collect()] == [("v_s000", 30.0), ("v_s001", 60.0), ("v_s002", 75.0)]


def test_review_clips_are_shared(spark):
    items = spark.createDataFrame([("v", "c1", 0, "P", 1000.0, [(0.0, 60.0)]), ("v", "c2", 1, "Q", 1000.0, [(30.0, 45.0)])], "source_video_id string, candidate_id string, item_pos int, participant_id string, duration_sec double, support array<struct<start_sec:double,end_sec:double>>")
    got = {r.cell: (list(r.candidate_ids), r.participant_id, r.clip_id) for r in evidence.review_clips(items).collect()}
    assert got == {0: (["c1"], "P", "v_qc_s00000"), 1: (["c1", "c2"], "P", "v_qc_s00001")}


# --- rules


def micro(**k):
    base = {"clip_id": "c1", "source_video_id": "v", "clip_time_range": {"start_sec": 0, "end_sec": 30}, "clip_summary": "s", "places": [{"place_id": "p1", "evidence_times": ["0:01"], "confidence": "high"}],
            "objects": [{"object_id": "o1", "name": "杯子", "category": "tool", "first_seen": "0:01", "last_seen": "0:05", "confidence": "high"}],
            "atomic_events": [{"event_id": "e1", "time_range": "0:01-0:03", "place_id": "p1", "object_ids": ["o1"], "confidence": "low"}], "state_observations": [], "state_changes": [], "end_state": [], "uncertainties": []}
    return base | k


def codes(spark, layer, record, parent, **kw):
    df = spark.createDataFrame([("r", json.dumps(record, ensure_ascii=False), json.dumps(parent))], "record_id string, r string, p string")
    v = rules.validate(layer, df.select("record_id", F.parse_json("r").alias("record")), df.select("record_id", F.parse_json("p").alias("parent")), **kw)
    return sorted(r.code for r in rules.issue_log(v, layer).collect()), v


PARENT = {"clip_id": "c1", "source_video_id": "v", "start_sec": 0, "end_sec": 30}


MICRO = [
    ({}, []),
    ({"places": None}, ["invalid_field_type", "unknown_place_reference"]),
    ({"objects": [{"object_id": f"o{i}", "first_seen": "0:01", "last_seen": "0:02"} for i in range(1, 8)]}, ["count_limit_exceeded"]),
    ({"objects": [{"object_id": "o1", "first_seen": "0:09", "last_seen": "0:02"}]}, ["invalid_relative_time"]),
    ({"places": [{"place_id": "p1", "evidence_times": ["0:31"]}]}, ["relative_time_out_of_bounds"]),
    ({"places": [{"place_id": "p1"}, {"place_id": "p1"}, {"place_id": ""}]}, ["duplicate_local_id", "missing_local_id"]),
    ({"atomic_events": [{"event_id": "e1", "time_range": "0:03-0:03", "place_id": "", "object_ids": ["zz"], "confidence": "sure"}]}, ["invalid_confidence", "unknown_object_reference", "zero_duration_range"]),
    ({"clip_time_range": {"start_sec": 1, "end_sec": 30}}, ["clip_time_range_mismatch"]),
    ({"source_video_id": "other"}, ["identity_field_normalized"]),
    ({"objects": [{"object_id": "o1", "name": "平底锅", "category": "clothing", "first_seen": "0:01", "last_seen": "0:02", "initial_state": "open"}]}, ["inconsistent_object_category", "non_chinese_state_token", "unreferenced_clothing_object"]),
    ({"end_state": [{"entity_id": "o1", "evidence_time": "0:05"}, {"entity_id": "o1", "evidence_time": "0:02"}]}, ["non_monotonic_time_order"]),
    ({"uncertainties": ["text"]}, ["invalid_item", "invalid_relative_time"]),
]


def test_micro_rules(spark):
    rows = [(f"r{i:02d}", json.dumps(micro(**change), ensure_ascii=False), json.dumps(PARENT)) for i, (change, _) in enumerate(MICRO)]
    df = spark.createDataFrame(rows, "record_id string, r string, p string")
    v = rules.validate("micro", df.select("record_id", F.parse_json("r").alias("record")), df.select("record_id", F.parse_json("p").alias("parent")))
    got = {}
    for r in rules.issue_log(v, "micro").collect():
        got.setdefault(r.record_id, []).append(r.code)
    for i, (_, want) in enumerate(MICRO):
        assert sorted(got.get(f"r{i:02d}", [])) == want, i


def test_missing_field_and_parent(spark):
    r = micro()
    del r["clip_summary"]
    got, v = codes(spark, "micro", r, PARENT)
    assert got == ["missing_required_field"] and not v.first().accepted
    df = spark.createDataFrame([("a", "{}")], "record_id string, j string").select("record_id", F.parse_json("j").alias("record"))
    par = spark.createDataFrame([("b", "{}")], "record_id string, j string").select("record_id", F.parse_json("j").alias("parent"))
    log = {r.record_id: r.code for r in rules.issue_log(rules.validate("micro", df, par), "micro").collect()}
    assert log == {"a": "missing_parent_metadata", "b": "missing_model_output"}
    s = rules.summary(codes(spark, "micro", micro(), PARENT)[1], "micro").first()
    assert s.schema_status == "passed" and s.confidence_distribution == {"high": 2, "low": 1}


def test_session_rules(spark):
    rec = {k: [] for k in rules.LIMITS["session"]} | {"session_id": "s", "source_video_id": "v", "participant_id": "P", "time_range": {}, "session_summary": ""}
    rec["session_entities"] = [{"entity_id": "e1", "supporting_window_ids": ["w0"]}]
    rec["cross_session_evidence_candidates"] = [
        {"candidate_id": "c1", "type": "stable_layout", "claim": "他通常如此", "supporting_window_ids": ["w0"], "entity_ids": ["e1"], "confidence": "high"},
        {"candidate_id": "c2", "type": "event", "claim": "x", "supporting_window_ids": ["w9"], "entity_id": "zz"},
        {"candidate_id": "c3", "type": "event", "claim": "y", "supporting_window_ids": ["w0", "w1"], "entity_id": "e1", "confidence": "high"},
    ]
    rec["contradictions_or_uncertainties"] = [{"affected_candidate_ids": ["c3", "nope"]}]
    got, v = codes(spark, "session", rec, {"session_id": "s", "source_video_id": "v", "participant_id": "P", "window_ids": ["w0", "w1"]})
    assert got == ["affected_by_uncertainty", "long_term_overclaim", "single_window_support", "unknown_candidate_reference", "unknown_entity_reference", "unknown_window_reference"]
    cs = {x.candidate_id: (list(x.quality_flags), x.normalized_confidence, x.qc_status) for x in v.first().candidates}
    assert cs == {
        "c1": (["long_term_overclaim", "single_window_support"], "high", "schema_passed"),
        "c2": (["unknown_entity_reference", "unknown_window_reference"], "low", "schema_failed"),
        "c3": (["affected_by_uncertainty"], "medium", "schema_passed"),
    }


def test_window_rules(spark):
    rec = {k: [] for k in rules.LIMITS["window"]} | {"window_id": "w", "source_video_id": "v", "time_range": {}, "window_summary": ""}
    rec["entity_map"] = [{"entity_id": "e1", "supporting_clip_ids": ["c1", "c9"]}]
    rec["state_changes"] = [{"entity_id": "e2", "supporting_event_ids": ["ev"]}]
    rec["conflicts_or_uncertainties"] = [{"affected_fact_ids": ["f"]}]
    assert codes(spark, "window", rec, {"window_id": "w", "source_video_id": "v", "micro_clip_ids": ["c1"]})[0] == ["unknown_clip_reference", "unknown_entity_reference", "unknown_event_reference", "unknown_fact_reference"]


# --- review


def test_decisions(spark):
    rev = spark.createDataFrame([("a", "human_review_required", "f1"), ("b", "verification_passed", "f2")], "candidate_id string, qc_status string, fingerprint string")
    dec = spark.createDataFrame([("a", "accept", "old", None), ("b", "accept", "f2", None), ("c", "maybe", "x", None), ("a", "accept_corrected", "f1", " "), ("b", "", "f2", None)], "candidate_id string, decision string, fingerprint string, approved_claim string")
    got = {(r.candidate_id, r.code) for r in qc.decision_violations(rev, dec, ["candidate_id"]).collect()}
    assert got == {("a", "stale_fingerprint"), ("b", "not_in_review"), ("c", "unknown_candidate"), ("c", "unknown_decision"), ("a", "missing_approved_claim"), ("a", "duplicate_decision")}


def test_support_ranges_and_bad_verdicts(spark):
    cand = spark.createDataFrame([("c", ["w1", "w0"])], "candidate_id string, ids array<string>")
    rng = spark.createDataFrame([("w0", 0.0, 120.0), ("w1", 120.0, 240.0)], "window_id string, start_sec double, end_sec double")
    assert [r.start_sec for r in qc.support_ranges(cand, rng, ["candidate_id"], "ids", "window_id").first().support] == [120.0, 0.0]
    v = spark.createDataFrame([("a", True, "perhaps"), ("b", False, None), ("c", True, "entailed")], "candidate_id string, requested boolean, verdict string")
    assert [r.candidate_id for r in qc.bad_verdicts(v, ["candidate_id"]).collect()] == ["a"]


# --- adapters and streams


def test_adapters(spark):
    req = spark.createDataFrame([(f"r{i}", f"p{i}") for i in range(20)], "request_id string, payload string")
    done, left = adapters.until_complete(req, lambda r, n: adapters.execute(r, adapters.FakeClient(("r3",) if n < 2 else ()), 1), 3)
    assert done.count() == 20 and left.isEmpty()
    now = [0.0]
    lim = adapters.RateLimit(2, 60.0, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(5):
        lim.acquire()
    assert now[0] == 120.0
    assert adapters.retry_delay(3, "7") == 7.0 and 4.0 <= adapters.retry_delay(3, "soon") < 5.0 and adapters.retry_delay(99) < 61.0


def test_streams(spark, tmp_path):
    src, log, snap = (str(tmp_path / x) for x in ("in", "log", "snap"))
    schema = "k string, seq bigint, ts timestamp"
    put = lambda rows: spark.createDataFrame([(k, s, None) for k, s in rows], schema).withColumn("ts", F.timestamp_seconds(F.col("seq") * 60)).write.mode("append").parquet(src)
    put([("a", 1), ("b", 2)])
    for _ in range(2):
        incremental.append(incremental.arrivals(spark, src, schema), log, str(tmp_path / "c1")).awaitTermination(60)
        incremental.snapshot(incremental.arrivals(spark, src, schema), snap, str(tmp_path / "c2"), ["k"], ["seq"]).awaitTermination(60)
        put([("a", 5)])
    incremental.snapshot(incremental.arrivals(spark, src, schema), snap, str(tmp_path / "c2"), ["k"], ["seq"]).awaitTermination(60)
    assert {(r.k, r.seq) for r in spark.read.parquet(snap).collect()} == {("a", 5), ("b", 2)}
    assert spark.read.parquet(log).count() == 3
    q = incremental.tumbling(incremental.arrivals(spark, src, schema), "ts", "2 minutes", ["k"], "1 minute", "seq").writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sum(r.n for r in spark.sql("select n from tumbled").collect()) == 4


def test_normalised(spark):
    rec = micro(objects=[{"object_id": "o1", "name": "煎锅", "category": "food", "initial_state": " Opened "}], end_state=[{"n": 1, "evidence_time": "0:09"}, {"n": 2, "evidence_time": "0:02"}], state_changes=[{"time_range": "0:09-0:10"}, {"time_range": "x"}], extra={"deep": [1]})
    df = spark.createDataFrame([(json.dumps(rec), json.dumps(PARENT | {"source_video_id": "w"})), ("[1]", "{}"), (None, None)], "record string, parent string")
    got = [r.normalised for r in normalise.normalised(df, "micro").collect()]
    x = json.loads(got[0])
    assert got[1:] == [None, None] and x["source_video_id"] == "w" and x["extra"] == {"deep": [1]}
    assert (x["objects"][0]["category"], x["objects"][0]["initial_state"]) == ("tool", "打开")
    assert [e["n"] for e in x["end_state"]] == [2, 1] and [e["time_range"] for e in x["state_changes"]] == ["0:09-0:10", "x"]


# --- lookups


def test_lookups(spark):
    df = spark.createDataFrame([("P01_101", "P01"), ("P02_07", "P02"), ("P03", "P03")], "video_id string, participant_id string")
    splits = spark.createDataFrame([("P02_07", "test"), ("P02_07", " "), ("P03", "")], "video_id string, split string")
    got = lookups.lookup(df, splits, ["video_id"], "split").select("video_id", lookups.remote_object("video_id", "split").alias("o"), lookups.video_sequence("video_id").alias("n")).orderBy("video_id").collect()
    assert [(r.video_id, r.o.version, r.o.key, r.n) for r in got] == [("P01_101", "100", "P01/videos/P01_101.MP4", 101), ("P02_07", "55", "videos/test/P02/P02_07.MP4", 7), ("P03", None, None, 0)]
    assert [r.video_id for r in lookups.chosen(df, "video_id", ["P03"], "participant_id", ["P01"]).collect()] == ["P03"]
    assert lookups.chosen(df, "video_id", None, "participant_id", ["P01"]).count() == 1 and lookups.chosen(df, "video_id", None, "participant_id", None).count() == 3
    assert [r.video_id for r in lookups.unknown_ids(df, "video_id", ["P03", "zz"]).collect()] == ["zz"]
    assert [r.video_id for r in lookups.first_rows(df, [F.desc("video_id")], 2).collect()] == ["P03", "P02_07"]
    joined, missing = lookups.must_match(df, splits.where("split = 'test'"), ["video_id"], "no_split")
    assert joined.count() == 1 and {(r.video_id, r.code) for r in missing.collect()} == {("P01_101", "no_split"), ("P03", "no_split")}
    assert {r.video_id: r.needed for r in lookups.reused(df, splits, ["video_id"], "split").collect()} == {"P01_101": True, "P02_07": False, "P03": True}


def test_orders_and_jobs(spark):
    every = spark.createDataFrame([("b", 0), ("a", 1)], "participant_id string, position int")
    few = every.where("position = 1")
    order = lambda mode: [r.participant_id for r in lookups.participant_order(spark, mode, every, few).orderBy("position").collect()]
    assert order("all") == ["b", "a"] and order("all-candidates") == ["a"] and order(" z, ,b") == ["z", "b"]
    jobs = spark.createDataFrame([("a", "batch_1"), ("b", " "), ("c", None)], "participant_id string, batch_id string")
    assert [r.participant_id for r in lookups.submittable(every, jobs, ["participant_id"]).collect()] == ["b"] and lookups.submittable(every, jobs, ["participant_id"], True).count() == 2
    assert one(spark, a=lookups.token_limit(F.lit(2), 3, 10, 20), b=lookups.token_limit(F.lit(3), 3, 10, 20)) == {"a": 10, "b": 20}
    s = spark.createDataFrame([("p", "v1", [1, 2]), ("p", "v2", None), ("q", "v3", [])], "participant_id string, source_video_id string, c array<int>")
    assert {(r.participant_id, r.sources, r.candidates) for r in lookups.bundle_report(s, "c").collect()} == {("p", 2, 2), ("q", 1, 0), (None, 3, 2)}
    assert {tuple(r) for r in lookups.status_counts(jobs, "batch_id").collect()} == {("batch_1", 1), ("unknown", 2)}


def test_addresses(spark):
    rows = spark.createDataFrame([("k", "", None), ("k", "main", "near"), ("", None, None), ("z", None, "far")], "key string, bucket string, region string")
    assert sorted(tuple(r) for r in lookups.address_violations(rows, "main", "near").select("code", F.coalesce("key", F.lit(""))).collect()) == [("duplicate_object", "k"), ("missing_key", ""), ("region_differs", "z")]
    assert {r.code for r in lookups.address_violations(rows.limit(1), "", "").collect()} == {"missing_bucket"}
    got = lookups.refreshed(rows.where("key = 'z'"), lambda b, k: F.concat_ws("/", b, k), "main", "near").first()
    assert (got.bucket, got.region, got.signed_url) == ("main", "far", "main/z")


def test_local_items_and_coverage(spark):
    cols = "source_video_id string, participant_id string, candidate_id string, type string, claim string, observed_value string, supporting_window_ids array<string>, support array<struct<start_sec:double,end_sec:double>>, flags array<string>, verdict string, evidence array<struct<start_sec:double,end_sec:double>>, reason_codes array<string>, reason string, corrected_claim string, qc_status string"
    a = ("v", "p", "c1", "t", "x", None, ["w"], [(0.0, 1.0)], None, "contradicted", None, None, "r", None, "verification_disputed")
    got = qc.local_items(spark.createDataFrame([a, (*a[:2], "c2", *a[3:-1], "verification_passed")], cols)).collect()
    assert len(got) == 1 and got[0].record_id == "v:c1" and got[0].quality_flags == [] and got[0].first_pass_verdict == "contradicted" and len(got[0]) == 15
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k string")
    got = qc.verdict_coverage(ids("a", "b", "c"), ids("a", "b", "z"), ids("a", "a", "c", "z"), ["k"]).collect()
    assert {tuple(r) for r in got} == {("a", "duplicate_verdict"), ("b", "missing_verdict"), ("c", "unrequested_verdict"), ("z", "unknown_candidate")}


def test_decisions_count_once(spark):
    reviewed = spark.createDataFrame([("a", "x", "human_review_required", False), ("b", "y", "human_review_required", False), ("c", "z", "human_review_required", False)], "k string, claim string, qc_status string, usable boolean")
    decisions = spark.createDataFrame([("a", " accept ", None), ("b", "accept", None), ("b", "reject", None), ("c", " ", None)], "k string, decision string, approved_claim string")
    got = {r.k: r.outcome for r in qc.finalise(reviewed, decisions, ["k"]).collect()}
    assert got == {"a": "ready", "b": "unresolved", "c": "unresolved"} and qc.finalise(reviewed, decisions, ["k"]).count() == 3
    assert [r.video_uid for r in audit.repeated_in_manifest(spark.createDataFrame([("u", 1), ("u", 2), ("w", 1)], "video_uid string, x int")).collect()] == ["u"]


def test_orphans_and_upserts(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k bigint")
    got = {(r.k, r.code) for r in constraints.coverage(ids(1, 2), ids(2, 3), "k", "no_output", "no_parent").collect()}
    assert got == {(1, "no_output"), (2, "matched"), (3, "no_parent")}
    rows = lambda *x: spark.createDataFrame(x, "k bigint, v string")
    assert {tuple(r) for r in constraints.upsert(rows((1, "a"), (2, "b")), rows((2, "c"), (3, "d")), ["k"]).select("k", "v").collect()} == {(1, "a"), (2, "c"), (3, "d")}
