"""Nested records, validation across levels, requests: small fixtures and models written here."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from braid.operators import levels, nested, requests, rules


def variants(spark, rows, column="record"):
    return spark.createDataFrame([(k, None if v is None else json.dumps(v)) for k, v in rows], "record_id string, j string").select("record_id", F.parse_json("j").alias(column))


def test_walk_of_any_depth(spark):
    rng = random.Random(5)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice([None, True, 1, 2.5, "high", "a.b", ""])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["confidence", "x", "key with space", "é"]): value(depth - 1) for _ in range(rng.randrange(4))}

    records = [(str(i), value(6)) for i in range(120)] + [("none", None), ("deep", {"confidence": "x"})]
    deep = {"confidence": "bottom"}
    for _ in range(40):
        deep = {"child": [deep]}
    records.append(("deeper", deep))
    want = Counter()

    def walk(k, v, path):
        for name, x in v.items() if isinstance(v, dict) else enumerate(v) if isinstance(v, list) else ():
            at = f"{path}.{name}" if isinstance(v, dict) else f"{path}[{name}]"
            want[k, at, name if isinstance(v, dict) else None] += 1
            walk(k, x, at)

    for k, v in records:
        walk(k, v, "$")
    df = variants(spark, records)
    got = Counter((r.record_id, r.path, r.name) for r in nested.walked(df, ["record_id"], "record").select("record_id", "path", "name").collect())
    assert got == want
    spread = {(r.record_id, r.value): r.n for r in nested.distribution(df, ["record_id"], "record", "confidence").collect()}
    assert spread["deep", "x"] == 1 and spread["deeper", "bottom"] == 1
    assert nested.walked(df.limit(0), ["record_id"], "record").collect() == []


def test_scalar_or_list(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, "y"), ("b", 1, "é\"q"), ("c", None, None)], "g string, i int, s string")
    got = {r.g: (r.i, r.s) for r in df.groupBy("g").agg(F.to_json(nested.scalar_or_list("i")).alias("i"), F.to_json(nested.scalar_or_list("s")).alias("s")).collect()}
    assert got == {"a": ("1", '"x"'), "b": ("[1,2]", '["y","é\\"q"]'), "c": (None, None)}


def window(**over):
    base = {
        "window_id": "w", "source_video_id": "v", "time_range": {}, "window_summary": "s", "entity_map": [{"entity_id": "e"}], "local_event_chain": [{"event_id": "ev", "entity_ids": ["e"], "supporting_clip_ids": ["c1"]}],
        "state_changes": [], "window_end_state": [], "open_threads": [], "evidence_facts": [{"fact_id": "f"}], "conflicts_or_uncertainties": [],
    }
    return {k: v for k, v in (base | over).items() if v != "absent"}


def session(**over):
    base = {f: [] for f in rules.LIMITS["session"]} | {"session_id": "s", "source_video_id": "v", "participant_id": "p", "time_range": {}, "session_summary": "x", "session_entities": [{"entity_id": "e"}]}
    return base | over


def both_ways(spark, layer, records, parents):
    """Issues by joins and by rules within a record are the same."""
    r, p = variants(spark, records), variants(spark, parents, "parent")
    out = []
    for validate in (levels.validate, rules.validate):
        v = validate(layer, r, p)
        states = sorted((x.record_id, s["candidate_id"], s["qc_status"], s["normalized_confidence"], tuple(s["quality_flags"])) for x in v.collect() for s in (x.candidates or ())) if layer == "session" else []
        log = sorted(tuple(x) for x in rules.issue_log(v, layer).select("record_id", "candidate_id", "severity", "code", "message").collect())
        out.append((log, sorted((x.record_id, x.accepted) for x in v.collect()), states))
    assert out[0] == out[1]
    return out[0]


def test_windows_across_levels(spark):
    parent = {"window_id": "w", "source_video_id": "v", "micro_clip_ids": ["c1", "c2"]}
    records = [
        ("good", window()), ("lost", window()),
        ("refs", window(open_threads=[{"entity_ids": ["e", "x", "x", "", None], "supporting_clip_ids": ["c2", "c9"]}], state_changes=[{"entity_id": "z", "supporting_event_ids": ["ev", "no"]}], conflicts_or_uncertainties=[{"affected_fact_ids": ["f", "g"]}])),
        ("odd", window(window_end_state="text", open_threads=["item", {"entity_ids": "not a list"}], evidence_facts=[{"fact_id": ""}, {"fact_id": "f"}, {"fact_id": "f"}], window_summary="absent")),
        ("many", window(open_threads=[{}] * 5, entity_map=[{"entity_id": f"e{i}", "confidence": "sure"} for i in range(11)])),
    ]
    parents = [(k, parent) for k, _ in records if k != "lost"] + [("unanswered", parent), ("bare", {})]
    records.append(("bare", window()))
    log, accepted, _ = both_ways(spark, "window", records, parents)
    codes = Counter((k, code) for k, _, _, code, _ in log)
    assert codes["refs", "unknown_entity_reference"] == 3 and codes["refs", "unknown_clip_reference"] == 1 and codes["refs", "unknown_event_reference"] == 1 and codes["refs", "unknown_fact_reference"] == 1
    assert codes["lost", "missing_parent_metadata"] == codes["unanswered", "missing_model_output"] == 1 and codes["bare", "unknown_clip_reference"] == 1
    assert dict(accepted) == {"good": True, "refs": True, "lost": False, "unanswered": False, "odd": False, "many": False, "bare": True}


def test_sessions_across_levels(spark):
    parent = {"session_id": "s", "source_video_id": "v", "participant_id": "p", "window_ids": ["w1", "w2"]}
    cand = {"candidate_id": "q", "type": "stable_layout", "claim": "c", "confidence": "high", "supporting_window_ids": ["w1", "w2"], "entity_ids": ["e"]}
    records = [
        ("good", session(cross_session_evidence_candidates=[cand])),
        ("window", session(cross_session_evidence_candidates=[cand | {"supporting_window_ids": ["w1", "w9"]}], session_timeline=[{"supporting_window_ids": ["w8"]}])),
        ("entity", session(cross_session_evidence_candidates=[cand | {"entity_ids": ["e", "y"]}], session_final_state=[{"entity_id": "z"}])),
        ("unsure", session(cross_session_evidence_candidates=[cand], contradictions_or_uncertainties=[{"affected_candidate_ids": ["q", "r"]}])),
        ("always", session(cross_session_evidence_candidates=[cand | {"claim": "always so", "supporting_window_ids": ["w1"]}])),
    ]
    log, _, states = both_ways(spark, "session", records, [(k, parent) for k, _ in records])
    said = {(k, c, severity, code) for k, c, severity, code, _ in log}
    assert ("window", "q", "candidate_blocking", "unknown_window_reference") in said and ("window", "", "warning", "unknown_window_reference") in said
    assert ("entity", "q", "candidate_blocking", "unknown_entity_reference") in said and ("entity", "", "warning", "unknown_entity_reference") in said
    assert {k: (s, c) for k, _, s, c, _ in states} == {"good": ("schema_passed", "high"), "window": ("schema_failed", "high"), "entity": ("schema_failed", "high"), "unsure": ("schema_passed", "medium"), "always": ("schema_passed", "high")}
    assert {k: f for k, _, _, _, f in states}["always"] == ("long_term_overclaim", "single_window_support")


def test_no_records(spark):
    empty, parents = variants(spark, [("a", {})]).limit(0), variants(spark, [("a", {})], "parent").limit(0)
    for layer in ("micro", "window", "session"):
        assert levels.validate(layer, empty, parents).collect() == []


def test_elements_in_order(spark):
    items = spark.createDataFrame([("a", 1, ["x", "y", "x"]), ("b", 1, ["x", "gone"]), ("c", 2, ["x"]), ("d", 1, ["bare", "x"]), ("e", 1, []), ("f", 1, None), ("g", None, ["z"])], "item string, source int, ids array<string>")
    targets = spark.createDataFrame([("x", 1, "ux"), ("y", 1, "uy"), ("bare", 1, " "), ("z", None, "uz")], "id string, target_source int, url string")
    whole, bad = requests.resolved(items, "item", "ids", targets, "id", "url", "source", "target_source", "url")
    assert {r.item: r.ids for r in whole.collect()} == {"a": ["ux", "uy", "ux"], "e": [], "f": [], "g": ["uz"]}
    assert sorted(tuple(r) for r in bad.collect()) == [("b", 1, "gone", "missing_target"), ("c", 0, "x", "other_source"), ("d", 0, "bare", "no_url")]


def test_requests_and_statuses(spark):
    sessions = spark.createDataFrame([("s1", "p1"), ("s2", "p2"), ("s3", "p3"), ("s4", "p1")], "session string, proxy_id string")
    inputs = spark.createDataFrame([("s1", 5), ("s2", 5), ("s3", 0)], "session string, n int")
    proxies = spark.createDataFrame([("p1", "u"), ("p2", " ")], "proxy_id string, proxy string")
    got = requests.session_requests(sessions, inputs, proxies, "session", "proxy_id", "proxy", F.col("n") > 0)
    assert {r.session: r.code for r in got.collect()} == {"s1": None, "s2": "missing_proxy", "s3": None, "s4": "missing_input"}
    manifest = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    statuses = spark.createDataFrame([("a", 1, "error"), ("a", 2, "ok"), ("b", 1, "ok"), ("b", 3, "error"), ("d", 1, None)], "id string, at int, status string")
    assert sorted(tuple(r) for r in requests.unfinished(manifest, statuses, ["id"], ["at"]).collect()) == [("b", "not_ok"), ("c", "missing_status"), ("d", "not_ok")]


def test_references_are_looked_up_without_shuffles(spark):
    """Record and parent meet, and that is all that moves."""
    records = spark.range(3).select(F.col("id").alias("record_id"), F.parse_json(F.lit("{}")).alias("record"))
    parents = spark.range(3).select(F.col("id").alias("record_id"), F.parse_json(F.lit("{}")).alias("parent"))
    for layer in ("micro", "window", "session"):
        plan = levels.validate(layer, records, parents)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") <= 2, layer


def test_many_references_of_a_record(spark):
    """Thousands of ids, of references and of unknown ones, in one record; null, blank and repeated ones, and keys that are there but null."""
    rng = random.Random(3)
    ids = [f"e{i}" for i in range(5000)]
    refs = [rng.choice([f"e{rng.randrange(9000)}", f"é{rng.randrange(4000)}", "", None]) for _ in range(20000)]
    clips = [f"c{rng.randrange(3000)}" for _ in range(6000)]
    record = window(entity_map=[{"entity_id": x} for x in ids], open_threads=[{"entity_ids": refs[:9000]}, {"entity_ids": refs[9000:], "supporting_clip_ids": clips}], window_summary=None)
    parent = {"window_id": "w", "source_video_id": "v", "micro_clip_ids": ["c1", "c2", None, "c1500"] + [f"c{i}" for i in range(2000, 4000)]}
    log = rules.issue_log(levels.validate("window", variants(spark, [("a", record)]), variants(spark, [("a", parent)], "parent")), "window")
    got = Counter((r.code, r.message) for r in log.where("code like 'unknown%'").collect())
    known, above = set(ids), set(parent["micro_clip_ids"])
    want = Counter(("unknown_entity_reference", f"open_threads:{x}") for x in refs if x and x not in known) + Counter(("unknown_clip_reference", f"open_threads:{x}") for x in clips if x not in above)
    assert got == want + Counter([("unknown_entity_reference", "local_event_chain:e")])
    assert log.where("code in ('missing_required_field', 'invalid_field_type')").count() == 0


def test_rules_are_evaluated_once_a_record(spark):
    """A log of issues holds each rule once: no filter below its explode repeats them."""
    records = spark.range(3).select(F.col("id").alias("record_id"), F.parse_json(F.lit("{}")).alias("record"))
    parents = spark.range(3).select(F.col("id").alias("record_id"), F.parse_json(F.lit("{}")).alias("parent"))
    for layer, check in (("micro", rules.validate), ("window", levels.validate), ("session", levels.validate)):
        plan = rules.issue_log(check(layer, records, parents), layer)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("missing_model_output") == 1, (layer, plan.count("missing_model_output"))
