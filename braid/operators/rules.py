"""Validation of nested evidence records: rule tables compiled into one projection over VARIANT records.

A record is a VARIANT (a missing key stays different from a null one), its parent metadata another. Each rule yields an array of issues; all are
concatenated and exploded once, so a record is read once whatever the number of rules. Items that aren't objects yield `invalid_item` instead of
ending the job. `validate` joins records with parents on both sides, so what either lacks is an issue as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c

# Required fields, limits, references and vocabularies of the evidence format.
CONFIDENCES = ("high", "medium", "low")
REQUIRED = {
    "micro": ("clip_id", "source_video_id", "clip_time_range", "clip_summary", "places", "objects", "atomic_events", "state_observations", "state_changes", "end_state", "uncertainties"),
    "window": ("window_id", "source_video_id", "time_range", "window_summary", "entity_map", "local_event_chain", "state_changes", "window_end_state", "open_threads", "evidence_facts", "conflicts_or_uncertainties"),
    "session": ("session_id", "source_video_id", "participant_id", "time_range", "session_summary", "session_timeline", "session_entities", "state_update_timeline", "session_final_state", "open_tasks_or_unresolved_states", "cross_session_evidence_candidates", "contradictions_or_uncertainties"),
}
LIMITS = {
    "micro": {"places": 3, "objects": 6, "atomic_events": 4, "state_observations": 6, "state_changes": 4, "end_state": 5, "uncertainties": 3},
    "window": {"entity_map": 10, "local_event_chain": 8, "state_changes": 6, "window_end_state": 8, "open_threads": 4, "evidence_facts": 8, "conflicts_or_uncertainties": 5},
    "session": {"session_timeline": 12, "session_entities": 20, "state_update_timeline": 16, "session_final_state": 12, "open_tasks_or_unresolved_states": 8, "cross_session_evidence_candidates": 12, "contradictions_or_uncertainties": 8},
}
LOCAL_IDS = {
    "micro": {"places": "place_id", "objects": "object_id", "atomic_events": "event_id"},
    "window": {"entity_map": "entity_id", "local_event_chain": "event_id", "evidence_facts": "fact_id"},
    "session": {"session_entities": "entity_id", "cross_session_evidence_candidates": "candidate_id"},
}
RECORD_ID = {"micro": "clip_id", "window": "window_id", "session": "session_id"}
TIMES = {
    "places": (("evidence_times", "either"),),
    "objects": (("first_seen", "point"), ("last_seen", "point")),
    "atomic_events": (("time_range", "range"),),
    "state_changes": (("time_range", "range"),),
    "state_observations": (("time", "point"),),
    "end_state": (("evidence_time", "point"),),
    "uncertainties": (("time_range", "either"),),
}
TIME_ORDER = {"atomic_events": "time_range", "state_observations": "time", "state_changes": "time_range", "end_state": "evidence_time", "uncertainties": "time_range"}
STATE_TOKENS = {"open": "打开", "opened": "打开", "closed": "关闭"}
STATE_FIELDS = ("initial_state", "final_state", "pre_state", "post_state", "value", "before", "after")
COOKWARE = ("平底锅", "煎锅", "炒锅", "不锈钢锅", "金属锅", "汤锅", "奶锅", "砂锅", "锅具")
LONG_TERM = "(?i)通常|习惯|经常|总是|长期|偏好|喜欢|always|usually|typically"
SINGLE_WINDOW_TYPES = ("stable_layout", "procedure_candidate")

ISSUE = "array<struct<candidate_id:string,severity:string,code:string,message:string>>"
RELATIVE = r"^\d+:[0-5]\d(\.\d+)?$"


@dataclass(frozen=True)
class Ref:
    """Items of `section` refer by `field` (an array if `many`) to ids of the record's `sections`, or to the parent's `parent` array."""

    section: str
    field: str
    code: str
    sections: tuple[tuple[str, str], ...] = ()
    parent: str | None = None
    many: bool = False
    severity: str = "warning"


_ENTITY = (("places", "place_id"), ("objects", "object_id"))
REFS = {
    "micro": (
        Ref("atomic_events", "place_id", "unknown_place_reference", (("places", "place_id"),)),
        Ref("atomic_events", "object_ids", "unknown_object_reference", (("objects", "object_id"),), many=True),
        *[Ref(s, "entity_id", "unknown_entity_reference", _ENTITY) for s in ("state_observations", "state_changes", "end_state")],
        Ref("state_changes", "trigger_event_id", "unknown_event_reference", (("atomic_events", "event_id"),)),
    ),
    "window": (
        *[Ref(s, "supporting_clip_ids", "unknown_clip_reference", parent="micro_clip_ids", many=True) for s in LIMITS["window"]],
        *[Ref(s, "entity_ids", "unknown_entity_reference", (("entity_map", "entity_id"),), many=True) for s in ("local_event_chain", "open_threads", "evidence_facts")],
        *[Ref(s, "entity_id", "unknown_entity_reference", (("entity_map", "entity_id"),)) for s in ("state_changes", "window_end_state")],
        Ref("state_changes", "supporting_event_ids", "unknown_event_reference", (("local_event_chain", "event_id"),), many=True),
        Ref("conflicts_or_uncertainties", "affected_fact_ids", "unknown_fact_reference", (("evidence_facts", "fact_id"),), many=True),
    ),
    "session": (
        *[Ref(s, "supporting_window_ids", "unknown_window_reference", parent="window_ids", many=True) for s in LIMITS["session"]],
        *[Ref(s, "entity_ids|entity_id", "unknown_entity_reference", (("session_entities", "entity_id"),), many=True) for s in ("state_update_timeline", "session_final_state", "open_tasks_or_unresolved_states", "cross_session_evidence_candidates")],
        Ref("contradictions_or_uncertainties", "affected_candidate_ids", "unknown_candidate_reference", (("cross_session_evidence_candidates", "candidate_id"),), many=True),
    ),
}


class Prepared:
    """A record whose sections, local ids, keys and confidences are columns of their own, computed once: rules that go over them by the item, or within one
    another, would have Spark read the record anew each time. Made by `prepared`."""

    def __init__(self, layer: str, record: str):
        self.v, self.layer = F.col(record), layer

    def made(self) -> dict[str, Column]:
        v, out = self.v, {}
        for s in LIMITS[self.layer]:
            out[f"_items_{s}"] = items(v, s)
        for s, f in LOCAL_IDS[self.layer].items():
            out[f"_ids_{s}"] = _ids(v, s, f)
        # the keys that rules ask for, without the record's text: writing that takes more time than all rules together
        named = dict.fromkeys((*REQUIRED[self.layer], *LIMITS[self.layer]))
        there = F.array_compact(F.array(*[F.when(F.try_variant_get(v, f"$.{f}", "variant").isNotNull(), F.lit(f)) for f in named]))
        return out | {"_keys": there, "_confidences": confidences(v)}


def prepared(layer: str, df: DataFrame, record: str = "record") -> tuple[DataFrame, Prepared]:
    """df with the columns of Prepared, as rows of a generator: what a generator makes isn't computed again by those who use it."""
    p = Prepared(layer, record)
    return once(df, **p.made()), p


def once(df: DataFrame, **made: Column) -> DataFrame:
    """df with columns as rows of a generator, computed once a record: what filters them (Spark adds such filters below an explode) would compute a column of a
    projection anew, each time it names it."""
    return df.select("*", F.inline(F.array(F.struct(*[x.alias(k) for k, x in made.items()]))))


def raw(v: Column | Prepared) -> Column:
    return v.v if isinstance(v, Prepared) else v


def items(v: Column | Prepared, section: str) -> Column:
    if isinstance(v, Prepared):
        return F.col(f"_items_{section}")
    return F.coalesce(F.try_variant_get(v, f"$.{section}", "array<variant>"), F.array().cast("array<variant>"))


def text(x: Column | Prepared, field: str) -> Column:
    return F.coalesce(F.try_variant_get(raw(x), f"$.{field}", "string"), F.lit(""))


def texts(x: Column, field: str) -> Column:
    return F.coalesce(F.try_variant_get(x, f"$.{field}", "array<string>"), F.array().cast("array<string>"))


def _issue(code: str | Column, severity: str | Column, message: Column | str = "", candidate: Column | str = "") -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(lit(candidate).alias("candidate_id"), lit(severity).alias("severity"), lit(code).alias("code"), lit(message).cast("string").alias("message"))


def _bind(f, *args):
    """A lambda of one column: Spark would take further parameters, even with defaults, for its own."""
    return lambda x: f(x, *args)


def _none() -> Column:
    return F.array().cast(ISSUE)


def _if(cond: Column, *issue: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), F.array(*issue)).otherwise(_none())


def _each(values: Column, make) -> Column:
    return F.transform(values, make).cast(ISSUE)


def _ids(v: Column | Prepared, section: str, field: str) -> Column:
    if isinstance(v, Prepared):
        return F.col(f"_ids_{section}")
    return F.filter(F.transform(items(v, section), lambda x: text(x, field)), lambda t: t != "")


def shape_issues(layer: str, v: Column, keys: Column) -> list[Column]:
    """Required fields, their types, limits, and items that aren't objects."""
    out = []
    for field in REQUIRED[layer]:
        out.append(_if(~F.array_contains(keys, field), _issue("missing_required_field", "blocking", field)))
    for field, most in LIMITS[layer].items():
        kind = F.schema_of_variant(F.try_variant_get(raw(v), f"$.{field}", "variant"))
        out.append(_if(F.array_contains(keys, field) & ~F.coalesce(kind, F.lit("VOID")).startswith("ARRAY"), _issue("invalid_field_type", "blocking", field)))
        n = F.size(items(v, field))
        out.append(_if(n > most, _issue("count_limit_exceeded", "warning", F.concat(F.lit(f"{field}:"), n.cast("string"), F.lit(f">{most}")))))
        out.append(_each(F.filter(items(v, field), lambda x: ~F.schema_of_variant(x).startswith("OBJECT")), _bind(lambda x, f: _issue("invalid_item", "blocking", F.lit(f)), field)))
    return out


def id_issues(layer: str, v: Column) -> list[Column]:
    out = []
    for section, field in LOCAL_IDS[layer].items():
        every = F.transform(items(v, section), _bind(text, field))
        out.append(_each(F.filter(every, lambda t: t == ""), _bind(lambda t, s: _issue("missing_local_id", "blocking", F.lit(s)), section)))
        twice = F.filter(F.transform(every, lambda t, i: F.struct(t.alias("t"), i.alias("i"))), _bind(lambda s, e: (s["t"] != "") & (F.array_position(e, s["t"]) <= s["i"]), every))
        out.append(_each(twice, lambda s: _issue("duplicate_local_id", "blocking", s["t"])))
    return out


def ref_issues(layer: str, v: Column, parent: Column) -> list[Column]:
    out = []
    for r in REFS[layer]:
        allowed = texts(parent, r.parent) if r.parent else F.array_union(*[_ids(v, *s) for s in r.sections]) if len(r.sections) == 2 else _ids(v, *r.sections[0])

        def refs(x: Column, r: Ref) -> Column:
            if "|" in r.field:
                many, one = r.field.split("|")
                return F.coalesce(F.try_variant_get(x, f"$.{many}", "array<string>"), F.array(text(x, one)))
            return texts(x, r.field) if r.many else F.array(text(x, r.field))

        def bad(x: Column, r: Ref, allowed: Column) -> Column:
            candidate = text(x, "candidate_id") if layer == "session" and r.code != "unknown_candidate_reference" else F.lit("")
            severity = F.when(candidate != "", "candidate_blocking").otherwise(r.severity)
            unknown = F.filter(refs(x, r), lambda t: t.isNotNull() & (t != "") & ~F.array_contains(allowed, t))
            return F.transform(unknown, lambda t: _issue(r.code, severity, F.concat(F.lit(f"{r.section}:"), t), candidate))

        out.append(F.flatten(F.transform(items(v, r.section), _bind(bad, r, allowed))).cast(ISSUE))
    return out


def confidences(v: Column | Prepared) -> Column:
    """Values of every `confidence` at any depth, as text; JSON null and others than strings as they are written."""
    if isinstance(v, Prepared):
        return F.col("_confidences")
    found = F.regexp_extract_all(F.to_json(v), F.lit(r'(?<!\\)"confidence":("(?:[^"\\]|\\.)*"|[^,}\]]+)'), F.lit(1))
    return F.transform(found, lambda t: F.regexp_replace(t, '^"|"$', ""))


def confidence_issues(v: Column) -> list[Column]:
    return [_each(F.filter(confidences(v), lambda t: ~t.isin(*CONFIDENCES)), lambda t: _issue("invalid_confidence", "blocking", t))]


def clip_duration(v: Column, parent: Column) -> Column:
    """Known length of a clip: the parent's duration, its end less its start, or the record's own range."""
    num = lambda x, f: F.try_variant_get(raw(x), f"$.{f}", "double")
    positive = lambda x: F.when(x > 0, x)
    return F.coalesce(positive(num(parent, "duration_sec")), positive(num(parent, "end_sec") - num(parent, "start_sec")), positive(num(v, "clip_time_range.end_sec") - num(v, "clip_time_range.start_sec")))


def time_issues(v: Column, parent: Column) -> list[Column]:
    """Format, order and bounds of relative times."""
    limit = c.bounded_ceiling(clip_duration(v, parent))
    out = []

    def judged(value: Column, mode: str) -> Column:
        parts = F.transform(F.split(value, "-"), lambda p: F.trim(p))
        size_ok = {"point": F.size(parts) == 1, "range": F.size(parts) == 2, "either": F.size(parts) <= 2}[mode]
        good = size_ok & F.forall(parts, lambda p: p.rlike(RELATIVE))
        first, last = c.relative_seconds(F.get(parts, F.lit(0))), c.relative_seconds(F.get(parts, F.size(parts) - 1))
        code = F.when(~good | (first > last), "invalid_relative_time").when(last > limit, "relative_time_out_of_bounds")
        return code

    for section, fields in TIMES.items():
        for field, mode in fields:

            def found(x: Column, s: str, f: str, m: str) -> Column:
                values = texts(x, f) if f == "evidence_times" else F.array(text(x, f))
                coded = F.transform(values, lambda t: F.struct(judged(t, m).alias("code"), t.alias("t")))
                return F.transform(F.filter(coded, lambda y: y["code"].isNotNull()), lambda y: _issue(y["code"], "blocking", F.concat(F.lit(f"{s}.{f}:"), y["t"])))

            out.append(F.flatten(F.transform(items(v, section), _bind(found, section, field, mode))).cast(ISSUE))
    seen = lambda x, f: c.relative_seconds(text(x, f))
    out.append(_each(F.filter(items(v, "objects"), lambda x: seen(x, "first_seen") > seen(x, "last_seen")), lambda x: _issue("invalid_relative_time", "blocking", F.concat(F.lit("objects:"), text(x, "object_id")))))
    num = lambda x, f: F.try_variant_get(raw(x), f"$.{f}", "double")
    off = lambda f: F.abs(num(v, f"clip_time_range.{f}") - num(parent, f)) > 0.25
    out.append(_if(off("start_sec") | off("end_sec"), _issue("clip_time_range_mismatch", "blocking")))
    return out


def expected_category(name: Column) -> Column:
    return F.when(F.contains(name, F.lit("砧板")) | (name == "锅") | c.any_of(name, COOKWARE), "tool")


def meaning_issues(v: Column) -> list[Column]:
    """Warnings on what a micro record says."""
    stateful = F.transform(items(v, "state_changes"), lambda x: text(x, "entity_id"))
    clothing = F.filter(items(v, "objects"), lambda x: (text(x, "category") == "clothing") & ~F.array_contains(stateful, text(x, "object_id")))
    named = lambda x: F.concat_ws(":", text(x, "object_id"), text(x, "name"))
    out = [_each(clothing, lambda x: _issue("unreferenced_clothing_object", "warning", named(x)))]
    values = confidences(v)
    out.append(_if((F.size(values) >= 10) & F.forall(values, lambda t: t == "high"), _issue("uncalibrated_confidence", "warning", F.size(values))))
    for s in ("atomic_events", "state_changes"):
        ends = lambda x: F.transform(F.split(text(x, "time_range"), "-"), lambda p: F.trim(p))
        out.append(_each(F.filter(items(v, s), lambda x: (F.size(ends(x)) == 2) & (F.get(ends(x), F.lit(0)) == F.get(ends(x), F.lit(1)))), _bind(lambda x, s: _issue("zero_duration_range", "warning", F.concat(F.lit(f"{s}:"), text(x, "time_range"))), s)))
    odd = F.filter(items(v, "objects"), lambda x: expected_category(text(x, "name")) != text(x, "category"))
    out.append(_each(odd, lambda x: _issue("inconsistent_object_category", "warning", named(x))))
    for s in LIMITS["micro"]:
        for f in STATE_FIELDS:
            tokens = F.filter(items(v, s), _bind(lambda x, f: F.lower(F.trim(text(x, f))).isin(*STATE_TOKENS), f))
            out.append(_each(tokens, _bind(lambda x, s, f: _issue("non_chinese_state_token", "warning", F.concat(F.lit(f"{s}.{f}:"), text(x, f))), s, f)))
    for s, f in TIME_ORDER.items():
        at = F.transform(items(v, s), _bind(lambda x, f: c.relative_seconds(F.split_part(text(x, f), F.lit("-"), F.lit(1))), f))
        known = (F.size(at) >= 2) & F.forall(at, lambda t: t.isNotNull())
        out.append(_if(known & (F.to_json(F.sort_array(at)) != F.to_json(at)), _issue("non_monotonic_time_order", "warning", s)))
    return out


def candidate_state(v: Column, found: Column) -> Column:
    """Of each session candidate: flags, confidence and status, given the issues found so far."""
    affected = F.flatten(F.transform(items(v, "contradictions_or_uncertainties"), lambda x: texts(x, "affected_candidate_ids")))
    blocking = F.exists(found, lambda i: i["severity"] == "blocking")

    def one(x: Column) -> Column:
        cid = text(x, "candidate_id")
        coded = F.transform(F.filter(found, lambda i: (i["candidate_id"] == cid) & (i["severity"] == "candidate_blocking")), lambda i: i["code"])
        touched = F.array_contains(affected, cid)
        single = text(x, "type").isin(*SINGLE_WINDOW_TYPES) & (F.size(F.array_distinct(texts(x, "supporting_window_ids"))) <= 1)
        own = c.reasons((text(x, "claim").rlike(LONG_TERM), "long_term_overclaim"), (touched, "affected_by_uncertainty"), (single, "single_window_support"))
        flags = F.sort_array(F.array_union(F.array_union(F.filter(texts(x, "quality_flags"), lambda t: t != ""), coded), own))
        confidence = F.coalesce(F.nullif(text(x, "confidence"), F.lit("")), F.lit("low"))
        lowered = F.when(F.array_contains(flags, "affected_by_uncertainty") & (confidence == "high"), "medium").otherwise(confidence)
        return F.struct(
            cid.alias("candidate_id"),
            text(x, "type").alias("type"),
            text(x, "claim").alias("claim"),
            texts(x, "supporting_window_ids").alias("supporting_window_ids"),
            flags.alias("quality_flags"),
            own.alias("own_flags"),
            lowered.alias("normalized_confidence"),
            F.when(blocking | (F.size(coded) > 0), "schema_failed").otherwise("schema_passed").alias("qc_status"),
            F.lit(False).alias("usable_for_reference"),
        )

    return F.transform(items(v, "cross_session_evidence_candidates"), one)


def identity_issues(layer: str, v: Column, parent: Column) -> list[Column]:
    """What identity fields differ from the parent's (they are overwritten by `identified`)."""
    out = []
    for field in (RECORD_ID[layer], "source_video_id", *(("participant_id",) if layer == "session" else ())):
        want = text(parent, field)
        out.append(_if((want != "") & (text(v, field) != want), _issue("identity_field_normalized", "warning", F.concat_ws("->", text(v, field), want))))
    return out


def mismatch_issues(layer: str, v: Column, parent: Column) -> list[Column]:
    rid = RECORD_ID[layer]
    out = [_if((text(parent, rid) != "") & (text(v, rid) != text(parent, rid)), _issue("record_id_mismatch", "blocking", text(parent, rid)))]
    out.append(_if(text(v, "source_video_id") != text(parent, "source_video_id"), _issue("source_video_id_mismatch", "blocking", text(parent, "source_video_id"))))
    return out


def record_issues(layer: str, v: Column, parent: Column, normalise_identity: bool = True, references: bool = True) -> Column:
    """references: whether what refers to nothing is looked for here, among all ids one by one; see `levels` for records with many references."""
    keys = F.col("_keys") if isinstance(v, Prepared) else F.coalesce(F.json_object_keys(F.to_json(v)), F.array().cast("array<string>"))
    parts = shape_issues(layer, v, keys) + id_issues(layer, v) + (ref_issues(layer, v, parent) if references else []) + confidence_issues(v)
    if layer == "micro":
        parts += time_issues(v, parent) + meaning_issues(v)
    parts += identity_issues(layer, v, parent) if normalise_identity else mismatch_issues(layer, v, parent)
    return F.concat(*parts)


def validate(layer: str, records: DataFrame, parents: DataFrame, key: str = "record_id", normalise_identity: bool = True) -> DataFrame:
    """records (key, record VARIANT) and parents (key, parent VARIANT) to key, issues, accepted, and for sessions candidates.

    The issue column is computed once per record and kept as a column for what follows."""
    j, v = prepared(layer, records.join(parents, key, "full_outer"))
    p = F.col("parent")
    found = (
        F.when(v.v.isNull(), F.array(_issue("missing_model_output", "blocking")))
        .when(p.isNull(), F.array(_issue("missing_parent_metadata", "blocking")))
        .otherwise(record_issues(layer, v, p, normalise_identity))
    )
    return finished(v, once(j, issues=found))


def finished(v: Prepared, out: DataFrame) -> DataFrame:
    """out (record, issues) with `accepted`, and for sessions the candidates and what is said of them."""
    if v.layer == "session":
        out = once(out, candidates=candidate_state(v, F.col("issues")))
        extra = F.flatten(F.transform("candidates", lambda x: F.transform(x["own_flags"], lambda f: _issue(f, "warning", x["claim"], x["candidate_id"]))))
        out = once(out.withColumnRenamed("issues", "_found"), issues=F.concat("_found", F.coalesce(extra.cast(ISSUE), _none()))).drop("_found")
    return out.withColumn("accepted", ~F.exists("issues", lambda i: i["severity"] == "blocking")).drop(*v.made())


def issue_log(validated: DataFrame, layer: str, key: str = "record_id") -> DataFrame:
    """layer, record_id, candidate_id, severity, code, message."""
    return validated.select(F.lit(layer).alias("layer"), F.col(key).alias("record_id"), F.explode("issues").alias("i")).select("layer", "record_id", "i.candidate_id", "i.severity", "i.code", "i.message")


def summary(validated: DataFrame, layer: str) -> DataFrame:
    """quality_summary of each record: status, distinct codes, and for micro records the distribution of confidences."""
    codes = F.sort_array(F.array_distinct(F.transform("issues", lambda i: i["code"])))
    out = validated.withColumn("schema_status", F.when(F.col("accepted"), "passed").otherwise("failed")).withColumn("issue_codes", codes)
    if layer == "micro":
        values = confidences(F.col("record"))
        spread = F.map_from_arrays(F.sort_array(F.array_distinct(values)), F.transform(F.sort_array(F.array_distinct(values)), lambda k: F.size(F.filter(values, lambda t: t == k))))
        out = out.withColumn("model_confidence_policy", F.lit("self_reported_unverified")).withColumn("confidence_distribution", spread)
    return out


def feedback(log: DataFrame, most: int = 20) -> DataFrame:
    """record_id and the first messages of its blocking issues, for a retry."""
    x = log.where("severity = 'blocking'").groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("code", "message"))).alias("m"))
    return x.select("record_id", F.transform(F.slice("m", 1, most), lambda s: F.concat_ws(": ", s["code"], s["message"])).alias("messages"))
