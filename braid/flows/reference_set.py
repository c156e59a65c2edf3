"""From answers of a batch service to the reference set: verdicts are read, held against what was asked, merged, and published with the queues they lead to;
then people's decisions make of them what is ready, rejected or unresolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..operators import constraints, qc
from ..sources.publication import PublishedSet
from ..sources.workspace import kept

KEYS = ["source_video_id", "candidate_id"]
_RANGES = "array<struct<start_sec:double,end_sec:double>>"
_RESULTS = f"verification_results array<struct<candidate_id:string,verdict:string,evidence_time_ranges:{_RANGES},corrected_claim:string,reason:string,reason_codes:array<string>>>"
#: What a person sees of a candidate: a decision about another state of it is stale.
SEEN = ["source_video_id", "candidate_id", "type", "claim", "flags", "support", "qc_status", "verdict", "evidence", "corrected_claim", "reason"]
#: Columns of the second pass, which the first leaves empty.
LOCAL = {"local_verdict": "string", "local_evidence": _RANGES, "local_corrected_claim": "string", "local_reason": "string"}


def responses(lines: DataFrame) -> DataFrame:
    """custom_id, payload, error of a service's output lines (value). A line for an id that has one already is an error."""
    r = kept(lines.select(jsontext.batch_response("value").alias("r")).select("r.*"))
    constraints.enforce(constraints.duplicates(r.where("custom_id is not null"), ["custom_id"]), "answered more than once")
    return r


def verdicts(answers: DataFrame) -> DataFrame:
    """source_video_id, candidate_id and the verdict's columns, of answers (custom_id: the source; payload)."""
    x = answers.where("payload is not null").select(F.col("custom_id").alias("source_video_id"), F.explode(F.from_json("payload", _RESULTS)["verification_results"]).alias("v"))
    return x.select("source_video_id", "v.candidate_id", "v.verdict", F.col("v.evidence_time_ranges").alias("evidence"), "v.corrected_claim", "v.reason", "v.reason_codes")


def first_pass(out: PublishedSet, candidates: DataFrame, requested: DataFrame, lines: DataFrame) -> int:
    """Merge a service's verdicts on candidates and publish `merged`, `local_review_queue`, `human_review` and a report; the version.

    candidates: source_video_id, candidate_id, participant_id, type, claim, observed_value, supporting_window_ids, support, flags. requested: source_video_id,
    candidate_id of what was asked; others fail. Sources without an answer that can be read are published as `retry_queue`, and Incomplete is raised: nothing
    else but the report and emptied queues takes effect. Verdicts that don't cover what was asked of an answered source, or are none, are an error."""
    answers = responses(lines)
    good = answers.where("payload is not null").select(F.col("custom_id").alias("source_video_id"))
    lost = requested.select("source_video_id").distinct().join(good, "source_video_id", "left_anti")
    why = answers.where("error is not null and custom_id is not null").select(F.col("custom_id").alias("source_video_id"), "error")
    retry = kept(lost.join(why, "source_video_id", "left").select("source_video_id", F.coalesce("error", F.lit("missing_batch_output")).alias("reason")))
    said = kept(verdicts(answers))
    asked = requested.select(*KEYS).join(good, "source_video_id", "left_semi")
    constraints.enforce(constraints.duplicates(candidates, KEYS, blanks=True), "candidates without ids of their own")
    constraints.enforce(qc.verdict_coverage(candidates, asked, said, KEYS), "verdicts don't cover what was asked")
    constraints.enforce(qc.bad_verdicts(asked.withColumn("requested", F.lit(True)).join(said.select(*KEYS, "verdict"), KEYS), KEYS), "no verdicts")
    merged = qc.merge_first(candidates, requested.select(*KEYS), said, KEYS)
    merged = kept(merged.withColumns({k: F.lit(None).cast(t) for k, t in LOCAL.items()}).withColumn("fingerprint", qc.fingerprint(SEEN)))
    outputs = {"merged": merged, "local_review_queue": qc.local_items(merged), "human_review": qc.human_review(merged)}
    return out.publish(outputs, retry, ["local_review_queue", "human_review"], lambda made: qc.quality_report(made["merged"], ["type", "verdict", "qc_status"]))


def finalise(out: PublishedSet, reviewed: DataFrame, decisions: DataFrame) -> int:
    """Candidates as merged, with people's decisions (source_video_id, candidate_id, decision, approved_claim, fingerprint, claim, human_notes), published as
    `reference_ready`, `rejected`, `unresolved` and a report of each type's outcomes; the version. A decision that can't stand ends it: nothing is published."""
    constraints.enforce(qc.decision_violations(reviewed, decisions, KEYS), "decisions that can't stand")
    d = decisions.select(*KEYS, "decision", "approved_claim", "human_notes")
    final = kept(qc.finalise(reviewed, d.drop("human_notes"), KEYS).join(d.where("trim(decision) <> ''").select(*KEYS, "human_notes"), KEYS, "left"))
    final = final.withColumn("reference_id", F.concat_ws(":", *KEYS)).withColumn("usable", F.col("outcome") == "ready")
    parts = {name: final.where(F.col("outcome") == kind).drop("outcome") for name, kind in (("reference_ready", "ready"), ("rejected", "rejected"), ("unresolved", "unresolved"))}
    return out.publish(parts, report=lambda _: final.groupBy(F.coalesce("type", F.lit("unknown")).alias("type"), "outcome").agg(F.count("*").alias("n")))
