"""Candidate verification: two verdict passes, human decisions, and the finished reference set, as CASE expressions over joined state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constraints, intervals

# Vocabularies of verdicts, flags and decisions.
VERDICTS = ("entailed", "contradicted", "insufficient")
BLOCKING_FLAGS = ("long_term_overclaim", "affected_by_uncertainty", "single_window_support", "unsupported_aggregation", "needs_visual_review")
READY = ("verification_passed", "local_verification_passed", "human_accepted")
REJECTED = ("local_verification_rejected", "human_rejected")
ACCEPT = ("accept", "accept_original", "接受", "接受原事实")
ACCEPT_CORRECTED = ("accept_corrected", "接受修正")
REJECT = ("reject", "拒绝")
DECISIONS = (*ACCEPT, *ACCEPT_CORRECTED, *REJECT)
QUEUED = ("verification_disputed", "verification_uncertain")


def blocked(flags: Column) -> Column:
    return F.arrays_overlap(F.coalesce(flags, F.array().cast("array<string>")), F.array(*[F.lit(f) for f in BLOCKING_FLAGS]))


def first_pass(requested: Column, verdict: Column, overlap: Column, blocking: Column, corrected: Column) -> Column:
    """Status after the first verdict; a verdict outside the vocabulary has none (see `bad_verdicts`)."""
    return (
        F.when(~requested, "schema_failed")
        .when((verdict == "entailed") & overlap & ~blocking & ~corrected, "verification_passed")
        .when(verdict == "contradicted", "verification_disputed")
        .when((verdict == "insufficient") | ((verdict == "entailed") & ~overlap), "verification_uncertain")
        .when(verdict == "entailed", "human_review_required")
    )


def second_pass(verdict: Column, overlap: Column, blocking: Column, corrected: Column) -> Column:
    return F.when((verdict == "entailed") & overlap & ~blocking & ~corrected, "local_verification_passed").when((verdict == "contradicted") & overlap, "local_verification_rejected").otherwise("human_review_required")


def usable(status: Column) -> Column:
    return status.isin("verification_passed", "local_verification_passed")


def final_status(status: Column, decision: Column) -> Column:
    return F.when(decision.isin(*ACCEPT, *ACCEPT_CORRECTED), "human_accepted").when(decision.isin(*REJECT), "human_rejected").otherwise(status)


def outcome(status: Column, is_usable: Column) -> Column:
    """ready, rejected or unresolved."""
    return F.when((status == "human_accepted") | (status.isin("verification_passed", "local_verification_passed") & F.coalesce(is_usable, F.lit(False))), "ready").when(status.isin(*REJECTED), "rejected").otherwise("unresolved")


def bad_verdicts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Requested candidates with no verdict or one outside the vocabulary."""
    return df.where(F.col("requested") & (F.col("verdict").isNull() | ~F.col("verdict").isin(*VERDICTS))).select(*keys, "verdict")


def merge_first(candidates: DataFrame, requests: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """candidates (keys, claim, flags, support) with requests (keys) and verdicts (keys, verdict, evidence, corrected_claim): qc_status, usable.

    support and evidence are arrays of start_sec, end_sec."""
    j = candidates.join(requests.select(*keys, F.lit(True).alias("requested")), keys, "left").join(verdicts, keys, "left")
    j = j.withColumn("requested", F.coalesce("requested", F.lit(False)))
    corrected = F.coalesce(F.trim("corrected_claim") != "", F.lit(False))
    status = first_pass(F.col("requested"), F.col("verdict"), intervals.overlaps(F.col("evidence"), F.col("support")), blocked(F.col("flags")), corrected)
    return j.withColumn("qc_status", status).withColumn("usable", usable(F.col("qc_status")))


def merge_second(first: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Local verdicts (keys, local_verdict, local_evidence, local_corrected_claim) take effect on queued candidates only."""
    j = first.join(verdicts, keys, "left")
    queued = F.col("qc_status").isin(*QUEUED) & F.col("local_verdict").isNotNull()
    corrected = F.coalesce(F.trim("local_corrected_claim") != "", F.lit(False))
    new = second_pass(F.col("local_verdict"), intervals.overlaps(F.col("local_evidence"), F.col("support")), blocked(F.col("flags")), corrected)
    return j.withColumn("qc_status", F.when(queued, new).otherwise(F.col("qc_status"))).withColumn("usable", usable(F.col("qc_status")))


def decision_violations(reviewed: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Decisions that can't stand: repeated, for no candidate, not asked for, outside the vocabulary, stale, about another claim (where decisions have one), or a
    correction without a claim."""
    d = decisions.where(F.col("decision").isNotNull() & (F.trim("decision") != "")).withColumn("decision", F.trim("decision"))
    twice = constraints.duplicates(d, keys).select(*keys, F.lit("duplicate_decision").alias("code"))
    j = d.join(reviewed.select(*keys, F.col("qc_status").alias("_s"), F.col("fingerprint").alias("_f"), *([F.col("claim").alias("_c")] if "claim" in decisions.columns else []), F.lit(True).alias("_known")), keys, "left")
    checks = [
        constraints.Check("unknown_candidate", "blocking", F.col("_known").isNull()),
        constraints.Check("not_in_review", "blocking", F.col("_known").isNotNull() & (F.coalesce("_s", F.lit("")) != "human_review_required")),
        constraints.Check("unknown_decision", "blocking", ~F.col("decision").isin(*DECISIONS)),
        constraints.Check("stale_fingerprint", "blocking", F.col("_known").isNotNull() & ~F.col("_f").eqNullSafe(F.col("fingerprint"))),
        constraints.Check("missing_approved_claim", "blocking", F.col("decision").isin(*ACCEPT_CORRECTED) & (F.coalesce(F.trim("approved_claim"), F.lit("")) == "")),
    ]
    if "claim" in decisions.columns:
        other = F.trim(F.coalesce("claim", F.lit(""))) != F.trim(F.coalesce("_c", F.lit("")))
        checks.append(constraints.Check("claim_mismatch", "blocking", F.col("_known").isNotNull() & other))
    return constraints.issues(j, keys, checks).select(*keys, "code").unionByName(twice)


def finalise(reviewed: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """reviewed (keys, claim, qc_status, usable) with decisions (keys, decision, approved_claim): final_status, outcome, claim, original_claim.

    Decisions are trimmed. Of several for one candidate none counts, so no candidate is doubled; `decision_violations` names them."""
    d = decisions.where(F.trim("decision") != "").groupBy(*keys).agg(F.count("*").alias("_n"), F.max(F.trim("decision")).alias("decision"), F.max("approved_claim").alias("approved_claim")).where("_n = 1").drop("_n")
    j = reviewed.join(d, keys, "left")
    fixed = F.col("decision").isin(*ACCEPT_CORRECTED)
    j = j.withColumn("final_status", final_status(F.col("qc_status"), F.col("decision"))).withColumn("outcome", outcome(F.col("final_status"), F.col("usable")))
    return j.withColumn("original_claim", F.when(fixed, F.col("claim"))).withColumn("claim", F.when(fixed, F.trim("approved_claim")).otherwise(F.col("claim")))


def quality_report(reviewed: DataFrame, dimensions: list[str]) -> DataFrame:
    """dimension, value, n, rate: a histogram for each dimension in one pass, and shares of all candidates."""
    long = reviewed.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("")).alias("value")) for d in dimensions])).alias("x"))
    n = long.groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))
    total = reviewed.agg(F.count("*").alias("total"))  # a single row
    return n.join(F.broadcast(total)).select("dimension", "value", "n", F.round(F.try_divide("n", "total"), 6).alias("rate"))


def fingerprint(columns: list[str]) -> Column:
    """SHA-256 of the JSON of columns in sorted order, nulls included."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def support_ranges(candidates: DataFrame, ranges: DataFrame, keys: list[str], ids: str, key: str) -> DataFrame:
    """keys and `support`: the ranges (key, start_sec, end_sec) of a candidate's ids, in their order; unknown ids are left for `unknown_references`."""
    x = candidates.select(*keys, F.posexplode(ids).alias("_pos", key)).join(ranges.select(key, "start_sec", "end_sec"), key)
    g = x.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_pos", "start_sec", "end_sec"))).alias("_r"))
    return g.select(*keys, F.transform("_r", lambda r: F.struct(r["start_sec"].alias("start_sec"), r["end_sec"].alias("end_sec"))).alias("support"))


def verdict_coverage(known: DataFrame, requested: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and a code where verdicts, requests and candidates don't cover each other: every request has one verdict, nothing else has any, and only
    known candidates are requested. All three are counted in one shuffle."""
    side = lambda df, name: df.select(*keys, *[F.lit(int(s == name)).alias(s) for s in ("known", "requested", "verdicts")])
    n = side(known, "known").unionByName(side(requested, "requested")).unionByName(side(verdicts, "verdicts")).groupBy(*keys).agg(*[F.sum(s).alias(s) for s in ("known", "requested", "verdicts")])
    checks = [
        constraints.Check("unknown_candidate", "blocking", (F.col("requested") > 0) & (F.col("known") == 0)),
        constraints.Check("missing_verdict", "blocking", (F.col("requested") > 0) & (F.col("verdicts") == 0)),
        constraints.Check("unrequested_verdict", "blocking", (F.col("requested") == 0) & (F.col("verdicts") > 0)),
        constraints.Check("duplicate_verdict", "blocking", F.col("verdicts") > 1),
    ]
    return constraints.issues(n, keys, checks).select(*keys, "code")


def local_items(first: DataFrame) -> DataFrame:
    """What the second pass is given of each queued candidate, under the names it expects."""
    array = lambda x: F.coalesce(F.col(x), F.array().cast(dict(first.dtypes)[x]))
    return first.where(F.col("qc_status").isin(*QUEUED)).select(
        F.concat_ws(":", "source_video_id", "candidate_id").alias("record_id"),
        "source_video_id",
        "participant_id",
        "candidate_id",
        F.col("type").alias("candidate_type"),
        "claim",
        "observed_value",
        array("supporting_window_ids").alias("supporting_window_ids"),
        array("support").alias("support_ranges"),
        array("flags").alias("quality_flags"),
        F.col("verdict").alias("first_pass_verdict"),
        array("evidence").alias("first_pass_evidence_time_ranges"),
        array("reason_codes").alias("first_pass_reason_codes"),
        F.col("reason").alias("first_pass_reason"),
        "corrected_claim",
    )


def human_review(second: DataFrame) -> DataFrame:
    """The sheet for people: candidates that need them, with the local verdict's words where there is one, and empty columns to fill in."""
    word = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    said = lambda x: F.when(F.col("local_verdict").isNotNull(), word(f"local_{x}")).otherwise(word(x))
    listed = lambda x: F.coalesce(F.to_json(x), F.lit("[]"))
    return second.where("qc_status = 'human_review_required'").select(
        *[word(x).alias(x) for x in ("source_video_id", "participant_id", "candidate_id")],
        word("type").alias("candidate_type"),
        word("claim").alias("claim"),
        "qc_status",
        F.col("fingerprint").alias("review_fingerprint"),
        word("verdict").alias("first_pass_verdict"),
        word("local_verdict").alias("local_verdict"),
        listed("flags").alias("quality_flags"),
        listed("support").alias("support_ranges"),
        said("corrected_claim").alias("corrected_claim"),
        said("reason").alias("reason"),
        *[F.lit("").alias(x) for x in ("human_decision", "approved_claim", "human_notes")],
    )
