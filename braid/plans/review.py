"""Verification queries: documents as candidates, labels as verdicts, spans of characters as evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc
from .catalog import query
from .tables import table

# A document is a candidate of type lang; what labels say becomes a verdict, its length the evidence, its id the flags and decisions.
_CAND = """
with c as (
  select d.doc_id, lang as type, d.doc_id % 13 <> 0 as requested, case when l.quality is null then 'insufficient' when l.quality = 0 then 'contradicted' else 'entailed' end as verdict,
    n_chars > 300 and d.doc_id % 11 <> 0 as overlap, d.doc_id % 17 = 0 as blocking, d.doc_id % 19 = 0 as corrected
  from documents d left join labels l using (doc_id)),
f as (
  select *, case when not requested then 'schema_failed' when verdict = 'entailed' and overlap and not blocking and not corrected then 'verification_passed' when verdict = 'contradicted' then 'verification_disputed'
    when verdict = 'insufficient' or not overlap then 'verification_uncertain' else 'human_review_required' end as first_status from c),
s as (
  select *, case when first_status in ('verification_disputed', 'verification_uncertain') then
      case when doc_id % 3 = 0 and overlap and not blocking then 'local_verification_passed' when doc_id % 3 = 1 and overlap then 'local_verification_rejected' else 'human_review_required' end
    else first_status end as qc_status from f),
h as (
  select *, case when qc_status = 'human_review_required' and doc_id % 4 = 0 then 'accept' when qc_status = 'human_review_required' and doc_id % 4 = 1 then 'accept_corrected' when qc_status = 'human_review_required' and doc_id % 4 = 2 then 'reject' end as decision from s),
z as (select *, case when decision in ('accept', 'accept_corrected') then 'human_accepted' when decision = 'reject' then 'human_rejected' else qc_status end as final_status from h),
o as (select *, case when final_status in ('human_accepted', 'verification_passed', 'local_verification_passed') then 'ready' when final_status in ('local_verification_rejected', 'human_rejected') then 'rejected' else 'unresolved' end as outcome from z)
"""


def _range(start, end):
    return F.array(F.struct(start.cast("double").alias("start_sec"), end.cast("double").alias("end_sec")))


def _first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("type"), "n_chars")
    none = F.array().cast("array<string>")
    cand = d.select("doc_id", "type", F.format_string("claim %d", "doc_id").alias("claim"), F.when(F.col("doc_id") % 17 == 0, F.array(F.lit("long_term_overclaim"))).otherwise(none).alias("flags"), _range(F.lit(0), F.lit(300)).alias("support"))
    requests = d.where("doc_id % 13 <> 0").select("doc_id")
    verdict = F.when(F.col("quality").isNull(), "insufficient").when(F.col("quality") == 0, "contradicted").otherwise("entailed")
    evidence = F.when((F.col("n_chars") > 300) & (F.col("doc_id") % 11 != 0), _range(F.lit(200), F.col("n_chars"))).otherwise(_range(F.lit(300), F.col("n_chars") + 300))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    verdicts = d.join(labels, "doc_id", "left").select("doc_id", verdict.alias("verdict"), evidence.alias("evidence"), F.when(F.col("doc_id") % 19 == 0, "better").alias("corrected_claim"))
    return qc.merge_first(cand, requests, verdicts, ["doc_id"])


def _second(spark, sf_dir):
    first = _first(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    local = F.when(F.col("doc_id") % 3 == 0, "entailed").when(F.col("doc_id") % 3 == 1, "contradicted").otherwise("insufficient")
    evidence = F.when((F.col("n_chars") > 300) & (F.col("doc_id") % 11 != 0), _range(F.lit(200), F.col("n_chars"))).otherwise(_range(F.lit(300), F.col("n_chars") + 300))
    verdicts = d.select("doc_id", local.alias("local_verdict"), evidence.alias("local_evidence"), F.lit(None).cast("string").alias("local_corrected_claim"))
    return qc.merge_second(first, verdicts, ["doc_id"])


def _final(spark, sf_dir):
    second = _second(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select("doc_id")
    decision = F.get(F.array(F.lit("accept"), F.lit("accept_corrected"), F.lit("reject"), F.lit("")), F.pmod("doc_id", F.lit(4)).cast("int"))
    asked = second.where("qc_status = 'human_review_required'").select("doc_id")
    decisions = d.select("doc_id", decision.alias("decision"), F.format_string("approved %d", "doc_id").alias("approved_claim")).join(asked, "doc_id", "left_semi")
    return qc.finalise(second, decisions, ["doc_id"])


@query(_CAND + "select doc_id, first_status as qc_status, first_status = 'verification_passed' as usable from f")
def q44_qc_first_pass(spark, sf_dir):
    return _first(spark, sf_dir).select("doc_id", "qc_status", "usable")


@query(_CAND + "select doc_id, qc_status, qc_status in ('verification_passed', 'local_verification_passed') as usable from s")
def q45_qc_local(spark, sf_dir):
    return _second(spark, sf_dir).select("doc_id", "qc_status", "usable")


@query(_CAND + "select doc_id, final_status, outcome, case when decision = 'accept_corrected' then 'approved ' || doc_id else 'claim ' || doc_id end as claim, case when decision = 'accept_corrected' then 'claim ' || doc_id end as original_claim from o")
def q46_finalise(spark, sf_dir):
    return _final(spark, sf_dir).select("doc_id", "final_status", "outcome", "claim", "original_claim")


@query(_CAND + ", l as (select unnest(['type', 'verdict', 'qc_status', 'final_status', 'outcome']) as dimension, unnest([coalesce(type, ''), verdict, qc_status, final_status, outcome]) as value from o) select dimension, value, count(*)::bigint as n, round(count(*)::double / (select count(*) from o), 6) as rate from l group by 1, 2")
def q47_quality_report(spark, sf_dir):
    return qc.quality_report(_final(spark, sf_dir), ["type", "verdict", "qc_status", "final_status", "outcome"])
