"""The metadata audit as one call: nested videos to flat rows, summaries, reasons, the benchmark with its index, the pilot and the report."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from ..operators import audit, constraints, metadata
from ..operators.nested import present
from ..sources.publication import PublishedSet
from ..sources.workspace import kept

#: Names that the operators of `audit` give to columns of `metadata.video_rows`.
NAMES = {"fb_participant_id": "raw_participant_id", "redacted_ratio": "redaction_ratio", "redaction_measurement_status": "redaction_status", "audio_coverage_ratio": "audio_coverage"}


def concurrent_sets(sets: DataFrame, record: str = "record") -> DataFrame:
    """video_uid and the sorted ids (as text) of the sets it is in, from sets (record VARIANT). A set that says `valid: false`, and one without an id, holds no one."""
    get = lambda x, p: F.try_variant_get(x, p, "variant")
    members = F.coalesce(F.try_variant_get(record, "$.videos", "array<variant>"), F.array().cast("array<variant>"))
    rows = sets.where(F.coalesce(present(get(record, "$.valid")), F.lit("")) != "false").select(present(get(record, "$.concurrent_video_set_id")).alias("id"), F.explode(members).alias("m"))
    named = rows.select("id", F.trim(present(get("m", "$.video_uid"))).alias("video_uid")).where("id is not null and video_uid <> ''")
    return named.groupBy("video_uid").agg(F.sort_array(F.collect_set("id")).alias("concurrent_video_set_ids"))


def manifest_file(participant: str | Column) -> Column:
    """Name of a participant's manifest; null where the id leaves nothing to name it by."""
    p = F.col(participant) if isinstance(participant, str) else participant
    slug = F.lower(F.regexp_replace(F.regexp_replace(p, r"[^A-Za-z0-9_.-]+", "_"), r"^[_.-]+|[_.-]+$", ""))
    return F.when(slug != "", F.concat(slug, F.lit("_all_videos.csv")))


def manifest_index(bench: DataFrame) -> DataFrame:
    """A row for each participant of the benchmark: its manifest, videos, duration, first and last place."""
    n = bench.groupBy("participant_id").agg(
        F.count("*").alias("video_count"),
        F.sum("duration_sec").alias("total_duration_sec"),
        F.min("benchmark_session_order").alias("first_benchmark_session_order"),
        F.max("benchmark_session_order").alias("last_benchmark_session_order"),
    )
    return n.withColumn("manifest_file", manifest_file("participant_id"))


def tables(videos: DataFrame, sets: DataFrame, filters: audit.Filters | None = None, accessible: DataFrame | None = None, pilot_participants: int = 5, pilot_videos: int = 3) -> dict[str, DataFrame]:
    """All tables of the audit, by name, from videos (record VARIANT) and the sets they are in (video_uid, concurrent_video_set_ids; see `concurrent_sets`).

    accessible: video_uid of those that an access audit found; without it nothing is left out for that. A video without an id is left out, a repeated id is an
    error. Rows and candidates are stored once, as most of the rest is made of them."""
    f = filters or audit.Filters()
    if pilot_participants < 0 or pilot_videos < 0:
        raise ValueError("limits of the pilot can't be negative")
    rows = kept(metadata.video_rows(videos, sets))
    constraints.enforce(constraints.duplicates(rows, ["video_uid"]), "videos occur more than once")
    v = rows.withColumnsRenamed(NAMES).withColumn("video_components", F.col("component_indices"))
    people = kept(audit.participants(v))
    cand = kept(audit.candidates(v, f, accessible))
    bench = kept(audit.benchmark(cand))
    index = kept(manifest_index(bench))
    constraints.enforce(index.where("manifest_file is null").select("participant_id"), "participants that no manifest can be named after")
    pilot = kept(audit.pilot(bench, pilot_participants, pilot_videos))
    report = metadata.report(rows, cand, bench, pilot, accessible, least_videos=2)
    report = report.withColumns({"candidate_filter": F.lit(json.dumps(f.as_dict(), sort_keys=True)), "pilot_participant_limit": F.lit(pilot_participants), "pilot_videos_per_participant": F.lit(pilot_videos)})
    return {
        "video_summary": rows,
        "participant_summary": people,
        "scenario_summary": audit.scenarios(v),
        "temporal_order_audit": audit.order_audit(people),
        "candidate_videos": cand,
        "benchmark_manifest": bench,
        "participant_manifest_index": index,
        "pilot_manifest": pilot,
        "metadata_report": report,
    }


def publish(out: PublishedSet, *args, **kwargs) -> int:
    """The tables of `tables`, published as one version, whose number is returned: readers see all of an audit or all of the one before."""
    return out.publish(tables(*args, **kwargs))


def participant_manifest(bench: DataFrame, participant: str) -> DataFrame:
    """The rows of a participant's manifest in their order."""
    return bench.where(F.col("participant_id") == c.canonical_participant(F.lit(participant))).orderBy("benchmark_session_order")
