"""Assembly of the evidence hierarchy: clips into windows, windows into sessions, sessions into trees."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ship
from ..functions import columns as c
from . import intervals

SELF_ASSESSMENT = ("confidence", "trackability")


def without_keys(df: DataFrame, column: str, keys: tuple[str, ...] = SELF_ASSESSMENT) -> DataFrame:
    """The JSON text of a column without those keys at any depth. Depth and schema are open, so Arrow batches go through Python's parser."""

    def drop(x: object) -> object:
        if isinstance(x, dict):
            return {k: drop(v) for k, v in x.items() if k not in keys}
        return [drop(v) for v in x] if isinstance(x, list) else x

    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [None if t is None else json.dumps(drop(json.loads(t)), ensure_ascii=False, separators=(",", ":")) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.names[at], pa.array(new, pa.string()))

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def ordered(order: list[str], value: Column | str) -> Column:
    """Aggregate: values of a group as an array in order."""
    v = F.col(value) if isinstance(value, str) else value
    return F.transform(F.sort_array(F.collect_list(F.struct(*order, v.alias("_v")))), lambda s: s["_v"])


def windows(clips: DataFrame, seconds: float = 120.0) -> DataFrame:
    """clips (clip_id, source_video_id, participant_id, start_sec, end_sec, evidence) in windows by their start: a clip that crosses the edge stays in the earlier one."""
    index = F.floor(F.col("start_sec") / seconds)
    order = ["start_sec", "clip_id"]
    g = clips.groupBy("source_video_id", index.alias("window_index")).agg(
        F.min("start_sec").alias("start_sec"),
        F.max("end_sec").alias("end_sec"),
        F.min_by("participant_id", F.struct(*order)).alias("participant_id"),
        ordered(order, "clip_id").alias("micro_clip_ids"),
        ordered(order, F.struct("clip_id", "start_sec", "end_sec")).alias("clip_ranges"),
        ordered(order, "evidence").alias("evidence"),
        *[F.min_by(x, F.struct(*order)).alias(x) for x in ("benchmark_session_order", "benchmark_temporal_evolution_eligible") if x in clips.columns],
    )
    return g.withColumn("window_id", c.numbered("source_video_id", "w", "window_index"))


def sessions(w: DataFrame) -> DataFrame:
    """Windows (with evidence of their own) as one record for each source video."""
    order = ["start_sec", "window_id"]
    return w.groupBy("source_video_id").agg(
        F.min("start_sec").alias("start_sec"),
        F.max("end_sec").alias("end_sec"),
        F.min_by("participant_id", F.struct(*order)).alias("participant_id"),
        ordered(order, "window_id").alias("window_ids"),
        ordered(order, F.struct("window_id", "start_sec", "end_sec")).alias("window_ranges"),
        ordered(order, "evidence").alias("evidence"),
    ).withColumn("session_id", F.col("source_video_id"))


def cut(videos: DataFrame, seconds: float = 30.0, least_tail: float = 10.0) -> DataFrame:
    """videos (source_video_id, duration_sec, ...) in clips of fixed length with their ids."""
    x = videos.select("*", F.explode(intervals.pieces(F.col("duration_sec"), seconds, least_tail)).alias("_p"))
    return x.select("*", F.col("_p.index").alias("session_index"), "_p.start_sec", "_p.end_sec", c.numbered("source_video_id", "s", "_p.index").alias("clip_id")).drop("_p")


def review_clips(items: DataFrame, seconds: float = 30.0, most: int = 16, least_tail: float = 10.0) -> DataFrame:
    """items (source_video_id, candidate_id, item_pos, participant_id, duration_sec, support) to shared review clips on a grid.

    A candidate's cells are sampled to `most`; a cell that several candidates need is one clip."""
    cells = intervals.grid_cells(F.col("support"), seconds)
    x = items.select("*", cells.alias("_cells")).withColumn("_take", intervals.uniform_sample(F.col("_cells"), most)).withColumn("exhaustive", F.size("_cells") <= most)
    x = x.select("source_video_id", "candidate_id", "item_pos", "participant_id", "duration_sec", "exhaustive", F.explode("_take").alias("cell"))
    g = x.groupBy("source_video_id", "cell").agg(F.sort_array(F.collect_set("candidate_id")).alias("candidate_ids"), F.min_by("participant_id", "item_pos").alias("participant_id"), F.max("duration_sec").alias("duration_sec"))
    b = intervals.review_bounds(F.col("cell").cast("double"), seconds, least_tail, F.col("duration_sec"))
    return g.withColumn("clip_id", c.numbered("source_video_id", "qc_s", "cell", 5)).select("*", b.alias("_b")).select("*", "_b.start_sec", "_b.end_sec").drop("_b")


def last_use(clips: DataFrame) -> DataFrame:
    """Whether a clip is the last that needs its source."""
    w = Window.partitionBy("source_video_id")
    return clips.withColumn("remaining", F.count("*").over(w) - F.row_number().over(w.orderBy("cell")))


def tree(sessions_: DataFrame, windows_: DataFrame, clips: DataFrame) -> DataFrame:
    """Sessions with their windows with their clips, nested in order."""
    m = clips.groupBy("window_id").agg(ordered(["start_sec", "clip_id"], F.struct("clip_id", "start_sec", "end_sec", "evidence")).alias("clips"))
    w = windows_.select("window_id", "source_video_id", "start_sec", "end_sec", F.col("evidence").alias("window_evidence")).join(m, "window_id", "left")
    n = w.groupBy("source_video_id").agg(ordered(["start_sec", "window_id"], F.struct("window_id", "start_sec", "end_sec", "window_evidence", "clips")).alias("windows"))
    return sessions_.join(n, "source_video_id", "left")


def completed(status: DataFrame, urls: DataFrame, key: str) -> DataFrame:
    """Ids with status ok, validated where the status says so, and a URL."""
    ok = status.where((F.col("status") == "ok") & (c.truth("duration_validated") if "duration_validated" in status.columns else F.lit(True))).select(key)
    return ok.intersect(urls.where(c.blank_to_null("signed_url").isNotNull()).select(key))


def progress(done: int, total: int, elapsed: float) -> str:
    """A line on how far a run is and how long it has to go."""
    span = lambda s: f"{int(s) // 3600:02d}:{int(s) // 60 % 60:02d}:{int(s) % 60:02d}"
    left = elapsed * (total - done) / done if done else None
    return f"{done}/{total} ({100 * done / total if total else 100:.1f}%) elapsed {span(elapsed)} left {'--:--:--' if left is None else span(left)}"
