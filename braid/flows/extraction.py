"""Extraction through three layers: videos are cut into clips, clips are asked about, windows are built of what was accepted and asked about, then sessions.

Each layer asks until its records are accepted: an answer is read as JSON, validated against its parent across levels, and refused with the messages of its
blocking issues, which go with the next request. What was judged lies in the layer's folder, so a run that ends early goes on from there. A layer whose records
are not all accepted ends the run, unless gaps are allowed; then the next layer is built of those that were."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext
from ..operators import constraints, evidence, levels, normalise, rules
from ..operators.lookups import token_limit
from ..sources import io
from ..sources.publication import Incomplete
from ..sources.workspace import folder, kept as stored

#: Records that an error names, and messages that a record is asked again with.
NAMED = 20
STEPS = f"record_id string, attempt int, accepted boolean, answer string, message string, issues {rules.ISSUE}"

#: asks a layer: (layer, requests) to record_id, attempt, content, finish_reason. Requests: record_id, attempt, max_tokens, message, parent (JSON).
Ask = Callable[[str, DataFrame], DataFrame]


@dataclass(frozen=True)
class Options:
    """How a run asks. `tokens` and `last_tokens`: for an answer to each layer, usually and on the last attempt."""

    attempts: int = 3
    clip_sec: float = 30.0
    least_tail_sec: float = 10.0
    window_sec: float = 120.0
    allow_missing: bool = False
    tokens: tuple[int, int, int] = (4096, 8192, 16384)
    last_tokens: tuple[int, int, int] = (8192, 24576, 24576)

    def __post_init__(self) -> None:
        if self.attempts < 1:
            raise ValueError("a record is asked about once at least")
        if self.clip_sec <= 0 or self.window_sec <= 0:
            raise ValueError("clips and windows have a length")
        if not 0 <= self.least_tail_sec <= self.clip_sec:
            raise ValueError("a tail is no longer than a clip")
        if any(last < usual or usual < 1 for usual, last in zip(self.tokens, self.last_tokens, strict=True)):
            raise ValueError("the last attempt has no fewer tokens than the others")


@dataclass(frozen=True)
class Layer:
    """What came of a layer: `parents` (record_id, parent as JSON), `records` (see `outcome`), `accepted` (record_id, evidence as JSON, normalised), and the
    issues of each record's last answer."""

    parents: DataFrame
    records: DataFrame
    accepted: DataFrame
    issues: DataFrame


def kept(df: DataFrame) -> DataFrame:
    """A stored table that joins by sorting. Answers are much alike, so their file may be a hundredth of what they take in memory; Spark would go by the file,
    and broadcast them through the driver."""
    return stored(df).hint("merge")


def parents_of(layer: str, rows: DataFrame) -> DataFrame:
    """record_id and parent (JSON of a row). Blank and repeated ids are an error."""
    rid = rules.RECORD_ID[layer]
    p = kept(rows.select(F.trim(F.col(rid).cast("string")).alias("record_id"), F.to_json(F.struct("*")).alias("parent")))
    constraints.enforce(constraints.duplicates(p, ["record_id"], blanks=True), f"{layer} records without an id of their own")
    return p


def judged(layer: str, answers: DataFrame, parents: DataFrame) -> DataFrame:
    """answers (record_id, attempt, content, finish_reason), one for each record, to record_id, attempt, accepted, answer, message (why it was refused: what its
    text is, or its blocking issues), issues."""
    read = kept(jsontext.cleaned(answers))
    records = read.where("json_text is not null").select("record_id", F.parse_json("json_text").alias("record"))
    asked = parents.join(read.select("record_id"), "record_id", "left_semi")
    checked = levels.validate(layer, records, asked.select("record_id", F.parse_json("parent").alias("parent"))).select("record_id", "issues", "accepted")
    j = read.select("record_id", "attempt", "content", "json_text", "status").join(checked, "record_id")
    ok = F.col("json_text").isNotNull() & F.col("accepted")
    worst = F.sort_array(F.transform(F.filter("issues", lambda i: i["severity"] == "blocking"), lambda i: F.concat_ws(": ", i["code"], i["message"])))
    message = F.when(F.col("json_text").isNull(), F.col("status")).otherwise(F.array_join(F.slice(worst, 1, NAMED), "\n"))
    return j.select("record_id", "attempt", ok.alias("accepted"), F.coalesce("json_text", "content").alias("answer"), F.when(~ok, message).alias("message"), "issues")


def attempted(layer: str, parents: DataFrame, ask: Ask, o: Options, root: str | None = None) -> DataFrame:
    """The steps of a layer: what `judged` says of each answer. A round is a stored table, whole or not there; the next round asks about what it refused. In a
    folder that holds rounds these are read and not asked again."""
    spark = parents.sparkSession
    root = root or folder(spark)
    at = tuple(rules.RECORD_ID).index(layer)
    todo, steps = parents.select("record_id", F.lit("").alias("message")), None
    for attempt in range(1, o.attempts + 1):
        path = f"{root}/{attempt}"
        if not io.exists(spark, f"{path}/_SUCCESS"):
            tokens = token_limit(F.lit(attempt), o.attempts, o.tokens[at], o.last_tokens[at])
            requests = todo.select("record_id", F.lit(attempt).alias("attempt"), tokens.alias("max_tokens"), "message").join(parents, "record_id")
            got = kept(ask(layer, requests).select("record_id", "attempt", "content", "finish_reason"))
            constraints.enforce(constraints.duplicates(got, ["record_id"]), f"{layer} records answered more than once")
            judged(layer, requests.select("record_id", "attempt").join(got, ["record_id", "attempt"], "left"), parents).write.mode("overwrite").parquet(path)
        step = spark.read.schema(STEPS).parquet(path)
        steps = step if steps is None else steps.unionByName(step)
        todo = step.where("not accepted").select("record_id", "message")
        if todo.isEmpty():
            break
    return steps


def outcome(steps: DataFrame) -> DataFrame:
    """record_id, attempts, accepted, answer and issues (of the last step), and the answers refused before it, in order."""
    last = F.max_by(F.struct("accepted", "answer", "issues"), "attempt").alias("s")
    old = F.sort_array(F.collect_list(F.when(~F.col("accepted"), F.struct("attempt", "answer")))).alias("old")
    g = steps.groupBy("record_id").agg(F.max("attempt").alias("attempts"), last, old)
    before = F.filter("old", lambda x: x["attempt"] < F.col("attempts"))
    return g.select("record_id", "attempts", "s.accepted", "s.answer", "s.issues", F.transform(before, lambda x: x["answer"]).alias("archived"))


def run_layer(layer: str, parents: DataFrame, ask: Ask, o: Options, root: str | None = None) -> Layer:
    """Ask until accepted, `o.attempts` times at most. Incomplete is raised for records that never were, unless gaps are allowed; `root` is a folder to go on from."""
    records = kept(outcome(attempted(layer, parents, ask, o, root)))
    if not o.allow_missing:
        gone = records.where("not accepted").orderBy("record_id").limit(NAMED).collect()
        if gone:
            raise Incomplete(f"{layer}: not accepted after {o.attempts} attempts: " + ", ".join(r.record_id for r in gone))
    good = records.where("accepted").select("record_id", F.col("answer").alias("evidence")).join(parents, "record_id")
    named = normalise.normalised(good, layer, "evidence").select("record_id", F.col("normalised").alias("evidence"))
    return Layer(parents, records, kept(named), rules.issue_log(records, layer))


def extract(videos: DataFrame, ask: Ask, o: Options | None = None, root: str | None = None) -> dict[str, Layer]:
    """videos (source_video_id, participant_id, duration_sec) through clips, windows and sessions: what came of each layer, by name."""
    o = o or Options()
    under = lambda layer: f"{root}/{layer}" if root else None
    whose = lambda df: df.withColumn("duration_sec", F.col("end_sec") - F.col("start_sec"))
    clips = whose(evidence.cut(videos.select("source_video_id", "participant_id", "duration_sec"), o.clip_sec, o.least_tail_sec))
    clips = kept(clips.select("clip_id", "source_video_id", "participant_id", "start_sec", "end_sec", "duration_sec"))
    micro = run_layer("micro", parents_of("micro", clips), ask, o, under("micro"))
    plain = evidence.without_keys(micro.accepted.select(F.col("record_id").alias("clip_id"), "evidence"), "evidence")
    windows = kept(whose(evidence.windows(clips.join(plain, "clip_id"), o.window_sec)))
    window = run_layer("window", parents_of("window", windows), ask, o, under("window"))
    plain = evidence.without_keys(window.accepted.select(F.col("record_id").alias("window_id"), "evidence"), "evidence")
    sessions = whose(evidence.sessions(windows.drop("evidence").join(plain, "window_id")))
    session = run_layer("session", parents_of("session", sessions), ask, o, under("session"))
    return {"micro": micro, "window": window, "session": session}


def report(layers: dict[str, Layer]) -> DataFrame:
    """A row for each layer: records, accepted, rejected, requests made, and issues by severity."""
    out = None
    for name, x in layers.items():
        severe = lambda k: F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i["severity"] == k))), F.lit(0))  # noqa: B023, E731
        row = x.records.agg(
            F.count("*").alias("records"),
            F.count_if("accepted").alias("accepted"),
            F.count_if(~F.col("accepted")).alias("rejected"),
            F.coalesce(F.sum("attempts"), F.lit(0)).alias("requests"),
            F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("issues"),
            *[severe(k).alias(f"{k}_issues") for k in ("blocking", "candidate_blocking")],
        ).withColumn("layer", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out
