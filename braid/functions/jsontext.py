"""JSON of open schema: strict parsing with audited repair, canonical digests, responses of batch services."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from . import columns as c

_MINUTES = re.compile(r'("(?:start_sec|end_sec)"\s*:\s*)(\d+):([0-5]?\d(?:\.\d+)?)(?=\s*[,}\]])')


def minutes_to_seconds(text: str) -> str:
    """An unquoted 4:55.0 as the value of start_sec or end_sec becomes 295.0."""
    return _MINUTES.sub(lambda m: m[1] + str(int(m[2]) * 60 + float(m[3])), text)


def canonical(value: object) -> str:
    """JSON with keys sorted at every depth and no spaces."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def _mapped(df: DataFrame, column: str, out: str, f: Callable[[str | None], str | None]) -> DataFrame:
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f(t) for t in b.column(at).to_pylist()], pa.string())], [*b.schema.names, out])

    ship(df.sparkSession)
    return df.mapInArrow(run, f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, `{out}` string")


def canonical_sha256(df: DataFrame, column: str, out: str = "fingerprint") -> DataFrame:
    """SHA-256 of a column's JSON in canonical form: numbers and nesting as Python writes them, so digests agree with those of other writers."""
    return _mapped(df, column, out, lambda t: None if t is None else hashlib.sha256(canonical(json.loads(t)).encode()).hexdigest())


def repaired(df: DataFrame, column: str, out: str = "repaired", repair: Callable[[str], str] = minutes_to_seconds) -> DataFrame:
    """The text after a repair, where that makes valid JSON of it; else null. The repair is pluggable."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        try:
            fixed = repair(t)
            json.loads(fixed)
            return fixed
        except ValueError:
            return None

    return _mapped(df, column, out, one)


def cleaned(responses: DataFrame, repair: Callable[[str], str] = minutes_to_seconds) -> DataFrame:
    """responses (record_id, content, finish_reason) to json_text, status, and digests for the audit.

    status: ok as it stands, repaired (only if the model stopped by itself), truncated, or invalid. Only what fails to parse goes to Python."""
    x = responses.withColumn("block", c.json_block("content")).withColumn("_ok", F.try_parse_json("block").isNotNull())
    good = x.where("_ok").withColumn("json_text", F.col("block")).withColumn("status", F.lit("ok"))
    bad = repaired(x.where("not _ok").withColumn("_try", F.when(F.col("finish_reason") == "stop", F.col("block"))), "_try", "json_text", repair).drop("_try")
    bad = bad.withColumn("status", F.when(F.col("json_text").isNotNull(), "repaired").when(F.col("finish_reason") == "length", "truncated").otherwise("invalid"))
    out = good.unionByName(bad)
    return out.drop("_ok", "block").withColumn("raw_sha256", F.sha2("content", 256)).withColumn("json_sha256", F.sha2("json_text", 256))


def batch_response(line: str | Column) -> Column:
    """payload and error of a batch service's line: its error, a status other than 200, no choice, an empty one, or no JSON, in that order."""
    text = F.col(line) if isinstance(line, str) else line
    v = F.try_parse_json(text)
    get = lambda path, kind="string": F.try_variant_get(v, path, kind)
    content = get("$.response.body.choices[0].message.content")
    block = c.json_block(content)
    fault = get("$.error", "variant")
    error = (
        F.when(v.isNull(), "malformed_line")
        .when(fault.isNotNull() & (F.to_json(fault) != "null"), F.concat(F.lit("error:"), F.to_json(fault)))
        .when(F.coalesce(get("$.response.status_code", "int"), F.lit(0)) != 200, F.concat(F.lit("http_"), F.coalesce(get("$.response.status_code"), F.lit("none"))))
        .when(get("$.response.body.choices[0]", "variant").isNull(), "no_choices")
        .when(F.coalesce(F.trim(content), F.lit("")) == "", "empty_content")
        .when(F.try_parse_json(block).isNull(), "invalid_json")
    )
    return F.struct(get("$.custom_id").alias("custom_id"), F.when(error.isNull(), block).alias("payload"), error.alias("error"))


def usage(v: Column) -> Column:
    """Token counts of a response as texts, empty where they are missing."""
    get = lambda p: F.coalesce(F.try_variant_get(v, f"$.usage.{p}", "string"), F.lit(""))
    return F.struct(*[get(k).alias(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")])


def prompt(template: str, record: Column) -> Column:
    return F.concat(F.lit(template.rstrip() + "\n\n"), record)


def context(fields: list[str]) -> Column:
    """key=value lines of the fields that are present."""
    return F.concat_ws("\n", *[F.when(c.blank_to_null(f).isNotNull(), F.concat(F.lit(f"{f}="), F.col(f).cast("string"))) for f in fields])
