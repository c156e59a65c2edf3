"""Lines of text files, numbered in file order without reading a file in one task, and what needs those numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..functions import columns as c
from .workspace import kept, small

#: Violations that an error names.
NAMED = 20


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value of every line, blank ones too.

    A file is read in splits; each split's lines are counted, the counts of the splits before it are added up, and a line's number is that sum and its place
    in its split. The lines are stored once, as splits may be cut otherwise another time. Splits, not lines, are sorted and joined."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    t = kept(read)
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = t.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    blocks = kept(blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift")))
    return t.join(small(blocks), ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def json_violations(lines: DataFrame) -> DataFrame:
    """file, line, code of lines that aren't blank and hold no JSON object."""
    v = F.try_parse_json("value")
    code = F.when(v.isNull(), "malformed").when(~F.schema_of_variant(v).startswith("OBJECT"), "not_an_object")
    return lines.where("trim(value) <> ''").select("file", "line", code.alias("code")).where("code is not null")


def strict_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """file, line and the fields of JSON lines, blank lines skipped; a malformed line is an error that names its place as `file:line`."""
    lines = kept(numbered(spark, path))
    bad = json_violations(lines).orderBy("file", "line").limit(NAMED).collect()
    if bad:
        raise ValueError("Invalid JSONL at " + ", ".join(f"{r.file}:{r.line} ({r.code})" for r in bad))
    return lines.where("trim(value) <> ''").select("file", "line", F.from_json("value", schema).alias("r")).select("file", "line", "r.*")


def order_violations(rows: DataFrame, keys: list[str], order: str, place: list[str]) -> DataFrame:
    """keys, place, found, expected: rows whose number isn't their position, 1 to N, among the rows of their keys in order of place. Blank numbers are 0."""
    found = F.coalesce(c.safe_long(F.col(order).cast("string")), F.lit(0))
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*place)).cast("bigint")
    return rows.select(*keys, *place, found.alias("found"), at.alias("expected")).where("found <> expected")


def manifest_violations(rows: DataFrame, participant: str, order: str) -> DataFrame:
    """file, code, line of manifests (rows with file and line): other than one participant, orders that aren't 1..N in file order (their first line)."""
    people = rows.groupBy("file").agg(F.count_distinct(c.blank_to_null(participant)).alias("n")).where("n <> 1")
    gaps = order_violations(rows, ["file"], order, ["line"]).groupBy("file").agg(F.min("line").alias("line"))
    return people.select("file", F.lit("participants").alias("code"), F.lit(None).cast("bigint").alias("line")).unionByName(gaps.select("file", F.lit("order").alias("code"), "line"))
