"""Sources and sinks: CSV, JSON lines, document folders, manifests, keyed upserts and all-or-nothing publication."""

from __future__ import annotations

import configparser
import json
import tarfile
import uuid
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import columns as c
from ..operators import constraints

#: Longest line that a batch service takes.
LINE_BYTES = 6 * 1024 * 1024
SECRETS = ("api_key", "secret_key", "authorization")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def text_schema(fields: Iterable[str]) -> StructType:
    return StructType([StructField(f, StringType()) for f in fields])


# --- sources


def csv(spark: SparkSession, path: str, fields: Iterable[str] | None = None) -> DataFrame:
    """A CSV with a header, every value text. A missing file is an empty table if `fields` says of which columns."""
    if fields is not None and not exists(spark, path):
        return spark.createDataFrame([], text_schema(fields))
    return spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)


def with_columns(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """df with the named columns that it lacks, as null texts."""
    return df.withColumns({f: F.lit(None).cast("string") for f in fields if f not in df.columns})


def jsonl(spark: SparkSession, path: str, schema: StructType | str, strict: bool = False) -> DataFrame:
    """JSON lines, blank ones skipped. strict: a malformed line ends the job and names its file; else it is a row with _corrupt_record."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if strict:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    return spark.read.schema(StructType([*schema.fields, StructField("_corrupt_record", StringType())])).json(path, mode="PERMISSIVE")


def jsonl_variants(spark: SparkSession, path: str) -> DataFrame:
    """file, line (text) and record (VARIANT, null where the line is malformed): for records of unknown schema."""
    t = spark.read.text(path).where("trim(value) <> ''")
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), F.try_parse_json("value").alias("record"))


def requests(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Request lines (custom_id, method, body) and their violations: repeated or blank ids, other methods than POST, bodies that are no objects."""
    v = jsonl_variants(spark, path)
    r = v.select("line", F.try_variant_get("record", "$.custom_id", "string").alias("custom_id"), F.try_variant_get("record", "$.method", "string").alias("method"), F.try_variant_get("record", "$.body", "variant").alias("body"))
    body_ok = F.coalesce(F.schema_of_variant("body").startswith("OBJECT"), F.lit(False))
    checks = [constraints.Check("bad_method", "blocking", ~F.coalesce(F.col("method") == "POST", F.lit(False))), constraints.Check("bad_body", "blocking", ~body_ok)]
    twice = constraints.duplicates(r, ["custom_id"], blanks=True).select("custom_id", F.lit("bad_custom_id").alias("code"))
    return r, constraints.issues(r, ["custom_id"], checks).select("custom_id", "code").unionByName(twice)


def json_document(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A file that is one JSON document."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.json(path, multiLine=True)


def documents(spark: SparkSession, folder: str, suffix: str = ".clean.json") -> DataFrame:
    """record_id (the file name without the suffix), record (VARIANT) of a folder with a document for each record."""
    t = spark.read.text(f"{folder}/*{suffix}", wholetext=True)
    name = c.file_name("_metadata.file_path")
    return t.select(F.regexp_replace(name, f"{suffix.replace('.', '[.]')}$", "").alias("record_id"), F.try_parse_json("value").alias("record"))


def document_ids(spark: SparkSession, folder: str, suffix: str = ".clean.json") -> DataFrame:
    """record_id of the documents there are; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").load(folder).select("path")
    return files.select(F.regexp_replace(c.file_name("path"), f"{suffix.replace('.', '[.]')}$", "").alias("record_id"))


def lookup(wanted: DataFrame, docs: DataFrame, key: str = "record_id", allow_missing: bool = False) -> DataFrame:
    """Documents of the wanted ids; a missing one is left out or an error."""
    if not allow_missing:
        constraints.enforce(wanted.select(key).join(docs.select(key), key, "left_anti"), "documents are missing")
    return wanted.join(docs, key)


def ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct present values of a column."""
    return df.select(c.blank_to_null(column).alias(column)).where(F.col(column).isNotNull()).distinct()


def manifests(spark: SparkSession, glob: str, participant: str = "participant_id") -> DataFrame:
    """file, participant, rows of each manifest, and whether it has one participant that no other file has (in any case)."""
    from pyspark.sql.window import Window

    m = spark.read.csv(glob, header=True, multiLine=True, escape='"').select(F.col("_metadata.file_path").alias("file"), c.blank_to_null(participant).alias("p"))
    per = m.groupBy("file").agg(F.min("p").alias("participant"), F.count_distinct("p").alias("_k"), F.count("*").alias("rows"))
    alone = F.count("*").over(Window.partitionBy(F.lower("participant"))) == 1
    return per.select("file", "participant", "rows", ((F.col("_k") == 1) & alone).alias("valid"))


def manifest_violations(df: DataFrame, required: list[str], uid: str = "video_uid") -> DataFrame:
    """code, value: missing columns, no rows, blank, repeated or path-unsafe ids."""
    spark = df.sparkSession
    lacking = [f for f in required if f not in df.columns]
    out = spark.createDataFrame([("missing_column", f) for f in lacking], "code string, value string")
    if uid in lacking:
        return out
    empty = df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("empty_manifest").alias("code"), F.lit("").alias("value"))
    twice = constraints.duplicates(df, [uid]).select(F.lit("duplicate_id").alias("code"), F.col(uid).alias("value"))
    unsafe = df.where(~c.path_safe(F.coalesce(uid, F.lit("")))).select(F.lit("unsafe_id").alias("code"), F.col(uid).alias("value"))
    return out.unionByName(empty).unionByName(twice).unionByName(unsafe)


def ini(path: str, section: str, required: Iterable[str]) -> dict[str, str]:
    p = configparser.ConfigParser()
    p.read(path)
    missing = [k for k in required if not p.has_option(section, k) or not p.get(section, k).strip()]
    if missing:
        raise ValueError(f"{path}: [{section}] lacks {', '.join(missing)}")
    return dict(p.items(section))


def log_tail(path: str, start: int = 0, most: int = 1 << 20) -> str:
    """The last `most` bytes of a log after an offset."""
    with open(path, "rb") as f:
        size = f.seek(0, 2)
        f.seek(max(start, size - most))
        return f.read().decode("utf-8", "replace")


def allowed_ids(audit: DataFrame, uid: str, status: str = "status") -> DataFrame:
    """Ids that an access audit calls available; none at all is an error."""
    out = audit.where(F.col(status) == "available").select(uid).distinct()
    if out.isEmpty():
        raise ValueError("the audit has no available id")
    return out


def union_of_fields(frames: list[DataFrame], first: list[str]) -> DataFrame:
    """All rows with all columns: preferred ones first, then in order of appearance."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    order = [x for x in first if x in out.columns] + [x for x in out.columns if x not in first]
    return out.select(*order)


# --- sinks


def _cells(df: DataFrame, fields: list[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[c.csv_cell(f, kinds[f]).alias(f) if f in kinds else F.lit("").alias(f) for f in fields])


def write_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """A declared list of columns, missing ones empty. Rows go to a folder beside it, which then takes its place; see `swap`."""
    swap(_cells(df, fields or df.columns).write.option("header", True).option("emptyValue", "").option("escape", '"'), df.sparkSession, path, "csv")


def swap(writer, spark: SparkSession, path: str, kind: str) -> None:
    """Write a folder beside path and put it in its place. The old one is renamed aside first and goes last, so a crash at any time loses neither; between
    the two renames path is missing, and a failed second rename puts the old one back."""
    beside = f"{path}.{uuid.uuid4().hex}"
    writer.format(kind).save(beside)
    fs, target = _fs(spark, path)
    _, new = _fs(spark, beside)
    _, old = _fs(spark, f"{beside}.old")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"can't rename {path} aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"can't rename {beside} to {path}")
    if had:
        fs.delete(old, True)


def json_lines(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, key: str | None = None, most: int | None = LINE_BYTES) -> None:
    """A compact line for each row; lines that are too long are an error that names their keys, before anything is written."""
    lines = json_lines(df)
    if most is not None:
        name = F.col(key).cast("string") if key else F.lit("")
        long = df.select(name.alias("id"), F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias("bytes")).where(F.col("bytes") > most)
        constraints.enforce(long, "lines are too long")
    swap(lines.write, df.sparkSession, path, "text")


def append_jsonl(df: DataFrame, path: str) -> None:
    """Results as they come; a run that ends early leaves whole files only."""
    json_lines(df).write.mode("append").text(path)


def write_documents(df: DataFrame, path: str, key: str) -> None:
    """Documents by key, replacing all that were there: stale ones go with the old folder."""
    swap(df.select(F.col(key), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.partitionBy(key), df.sparkSession, path, "text")


def write_partitioned(df: DataFrame, path: str, key: str, order: str, total: str) -> DataFrame:
    """A folder of rows for each key, and the index: key, rows, total, first and last order."""
    swap(df.repartition(key).sortWithinPartitions(key, order).write.partitionBy(key).option("header", True), df.sparkSession, path, "csv")
    return df.groupBy(key).agg(F.count("*").alias("rows"), F.sum(total).alias("total"), F.min(order).alias("first_order"), F.max(order).alias("last_order"))


def write_ids(df: DataFrame, path: str, column: str) -> None:
    swap(df.select(F.col(column).cast("string")).write, df.sparkSession, path, "text")


def write_report(row: DataFrame, path: str) -> None:
    """The one row of a report as a JSON file with sorted keys."""
    r = row.limit(2).collect()
    if len(r) != 1:
        raise ValueError("a report is one row")
    Path(path).write_text(json.dumps(r[0].asDict(True), sort_keys=True, indent=2, ensure_ascii=False, default=str) + "\n", encoding="utf-8")


def markdown(df: DataFrame, most: int = 50) -> str:
    """A small table as Markdown."""
    rows = df.limit(most).collect()
    line = lambda cells: "| " + " | ".join("" if x is None else str(x).replace("|", "\\|") for x in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)]) + "\n"


def redacted(df: DataFrame, secrets: Iterable[str] = SECRETS) -> DataFrame:
    """df without secret columns, whatever their case."""
    return df.drop(*[x for x in df.columns if x.lower() in set(secrets)])


def publish(retry: DataFrame, outputs: dict[str, Callable[[], None]], report: Callable[[], None]) -> bool:
    """All outputs, or none if anything has to be retried; the report in any case. Returns whether it was published."""
    clean = retry.isEmpty()
    if clean:
        for write in outputs.values():
            write()
    report()
    return clean


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: list[str | Column] | None = None) -> None:
    """Replace rows by key in a stored table: the last writer wins."""
    merged = constraints.upsert(spark.read.parquet(path), new, keys) if exists(spark, path) else new
    swap((merged.orderBy(*order) if order else merged).write, spark, path, "parquet")


def remove_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.where(~F.col(key).eqNullSafe(F.lit(value)))


def bundle(folder: str, archive: str, overwrite: bool = False) -> None:
    """A folder as tar.gz, under its name only when it is whole."""
    target = Path(archive)
    if target.exists() and not overwrite:
        raise FileExistsError(archive)
    part = target.with_name(target.name + ".part")
    with tarfile.open(part, "w:gz") as t:
        t.add(folder, arcname=Path(folder).name)
    part.replace(target)


def file_digests(spark: SparkSession, glob: str) -> DataFrame:
    """path, bytes, sha256, md5 of files."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))
