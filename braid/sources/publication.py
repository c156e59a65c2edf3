"""Publication of several tables as one: readers see all of a version or all of the one before it.

A set is a folder. Each publication writes its tables to new folders under `data`; then one small file, CURRENT, which says where each table lies, is
renamed over the old one. That rename is the only step that readers can notice, and file systems do it whole. A writer that fails leaves the set as it was."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Rows that an error names.
NAMED = 20


class Incomplete(RuntimeError):
    """Something has to be done again before the set can be published whole."""


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there whole or as it was before: written beside it and renamed over it in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, beside = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target = fs.makeQualified(_hadoop(spark, path)[1])
    beside = fs.makeQualified(beside)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, how)
    except BaseException:
        fs.delete(beside, False)
        raise


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


@dataclass(frozen=True)
class PublishedSet:
    """The tables published in a folder."""

    spark: SparkSession
    root: str

    def _current(self) -> dict:
        text = read_file(self.spark, f"{self.root}/CURRENT")
        return json.loads(text) if text else {"version": 0, "tables": {}}

    @property
    def version(self) -> int:
        """0 before the first publication."""
        return self._current()["version"]

    @property
    def tables(self) -> list[str]:
        return sorted(self._current()["tables"])

    def read(self, name: str) -> DataFrame:
        """A table of the current version. What was read stays readable when another version comes, until `vacuum`."""
        t = self._current()["tables"].get(name)
        if t is None:
            raise KeyError(f"{name} is not published in {self.root}")
        return self.spark.read.schema(StructType.fromJson(t["schema"])).options(**t["options"]).format(t["format"]).load(t["path"])

    def _write(self, name: str, df: DataFrame, folder: str, kind: str) -> dict:
        options = {"header": "true", "escape": '"', "emptyValue": ""} if kind == "csv" else {}
        path = f"{folder}/{name}"
        df.write.options(**options).format(kind).save(path)
        return {"path": path, "schema": df.schema.jsonValue(), "format": kind, "options": options}

    def publish(self, outputs: dict[str, DataFrame], retry: DataFrame | None = None, emptied: Iterable[str] = (), report: Callable[[dict[str, DataFrame]], DataFrame] | None = None, kinds: dict[str, str] | None = None) -> int:
        """Write all outputs and make them the current version, whose number is returned. kinds: formats other than parquet, by name.

        retry: rows that have to be done again, published as `retry_queue`. If there are any, the outputs aren't published: those of the version before stay,
        the ones named in `emptied` (queues of the next step) are published without rows, and Incomplete is raised. report makes a table from the outputs
        as written; it is published as `report` in either case. Nothing that fails on the way changes what readers see."""
        kinds, before = kinds or {}, self._current()
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        try:
            new, odd = {}, []
            if retry is not None:
                new["retry_queue"] = self._write("retry_queue", retry, folder, "parquet")
                odd = self.spark.read.schema(retry.schema).parquet(new["retry_queue"]["path"]).limit(NAMED).collect()
            for name, df in outputs.items():
                if not odd:
                    new[name] = self._write(name, df, folder, kinds.get(name, "parquet"))
                elif name in set(emptied):
                    new[name] = self._write(name, df.limit(0), folder, kinds.get(name, "parquet"))
            if report is not None:
                made = {n: self.spark.read.schema(StructType.fromJson(t["schema"])).options(**t["options"]).format(t["format"]).load(t["path"]) for n, t in new.items()}
                new["report"] = self._write("report", report(outputs if odd else made), folder, "json")
            tables = {**before["tables"], **new} if odd else new
            number = before["version"] + 1
            if self._current()["version"] != before["version"]:
                raise RuntimeError(f"{self.root} was published by another writer meanwhile")
            write_file(self.spark, f"{self.root}/CURRENT", json.dumps({"version": number, "tables": tables}))
        except BaseException:
            fs, p = _hadoop(self.spark, folder)
            fs.delete(p, True)
            raise
        if odd:
            raise Incomplete(f"{len(odd)}{'+' if len(odd) == NAMED else ''} rows to be done again: " + "; ".join(str(tuple(r)) for r in odd))
        return number

    def vacuum(self) -> int:
        """Delete folders that the current version doesn't use; how many. Readers of earlier versions lose their tables, so call it when there are none."""
        used = {t["path"].rsplit("/", 1)[0].rsplit("/", 1)[1] for t in self._current()["tables"].values()}
        fs, p = _hadoop(self.spark, f"{self.root}/data")
        gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName() not in used] if fs.exists(p) else []
        for x in gone:
            fs.delete(x, True)
        return len(gone)
