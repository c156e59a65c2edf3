"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Rows up to which a side of a join may be broadcast: ids and short numbers, 64 MB at most. Beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Bytes up to which a side with lists may be broadcast.
BROADCAST_BYTES = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """df.mapInArrow, by workers that have this package and give back what a task has freed: workers stay for later tasks."""
    ship(df.sparkSession)

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return df.mapInArrow(released, schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir where the session names one, else (tests, one machine) a temporary one."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_braid_shared", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = sc._braid_shared = f"file://{tempfile.mkdtemp(prefix='braid-')}"
    return f"{root}/braid-{sc.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, a lost executor loses nothing, and its row count is known.

    The tables of a session go when its Python ends."""
    spark = df.sparkSession
    root = shared_dir(spark)
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not getattr(spark.sparkContext, "_braid_cleanup", False):
        spark.sparkContext._braid_cleanup = True
        atexit.register(_remove, spark, root)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, root: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, marked for broadcast if it has no more than that many rows; else as it is, and the join shuffles. df is a stored table: counting reads footers only."""
    return F.broadcast(df) if df.count() <= rows else df


def small_bytes(df: DataFrame, size: Column, most: int = BROADCAST_BYTES) -> DataFrame:
    """df, marked for broadcast if its rows, of `size` bytes each, take no more than `most`; else as it is, and the join shuffles. df is a stored table."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_column(name: str = "text"):
    """A text with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_mod(column: str, n: int):
    """crc32 of the column as text, modulo n; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def bounded_sample(df: DataFrame, rows: int, seed: str, by: str | None = None) -> DataFrame:
    """About `rows` rows of df (for each value of `by`), chosen by a hash of doc_id; all of them if there are fewer. The choice never reads the order of rows."""
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    if by is None:
        n = df.count()
        return df.where(u < rows / max(n, 1)) if n > rows else df
    counts = {r[0]: r[1] for r in df.groupBy(by).agg(F.count("*")).collect()}
    keep = F.lit(False)
    for value, n in sorted(counts.items()):
        keep = keep | ((F.col(by) == value) & (u < rows / n))
    return df.where(keep)
