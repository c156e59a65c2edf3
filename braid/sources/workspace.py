"""Tables that a job writes for itself: in the folder that spark.checkpoint.dir names, which driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of ids and short numbers up to which a stored table may be broadcast.
BROADCAST_ROWS = 1_000_000


def folder(spark: SparkSession) -> str:
    """A new path in the shared folder; on one machine, where none is named, in a temporary one. What lies there goes when the session's Python ends."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or getattr(sc, "_braid_work", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = sc._braid_work = f"file://{tempfile.mkdtemp(prefix='braid-work-')}"
    root = f"{root}/braid-work-{sc.applicationId}"
    if not getattr(sc, "_braid_work_cleanup", False):
        sc._braid_work_cleanup = True
        atexit.register(_remove, spark, root)
    return f"{root}/{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df, written and read back: its lineage ends there, and what was not the same each time it is computed is settled."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast if it has no more than that many rows."""
    return F.broadcast(df) if df.count() <= rows else df


def _remove(spark: SparkSession, root: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is not None:
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
