"""Incremental processing: what arrives is taken once, snapshots are upserted, late rows wait for their window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import ranking
from ..sources import io


def arrivals(spark: SparkSession, path: str, schema: str, kind: str = "parquet", files: int = 100) -> DataFrame:
    """Files of a folder as a stream, a bounded number in a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(path)


def append(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows to a log of files, each once: a query that starts again goes on where it stopped."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def snapshot(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> StreamingQuery:
    """The last row of each key, kept in a stored table: batches are reduced to one row a key, then upserted. Replays change nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = [spark.read.parquet(path)] if io.exists(spark, path) else []
        both = batch
        for o in old:
            both = o.unionByName(batch, allowMissingColumns=True)
        io.swap(ranking.latest(both, keys, order).write, spark, path, "parquet")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(stream: DataFrame, time: str, width: str, keys: list[str], late: str, value: str) -> DataFrame:
    """Counts and sums by window; rows later than `late` are dropped, as a watermark demands."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, time: str, gap: str, keys: list[str], late: str) -> DataFrame:
    """Runs of a key's rows without a gap that long."""
    s = F.session_window(time, gap)
    return stream.withWatermark(time, late).groupBy(s, *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")
