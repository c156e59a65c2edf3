"""Session factory: UTC, adaptive execution, Arrow; sizes are left to the cluster. And the package for workers that lack it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Bytes of a batch that goes to a Python worker: batches are otherwise cut by rows alone, however long their texts.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, for sessions whose Python workers don't have it on their path, and bound batches in bytes where the session
    says nothing of them."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if not getattr(sc, "_braid_shipped", False):
        sc._braid_shipped = True
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="braid-")) / "braid.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))  # served by the driver; executors fetch it


def session(name: str = "braid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the operators are written for; conf (dots as double underscores) overrides them."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
