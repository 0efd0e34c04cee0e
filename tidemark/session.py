"""Prepares a session: sources in the Python workers, and Arrow batches of bounded bytes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: A session that has its own bound keeps it.
_BATCH_BYTES, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Send the package's sources to all executors through Spark's own file server, once for each application."""
    if spark.conf.get(_BATCH_BYTES) == _DEFAULT:
        spark.conf.set(_BATCH_BYTES, "16m")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    top = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for source in sorted(top.rglob("*.py")):
            packed.write(source, source.relative_to(top.parent))
    context.addPyFile(str(path))


def spread(frame: DataFrame) -> DataFrame:
    """`frame` as it was read, or dealt out evenly where its files are divided, but into fewer parts than there are cores.

    A file of one row group is read by one task, however many splits it has. A table of one split is small, and one
    of as many splits as cores has work for all, so neither pays for a shuffle.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if 1 < frame.rdd.getNumPartitions() < cores else frame


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; on one machine a temporary one will do."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
