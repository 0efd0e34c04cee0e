"""Statuses as a stream: the latest of each key, and an outbox of what is to be published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """The Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def latest_stream(statuses: DataFrame, by: list[str], order: str) -> DataFrame:
    """The last status of each key so far: one row of state for each key.

    A status that comes late, after one of a higher `order`, changes nothing, and neither does one that comes again.
    """
    rest = [c for c in statuses.columns if c not in (*by, order)]
    return statuses.groupBy(*by).agg(F.max(F.struct(order, *rest)).alias("_last")).select(*by, "_last.*")


def _each_batch(write: Callable[[DataFrame, int], None], stream: DataFrame, checkpoint: str, mode: str) -> None:
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def keep_batches(stream: DataFrame, to: str, checkpoint: str, mode: str = "append") -> None:
    """All that is there now, as one folder for each batch below `to`. A batch that runs again, after a failure between its
    write and its commit, replaces its own folder, so that it adds no row. A later call goes on after it."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{to}/batch={number}")

    _each_batch(write, stream, checkpoint, mode)


def latest_kept(spark: SparkSession, to: str, schema: StructType, by: list[str], order: str) -> DataFrame:
    """The state that the batches of `latest_stream`, kept in update mode, have led to: of each key the last change."""
    kept = spark.read.schema(StructType([*schema])).parquet(to).select(*schema.names)
    return latest_stream(kept, by, order).select(*schema.names)


def outbox(statuses: DataFrame, payload: Column, key: str, to: str, checkpoint: str) -> None:
    """What is to be published of each status (`key` and the fields of `payload`), once for each key however often it comes.

    Publishing itself stays outside: whoever does it takes the folders in the order of their batches, and can take
    one again, since its rows don't change. Keys are remembered in the stream's state.
    """
    once = statuses.dropDuplicates([key])
    keep_batches(once.select(key, payload.alias("_payload")).select(key, "_payload.*"), to, checkpoint)
