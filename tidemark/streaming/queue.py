"""The append-only request queue as a file-source stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.requests import validate_request
from ..sources.files import PACKED


def request_stream(spark: SparkSession, path: str, files_per_trigger: int = 100, named_by: str | None = None) -> DataFrame:
    """A stream of (file_name, value), one row for each queued JSON file. With `named_by` the name is that of the folder
    `<named_by>=<name>` in which a writer partitioned by that column has put the file."""
    stream = spark.readStream.format("text").schema("value string").option("wholetext", "true").option("maxFilesPerTrigger", files_per_trigger)
    name = F.regexp_extract("_metadata.file_path", f"/{named_by}=([^/]+)/", 1) if named_by else F.col("_metadata.file_name")
    return stream.load(path).select(name.alias("file_name"), "value")


def packed_stream(spark: SparkSession, path: str, packs_per_trigger: int = 100) -> DataFrame:
    """The same stream from packs of queued files (see `write_packed`), each file with its own name."""
    packs = spark.readStream.schema(PACKED).option("maxFilesPerTrigger", packs_per_trigger).parquet(path)
    return packs.select(F.col("name").alias("file_name"), F.col("content").cast("string").alias("value"))


def resolve_stream(stream: DataFrame) -> DataFrame:
    """(file_name, message, request_id, url, language); a file must be named after its request."""
    out = stream.withColumn("request", validate_request(F.col("value")))
    named = F.col("file_name") == F.concat("request.request_id", F.lit(".json"))
    message = F.coalesce("request.message", F.when(~named, "file name must equal request_id"))
    good = lambda name: F.when(message.isNull(), F.col(f"request.{name}")).alias(name)
    return out.select("file_name", message.alias("message"), good("request_id"), good("url"), good("language"))


def drain(stream: DataFrame, to: str, checkpoint: str) -> DataFrame:
    """All that is queued now, written as Parquet and read back. A later call goes on after it."""
    query = stream.writeStream.format("parquet").option("path", to).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(to)
