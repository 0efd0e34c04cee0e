"""Sources and sinks: JSON requests, subtitle files, scan reports, result folders."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.cues import decode_file


def read_json_files(spark: SparkSession, *paths: str) -> DataFrame:
    """One row (path, file_name, value) for each file with its whole text, JSON types and unknown keys kept."""
    return spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), "value")


#: Bytes of files that one task reads, if there are so many.
TASK_BYTES = 128 << 20


def read_binary(spark: SparkSession, path: str, pattern: str | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row (path, content) for each file below a folder. Small files are read many to a task: as many tasks as the files' bytes
    need, and one for each core at least. Names and sizes are listed first; no content is read for that."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)
    size = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // task_bytes))
    return files.select("path", "content").coalesce(tasks)


def read_subtitles(spark: SparkSession, path: str, pattern: str = "*.{vtt,srt}") -> DataFrame:
    """One row (path, raw) for each vtt and srt file, decoded."""
    return read_binary(spark, path, pattern).select("path", decode_file(F.col("content")).alias("raw"))


def write_packed(files: DataFrame, path: str, name: Column, content: Column) -> None:
    """Many small files as rows (name, content) of few Parquet files, as many as there are tasks: a file of its own for each
    would cost the file system's time, and Spark names none."""
    files.select(name.cast("string").alias("name"), content.cast("binary").alias("content")).write.parquet(path)


PACKED = "name string, content binary"


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """One row (name, content) for each file in the packs of a folder."""
    return spark.read.schema(PACKED).parquet(path)


def relative(path: Column, root: str) -> Column:
    return F.substr(path, F.instr(path, root) + len(root.rstrip("/")) + 1)


def write_resolved(requests: DataFrame, path: str) -> None:
    """The accepted requests (a column `request` from `resolve_requests`) as JSON lines, without the message."""
    good = requests.where("request is not null and request.message is null").select("request.*").drop("message")
    good.write.mode("overwrite").json(path)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("schema_version string, enabled boolean, request_id string, url string, video_id string, source_type string, language string").json(path)


def keep_run(results: DataFrame, path: str, stamp: str) -> str:
    """Results below a folder of their own run, so that former runs stay; gives that folder. A stamp that is taken is an error."""
    place = f"{path}/run={stamp}"
    results.write.mode("errorifexists").option("ignoreNullFields", "false").json(place)
    return place


def publish_run(results: DataFrame, path: str, stamp: str) -> dict[str, int]:
    """All results of a run, whole or not at all: rows as JSON lines below `data/run=<stamp>`, in as many files as there are tasks
    and not one for each request, then one small file below `committed` that makes the run count. Gives that file's content.

    A run that ends before it is committed leaves former runs as they were, and may be published again under its stamp;
    a committed one may not.
    """
    spark = results.sparkSession
    if stamp in committed_runs(spark, path):
        raise ValueError(f"run {stamp} is committed already")
    seen = Observation("run")
    text = F.coalesce(F.length("transcript"), F.lit(0))
    counted = results.observe(seen, F.count("*").alias("results"), F.count("transcript").alias("transcripts"), F.coalesce(F.sum(text), F.lit(0)).alias("chars"))
    counted.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/data/run={stamp}")
    put_text(spark, f"{path}/committed/{stamp}.json", json.dumps({"stamp": stamp, **seen.get}))
    return seen.get


def committed_runs(spark: SparkSession, path: str) -> list[str]:
    """The stamps of all committed runs, in order: one name for each run."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/committed")
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listStatus(place) if files.exists(place) else []
    return sorted(f.getPath().getName().removesuffix(".json") for f in found if f.getPath().getName().endswith(".json"))


def published(spark: SparkSession, path: str, schema: StructType, stamp: str | None = None) -> DataFrame:
    """The results of a committed run, the last one by its stamp unless one is named."""
    runs = committed_runs(spark, path)
    if not runs or stamp and stamp not in runs:
        raise ValueError(f"no committed run {stamp or ''}".rstrip())
    return spark.read.schema(schema).json(f"{path}/data/run={stamp or runs[-1]}")


def listed(results: DataFrame) -> DataFrame:
    """(request_id, rel_path) of the files that each result consists of, as a listing of its folder would give them."""
    names = F.array_compact(F.array(F.lit("result.json"), F.when(F.col("transcript").isNotNull(), "transcript.txt")))
    return results.select("request_id", F.explode(names).alias("rel_path"))


def write_results(results: DataFrame, path: str) -> None:
    """Results as JSON and transcripts as text, both partitioned by request; a request's former files are replaced."""
    results.drop("transcript").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request_id").option("ignoreNullFields", "false").json(f"{path}/results")
    kept = results.where("transcript is not null").select("request_id", F.regexp_replace("transcript", r"\n\z", "").alias("value"))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("request_id").text(f"{path}/transcripts")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file on any file system that Spark reaches."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
