"""What the operators of this package share: tables, written intermediate results, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file, the same on all machines."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            found = current.get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        else:  # each executor would write to its own disk, and what is read back would lack the others' parts
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def spill(df: DataFrame, name: str, row_group: int = 32 << 20) -> DataFrame:
    """`df` written as a table in the shared folder and read again: lineage ends here, and a lost
    executor costs nothing that came before. Spark removes the shuffle files of the write once it is
    done. Row groups of at most `row_group` bytes bound a writer's memory. `discard` removes a table
    that is no longer needed; the folder's owner removes the rest."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("parquet.block.size", row_group).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    spark.sparkContext._jvm.System.gc()  # broadcast blocks of former steps leave the executors with their last reference here
    out = spark.read.schema(df.schema).parquet(path)
    out.spilled_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the tables behind frames from `spill`, once nothing that is still to run reads them."""
    for frame in frames:
        place = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.spilled_to)
        place.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def parallel(df: DataFrame) -> int:
    """Partitions for an exchange of this package, as the session sets them."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sized(df: DataFrame, text_col: str, bytes_each: int, least: int) -> int:
    """Buckets of about `bytes_each` bytes of text, and `least` for each partition of an exchange at any rate."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(least * parallel(df), -(-size // bytes_each))


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, component), the smallest node being the name.

    Large-star and small-star steps in turn; each takes the minimum over a node's neighbours with a
    partial aggregate and joins it back, so that a hub of any degree stays spread (AQE splits its
    join partition). Every round is written to the shared folder. Nodes without edges don't appear.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def star(df: DataFrame, large: bool) -> DataFrame:
        if large:  # all neighbours, larger ones move to the minimum
            both = df.union(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            out = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # smaller neighbours and the node itself move to the smallest
            least = df.groupBy("u").agg(F.min("v").alias("m"))
            moved = df.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            out = moved.union(least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    now = spill(now, "edges")
    before = state(now)
    for _ in range(limit):
        if not before[0]:
            break
        now, last = spill(star(star(now, True), False), "edges"), now
        after = state(now)
        discard(last)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
