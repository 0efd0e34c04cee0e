"""SHA-256 manifests of files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest(files: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """path and sha256 of each file, in binary order of the path."""
    return files.select(F.col(path_col).alias("path"), F.sha2(F.col(content_col).cast("binary"), 256).alias("sha256")).orderBy("path")


def manifest_lines(rows: DataFrame) -> DataFrame:
    """The text lines of a manifest: digest, two spaces, path."""
    return rows.select(F.concat("sha256", F.lit("  "), "path").alias("value"))


def verify(files: DataFrame, expected: DataFrame, path_col: str = "path", content_col: str = "content") -> DataFrame:
    """Expected entries (path, sha256) with ok; a missing file and an unknown digest fail."""
    found = files.select(F.col(path_col).alias("path"), F.sha2(F.col(content_col).cast("binary"), 256).alias("_found"))
    return expected.join(found, "path", "left").withColumn("ok", F.coalesce(F.col("_found") == F.lower("sha256"), F.lit(False))).drop("_found")
