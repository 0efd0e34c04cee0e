"""Streams of statuses, published runs and observed counts: restarts, repeats and failures."""

from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import results, status
from tidemark.plans import queries as plans
from tidemark.sources import files as sources
from tidemark.streaming import statuses

SF = "/root/testdata/sf0.001"


def write(spark, rows, base):
    spark.createDataFrame(rows, "who string, at long, what string").repartition(2).write.mode("append").parquet(f"{base}/in")


def state_of(spark, base):
    schema = spark.createDataFrame([], "who string, at long, what string").schema
    stream = statuses.latest_stream(statuses.table_stream(spark, f"{base}/in", schema, 1), ["who"], "at")
    statuses.keep_batches(stream, f"{base}/changes", f"{base}/state", "update")
    return {r.who: (r.at, r.what) for r in statuses.latest_kept(spark, f"{base}/changes", schema, ["who"], "at").collect()}


def test_latest_status_over_restarts(spark, tmp_path):
    base = f"file://{tmp_path}"
    write(spark, [("a", 1, "pending"), ("b", 5, "success"), ("a", 3, "failure"), ("a", 3, "failure")], base)
    assert state_of(spark, base) == {"a": (3, "failure"), "b": (5, "success")}
    write(spark, [("a", 2, "late"), ("b", 6, None), ("c", None, "odd"), (None, 1, "nameless")], base)
    assert state_of(spark, base) == {"a": (3, "failure"), "b": (6, None), "c": (None, "odd"), None: (1, "nameless")}
    assert state_of(spark, base)["a"] == (3, "failure")  # nothing new


def sent(spark, base):
    schema = spark.createDataFrame([], "who string, at long, what string").schema
    made = status.payload(F.col("who"), F.col("what"), F.lit("o/r"), F.col("at").cast("string"))
    statuses.outbox(statuses.table_stream(spark, f"{base}/in", schema, 1), made, "at", f"{base}/out", f"{base}/state")
    return sorted(tuple(r) for r in spark.read.parquet(f"{base}/out").select("at", "state", "description").collect())


def test_a_batch_that_runs_again_adds_no_row(spark, tmp_path):
    base = f"file://{tmp_path}"
    write(spark, [("a", 1, "pending"), ("a", 2, "success"), ("a", 2, "success")], base)
    first = sent(spark, base)
    assert first == [(1, "pending", "a: pending"), (2, "success", "a: success")]
    commits = sorted((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):  # as if it had ended before its commit
        path.unlink(missing_ok=True)
    assert sent(spark, base) == first
    write(spark, [("a", 2, "again"), ("b", 3, "odd")], base)
    assert sent(spark, base) == [*first, (3, "error", "b: error")]


def test_a_run_counts_whole_or_not_at_all(spark, tmp_path):
    base = f"file://{tmp_path}"
    rows = spark.createDataFrame([("r1", "ok", "text\n"), ("r2", "error", None)], "request_id string, status string, transcript string")
    with pytest.raises(ValueError, match="no committed run"):
        sources.published(spark, base, rows.schema)
    assert sources.publish_run(rows, base, "2031-01") == {"results": 2, "transcripts": 1, "chars": 5}
    broken = rows.withColumn("status", F.when(F.col("request_id") == "r2", F.raise_error(F.lit("lost"))).otherwise(F.col("status")))
    with pytest.raises(PySparkException):
        sources.publish_run(broken, base, "2031-02")
    assert sources.committed_runs(spark, base) == ["2031-01"]
    assert sorted(map(tuple, sources.published(spark, base, rows.schema).collect())) == sorted(map(tuple, rows.collect()))
    sources.publish_run(rows.limit(1), base, "2031-02")  # what the broken one left is replaced
    assert sources.published(spark, base, rows.schema).count() == 1 and sources.published(spark, base, rows.schema, "2031-01").count() == 2
    with pytest.raises(ValueError, match="committed already"):
        sources.publish_run(rows, base, "2031-02")
    assert sources.publish_run(rows.limit(0), base, "2031-03") == {"results": 0, "transcripts": 0, "chars": 0}
    assert sorted(map(tuple, sources.listed(rows).collect())) == [("r1", "result.json"), ("r1", "transcript.txt"), ("r2", "result.json")]


def test_many_requests_make_few_files(spark, tmp_path):
    many = spark.range(5000).select(F.col("id").cast("string").alias("request_id"), F.lit("ok").alias("status"), F.lit("t\n").alias("transcript")).repartition(3)
    sources.publish_run(many, f"file://{tmp_path}", "1")
    assert len(list((tmp_path / "data" / "run=1").glob("part-*"))) == 3


def test_rules_are_counted_by_the_pass_that_collects(spark):
    validated, seen = results.observed(plans.contract_results(spark, SF))
    rows = validated.select("run_id", "violations").collect()
    counts = seen.get
    assert counts.pop("results") == len(rows)
    assert counts == {rule: sum(rule in r.violations for r in rows) for rule in results.RULES} and sum(counts.values()) > 0


@pytest.mark.parametrize("name, folder", [("queue_stream", "queue"), ("sarif_files", "reports"), ("caption_files", "captions")])
def test_many_small_files_are_written_in_packs(spark, name, folder):
    """Not a file for each request, report or conversation."""
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(base.glob(f"{folder}-*"))
    rows = plans.QUERIES[name](spark, SF).count()
    (made,) = set(base.glob(f"{folder}-*")) - before
    assert len(list(made.rglob("part-*"))) <= 8 < rows
