"""The operators as jobs for spark-submit: `python -m tidemark <job> ...`. Each prints one JSON line, and ends with 1 where something failed.

What a job lists goes to files; printed are counts, and of failures no more than PRINTED.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import audit, requests, results, sarif, status
from .session import scratch, ship
from .sources import files as sources
from .streaming import statuses

PRINTED = 100


def _first(failures: DataFrame, column: str) -> list[str]:
    return [r[0] for r in failures.select(column).orderBy(column).limit(PRINTED).collect()]


def resolve(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """Request files to resolved requests; refused ones are counted by their message."""
    place = scratch(spark, "requests")
    requests.resolve_requests(sources.read_json_files(spark, a.requests)).select("file_name", "request").write.parquet(place)
    rows = spark.read.parquet(place)
    sources.write_resolved(rows, a.out)
    refused = {r.message: r["count"] for r in rows.groupBy("request.message").count().where("message is not null").limit(PRINTED).collect()}
    return {"resolved": rows.where("request.message is null").count(), "refused": refused, "ok": not refused}


def validate(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """A committed run of results against the result contract, with the tool versions of a contract file."""
    pins = audit.tool_versions(sources.read_json_files(spark, a.contract)).first().versions
    stamp = a.run or (sources.committed_runs(spark, a.published) or [None])[-1]
    rows = sources.published(spark, a.published, spark.read.json(f"{a.published}/data/run={stamp}").schema if stamp else "value string", stamp)
    named = rows.withColumn("run_id", F.col("request_id"))
    value = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != "transcript"]), {"ignoreNullFields": "false"})
    artifacts = sources.listed(rows).withColumnRenamed("request_id", "run_id")
    found, seen = results.observed(results.validate_results(named.select("run_id", value.alias("value")), named.select("run_id", "transcript").where("transcript is not null"), artifacts, pins or {}))
    found.where("first_violation is not null").select("run_id", "violations").write.mode("overwrite").json(a.out)
    counts = {k: n for k, n in seen.get.items() if n}
    return {"run": stamp, "results": counts.pop("results", 0), "violations": counts, "ok": not counts}


def gate(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """Scan reports against the severity gate."""
    found = sarif.high_findings(sources.read_json_files(spark, *a.reports).select("path", "value"))
    lines = found.select(F.concat_ws(" ", "path", "rule_id", "security_severity", "location", "message").alias("finding"))
    first = _first(lines, "finding")
    return {"findings": len(first) if len(first) < PRINTED else lines.count(), "first": first, "ok": not first}


def inspect(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """A tree of files against rules: a JSON file with lists `required`, `forbidden` (paths), `terms` and `needles` (path, needle, message)."""
    rules = json.loads(sources.read_json_files(spark, a.rules).first().value)
    files = sources.read_binary(spark, a.root).select(sources.relative(F.col("path"), "/" + a.root.split(":", 1)[-1].lstrip("/")).alias("path"), F.col("content").cast("string").alias("text"))
    paths = lambda key: spark.createDataFrame([(p,) for p in rules.get(key, [])], "path string")
    terms = spark.createDataFrame([(x,) for x in rules.get("terms", [])], "term string")
    needles = spark.createDataFrame([tuple(x) for x in rules.get("needles", [])], "path string, needle string, message string")
    found = audit.audit(audit.missing_files(files, paths("required")), audit.forbidden_files(files, paths("forbidden")), audit.any_term_hits(files, terms), audit.missing_needles(files, needles))
    first = _first(found, "failure")
    return {"mode": a.mode, "failures": first, "ok": not first}


def publish(spark: SparkSession, a: argparse.Namespace) -> dict[str, Any]:
    """Statuses (event_id, context, result, repository, run_id), as they arrive in a folder of Parquet files, to an outbox of payloads."""
    schema = spark.createDataFrame([], "event_id long, context string, result string, repository string, run_id string").schema
    made = status.payload(F.col("context"), F.col("result"), F.col("repository"), F.col("run_id"))
    statuses.outbox(statuses.table_stream(spark, a.statuses, schema), made, "event_id", a.out, f"{a.out}-state")
    return {"outbox": a.out, "ok": True}


JOBS: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], dict[str, Any]], dict[str, dict[str, Any]]]] = {
    "resolve": (resolve, {"--requests": {"required": True}, "--out": {"required": True}}),
    "validate": (validate, {"--published": {"required": True}, "--contract": {"required": True}, "--out": {"required": True}, "--run": {}}),
    "gate": (gate, {"reports": {"nargs": "+"}}),
    "inspect": (inspect, {"--root": {"required": True}, "--rules": {"required": True}, "--mode": {"default": "local"}}),
    "publish": (publish, {"--statuses": {"required": True}, "--out": {"required": True}}),
}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    known = parser.add_subparsers(dest="job", required=True)
    for name, (job, options) in JOBS.items():
        own = known.add_parser(name, help=(job.__doc__ or "").split("\n")[0])
        for option, settings in options.items():
            own.add_argument(option, **settings)
    given = parser.parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"tidemark-{given.job}").getOrCreate()
    ship(spark)
    said = JOBS[given.job][0](spark, given)
    print(json.dumps(said, ensure_ascii=False))
    return 0 if said["ok"] else 1
