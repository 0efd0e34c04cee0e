"""The result model, and the contract of results and their artifacts as one array of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import WS, classify_failure, sha256_text, strip
from ..functions.urls import VIDEO_ID, site_url
from ..functions.variants import at, kind, spelled, text, truthy
from .tracks import LANGUAGE_TAG

#: Statuses, refused keys, execution targets.
STATUSES = ("ok", "skipped_no_captions", "access_blocked", "error")
FORBIDDEN_KEYS = ("source_context", "project_id", "source_set_version")
TARGETS = ("self-hosted", "local", "test")
#: Media extensions and the artifacts a result may have.
MEDIA = (".mp4", ".webm", ".mkv", ".mov", ".avi", ".mp3", ".m4a", ".aac", ".ogg", ".opus", ".wav", ".flac")
ARTIFACTS = ("result.json", "transcript.txt", "SHA256SUMS.txt")
PROVENANCE = {"repository": "local", "head_sha": "local-unversioned", "run_id": "local", "run_attempt": "1", "workflow_ref": "local", "event": "local", "execution_target": "local", "yt_dlp_version": "unknown", "deno_version": "unknown"}


def runtime_provenance(**known: Column | str | None) -> Column:
    """The provenance struct, with defaults where a value is missing."""
    values = {k: F.lit(known[k]) if not isinstance(known.get(k), Column) and known.get(k) is not None else known.get(k) for k in PROVENANCE}
    return F.struct(*(F.coalesce(v if v is not None else F.lit(None).cast("string"), F.lit(PROVENANCE[k])).alias(k) for k, v in values.items()))


def acquisition_status(exit_code: Column, stdout: Column, stderr: Column) -> Column:
    """Null where metadata was read, else struct(status, error). A refusal in the diagnostics counts before the exit code."""
    diagnostic = F.right(F.coalesce(stderr, F.lit("")), F.lit(2000))
    refused = (diagnostic != "") & (classify_failure(diagnostic) == "access_blocked")
    missing = (exit_code != 0) | (strip(F.coalesce(stdout, F.lit(""))) == "")
    detail = F.when(diagnostic != "", diagnostic).otherwise("no metadata was returned")
    outcome = lambda s, e: F.struct(s.alias("status"), e.alias("error"))
    return (
        F.when(refused, outcome(F.lit("access_blocked"), diagnostic))
        .when(missing, outcome(classify_failure(detail), detail))
        .when(F.try_parse_json(stdout).isNull(), outcome(F.lit("error"), F.lit("metadata is invalid JSON")))
        .when(kind(F.try_parse_json(stdout)) != "OBJECT", outcome(F.lit("error"), F.lit("metadata is not an object")))
    )


def build_results(requests: DataFrame, provenance: Column | None = None) -> DataFrame:
    """Result rows of request rows (request_id, url, video_id, source_type, failure, track, format, cue_count, transcript).

    failure: struct(status, error) or null; track: struct(language, kind) or null. A failure comes
    first, then a missing track (skipped), then a missing transcript (error).
    """
    failed, skipped = F.col("failure").isNotNull(), F.col("track").isNull()
    ok = ~failed & ~skipped & F.col("transcript").isNotNull()
    status = F.when(failed, F.col("failure.status")).when(skipped, "skipped_no_captions").when(ok, "ok").otherwise("error")
    error = F.when(failed, F.right("failure.error", F.lit(2000))).when(~skipped & ~ok, "caption download produced no usable subtitle file")
    caption = F.when(ok, F.struct(F.col("track.language").alias("language"), F.col("track.kind").alias("kind"), F.col("format"), F.col("cue_count")))
    return requests.select(
        F.lit("2.1").alias("schema_version"),
        "request_id",
        status.alias("status"),
        F.struct("url", "video_id", F.col("source_type").alias("type")).alias("source"),
        caption.alias("caption"),
        F.when(ok, sha256_text(F.col("transcript"))).alias("transcript_sha256"),
        F.when(ok, F.length("transcript")).otherwise(0).cast("long").alias("transcript_chars"),
        (provenance if provenance is not None else runtime_provenance()).alias("runtime_provenance"),
        F.lit(False).alias("media_downloaded"),
        error.alias("error"),
        F.when(ok, F.col("transcript")).alias("transcript"),
    )


def final_status(results: DataFrame) -> DataFrame:
    """request_id, line (what a run reports) and failure (null where the run ends well)."""
    bad = F.col("status").isin("access_blocked", "error")
    return results.select("request_id", F.concat(F.lit("status="), "status").alias("line"), F.when(bad, F.coalesce(F.nullif("error", F.lit("")), "status")).alias("failure"))


def violations(result: Column, transcript: Column, artifacts: Column, versions: Column) -> Column:
    """The ids of all violated rules, in order, of a result (VARIANT), its transcript text with plain line
    feeds (null if absent), its artifacts' relative paths and the contract's tool versions (map)."""
    source_type, video = text(result, "$.source.type"), spelled(at(result, "$.source.video_id"))
    provenance, target = at(result, "$.runtime_provenance"), spelled(at(result, "$.runtime_provenance.execution_target"))
    status, caption, cues = text(result, "$.status"), at(result, "$.caption"), at(result, "$.caption.cue_count")
    body = transcript
    known = lambda c, *values: F.coalesce(c.isin(*values), F.lit(False))
    ok, bad = status == "ok", status != "ok"
    absent = lambda v: v.isNull() | (kind(v) == "VOID")
    number = lambda path: F.when(kind(at(result, path)) == "BIGINT", F.try_variant_get(result, path, "long"))
    extension = F.transform(artifacts, lambda p: F.lower(F.regexp_extract(F.element_at(F.split(p, "/"), -1), r"\A.+(\.[^.]+)\z", 1)))
    rules = [
        ~text(result, "$.schema_version").eqNullSafe("2.1"),
        ~known(status, *STATUSES),
        ~known(source_type, "video", "short"),
        ~video.rlike(VIDEO_ID),
        ~text(result, "$.source.url").eqNullSafe(site_url(source_type, video)),
        F.coalesce(F.exists(F.json_object_keys(F.to_json(result)), lambda k: k.isin(*FORBIDDEN_KEYS)), F.lit(False)),
        ~((kind(at(result, "$.media_downloaded")) == "BOOLEAN") & ~F.coalesce(F.try_variant_get(result, "$.media_downloaded", "boolean"), F.lit(True))),
        ~kind(provenance).eqNullSafe("OBJECT"),
        ~target.isin(*TARGETS),
        (target != "test") & ~text(result, "$.runtime_provenance.yt_dlp_version").eqNullSafe(F.try_element_at(versions, F.lit("yt-dlp"))),
        (target != "test") & ~text(result, "$.runtime_provenance.deno_version").eqNullSafe(F.try_element_at(versions, F.lit("deno-ejs-runtime"))),
        ok & ~kind(caption).eqNullSafe("OBJECT"),
        ok & ~known(text(result, "$.caption.kind"), "manual", "automatic"),
        ok & ~spelled(at(result, "$.caption.language")).rlike(LANGUAGE_TAG),
        ok & ~known(text(result, "$.caption.format"), "vtt", "srt"),
        ok & ~(kind(cues).eqNullSafe("BIGINT") & F.coalesce(F.try_variant_get(cues, "$", "long") > 0, F.lit(False))),
        ok & transcript.isNull(),
        ok & (strip(body) == ""),
        ok & ~text(result, "$.transcript_sha256").eqNullSafe(sha256_text(body)),
        ok & ~number("$.transcript_chars").eqNullSafe(F.length(body).cast("long")),
        ok & truthy(at(result, "$.error")),
        bad & transcript.isNotNull(),
        bad & ~absent(caption),
        bad & ~(absent(at(result, "$.transcript_sha256")) & number("$.transcript_chars").eqNullSafe(F.lit(0).cast("long"))),
        (status == "skipped_no_captions") & truthy(at(result, "$.error")),
        status.isin("access_blocked", "error") & ~spelled(at(result, "$.error")).rlike(f"[^{WS[1:]}"),
        F.exists(extension, lambda e: e.isin(*MEDIA)),
        F.exists(artifacts, lambda p: ~p.isin(*ARTIFACTS)),
    ]
    named = F.array(*(F.when(F.coalesce(rule, F.lit(False)), f"V{k}") for k, rule in enumerate(rules, 1)))
    return F.filter(named, lambda v: v.isNotNull())


RULES = tuple(f"V{k}" for k in range(29))


def observed(validated: DataFrame) -> tuple[DataFrame, Observation]:
    """`validated` (from `validate_results`) and an observation of how many rows there are and how many violate each rule.

    The counts come from the pass that writes or collects the rows, and no second one: ask the observation after it.
    """
    seen = Observation("rules")
    counts = [F.count_if(F.array_contains("violations", rule)).alias(rule) for rule in RULES]
    return validated.observe(seen, F.count("*").alias("results"), *counts), seen


def validate_results(results: DataFrame, transcripts: DataFrame, artifacts: DataFrame, versions: dict[str, str], by: str = "run_id", value_col: str = "value") -> DataFrame:
    """`results` with first_violation (null: valid) and violations. A value that isn't JSON violates V0 alone.

    transcripts: (by, transcript); artifacts: (by, rel_path). The tool versions are a contract's few entries.
    """
    paths = artifacts.groupBy(by).agg(F.sort_array(F.collect_set("rel_path")).alias("_paths"))
    out = results.join(transcripts.select(by, F.col("transcript").alias("_transcript")), by, "left").join(paths, by, "left")
    pins = F.create_map(*(F.lit(x) for pair in versions.items() for x in pair)) if versions else F.create_map().cast("map<string,string>")
    files = F.coalesce("_paths", F.array().cast("array<string>"))
    checked = lambda v: F.when(v.isNull(), F.array(F.lit("V0"))).otherwise(let(F.regexp_replace("_transcript", "\r\n?", "\n"), lambda body: let(files, lambda paths: violations(v, body, paths, pins))))
    found = let(F.try_parse_json(value_col), checked)
    return out.withColumn("violations", found).withColumn("first_violation", F.get("violations", F.lit(0))).drop("_transcript", "_paths")
