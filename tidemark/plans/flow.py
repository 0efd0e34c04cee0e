"""The composed flow: requests, acquisition logs and subtitle files in, results out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import cues, results, tracks


def caption_results(requests: DataFrame, logs: DataFrame, files: DataFrame, provenance: Column | None = None) -> DataFrame:
    """Result rows (see `results.build_results`) of requests (request_id, url, video_id, source_type, language).

    logs: (request_id, exit_code, stdout, stderr) of the metadata acquisition; files: (request_id, path,
    raw) of the subtitle files that were acquired. A request without a log is an error; of its files
    the first by path that has text counts. Everything is joined by request, and cues stay inside their row.
    """
    outcome = logs.select("request_id", F.lit(True).alias("logged"), results.acquisition_status(F.col("exit_code"), F.col("stdout"), F.col("stderr")).alias("failure"), F.from_json("stdout", "subtitles map<string,variant>, automatic_captions map<string,variant>").alias("m"))
    parsed = cues.transcripts(cues.without_overlap(cues.parse_cues(files.select("request_id", "path", "raw"))).select("request_id", "path", "segments"))
    texts = cues.first_usable_file(parsed.select("request_id", "path", "transcript", "cue_count"), "request_id")
    rows = requests.join(outcome, "request_id", "left").join(texts, "request_id", "left")
    missing = F.struct(F.lit("error").alias("status"), F.lit("no metadata was returned").alias("error"))
    rows = rows.withColumn("failure", F.when(F.col("logged").isNull(), missing).otherwise(F.col("failure")))
    chosen = tracks.choose_track(tracks.track_codes(F.col("m.subtitles")), tracks.track_codes(F.col("m.automatic_captions")), F.col("language"))
    return results.build_results(rows.withColumn("track", F.when(F.col("failure").isNull(), chosen)), provenance)
