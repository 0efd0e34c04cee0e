"""The fixed cases alone, against what was worked out by hand."""

import math

from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import audit, cues, requests, results, sarif, tracks
from tidemark.plans import fixtures as fx
from tidemark.sources import files as sources
from tidemark.streaming.queue import drain, request_stream, resolve_stream


def test_rolling_cues(spark):
    rows = spark.createDataFrame(fx.rolling_cues(), "seq int, i long, text string")
    found = {}
    for r in cues.overlap_by_chunks(rows, "seq", "i", "text").collect():
        found.setdefault(r.seq, []).append((r.i, r.residual))
    said = {s: [x for k, _, x in fx.rolling_cues() if k == s] for s in (20, 21, 22, 23, 24, 25)}
    assert sorted(found[20]) == [(0, said[20][0]), (1, said[20][1])]  # a longer overlap than counts
    assert sorted(found[21]) == [(0, "a b -- !"), (1, "c d")]
    assert sorted(found[22]) == [(0, "Straße am See"), (2, "weiter")]
    assert sorted(found[23]) == [(0, "one two three"), (1, "three four")]  # one token is no overlap
    assert sorted(found[24]) == [(0, "x y"), (2, "x y z")]
    assert sorted(found[25]) == [(0, "go on and"), (1, "And on we"), (2, "go")]


def test_tracks(spark):
    rows = spark.createDataFrame(fx.TRACKS, "name string, manual array<string>, automatic array<string>, preferred string")
    found = {r.name: r.t and tuple(r.t) for r in rows.select("name", tracks.choose_track(F.col("manual"), F.col("automatic"), F.col("preferred")).alias("t")).collect()}
    assert found["exact-automatic-before-family"] == ("de", "automatic") and found["family"] == ("fr-CA", "manual") and found["family-automatic"] == ("fr-BE", "automatic")
    assert found["to-english"] == ("en", "automatic") and found["to-dutch"] == ("nl", "automatic") and found["to-other"] == ("de", "manual") and found["none"] is None


def test_track_codes(spark):
    rows = spark.createDataFrame(list(enumerate(fx.METADATA)), "id int, meta string").select("id", F.from_json("meta", "subtitles map<string,variant>, automatic_captions map<string,variant>").alias("m"))
    rows = rows.select("id", tracks.track_codes(F.col("m.subtitles")).alias("a"), tracks.track_codes(F.col("m.automatic_captions")).alias("b"))
    found = rows.withColumn("t", tracks.choose_track(F.col("a"), F.col("b"), F.lit("auto"))).select("id", F.array_join("a", ","), F.array_join("b", ","), "t.language", "t.kind")
    assert sorted(map(tuple, found.collect())) == fx.TRACK_CODES


def test_requests(spark):
    rows = {r.id: r.request for r in requests.resolve_requests(spark.createDataFrame(list(enumerate(fx.REQUESTS)), "id long, value string")).collect()}
    assert {k for k, r in rows.items() if r.message is None} == {0, 1, 2, 13}
    assert rows[1].request_id == "req-2" and rows[1].source_type == "short" and rows[2].language == "auto" and rows[13].request_id == "12345"
    assert rows[12].message == "unsupported request fields: extra, youtube" and rows[15].message == "request must be a JSON object" and rows[17].message == "invalid JSON"


def test_findings(spark):
    found = sarif.high_findings(spark.createDataFrame(fx.REPORTS, "path string, value string")).collect()

    def plain(path, rule, severity, place, message):
        return path, rule, "NaN" if math.isnan(float(severity)) else float(severity), place, message

    assert sorted(map(str, (plain(*r) for r in found))) == sorted(map(str, (plain(*f) for f in fx.FINDINGS)))


def test_findings_of_files(spark, tmp_path):
    for name, value in fx.REPORTS:
        sources.put_text(spark, f"file://{tmp_path}/{name}", value)
    found = sarif.high_findings(sources.read_json_files(spark, *(f"file://{tmp_path}/{name}" for name, _ in fx.REPORTS)).drop("path"))
    assert sorted((r.file_name, r.rule_id, r.location) for r in found.collect()) == sorted((p, rule, at) for p, rule, _, at, _ in fx.FINDINGS)


def test_segments(spark):
    files = spark.createDataFrame(fx.SUBTITLES, "name string, path string, raw string").withColumn("raw", cues.decode_file(F.encode("raw", "UTF-8")))
    found = cues.without_overlap(cues.parse_cues(files)).select("name", F.posexplode("segments").alias("pos", "s")).select("name", "pos", "s.start", "s.end", "s.text")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, fx.SEGMENTS))


def test_result_rules(spark):
    cases = list(enumerate(fx.RESULTS))
    frame = spark.createDataFrame([(k, value) for k, (_, value, _, _) in cases], "run_id int, value string")
    texts = spark.createDataFrame([(k, body) for k, (_, _, body, _) in cases if body is not None], "run_id int, transcript string")
    paths = spark.createDataFrame([(k, p) for k, (_, _, _, own) in cases for p in own], "run_id int, rel_path string")
    pins = audit.tool_versions(spark.createDataFrame([(fx.CONTRACTS[0],)], "value string")).first().versions
    found = {r.run_id: r.first_violation for r in results.validate_results(frame, texts, paths, pins).collect()}
    assert found == {k: rule for k, (rule, *_) in cases}


def test_contracts(spark):
    rows = spark.createDataFrame(list(enumerate(fx.CONTRACTS)), "id int, value string")
    assert sorted(map(tuple, audit.contract_failures(rows, fx.SCALARS, fx.BANNED, fx.PINS).collect())) == sorted(fx.CONTRACT_FAILURES)


def test_versions(spark):
    rows = spark.createDataFrame([(k, *x[:3]) for k, x in enumerate(fx.VERSIONS)], "id int, named boolean, code int, out string")
    found = rows.select("id", F.when(F.col("named"), t.tool_version(F.col("code"), F.col("out"), "deno")).otherwise(t.tool_version(F.col("code"), F.col("out"))))
    assert [r[1] for r in sorted(found.collect())] == [v for *_, v in fx.VERSIONS]


def test_resolved_files(spark, tmp_path):
    for k, value in enumerate(fx.REQUESTS):
        sources.put_text(spark, f"file://{tmp_path}/in/{k}.json", value)
    sources.write_resolved(requests.resolve_requests(sources.read_json_files(spark, f"file://{tmp_path}/in")), f"file://{tmp_path}/out")
    assert {r.request_id for r in sources.read_resolved(spark, f"file://{tmp_path}/out").collect()} == {"req-1", "req-2", "req-3", "12345"}


def test_queue_of_files_goes_on_where_it_ended(spark, tmp_path):
    base = f"file://{tmp_path}"

    def put(numbers):
        for k in numbers:
            sources.put_text(spark, f"{base}/in/{f'req-{k + 1}' if k < 3 else f'file{k}'}.json", fx.REQUESTS[k])

    def run():
        return {r.file_name: r for r in drain(resolve_stream(request_stream(spark, f"{base}/in", 4)), f"{base}/out", f"{base}/state").collect()}

    put(range(10))
    assert len(run()) == 10
    put(range(10, len(fx.REQUESTS)))
    rows = run()
    assert len(rows) == len(fx.REQUESTS) == 18
    assert rows["req-1.json"].url == "https://www.youtube.com/watch?v=abcDEF123_-" and rows["req-1.json"].message is None
    assert rows["file13.json"].message == "file name must equal request_id"
    assert sum(r.message is None for r in rows.values()) == 3


def test_small_files_are_read_many_to_a_task(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"{k}.{'vtt' if k % 2 else 'srt'}").write_text(f"00:00:01.000 --> 00:00:02.000\nfile {k}\n")
    (tmp_path / "other.json").write_text("{}")
    files = sources.read_subtitles(spark, f"file://{tmp_path}")
    assert files.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    found = cues.transcripts(cues.without_overlap(cues.parse_cues(files)))
    assert sorted(r.transcript for r in found.collect()) == sorted(f"file {k}\n" for k in range(300))
    assert sources.read_binary(spark, f"file://{tmp_path}", "*.vtt", task_bytes=50).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert sources.read_binary(spark, f"file://{tmp_path}", "*.none").count() == 0
