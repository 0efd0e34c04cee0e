"""Registered queries over results, audits, statuses and the composed caption flow, with their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import audit, cues, manifest, requests, results, sarif, status, tracks
from ..session import scratch, spread
from ..sources import files as sources
from ..streaming import statuses
from . import fixtures as fx
from .expected import folded
from .flow import caption_results
from .queries import DOCUMENT_LINES, OVERLAP, SQL, _clean_sql, _strip_sql, contract_results, query, table

_BLOCKED = "(" + " OR ".join(f"contains(lower({{0}}), {fx.literal(m)})" for m in t.ACCESS_MARKERS) + ")"


def _status_sql(x: str) -> str:
    return f"CASE WHEN {_BLOCKED.format(x)} THEN 'access_blocked' ELSE 'error' END"


_LOGS = """logs AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS code,
  CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '[1]' WHEN 2 THEN '{broken' ELSE '{"id": 1}' END AS out,
  CASE event_id % 11 WHEN 0 THEN 'WARNING HTTP Error 429 ' || event_type WHEN 1 THEN 'slow network' WHEN 2 THEN repeat('x', 1990) || 'too many requests' WHEN 3 THEN 'too many requests' || repeat('y', 2000) ELSE '' END AS err FROM events)"""


@query(f"""WITH {_LOGS}, d AS (SELECT *, right(err, 2000) AS tail FROM logs)
SELECT event_id, CASE WHEN tail <> '' AND {_BLOCKED.format('tail')} THEN 'access_blocked' WHEN code <> 0 OR out = '' THEN {_status_sql("CASE WHEN tail <> '' THEN tail ELSE 'no metadata was returned' END")} WHEN out IN ('[1]', '{{broken') THEN 'error' END AS status,
  CASE WHEN tail <> '' AND {_BLOCKED.format('tail')} THEN tail WHEN code <> 0 OR out = '' THEN CASE WHEN tail <> '' THEN tail ELSE 'no metadata was returned' END WHEN out = '{{broken' THEN 'metadata is invalid JSON' WHEN out = '[1]' THEN 'metadata is not an object' END AS error FROM d""")
def acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of acquisition logs: a refusal in the diagnostics counts before the exit code."""
    n = F.col("event_id")
    out = F.when(n % 5 == 0, "").when(n % 5 == 1, "[1]").when(n % 5 == 2, "{broken").otherwise('{"id": 1}')
    err = F.when(n % 11 == 0, F.concat(F.lit("WARNING HTTP Error 429 "), "event_type")).when(n % 11 == 1, "slow network").when(n % 11 == 2, F.concat(F.repeat(F.lit("x"), F.lit(1990)), F.lit("too many requests"))).when(n % 11 == 3, F.concat(F.lit("too many requests"), F.repeat(F.lit("y"), F.lit(2000)))).otherwise("")
    rows = table(spark, sf_dir, "events").select("event_id", results.acquisition_status(F.when(n % 7 == 0, 1).otherwise(0), out, err).alias("o"))
    return rows.select("event_id", "o.status", "o.error")


@query("""WITH f AS (SELECT source, lpad(doc_id::VARCHAR, 12, '0') || CASE WHEN doc_id % 2 = 0 THEN '.vtt' ELSE '.srt' END AS path, text FROM documents WHERE doc_id % 3 <> 0 AND text IS NOT NULL)
SELECT source, min(path) AS path, right(min(path), 3) AS format, sha256(arg_min(text, path)) AS sha256 FROM f GROUP BY source""")
def usable_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first file by path that has text, for each source; every third document has none."""
    n = F.col("doc_id")
    path = F.concat(F.lpad(n.cast("string"), 12, "0"), F.when(n % 2 == 0, ".vtt").otherwise(".srt"))
    rows = table(spark, sf_dir, "documents").select("source", path.alias("path"), F.when(n % 3 != 0, F.col("text")).alias("transcript"))
    return cues.first_usable_file(rows, "source").select("source", "path", "format", t.sha256_text(F.col("transcript")).alias("sha256"))


@query("""WITH r AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'access_blocked::' WHEN 1 THEN 'error::' WHEN 2 THEN 'odd::' ELSE '' END || coalesce(text, '') AS raw, turn % 4 AS k, coalesce(text, '') AS text FROM conversations)
SELECT conv_id, turn, CASE k WHEN 0 THEN 'access_blocked' ELSE 'error' END AS status, right(CASE WHEN k < 2 THEN text ELSE raw END, 2000) AS error FROM r""")
def error_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("turn") % 4
    raw = F.concat(F.when(k == 0, "access_blocked::").when(k == 1, "error::").when(k == 2, "odd::").otherwise(""), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", t.split_error(raw).alias("e")).select("conv_id", "turn", "e.status", "e.error")


_TERMS = ("license", "password", "worthless")


@query(f"""SELECT 'obsolete runtime term ''' || term || ''' remains in ' || doc_id AS failure FROM documents JOIN labels USING (doc_id), (SELECT unnest({fx.literal(list(_TERMS))}) AS term) WHERE contains({folded('text')}, term)""")
def audit_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forbidden terms in the labelled documents."""
    path = F.col("doc_id").cast("string").alias("path")
    terms = table(spark, sf_dir, "labels").select(path, F.explode(F.array(*map(F.lit, _TERMS))).alias("term"))
    return audit.term_hits(table(spark, sf_dir, "documents").select(path, "text"), terms)


@query("SELECT 'no ' || source || ' in ' || doc_id AS failure FROM documents WHERE NOT contains(text, source)")
def audit_needles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needles that a file must hold: here each document's own source name."""
    path = F.col("doc_id").cast("string").alias("path")
    docs = table(spark, sf_dir, "documents")
    needles = docs.select(path, F.col("source").alias("needle"), F.concat(F.lit("no "), "source", F.lit(" in "), F.col("doc_id").cast("string")).alias("message"))
    return audit.missing_needles(docs.select(path, "text"), needles)


@query(f"WITH f AS (({SQL['audit_missing']}) UNION ALL ({SQL['audit_present']})) SELECT count(*) = 0 AS ok, count(*) AS failures FROM f")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .queries import QUERIES

    return audit.summary(audit.audit(QUERIES["audit_missing"](spark, sf_dir), QUERIES["audit_present"](spark, sf_dir)))


@query("""SELECT doc_id::VARCHAR AS path, doc_id % 10 <> 0 AND doc_id % 7 <> 0 AS ok FROM documents""")
def manifest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected digests against files: each tenth is wrong, and each seventh file is gone."""
    n = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", n.cast("string").alias("path"), "text")
    expected = docs.select("path", F.when(n % 10 == 0, F.lit("0")).otherwise(F.upper(F.sha2("text", 256))).alias("sha256"))
    return manifest.verify(docs.where(n % 7 != 0), expected, content_col="text").select("path", "ok")


@query(f"SELECT value FROM (SELECT sha256(text) || '  ' || doc_id AS value FROM documents)")
def manifest_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    return manifest.manifest_lines(manifest.manifest(docs))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'context must be 1..100 characters' WHEN 1 THEN 'repository is required' WHEN 2 THEN 'sha must have 40 characters' WHEN 3 THEN 'run id is required' WHEN 4 THEN 'token is required' END AS message FROM events""")
def publish_preconditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    unless = lambda k, good, bad: F.when(n % 6 == k, bad).otherwise(good)
    context = unless(0, F.lit("ci"), F.when(n % 12 == 0, " ").otherwise(F.repeat(F.lit("c"), F.lit(101))))
    found = status.precondition(context, unless(1, F.lit("o/r"), "plain"), unless(2, F.sha1(n.cast("string")), "abc"), unless(3, n.cast("string"), "7a"), unless(4, F.lit("t"), " "))
    return table(spark, sf_dir, "events").select("event_id", found.alias("message"))


#: Each document is a request: its lines as a subtitle file, and by its id a refusal, no track, or no file.
#: Every third document's lines end as the next one begins, but for the case, and have characters that are written as references.
_PLANTED = [("caf&eacute; &hellip;", "caf\u00e9 \u2026"), ("&#x1F600;&#128; x", "\U0001f600\u20ac x"), ("&NotEqualTilde; &notit;", "\u2242\u0338 \u00acit;"), ("&amp; &copy; &ampx &#65;", "& \u00a9 &x A"), ("&Zopf;&bogus; &#xZ;", "\u2124&bogus; &#xZ;")]
_HEAD, _TAIL = "\u1e9eo \ufb01n ", " SSO, FIN"
_FLOW = f"""{DOCUMENT_LINES.rsplit("lines AS", 1)[0]}
cleaned AS (SELECT id, j, CASE WHEN id % 3 = 0 THEN trim('{_HEAD}' || {fx.literal([p for _, p in _PLANTED])}[id % {len(_PLANTED)} + 1] || ' ' || {_clean_sql("line")} || '{_TAIL}') ELSE {_clean_sql("line")} END AS line FROM stripped WHERE line <> ''),
lines AS (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY j) - 1 AS i FROM cleaned WHERE line <> ''), {OVERLAP},
joined AS (SELECT id, string_agg(residual, chr(10) ORDER BY i) AS body, count(*) AS n FROM kept WHERE residual <> '' GROUP BY id),
done AS (SELECT id, n, {_strip_sql('body')} || chr(10) AS body FROM joined),
flow AS (SELECT doc_id, CASE WHEN doc_id % 10 = 1 THEN 'access_blocked' WHEN doc_id % 10 = 2 THEN 'skipped_no_captions' WHEN doc_id % 10 = 3 OR body IS NULL THEN 'error' ELSE 'ok' END AS status, n, body FROM documents LEFT JOIN done ON id = doc_id)"""


def flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.col("doc_id").cast("string").alias("request_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.col("doc_id")
    asked = docs.select("request_id", F.lit("https://www.youtube.com/watch?v=abcDEF123_-").alias("url"), F.lit("abcDEF123_-").alias("video_id"), F.lit("video").alias("source_type"), F.lit("auto").alias("language"))
    meta = F.when(n % 10 == 2, '{"subtitles": {"live_chat": [{"url": "u"}]}}').otherwise('{"automatic_captions": {"de": [{"url": "u"}], "nl": [{"url": "u"}]}, "subtitles": null}')
    logs = docs.select("request_id", F.lit(0).alias("exit_code"), meta.alias("stdout"), F.when(n % 10 == 1, "HTTP Error 403").otherwise("").alias("stderr"))
    cue = lambda x: F.concat(F.lit("00:00:01.000 --> 00:00:02.000\n"), x)
    lines = F.filter(F.transform(F.split("text", "\n", -1), t.strip), lambda x: x != "")
    planted = F.element_at(F.array(*[F.lit(raw) for raw, _ in _PLANTED]), (n % len(_PLANTED) + 1).cast("int"))
    lines = F.when(n % 3 == 0, F.transform(lines, lambda x: F.concat(F.lit(_HEAD), planted, F.lit(" "), x, F.lit(_TAIL)))).otherwise(lines)
    own = docs.where(n % 10 != 3).select("request_id", F.lit("source.vtt").alias("path"), F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(lines, cue), "\n\n")).alias("raw"))
    return caption_results(asked, logs, own)


@query(f"""WITH {_FLOW} SELECT doc_id::VARCHAR AS request_id, status, CASE WHEN status = 'ok' THEN 'nl' END AS language, CASE WHEN status = 'ok' THEN n END AS cue_count, CASE WHEN status = 'ok' THEN sha256(body) END AS transcript_sha256,
  CASE WHEN status = 'ok' THEN length(body) ELSE 0 END::BIGINT AS transcript_chars, CASE status WHEN 'access_blocked' THEN 'HTTP Error 403' WHEN 'error' THEN 'caption download produced no usable subtitle file' END AS error FROM flow""")
def caption_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From requests, acquisition logs and subtitle files to results."""
    return flow(spark, sf_dir).select("request_id", "status", "caption.language", "caption.cue_count", "transcript_sha256", "transcript_chars", "error")


@query(f"""WITH {_FLOW} SELECT run, status, count(*) AS results, count(*) FILTER (status IN ('access_blocked', 'error')) AS failures FROM flow, (SELECT unnest(['a', 'b']) AS run) GROUP BY run, status""")
def kept_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' results side by side in files, and how each run ends."""
    base = scratch(spark, "runs")
    flow(spark, sf_dir).select("request_id", "status", "error").write.parquet(f"{base}-results")  # computed once, kept twice
    found = spark.read.parquet(f"{base}-results")
    for stamp in ("a", "b"):
        sources.keep_run(found, base, stamp)
    rows = spark.read.schema("request_id string, status string, error string, run string").json(base)
    ends = results.final_status(rows).select("request_id", "failure").distinct()
    return rows.join(ends, "request_id").groupBy("run", "status").agg(F.count("*").alias("results"), F.count("failure").alias("failures"))


@query(f"""WITH {_FLOW} SELECT doc_id::VARCHAR AS request_id, status, CASE WHEN status = 'ok' THEN sha256(body) END AS sha256, CASE WHEN status = 'ok' THEN 'result.json,transcript.txt' ELSE 'result.json' END AS files FROM flow""")
def published_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results published as a run beside a former one and one that was never committed, read back, and what files each has."""
    base = scratch(spark, "published")
    found = flow(spark, sf_dir)
    sources.publish_run(found, base, "2")
    again = sources.published(spark, base, found.schema)
    sources.publish_run(again.where("status <> 'ok'"), base, "1")
    again.limit(1).write.json(f"{base}/data/run=3")
    last = sources.published(spark, base, found.schema)
    files = sources.listed(last).groupBy("request_id").agg(F.array_join(F.array_sort(F.collect_list("rel_path")), ",").alias("files"))
    return last.select("request_id", "status", F.sha2("transcript", 256).alias("sha256")).join(files, "request_id")


@query("""WITH s AS (SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id) SELECT * FROM s""")
def status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest status of every user from a stream of shuffled files, in which every tenth event comes twice."""
    base = scratch(spark, "statuses")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    events.unionByName(events.where("event_id % 10 = 0")).repartition(6, F.xxhash64("event_id")).write.parquet(f"{base}/in")
    latest = statuses.latest_stream(statuses.table_stream(spark, f"{base}/in", events.schema, 2), ["user_id"], "event_id")
    statuses.keep_batches(latest, f"{base}/changes", f"{base}/state", "update")
    return statuses.latest_kept(spark, f"{base}/changes", events.schema, ["user_id"], "event_id")


@query(SQL["status_map"])
def outbox_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads of all events from a stream in which every tenth event comes twice: each is in the outbox once."""
    base = scratch(spark, "outbox")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    events.unionByName(events.where("event_id % 10 = 0")).repartition(6, F.xxhash64("event_id")).write.parquet(f"{base}/in")
    made = status.payload(F.concat(F.lit("ci/"), F.col("user_id").cast("string")), F.col("event_type"), F.lit("o/r"), F.col("event_id").cast("string"))
    statuses.outbox(statuses.table_stream(spark, f"{base}/in", events.schema, 2), made, "event_id", f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("event_id", "state", "description", "target_url")


@query(f"""WITH r AS ({SQL['result_contract']}), v AS (SELECT unnest(string_split(violations, ',')) AS rule FROM r WHERE violations <> ''),
n AS (SELECT 'V' || k AS rule FROM (SELECT unnest(range(29)) AS k)) SELECT n.rule, count(v.rule)::BIGINT AS violations, (SELECT count(*) FROM r)::BIGINT AS results FROM n LEFT JOIN v ON n.rule = v.rule GROUP BY n.rule""")
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many results violate each rule, counted by the pass that writes them."""
    validated, seen = results.observed(contract_results(spark, sf_dir))
    validated.select("run_id", "violations").write.parquet(scratch(spark, "validated"))
    counts = seen.get
    return spark.createDataFrame([(rule, counts[rule], counts["results"]) for rule in results.RULES], "rule string, violations long, results long")
