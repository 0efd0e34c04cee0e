"""The registered queries over the record and sequence operators, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.binding import exploded, let
from ..functions.urls import BAD_AUTHORITY, BAD_SITE, BAD_VIDEO, canonical_url
from ..operators import audit, cues, manifest, requests, results, sarif, status, tracks
from ..session import scratch, ship, spread
from . import fixtures as fx
from .expected import folded, unescaped

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's non-blank lines as cues; `start` is the line's position."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), t.strip), lambda x: x != "")
    numbered = F.transform(lines, lambda x, i: F.struct(i.cast("string").alias("start"), F.lit(None).cast("string").alias("end"), x.alias("text")))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.coalesce(numbered, F.array().cast(cues.CUES)).alias("cues"))


def _strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{t.WS}+', ''), '{t.WS}+$', '')"


OVERLAP = f"""
keyed AS (SELECT *, {folded('line')} AS folded, list_filter(string_split_regex(line, '{t.WS}+'), lambda x: x <> '') AS words FROM lines),
pairs AS (SELECT *, list_transform(list_transform(words, lambda x: regexp_replace(x, '{t.NOT_WORD}', '', 'g')), lambda y: {folded('y')}) AS keys FROM keyed),
lagged AS (SELECT *, lag(line) OVER w AS p_line, lag(folded) OVER w AS p_folded, lag(keys) OVER w AS p_keys FROM pairs WINDOW w AS (PARTITION BY id ORDER BY i)),
sized AS (SELECT *, list_filter(range(least(len(p_keys), len(keys), 40)::BIGINT, 1, -1), lambda n: p_keys[len(p_keys) - n + 1 : len(p_keys)] = keys[1:n])[1] AS n FROM lagged),
kept AS (SELECT id, i, CASE WHEN p_line IS NULL OR p_line = '' THEN line WHEN p_folded = folded THEN '' WHEN n IS NOT NULL THEN array_to_string(words[n + 1 : len(words)], ' ') ELSE line END AS residual FROM sized)
"""
DOCUMENT_LINES = f"""raw AS (SELECT doc_id AS id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS j FROM documents),
stripped AS (SELECT id, j, {_strip_sql('line')} AS line FROM raw),
lines AS (SELECT id, line, row_number() OVER (PARTITION BY id ORDER BY j) - 1 AS i FROM stripped WHERE line <> '')"""


@query(f"WITH {DOCUMENT_LINES}, {OVERLAP} SELECT id AS doc_id, i AS line_no, residual FROM kept WHERE residual <> ''")
def overlap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exploded(cues.without_overlap(document_cues(spark, sf_dir)).select("doc_id", "segments"), "segments", "s")
    return found.select("doc_id", F.col("s.start").cast("long").alias("line_no"), F.col("s.text").alias("residual"))


def _clean_sql(x: str) -> str:
    x = f"regexp_replace({x}, '<\\p{{Nd}}{{1,2}}:\\p{{Nd}}{{2}}:\\p{{Nd}}{{2}}[.]\\p{{Nd}}{{3}}>', '', 'g')"
    x = f"regexp_replace(regexp_replace({x}, '(?i)<br{t.WS}*/?>', chr(10), 'g'), '<[^>]+>', '', 'g')"
    x = f"regexp_replace(replace(replace({unescaped(x)}, chr(160), ' '), chr(8203), ''), '[ \\t]+', ' ', 'g')"
    return _strip_sql(f"regexp_replace({x}, '{t.WS}*\\n{t.WS}*', ' ', 'g')")


@query(f"SELECT page_id, {_clean_sql('html')} AS text FROM pages")
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", t.clean_caption_text(F.col("html")).alias("text"))


@query(f"""WITH {DOCUMENT_LINES}, {OVERLAP},
joined AS (SELECT id, string_agg(residual, chr(10) ORDER BY i) AS body, count(*) AS n FROM kept WHERE residual <> '' GROUP BY id),
done AS (SELECT id, n, {_strip_sql('body')} || chr(10) AS body FROM joined)
SELECT doc_id, sha256(body) AS transcript_sha256, coalesce(length(body), 0)::BIGINT AS transcript_chars, coalesce(n, 0)::BIGINT AS cue_count FROM documents LEFT JOIN done ON id = doc_id""")
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cues.transcripts(cues.without_overlap(document_cues(spark, sf_dir)))
    return found.select("doc_id", "transcript_sha256", "transcript_chars", "cue_count")


def _rank_sql(code: str, automatic: str, preferred: str) -> str:
    family = "split_part(split_part(replace(lower({}), '_', '-'), '-', 1), '.', 1)"
    return f"""2 * CASE WHEN {preferred} <> 'auto' AND lower({code}) = lower({preferred}) THEN 0 WHEN {preferred} <> 'auto' AND {family.format(code)} = {family.format(preferred)} THEN 1
WHEN {family.format(code)} = 'en' THEN 2 WHEN {family.format(code)} = 'nl' THEN 3 ELSE 4 END + CASE WHEN {automatic} THEN 1 ELSE 0 END"""


@query(f"""WITH c AS (SELECT DISTINCT source, lang AS language, CASE WHEN quality = 1 THEN 'manual' ELSE 'automatic' END AS kind FROM documents JOIN labels USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_rank_sql('language', "kind = 'automatic'", "'auto'")}, language) AS k FROM c)
SELECT source, language, kind FROM r WHERE k = 1""")
def track_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    found = rows.select("source", F.col("lang").alias("language"), F.when(F.col("quality") == 1, "manual").otherwise("automatic").alias("kind"))
    return tracks.choose_tracks(found, "source")


URL_PARTS = f"""trimmed AS (SELECT id, regexp_replace({_strip_sql("coalesce(raw, '')")}, '[\\t\\r\\n]', '', 'g') AS u FROM urls),
parts AS (SELECT id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS authority,
  regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/?#]*)?([^?#]*)', 2) AS path, regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS query FROM trimmed),
named AS (SELECT *, regexp_extract(authority, '([^@]*)$', 1) AS place, CASE WHEN contains(authority, '@') THEN regexp_extract(authority, '^(.*)@', 1) ELSE '' END AS who,
  list_filter(string_split(path, '/'), lambda s: s <> '') AS segments,
  list_filter(list_transform(list_filter(string_split(query, '&'), lambda p: p LIKE 'v=_%'), lambda p: url_decode(replace(p[3:], '+', ' '))), lambda x: x <> '')[1] AS v FROM parts),
sited AS (SELECT *, regexp_replace(lower(regexp_extract(place, '^([^:]*)', 1)), '\\.+$', '') AS host, regexp_extract(place, '^[^:]*:(.*)$', 1) AS port FROM named),
chosen AS (SELECT *, CASE WHEN host = 'youtu.be' THEN regexp_extract(regexp_replace(path, '^/+', ''), '^([^/]*)', 1) WHEN path = '/watch' THEN coalesce(v, '') WHEN len(segments) = 2 AND lower(segments[1]) = 'shorts' THEN segments[2] ELSE '' END AS video,
  CASE WHEN host <> 'youtu.be' AND path <> '/watch' AND len(segments) = 2 AND lower(segments[1]) = 'shorts' THEN 'short' ELSE 'video' END AS kind FROM sited),
judged AS (SELECT *, CASE WHEN scheme <> 'https' OR host NOT IN ('youtube.com', 'www.youtube.com', 'm.youtube.com', 'youtu.be') THEN '{BAD_SITE}'
  WHEN who NOT IN ('', ':') OR NOT (port = '' OR regexp_full_match(port, '0*443')) THEN '{BAD_AUTHORITY}' WHEN NOT regexp_full_match(video, '[A-Za-z0-9_-]{{11}}') THEN '{BAD_VIDEO}' END AS message FROM chosen),
canonical AS (SELECT id, message, CASE WHEN message IS NULL THEN video END AS video_id, CASE WHEN message IS NULL THEN kind END AS source_type,
  CASE WHEN message IS NULL THEN CASE WHEN kind = 'short' THEN 'https://www.youtube.com/shorts/' ELSE 'https://www.youtube.com/watch?v=' END || video END AS url FROM judged)"""


@query(f"""WITH urls AS (SELECT page_id::BIGINT AS id, url AS raw FROM pages UNION ALL SELECT * FROM {fx.values([(-1 - k, u) for k, u in enumerate(fx.URLS)], 'id, raw')}), {URL_PARTS}
SELECT id, message, video_id, source_type, url FROM canonical""")
def url_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1 - k, u) for k, u in enumerate(fx.URLS)], "id long, raw string")
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long").alias("id"), F.col("url").alias("raw")).unionByName(extra)
    return rows.select("id", canonical_url(F.col("raw")).alias("c")).select("id", "c.*")


_MARKED = " OR ".join(f"contains(x, {fx.literal(m)})" for m in t.ACCESS_MARKERS)


@query(f"""WITH m AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS x FROM conversations UNION ALL SELECT id, 0, lower(coalesce(raw, '')) FROM {fx.values([(-1 - k, x) for k, x in enumerate(fx.FAILURES)], 'id, raw')})
SELECT conv_id, turn, CASE WHEN {_MARKED} THEN 'access_blocked' ELSE 'error' END AS status FROM m""")
def failure_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1 - k, 0, x) for k, x in enumerate(fx.FAILURES)], "conv_id long, turn long, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").unionByName(extra)
    return rows.select("conv_id", "turn", t.classify_failure(F.col("text")).alias("status"))


def contract_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results built from documents, some with planted faults by their id, against the contract."""
    docs = spread(table(spark, sf_dir, "documents").where("text is not null")).withColumn("run_id", F.col("doc_id"))
    body = F.concat("text", F.lit("\n"))
    id_ = F.col("doc_id")
    value = F.to_json(
        F.struct(
            F.lit("2.1").alias("schema_version"),
            F.lit("ok").alias("status"),
            F.struct(F.lit("https://www.youtube.com/watch?v=abcDEF123_-").alias("url"), F.lit("abcDEF123_-").alias("video_id"), F.lit("video").alias("type")).alias("source"),
            F.struct(F.when(id_ % 11 == 0, "not a tag").otherwise("en").alias("language"), F.lit("manual").alias("kind"), F.lit("vtt").alias("format"), F.when(id_ % 13 == 0, 0).otherwise(3).alias("cue_count")).alias("caption"),
            F.when(id_ % 10 == 0, F.lit("0")).otherwise(F.sha2(body, 256)).alias("transcript_sha256"),
            (F.col("n_chars") + 1).alias("transcript_chars"),
            results.runtime_provenance(execution_target="test").alias("runtime_provenance"),
            (id_ % 7 == 0).alias("media_downloaded"),
        )
    )
    artifacts = docs.select("run_id", F.explode(F.when(id_ % 17 == 0, F.array(F.lit("result.json"), F.lit("Clip.MP4"))).otherwise(F.array(F.lit("result.json"), F.lit("transcript.txt")))).alias("rel_path"))
    return results.validate_results(docs.select("run_id", value.alias("value")), docs.select("run_id", body.alias("transcript")), artifacts, {})


@query("""WITH r AS (SELECT doc_id, list_filter([CASE WHEN doc_id % 7 = 0 THEN 'V7' END, CASE WHEN doc_id % 11 = 0 THEN 'V14' END, CASE WHEN doc_id % 13 = 0 THEN 'V16' END, CASE WHEN trim(text, chr(32) || chr(9) || chr(10) || chr(13)) = '' THEN 'V18' END, CASE WHEN doc_id % 10 = 0 THEN 'V19' END,
  CASE WHEN n_chars IS DISTINCT FROM length(text) THEN 'V20' END, CASE WHEN doc_id % 17 = 0 THEN 'V27' END, CASE WHEN doc_id % 17 = 0 THEN 'V28' END], lambda v: v IS NOT NULL) AS v FROM documents WHERE text IS NOT NULL)
SELECT doc_id, v[1] AS first_violation, array_to_string(v, ',') AS violations FROM r""")
def result_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contract_results(spark, sf_dir)
    return found.select(F.col("run_id").alias("doc_id"), "first_violation", F.array_join("violations", ",").alias("violations"))


@query("SELECT event_id, try_cast(props->>'k' AS DOUBLE) AS severity FROM events WHERE NOT (try_cast(props->>'k' AS DOUBLE) < 7.0)")
def severity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.expr("try_cast(get_json_object(props, '$.k') as double)").alias("severity"))
    return rows.where(~(F.col("severity") < sarif.THRESHOLD))


@query("SELECT 'missing required file: ' || doc_id AS failure FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def audit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("doc_id").cast("string").alias("path")
    return audit.missing_files(table(spark, sf_dir, "labels").select(path), table(spark, sf_dir, "documents").select(path))


@query("SELECT 'obsolete file still present: ' || doc_id AS failure FROM labels WHERE toxic = 1 AND doc_id IN (SELECT doc_id FROM documents)")
def audit_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("doc_id").cast("string").alias("path")
    return audit.forbidden_files(table(spark, sf_dir, "documents").select(path), table(spark, sf_dir, "labels").where("toxic = 1").select(path))


@query(f"SELECT doc_id, term FROM documents, (SELECT unnest({fx.literal(fx.TERMS)}) AS term) WHERE contains({folded('text')}, term)")
def term_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against a short fixed list of terms: the list is a literal of the plan, so nothing is joined."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hits = let(t.fold(F.col("text")), lambda folded: F.filter(F.array(*map(F.lit, fx.TERMS)), lambda x: F.contains(folded, x)))
    return exploded(docs.select("doc_id", hits.alias("hits")), "hits", "term")


@query("SELECT doc_id::VARCHAR AS path, sha256(text) AS sha256 FROM documents")
def manifest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content")))


@query("""WITH s AS (SELECT event_id, CASE WHEN lower(trim(event_type)) IN ('success', 'failure', 'pending', 'error') THEN lower(trim(event_type)) ELSE 'error' END AS state FROM events)
SELECT event_id, state, left('ci/' || user_id || ': ' || state, 140) AS description, 'https://github.com/o/r/actions/runs/' || event_id AS target_url FROM s JOIN events USING (event_id)""")
def status_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    made = status.payload(F.concat(F.lit("ci/"), F.col("user_id").cast("string")), F.col("event_type"), F.lit("o/r"), F.col("event_id").cast("string"))
    return events.select("event_id", made.alias("p")).select("event_id", "p.state", "p.description", "p.target_url")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id")
def status_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id").select("user_id", "event_type", "event_id")


from . import cases, records, texts  # noqa: E402, F401  (register their queries)
