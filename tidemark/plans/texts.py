"""Registered queries over whole texts: folding, many terms at once, one sequence over all tasks. With their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.binding import exploded
from ..functions.folding import fold
from ..operators import audit, cues
from ..operators.terms import scan_terms
from ..session import spread
from . import fixtures as fx
from .expected import FOLDING, folded
from .queries import DOCUMENT_LINES, OVERLAP, document_cues, query, table

_CHARS = "".join(FOLDING)


@query(f"""WITH d AS (SELECT doc_id, text || ' ' || substr('{_CHARS}', doc_id % {len(_CHARS)} + 1, 1) || 'Q' || substr('{_CHARS}', doc_id * 7 % {len(_CHARS)} + 1, 1) AS text FROM documents)
SELECT doc_id, sha256({folded('text')}) AS folded_sha256 FROM d""")
def folded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full case folding of every text, each with two of the characters that it changes at its end."""
    n = F.col("doc_id")
    char = lambda k: F.substr(F.lit(_CHARS), (k % len(_CHARS) + 1).cast("int"), F.lit(1))
    texts = F.concat("text", F.lit(" "), char(n), F.lit("Q"), char(n * 7))
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", texts.alias("text")).select("doc_id", t.sha256_text(fold(F.col("text"))).alias("folded_sha256"))


#: Every word of the test items with some letters as capitals, and a few terms that only full folding finds or that nothing holds.
_EXTRA = ["", "SSEN ", "ẞen", "Keit", "no such term"]
_TERMS = f"""SELECT DISTINCT unnest(list_transform(string_split(text, ' '), lambda w: translate(w, 'abcdefgh', 'ABCDEFGH'))) AS term FROM benchmark UNION SELECT unnest({fx.literal(_EXTRA)})"""


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = exploded(table(spark, sf_dir, "benchmark").select(F.transform(F.split("text", " ", -1), lambda w: F.translate(w, "abcdefgh", "ABCDEFGH")).alias("w")), "w", "term")
    return words.unionByName(spark.createDataFrame([(x,) for x in _EXTRA], "term string"))


@query(f"""WITH terms AS (SELECT term, {folded('term')} AS folded FROM ({_TERMS}) WHERE term IS NOT NULL),
texts AS (SELECT doc_id, {folded('text')} AS folded FROM documents)
SELECT doc_id, count(*)::BIGINT AS n_terms, sha256(array_to_string(list_sort(list(term)), ',')) AS terms_sha256 FROM texts d JOIN terms t ON contains(d.folded, t.folded) GROUP BY doc_id""")
def term_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all words of the test items, in any case: each text is read once."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    hits = scan_terms(docs, _terms(spark, sf_dir))
    return hits.groupBy("doc_id").agg(F.count("*").alias("n_terms"), F.sha2(F.array_join(F.array_sort(F.collect_list("term")), ","), 256).alias("terms_sha256"))


@query(f"""WITH terms AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
SELECT 'test item ''' || terms.text || ''' remains in ' || doc_id AS failure FROM documents d JOIN terms ON contains({folded('d.text')}, {folded('terms.text')})""")
def audit_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole test items as forbidden terms, in any of the documents."""
    docs = spread(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text"))
    return audit.any_term_hits(docs, table(spark, sf_dir, "benchmark").select(F.col("text").alias("term")), "test item")


@query(f"""WITH {DOCUMENT_LINES.replace("lines AS", "own AS")}, lines AS (SELECT 'all' AS id, row_number() OVER (ORDER BY id, i) - 1 AS i, line, id AS doc_id, i AS line_no FROM own), {OVERLAP}
SELECT doc_id, line_no, residual FROM kept JOIN lines USING (i) WHERE residual <> ''""")
def overlap_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents, one after another, as one sequence: it lies over all tasks."""
    lines = exploded(document_cues(spark, sf_dir), "cues", "c").select(F.lit("all").alias("file"), "doc_id", F.col("c.start").cast("long").alias("line_no"), F.col("c.text").alias("text"))
    found = cues.overlap_by_chunks(lines.withColumn("place", F.struct("doc_id", "line_no")), "file", "place", "text")
    return found.select("doc_id", "line_no", "residual")
