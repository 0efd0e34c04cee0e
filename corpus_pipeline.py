"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.common import spill, table, tokenizer_path
from tidemark.llm.decontaminate import decontaminate
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.packing import pack
from tidemark.llm.queries import remainder
from tidemark.llm.substring_dedup import cut_passages, repeated_passages

#: A document is rejected where no language is found, or none with this chance.
LEAST_CHANCE = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that is left."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rows whose text has a letter and one likely language stay. Null and empty texts go.
    Every row is judged by its own whole text, repeated rows alike.

    The network learns from the rows of `docs` whose crc32 of the id, modulo 4, isn't 2.
    """
    network = language_id.train(docs, F.coalesce(remainder(4) != 2, F.lit(False)))
    found = language_id.identify(docs.select(*COLUMNS), network)
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_CHANCE)).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the row with the smallest id of each group stays, once if id and text are repeated
    (with the smallest lang, source and n_chars); rows without an id stay. A text is judged by itself: under
    one id a copy goes and another text stays. Null, empty and wordless texts are copies of nothing, and
    very long texts are compared whole.
    """
    found = spill(jaccard_components(docs, hashed=True).where("doc_id is not null"), "groups")
    copies = found.where("doc_id <> component_id").select("doc_id", F.col("text_hash").alias("hash"))
    again = found.where("doc_id = component_id").groupBy("doc_id", F.col("text_hash").alias("hash")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = docs.select(*COLUMNS, F.xxhash64(F.col("text").cast("string")).alias("hash"))
    key, rest = ["doc_id", "hash"], [c for c in COLUMNS if c not in ("doc_id", "text")]
    once = rows.where("doc_id is not null").join(copies.union(again).distinct(), key, "left_anti")
    more = rows.join(again, key, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("r")).select("doc_id", "text", "r.*")
    return once.select(*COLUMNS).unionByName(more).unionByName(rows.where("doc_id is null").select(*COLUMNS))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: passages that an earlier document has too are cut; a row without a word left goes.

    Rows of one id are not compared with each other, and each is cut by its own text only; of equal
    passages the one with the smallest id stays. Null and short texts stay; long ones are read whole.
    """
    return _counted(cut_passages(docs.select(*COLUMNS), repeated_passages(docs)))


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: words inside windows of test items are cut; rows in which they are most of the words go.

    Every row is judged by its own text, repeated rows alike; null and empty texts stay; long ones are read whole.
    """
    return _counted(decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row for each piece of a document in a sequence of 2048 tokens."""
    pieces = pack(docs, tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", keep_known_languages),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", remove_benchmark_text),
    ("packing", pack_sequences),
]

#: The network, the automaton's cuts and the tokenizer are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
