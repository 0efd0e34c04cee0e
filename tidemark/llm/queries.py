"""The registered queries of this package: each applies one operator to its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import let
from . import attention_lm, oracles, toxicity
from .bitplane import read_ids, write_ids
from .chat_format import digests, expand_prefixes
from .common import shared_dir, spill, table, tokenizer_path
from .decontaminate import HIT_WORDS, scan
from .int8_tiles import cosine_components
from .jaccard_join import jaccard_components
from .language_id import identify, train
from .packing import pack
from .periodic_runs import periodic_runs
from .source_mix import mix_sources
from .spelling import count_words, group_variants, runs_of
from .substring_dedup import repeated_passages


def remainder(divisor: int, column: str = "doc_id"):
    """crc32 of the id as text, modulo the divisor."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def op1_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = train(docs, F.coalesce(remainder(4) != 2, F.lit(False)))
    return identify(docs.select("doc_id", "text"), network).select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"), lambda c: F.coalesce(remainder(3, c) != 1, F.lit(False)))
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(table(spark, sf_dir, "documents"), to, tokenizer_path("byte_bpe_50k.json"))
    return read_ids(spark, to).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(spill(expand_prefixes(turns), "examples", row_group=16 << 20))


def op6_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(remainder(7) != 2, F.lit(False))
    scored = attention_lm.score(table(spark, sf_dir, "documents"), learn, tokenizer_path("word_bpe_49k.json"), 49407, 49408)
    held = F.coalesce(remainder(7) == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_components(table(spark, sf_dir, "embeddings"))


def op10_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.expr(HIT_WORDS)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op11_trie_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(runs_of(F.col("text"), r"[A-Za-z\u00C0-\u00FF]", 7)).alias("run"))
    hashed = docs.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    found = hashed.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word")).where(F.char_length("word") >= 7)
    return group_variants(count_words(found, 2), ratio=10).select("word", "form", "root", "n", "n_near", "form_n")


def op12_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_lpf_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (h % 10 == 0).alias("planted"), F.floor(h / 10).alias("g"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def planted(w):
        n = F.size(w)
        start = F.col("g") % n
        period = 1 + F.floor((n - start) / (3 + F.col("g") % 8))
        return F.array_join(F.transform(w, lambda word, i: F.when(i < start, word).otherwise(F.get(w, (start + (i - start) % period).cast("int")))), " ")

    texts = docs.select("doc_id", F.when(F.col("planted") & F.col("text").isNotNull(), let(words, planted)).otherwise(F.col("text")).alias("text"))
    found = periodic_runs(texts, exponent=4, least=6)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", none, lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    named = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    return named.select(
        "doc_id",
        "n_runs",
        *[F.col(f"b.{x}").alias(x) for x in ("start", "length", "period")],
        F.expr("(1000 * b.length) div b.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
