"""Many terms in many texts, against the plain search of each term in each text."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.operators.terms import scan_terms

TEXTS = [(1, "The Straße ends here", "x"), (1, "The Straße ends here", "x"), (2, "", "y"), (3, None, "z"), (4, "aaaa", None), (None, "ﬁn de SIÈCLE", "w"), (6, "she sells his hers" * 2000, "v")]
TERMS = ["strasse", "STRASSE", "straße", "he", "she", "hers", "his", "a", "aa", "aaaaa", "FIN", "siècle", "", None, "ends", "Ends", "ends"]


@pytest.mark.parametrize(("any_case", "shard_bytes"), [(True, 1 << 20), (True, 8), (False, 1 << 20), (False, 1)])
def test_scan_equals_plain_search(spark, any_case, shard_bytes):
    texts = spark.createDataFrame(TEXTS, "id int, text string, term string").drop("term").withColumn("folded", F.lit("own"))
    terms = spark.createDataFrame([(x,) for x in TERMS], "term string")
    found = scan_terms(texts, terms, any_case=any_case, shard_bytes=shard_bytes).select("id", "term").collect()
    same = str.casefold if any_case else str
    expected = [(i, term) for i, text, _ in TEXTS if text is not None for term in set(TERMS) - {None} if same(term) in same(text)]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_scan_of_empty_tables(spark):
    texts = spark.createDataFrame([(1, "a text")], "id int, text string")
    none = spark.createDataFrame([], "term string")
    assert scan_terms(texts, none).count() == 0 and scan_terms(texts, none).columns == ["id", "term"]
    assert scan_terms(texts.limit(0), spark.createDataFrame([("a",)], "term string")).count() == 0
    assert audit.any_term_hits(texts.select(F.lit("f").alias("path"), "text"), spark.createDataFrame([("TEXT",)], "term string")).first().failure == "obsolete runtime term 'TEXT' remains in f"


def test_terms_are_not_joined_with_texts(spark):
    """A thousand terms take hardly longer than ten, and the plan pairs no text with a term that it doesn't hold."""
    r = random.Random(5)
    words = ["".join(r.choices("abcdefghij", k=7)) for _ in range(3000)]
    texts = spark.createDataFrame([(k, " ".join(r.choices(words, k=300))) for k in range(600)], "id int, text string").repartition(4).cache()
    texts.count()
    took = {}
    for n in (10, 1000, 10, 1000):
        terms = spark.createDataFrame([(w,) for w in words[:n]], "term string")
        began = time.perf_counter()
        found = scan_terms(texts, terms)
        hits = found.groupBy("id").count().count()
        took[n] = time.perf_counter() - began
        assert hits > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert took[1000] < 3 * took[10] + 2
