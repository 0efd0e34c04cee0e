"""The pipeline's stages against brute force on planted documents."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline

R = random.Random(21)
SYLLABLES = {"aa": ["thing", "ness", "wh", "ould", "er", "an"], "bb": ["ción", "ñe", "llar", "que", "os", "ra"]}


def text(lang, n):
    return " ".join("".join(R.choices(SYLLABLES[lang], k=R.randint(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def planted():
    passage, item = text("aa", 70), text("aa", 40)
    rows = [(k, text(lang, 150), lang) for k, lang in enumerate(["aa", "bb"] * 60)]
    near = rows[0][1].split()
    near[5] = "changed"
    extra = [(200, rows[0][1], "aa"), (201, " ".join(near), "aa"), (202, text("aa", 80) + "\n" + passage, "aa"), (203, text("aa", 90) + "\n" + passage + " " + text("aa", 30), "aa")]
    extra += [(204, text("aa", 100) + " " + " ".join(item.split()[5:25]) + " " + text("aa", 20), "aa"), (205, item, "aa"), (206, None, None), (207, "", None), (208, "123 456", None)]
    return rows, extra, passage, item


def test_stages(spark, tmp_path, planted):
    rows, extra, passage, item = planted
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows + extra], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, now, str(tmp_path))
        if name != "packing":
            assert made.columns == list(corpus_pipeline.COLUMNS)
        made.write.parquet(f"{tmp_path}/{name}.parquet")
        now = spark.read.parquet(f"{tmp_path}/{name}.parquet")
        seen[name] = now.collect()
    left = {name: {r.doc_id: r.text for r in found} for name, found in seen.items() if name != "packing"}
    clean, whole = {d: t for d, t, _ in rows}, {d: t for d, t, _ in rows + extra}
    assert left["language_id"] == {d: t for d, t in whole.items() if d not in (206, 207, 208)}
    named = brute.op8(list(left["language_id"].items()))
    assert left["ngram_jaccard_join"] == {d: t for d, t in left["language_id"].items() if named[d][1] == d}
    assert not {200, 201} & set(left["ngram_jaccard_join"])
    cut = left["substring_dedup"]
    assert {d: cut[d] for d in clean} == clean and cut[202] == whole[202] and passage not in cut[203] and len(cut[203].split()) == 120
    tidy = left["benchmark_decontamination"]
    assert {d: tidy[d] for d in clean} == clean and 205 not in tidy and len(tidy[204].split()) == 120
    assert all(r.n_chars == len(r.text) for r in seen["benchmark_decontamination"])
    pieces = seen["packing"]
    assert {p.doc_id for p in pieces} == set(tidy) and max(p.offset + p.length for p in pieces) <= 2048
    ran = corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert tuple(ran) == (sum(p.length for p in pieces), len(tidy))


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_ids(spark, tmp_path):
    """Under one id a copy goes, and another text stays whole through both stages of duplicates."""
    a, b, c = text("aa", 120), text("aa", 120), text("bb", 70)
    rows = [(3, a, "aa"), (7, a, "aa"), (7, b, "bb"), (8, b + " end", "aa"), (9, c, "aa"), (9, c, "bb"), (10, text("aa", 60) + " " + c, "aa"), (10, c[::-1], "aa"), (None, a, "aa"), (None, None, None), (11, None, "aa"), (11, None, "aa"), (12, "", "aa")]
    docs = spark.createDataFrame([(d, t, lang, "s", len(t or "")) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumns({"hash": F.lit(1), "class": F.lit("x"), "n": F.lit(0)})
    kept = corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path))
    assert kept.columns == list(corpus_pipeline.COLUMNS)
    expected = [(3, a), (7, b), (9, c), (10, rows[6][1]), (10, c[::-1]), (None, a), (None, None), (11, None), (12, "")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert [r.lang for r in kept.collect() if r.doc_id == 9] == ["aa"]
    cut = {(r.doc_id, r.text) for r in corpus_pipeline.cut_repeated_passages(spark, kept, str(tmp_path)).collect()}
    assert {(3, a), (7, b), (9, c), (10, c[::-1]), (None, a)} <= cut and all(c not in t for d, t in cut if d == 10)
