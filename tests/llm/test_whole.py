"""Inputs on which earlier versions of the operators did less than the whole job."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tidemark.llm import attention_lm, jaccard_join
from tidemark.llm.kernel import MemoTokenizer, text_buffer, with_end


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_jaccard_links_of_unequal_sizes(spark):
    """Truncated and extended copies: shingles of one prefix stand in the other's suffix."""
    r, rows = random.Random(5), []
    for k in range(150):
        text = [f"v{r.randrange(10**6)}" for _ in range(104)]
        short = text[: r.randrange(80, 84)] if k % 2 else text[104 - r.randrange(80, 84) :]
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(short))]
    line = [f"h{j}" for j in range(90)]  # frequent shingles, so that prefixes have several matches
    for k in range(120):
        rows.append((1000 + k, " ".join(line[: 60 + k % 31] + [f"t{r.randrange(10**6)}" for _ in range(k % 7)])))
    found = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(frame(spark, rows)).collect()}
    assert found == brute.op8(rows)


def test_every_word_is_mixed(spark, monkeypatch):
    """Scores use the counts of all words, however many are sent to all tasks."""
    r = random.Random(6)
    rows = [(k, " ".join(r.choice(["plain", "words", f"rare{r.randrange(40)}"]) for _ in range(30))) for k in range(40)]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(attention_lm, "STEPS", 5)
    score = lambda: {x.doc_id: x.score for x in attention_lm.score(frame(spark, rows), F.lit(True), path, 49407, 49408).collect()}
    many = score()
    monkeypatch.setattr(attention_lm, "HEAVY", 2)
    assert score() == pytest.approx(many)


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    r = random.Random(16)
    rows = [(k, " ".join(f"w{int(r.paretovariate(0.6)) % 3000}" for _ in range(80))) for k in range(120)] + [(None, "w1 w2"), (5, "w1"), (5, "w1"), (900, "q" * 4000), (901, None)]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(attention_lm, "STEPS", 40)
    found, learn = [], F.coalesce(F.col("doc_id") != 900, F.lit(True))
    try:
        for n in (4, 16, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out = attention_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(n // 3), learn, path, 49407, 49408)
            found.append(sorted((x.doc_id or -1, x.n_tokens, x.score) for x in out.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found[0]) == len(rows) and all(x[2] < -1000 for x in found[0] if x[0] == 900)
    for other in found[1:]:
        assert [x[:2] for x in other] == [x[:2] for x in found[0]]
        assert [x[2] for x in other] == pytest.approx([x[2] for x in found[0]], abs=1e-6)


@pytest.mark.parametrize("block_bytes", [1 << 22, 20_000])
def test_every_window_is_learnt(spark, monkeypatch, block_bytes):
    """Classes, tables and weights come from whole texts and all of them; before, from at most 4,096 characters of some 3,000."""
    r = random.Random(7)
    rows = [(k, " ".join(f"w{r.randrange(90)}" for _ in range(20))) for k in range(3500)] + [(5000, "long " * 3000), (5001, "held out " * 50), (None, None)]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(attention_lm, "STEPS", 1)
    monkeypatch.setattr(attention_lm, "BLOCK_BYTES", block_bytes)
    docs = frame(spark, rows)
    counts, buckets, blocks = attention_lm.gathered(docs, F.coalesce(F.col("doc_id") != 5001, F.lit(True)), path, 49407, 49408)
    assert (blocks > attention_lm.ROUNDS) == (block_bytes == 20_000)
    model = attention_lm.train(counts, 49408, buckets, blocks)
    ids, bounds = with_end(*MemoTokenizer(path, "word").encode(*text_buffer(pa.array([t for d, t in rows if d != 5001]))), 49407)
    plain = attention_lm.AttentionModel(49408)
    pairs = np.unique(plain.pairs(ids, bounds), return_counts=True)
    plain.rank(plain.counts(*pairs))
    plain.gather(plain.around(*pairs))
    tally = plain.group(plain.beside(*pairs))
    assert (model.target == plain.target).all() and (tally == plain.tally(ids, bounds)).all() and (model.count == np.bincount(ids, minlength=49408)).all()
    assert model.learnt == (-(-np.diff(bounds) // attention_lm.STRIDE)).sum()


def test_pieces_of_a_long_text_have_its_windows(monkeypatch):
    monkeypatch.setattr(attention_lm, "TOGETHER", 240)
    r = np.random.default_rng(8)
    ids, rows = r.integers(0, 90, 1500).astype(np.uint16), np.array([0, 1000, 1000, 1240, 1500])
    model = attention_lm.AttentionModel(90)
    model.arrange(ids)
    starts, ends, leads, names = attention_lm._pieces(rows, np.arange(4, dtype=np.uint64))
    apart = np.concatenate([ids[a:b] for a, b in zip(starts, ends, strict=True)])
    for whole, part in zip(model.targets(ids, rows), model.targets(apart, np.append(0, np.cumsum(ends - starts)), leads), strict=True):
        assert (whole == part).all()
    assert len(set(names.tolist())) == len(names) and (ends - starts - leads).max() == 240


def test_gradient_equals_differences():
    r = np.random.default_rng(9)
    ids, rows = np.minimum(r.geometric(0.02, 2000), 299), np.array([0, 30, 31, 2000])
    model = attention_lm.AttentionModel(300)
    model.arrange(ids)
    model.prepare(model.tally(ids, rows))
    model.fit(ids, rows, 20)
    x, goal = model.targets(ids, rows)
    grad = model.gradient(x, goal)
    loss = lambda: -(model.log_chances(ids, rows) - model.share[ids]).astype(np.float64).mean()
    for name, p in model.p.items():
        at, found = np.unravel_index(np.abs(grad[name]).argmax(), p.shape), []
        here = p[at]
        for step in (0.002, -0.002):
            p[at] = here + step
            model.bound(*model.fixed()[:2])
            found.append(loss())
        p[at] = here
        assert (found[0] - found[1]) / 0.004 == pytest.approx(grad[name][at], rel=0.03, abs=1e-5)


def test_heavy_words_of_one_place():
    words = np.array([5, 5 + (1 << 20), 5 + (2 << 20), 9], np.uint64)
    heavy = attention_lm.HeavyWords(words, np.array([2, 30, 4, 7]))
    assert heavy.look_up(np.append(words, np.array([5 + (3 << 20), 8], np.uint64))).tolist() == [2, 30, 4, 7, 0, 0]
