"""Language and toxicity scores against plain versions: a convolution by loops, and the distance of every word to every term."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bitplane, language_id, toxicity

R = random.Random(31)


def plain_chances(network, raw):
    """Chances of a text's languages: every filter at every place of every window, one number after another."""
    total = np.zeros(len(network.languages))
    for start in range(0, len(raw), language_id.WINDOW):
        size = min(language_id.WINDOW, len(raw) - start)
        codes = [int(language_id._CLASS[b]) for b in raw[start : start + language_id.SPAN]]
        codes += [0] * (language_id.SPAN - len(codes))
        pooled = []
        for width in language_id.WIDTHS:
            weights = network.p[f"w{width}"].astype(np.float64)
            at = [[sum(float(network.p["e"][codes[t + o]].astype(np.float64) @ weights[o][:, f]) for o in range(width)) for t in range(language_id.WINDOW)] for f in range(language_id.FILTERS)]
            pooled += [max(x) for x in at]
        hidden = [max(0.0, x + float(b)) for x, b in zip(pooled, network.p["b"], strict=True)]
        z = [sum(h * float(w) for h, w in zip(hidden, network.p["o"][:, k], strict=True)) + float(network.p["c"][k]) for k in range(len(network.languages))]
        e = [math.exp(x - max(z)) for x in z]
        total += np.array(e) / sum(e) * size
    return total / len(raw)


def test_language_equals_a_plain_convolution(spark):
    network = language_id.ByteNetwork(["de", "en", "fr"], seed=4)
    texts = ["Hello there", "ein längerer Text über nichts " * 12, "a", "é" * 140, "12 34 !?", "x" * 300 + " ça va"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.identify(docs, network).collect():
        expected = plain_chances(network, r.text.encode())
        if any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == (network.languages[int(expected.argmax())], pytest.approx(float(expected.max()), abs=1e-4))
        else:
            assert (r.lang_pred, r.score) == ("und", 0)


def test_language_of_repeated_rows_and_ties(spark):
    network = language_id.ByteNetwork(["aa", "bb"], seed=4)
    network.p["o"][:], network.p["c"][:] = 0, 0  # both are equally likely
    docs = spark.createDataFrame([(1, "some text"), (1, "some text"), (None, "some text"), (2, None)], "doc_id long, text string").withColumn("score", F.lit("own"))
    found = language_id.identify(docs, network).collect()
    assert sorted((r.doc_id or 0, r.lang_pred, round(r.score, 6)) for r in found) == [(0, "aa", 0.5), (1, "aa", 0.5), (1, "aa", 0.5), (2, "und", 0.0)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for k, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[k] + 1, row[k - 1] + (x != y)))
        row = new
    return row[-1]


WORDS, STEMS = ["moron", "wretched", "disgusting", "scum"], ["idio", "garb"]


def plain_score(lexicon, text):
    """Every word against every term."""
    found = []
    for hit in brute.ALNUM.finditer(text.translate(brute._LOWER)):
        word = hit.group()
        if word in WORDS:
            found.append((WORDS.index(word), 0, hit))
        elif own := [s for s in STEMS if word.startswith(s)]:
            found.append((len(WORDS) + STEMS.index(max(own, key=len)), 0, hit))
        elif word not in lexicon.known:
            near = [(distance(word, t), k) for k, t in enumerate(WORDS) if distance(word, t) <= (0 if len(t) < 5 else 1 if len(t) < 9 else 2)]
            if near:
                found.append((min(near)[1], min(near)[0], hit))
    words = [m for m in brute.ALNUM.finditer(text.translate(brute._LOWER))]
    best = {}
    for term, edits, hit in found:
        times = sum(t == term for t, _, _ in found)
        chance = lexicon.chance[term][min(times, toxicity.MOST) - 1] * (lexicon.near_chance.get((term, edits), toxicity.PRIOR) if edits else 1)
        k = next(i for i, m in enumerate(words) if m.start() == hit.start())
        said = any(m.group() in toxicity.REPORTING for m in words[max(0, k - toxicity.CONTEXT_WORDS) : k])
        before, after = text[max(0, hit.start() - 80) : hit.start()], text[hit.end() : hit.end() + 80]
        quoted = before.count('"') % 2 == 1 and '"' in after
        best[term] = max(best.get(term, 0), chance * (toxicity.QUOTED if quoted else 1) * (toxicity.REPORTED if said else 1))
    return 1 - math.prod(1 - x for x in best.values()), len(found)


def test_toxicity_equals_plain_distances(spark):
    chance = [[0.5 + 0.05 * k + 0.02 * n for n in range(toxicity.MOST)] for k in range(len(WORDS) + len(STEMS))]
    lexicon = toxicity.Lexicon(WORDS, STEMS, chance, {(0, 1): 0.4, (2, 2): 0.7}, {"morons"})
    fill = ["the", "car", "said", "wrote", "plain", "stream", "scam", "morons"]
    texts = []
    for _ in range(150):
        w = R.choices(fill, k=R.randint(0, 40))
        for _ in range(R.randint(0, 4)):
            term = list(R.choice([*WORDS, "idiotic", "garbage", "idio"]))
            for _ in range(R.choice([0, 0, 1, 1, 2])):
                at = R.randrange(len(term))
                term[at : at + R.randint(0, 1)] = R.choices("aeimnorst", k=R.randint(0, 1))
                term = term or ["x"]
            term = "".join(term)
            w.insert(R.randint(0, len(w)), R.choice([term, term.upper(), f'"{term}"', f"{term},"]))
        texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    hits = 0
    for r in toxicity.score(docs, lexicon).collect():
        expected, n = plain_score(lexicon, r.text)
        assert (r.score, r.n_hits) == (pytest.approx(expected), n), r.text
        hits += n
    assert hits > 150


def test_misspellings_that_are_not_found():
    """What the README says of the method's limits: terms of four letters and stems match without edits only."""
    trie = toxicity.Trie(WORDS, STEMS)
    assert trie.match("scun") == (-1, 0) and trie.match("idiiotic") == (-1, 0) and trie.match("moran") == (0, 1)


def test_toxicity_of_repeated_rows_and_ties(spark):
    lexicon = toxicity.Lexicon(["moronic", "moronia"], [], [[0.9] * toxicity.MOST, [0.2] * toxicity.MOST], {}, set())
    docs = spark.createDataFrame([(1, "so moronix"), (1, "so moronix"), (None, "so moronix"), (2, "")], "doc_id long, text string")
    found = sorted((r.doc_id or 0, round(r.score, 6)) for r in toxicity.score(docs, lexicon).collect())
    assert found == [(0, 0.765), (1, 0.765), (1, 0.765), (2, 0.0)]  # of two terms at one distance the first counts


def test_ids_of_null_and_repeated_documents(spark, tmp_path):
    import public_tokenizers

    docs = spark.createDataFrame([(2, "a b"), (2, "a b"), (1, "c"), (None, "d")], "doc_id long, text string")
    bitplane.write_ids(docs, f"file://{tmp_path}/ids", str(public_tokenizers.path("byte_bpe_50k.json")))
    found = sorted((r.start, r.doc_id if r.doc_id is not None else -1, r.n_tokens) for r in bitplane.read_ids(spark, f"file://{tmp_path}/ids").collect())
    assert [d for _, d, _ in found if d >= 0] == [1, 2, 2] and all(a + n == b for (a, _, n), (b, _, _) in zip(found, found[1:], strict=False))
