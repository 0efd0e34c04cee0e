"""Spelling variants, source mixing and periodic runs against brute force and in edge cases."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs, source_mix, spelling

R = random.Random(23)


# Operator 11


def vocabulary():
    words = {"".join(R.choices("abé", k=R.randint(0, 6))) for _ in range(150)} | {"", "a", "😀b", "😀c", "x" * 200, "x" * 201, "y" + "x" * 199}
    words |= {"common" + "".join(R.choices("abcdefgh", k=R.randint(1, 3))) for _ in range(150)}
    return [(w, R.choice([1, 2, 3, 30, 40, 500, 6000])) for w in sorted(words)]


def forms(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


@pytest.mark.parametrize("most", [20_000, 7])
def test_variants_equal_brute_force(spark, most):
    """Also where nearly every partition holds too many words and is divided."""
    words = vocabulary()
    found = forms(spelling.group_variants(spark.createDataFrame(words, "word string, n long").repartition(3), most=most))
    assert found == brute.op11_forms(dict(words))
    assert any(root not in (form, word) for word, (form, root, *_) in found.items())  # chains of more than one step


def test_variants_of_odd_tables(spark):
    odd = [("absolute", 3, "x"), ("absolute", 4, "y"), (None, 9, "z"), ("absolut", None, "w"), ("absolutes", 70, None)]
    frame = spark.createDataFrame(odd, "word string, n long, key string").withColumns({"m": F.lit(1), "near": F.lit("x"), "root": F.lit(None).cast("int")})
    found = forms(spelling.group_variants(frame))
    assert found["absolute"] == ("absolutes", "absolutes", 7, 2, 70) and found["absolutes"] == (None, "absolutes", 70, 1, None)
    assert found["absolut"] == ("absolute", "absolutes", 0, 1, 7)
    assert forms(spelling.group_variants(frame.limit(0))) == {}
    tied = spark.createDataFrame([("wordb", 30), ("worda", 30), ("wordc", 2), ("wordé", 30)], "word string, n long")
    assert forms(spelling.group_variants(tied))["wordc"] == ("worda", "worda", 2, 3, 30)
    with pytest.raises(ValueError):
        spelling.group_variants(tied, ratio=1)


def test_trie_join_within_groups():
    for _ in range(150):
        entries, rooms = [], []
        for g in range(R.randint(1, 3)):
            size, letters = R.randint(0, 5), R.choice(["ab", "abcé"])
            entries += [(g, w, False) for w in {"".join(R.choices(letters, k=size)) for _ in range(R.randint(1, 20))}]
            entries += [(g, w, True) for w in {"".join(R.choices(letters, k=size + 1)) for _ in range(R.randint(0, 20))}]
            rooms.append(R.choice([1 << 60, max(1, size // 2)]))
        words = [w for _, w, _ in entries]
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        i, j = spelling.near_in_groups(np.array([g for g, _, _ in entries]), chars, bounds, np.array([x for _, _, x in entries]), np.array(rooms))

        def common(a, b):
            return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

        expected = [(x, y) for x in range(len(words)) for y in range(x + 1, len(words)) if entries[x][0] == entries[y][0] and not (entries[x][2] and entries[y][2]) and brute.one_edit(words[x], words[y]) and common(words[x], words[y]) < rooms[entries[x][0]]]
        assert sorted(tuple(sorted(p)) for p in zip(i.tolist(), j.tolist(), strict=True)) == expected


def test_words_of_texts(spark):
    texts = spark.createDataFrame([("Straßen STRASSEN1ÀÉÎÕÜß÷x abc",), (None,), ("",)], "text string")
    found = texts.select(spelling.runs_of(F.col("text"), r"[A-Za-zÀ-ÿ]", 7).alias("runs")).collect()
    assert [r.runs for r in found] == [["straßen", "strassen", "ÀÉÎÕÜß÷x"], None, []]


# Operator 12


def mix(spark, rows, schema="doc_id long, source string, text string", **settings):
    return source_mix.mix_sources(spark.createDataFrame(rows, schema).repartition(4), **settings).collect()


def test_mix_meets_targets(spark):
    rows = [(k, R.choice(["a", "b", "b", "b", "c", "d", None]), " ".join("w" * 1 for _ in range(R.randint(0, 60)))) for k in range(400)]
    rows += [(1000 + k, "hot", "one two three") for k in range(700)] + [(5000 + k, "wordless", R.choice(["", " \t", None])) for k in range(5)]
    found = mix(spark, rows)
    source = {d: s for d, s, _ in rows}
    size = {d: len((t or "").split()) for d, _, t in rows}
    whole = {}
    for d, s in source.items():
        whole[s] = whole.get(s, 0) + size[d]
    target = brute.op12_targets(whole)
    assert {r.doc_id: r["size"] for r in found} == size
    assert all(r.target == pytest.approx(target[source[r.doc_id]]) and r.source_size == whole[source[r.doc_id]] and r.taken == r.copies * r["size"] and r.copies <= 2 for r in found)
    for s in whole:
        off = abs(sum(r.taken for r in found if source[r.doc_id] == s) - target[s])
        assert off <= (1.5 if s == "hot" else 0.5)
    assert sorted(map(tuple, mix(spark, rows[::-1]))) == sorted(map(tuple, found))  # the same documents, however the rows lie
    assert sorted(map(tuple, mix(spark, rows, seed=3))) != sorted(map(tuple, found))


def test_fit_is_as_near_as_any_subset():
    for _ in range(300):
        sizes = [R.choice([1, 2, 3, 7, 10, 40, 90]) * R.choice([1, 1, 5]) for _ in range(R.randint(1, 12))]
        lengths, counts = np.unique(sizes, return_counts=True)
        budget = R.randint(0, sum(sizes) + 3)
        take = source_mix.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        # what goes in by proportion is fixed; the rest is as near as the others' subsets allow
        share = np.array([int(c) * budget // sum(sizes) for c in counts]) if budget < sum(sizes) else counts
        rest = [int(v) for v, c in zip(lengths, counts - share, strict=True) for _ in range(c)]
        assert abs(int((take * lengths).sum()) - min(budget, sum(sizes))) == brute.best_sum(rest, min(budget, sum(sizes)) - int((share * lengths).sum()))


def test_fit_of_long_documents():
    take = source_mix.fit(np.array([1_000_000]), np.array([1]), 600_000)
    assert take.tolist() == [1]
    take = source_mix.fit(np.array([3, 5, 700, 250_000]), np.array([1000, 1000, 1000, 40]), 5_000_001)
    assert int((take * np.array([3, 5, 700, 250_000])).sum()) == 5_000_001
    take = source_mix.fit(np.array([4, 6]), np.array([500_000, 500_000]), 2_000_001)  # no sum is odd
    assert int((take * np.array([4, 6])).sum()) == 2_000_000


def test_mix_of_odd_tables(spark):
    assert mix(spark, []) == []
    assert [(r["size"], r.target, r.taken) for r in mix(spark, [(1, "a", None), (2, None, "")])] == [(0, 0.0, 0), (0, 0.0, 0)]
    same = mix(spark, [(7, "a", "x y", 1)] * 4 + [(None, "b", "z " * 3000, 2)], "doc_id long, source string, text string, size int")
    assert len(same) == 5 and sum(r.taken for r in same if r.doc_id == 7) == 16 and [r.target for r in same if r.doc_id is None] == [pytest.approx(1.5 * 3008 - 16)]
    with pytest.raises(ValueError):
        mix(spark, [], share=3.0)


# Operator 13


def sequence():
    k, n = R.choice([1, 2, 2, 3, 5, 50]), R.choice([0, 1, 5, 20, 60, 120])
    w = [R.randrange(k) for _ in range(n)]
    for _ in range(R.randrange(4)):
        at, unit = R.randint(0, len(w)), [R.randrange(k) for _ in range(R.randint(1, 6))]
        w[at:at] = unit * R.randint(2, 9)
    return w * R.choice([1, 1, 1, 3, 5]) if R.random() < 0.7 else [*w, 99, *w]


@pytest.mark.parametrize(("exponent", "least"), [(4, 6), (2, 2), (3, 5)])
def test_runs_equal_brute_force(exponent, least):
    for _ in range(120):
        own = [sequence() for _ in range(R.randint(1, 5))]
        rows = np.cumsum([0, *map(len, own)])
        if rows[-1]:
            expected = [(k, *run) for k, w in enumerate(own) for run in brute.runs(w, exponent, least)]
            assert periodic_runs.find_runs(np.array([x for w in own for x in w], np.uint64), rows, exponent, least) == expected


def test_previous_factors_equal_brute_force():
    for _ in range(80):
        w = sequence()
        if not w:
            continue
        length, source = periodic_runs.previous_factors(*periodic_runs.suffix_order(np.array(w)))
        for i in range(len(w)):
            best = max((next((k for k in range(len(w) - i) if w[j + k] != w[i + k]), len(w) - i) for j in range(i)), default=0)
            assert length[i] == best
            assert best == 0 or (source[i] < i and w[source[i] : source[i] + best] == w[i : i + best])


def test_runs_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a a a a a a"), (4, "a a a a a a"), (None, "x  b c b c b c b c\ty"), (6, "A a A a A a A"), (7, "na " * 30_000), (8, "é ß é ß é ß é ß z"), (9, "solo")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "collapsed": F.lit("c"), "n_words": F.lit(0)}).repartition(2)
    found = {}
    for r in periodic_runs.periodic_runs(frame).collect():
        found.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    nothing = [(0, [], "")]
    assert found[1] == found[2] == found[3] == nothing
    assert found[4] == [(6, [(0, 6, 1)], "a")] * 2
    assert found[None] == [(10, [(1, 8, 2)], "x b c y")]
    assert found[6] == [(7, [], "A a A a A a A")]
    assert found[7] == [(30_000, [(0, 30_000, 1)], "na")]
    assert found[8] == [(9, [(0, 8, 2)], "é ß z")] and found[9] == [(1, [], "solo")]
    assert periodic_runs.periodic_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(frame, exponent=1)
