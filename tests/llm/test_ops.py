"""The ten operators against brute force and in edge cases."""

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import attention_lm, bitplane, chat_format, decontaminate, int8_tiles, jaccard_join, kernel, language_id, packing, substring_dedup, toxicity
from tidemark.llm.common import components

R = random.Random(11)
WORDS = [f"w{k}" for k in range(400)]
BYTE, WORD = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def words(n):
    return R.choices(WORDS, k=n)


def near(base, edits):
    out = base.split()
    for _ in range(edits):
        out[R.randrange(len(out))] = R.choice(WORDS)
    return " ".join(out)


def corpus():
    """Documents with copies, a group of near copies, a common line, repeats, null and empty texts."""
    base, line, passage = " ".join(words(120)), " ".join(words(12)), " ".join(words(70))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One two"), (6, "one two three four five"), (7, "é ß É")]
    rows += [(10 + k, base) for k in range(5)]
    rows += [(20 + k, near(base, k % 9)) for k in range(40)]
    rows += [(70 + k, line + "\n" + " ".join(words(60))) for k in range(60)]
    rows += [(140 + k, " ".join(words(30 + k)) + " " + passage + " " + " ".join(words(20))) for k in range(12)]
    rows += [(200, " ".join(words(30_000))), (201, line), (202, line)]
    return rows


DOCS = corpus()


def frame(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def named(rows, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in rows}


def test_jaccard_components(spark):
    clashing = frame(spark).withColumns({"class": F.lit(1), "rep": F.lit("x"), "n": F.lit(None).cast("int"), "token": F.lit(2)})
    assert named(jaccard_join.jaccard_components(clashing).collect(), "n_shingles", "component_id") == brute.op8(DOCS)
    odd = frame(spark, [(None, "a b c d e f"), (9, "a b c d e f"), (9, "a b c d e f"), (None, None)])
    assert sorted(map(str, jaccard_join.jaccard_components(odd).collect())) == sorted(["Row(doc_id=None, n_shingles=2, component_id=9)", "Row(doc_id=9, n_shingles=2, component_id=9)", "Row(doc_id=9, n_shingles=2, component_id=9)", "Row(doc_id=None, n_shingles=0, component_id=None)"])
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


def test_jaccard_with_hot_shingles(spark):
    """Frequent shingles reorder the sets and lengthen prefixes; the links stay the same."""
    line = " ".join(words(40))
    rows = [(k, line + " " + " ".join(words(8 + k % 9))) for k in range(150)] + [(200 + k, near(line, k % 4)) for k in range(60)]
    assert named(jaccard_join.jaccard_components(frame(spark, rows)).collect(), "n_shingles", "component_id") == brute.op8(rows)


def test_prefix_choice():
    found, above = np.sort(np.random.default_rng(1).integers(0, 2**63, 100).astype(np.uint64)), np.zeros(1 << jaccard_join.SLOT_BITS)
    tokens, levels, best, hot = jaccard_join.ordered_prefix(found, above)
    assert best == 1 and len(tokens) == 26 and not hot.any() and set(levels) == {1}
    above[(found >> np.uint64(46)).astype(int)] = 1000.0
    tokens, levels, best, hot = jaccard_join.ordered_prefix(found, above)
    assert best > 1 and len(tokens) == 25 + best and hot.all() and levels[-1] == best


def test_components(spark):
    edges = [(a, b) for a, b in ((R.randrange(300), R.randrange(300)) for _ in range(220))] + [(k, k + 1) for k in range(400, 440)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = brute.components({x for e in edges if e[0] != e[1] for x in e}, edges)
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_compact_windows():
    r = np.random.default_rng(3)
    for n in (5, 46, 47, 300):
        values = r.permutation(10_000)[: n + 60].astype(np.uint64)
        rows = np.array([0, 60, n + 60])
        found = set(zip(*(x.tolist() for x in substring_dedup.compact_windows(values, rows, 10)), strict=True))
        expected = set()
        for a, b in ((0, 60), (60, n + 60)):
            for c in range(a, b):
                left = right = c
                while left > a and values[left - 1] > values[c]:
                    left -= 1
                while right < b - 1 and values[right + 1] > values[c]:
                    right += 1
                if right - left + 1 >= 10:
                    expected.add((c, left, right))
        assert found == expected


def test_repeated_passages(spark):
    found = substring_dedup.repeated_passages(frame(spark).withColumn("a", F.lit(1)).withColumn("first", F.lit(2))).collect()
    covered = {}
    for r in found:
        assert r.source_doc_id < r.doc_id and r.n_words >= 50 and r.similarity >= 0.75
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    for doc, hit in brute.repeated_words(DOCS).items():
        assert hit <= covered.get(doc, set()), doc
    assert not {r.doc_id for r in found} & {*range(1, 10), *range(70, 130), 140, 200, 201, 202}
    assert substring_dedup.repeated_passages(frame(spark, [])).count() == 0


def test_passages_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 1 << 16)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").unionByName(frame(spark, [(d + 10**6, t) for d, t in DOCS]))
    found = [sorted(map(tuple, substring_dedup.repeated_passages(docs.repartition(n)).collect())) for n in (4, 16, 64)]
    assert found[0] and found[0] == found[1] == found[2]


def test_cut_passages(spark):
    passage = " ".join(words(60))
    rows = [(1, "Start\n" + passage + "\nend"), (2, "Ä first, " + passage + " , last"), (3, passage), (4, None), (None, passage)]
    docs = frame(spark, rows)
    left = {r.doc_id: r.text for r in substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs)).collect()}
    assert left == {1: rows[0][1], 2: "Ä first,  , last", 4: None, None: passage}


def test_cut_passages_of_repeated_ids(spark):
    """A passage is cut from the text that has it, not from another text under its id."""
    passage, other = " ".join(words(70)), " ".join(words(70))
    rows = [(1, passage), (7, "x " + passage + " y"), (7, other), (7, other), (8, passage[:100])]
    docs = frame(spark, rows).withColumns({"__passages": F.lit("clash"), "a": F.lit(1)})
    left = substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs))
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(1, passage), (7, "x  y"), (7, other), (7, other), (8, passage[:100])])


def test_packed_rows_grow_with_the_entries():
    """However many buckets there are, an emit writes rows for its entries alone, and loses none of them."""
    for entries in (100, 1000):
        for buckets in (4, 1000, 1_000_000):
            r = np.random.default_rng(entries)
            doc, key = r.integers(0, 50, entries), r.integers(0, entries // 2, entries).astype(np.uint64)
            marks = r.integers(0, 3, (entries, substring_dedup.MARKS)).astype(np.uint32)
            a, b, first = substring_dedup.star_pairs(key, doc, marks)
            packed = substring_dedup._emit(buckets, [(doc, key, marks)])
            assert packed.num_rows <= min(buckets, len(first) + len(a)) and len(set(packed.column(0).to_pylist())) == packed.num_rows
            got = [np.concatenate([np.frombuffer(x.as_py(), kind) for x in packed.column(k)]) for k, kind in ((1, np.uint64), (2, np.int64), (4, np.int64), (5, np.int64))]
            assert sorted(zip(got[0].tolist(), got[1].tolist(), strict=True)) == sorted(zip(key[first].tolist(), doc[first].tolist(), strict=True))
            assert sorted(zip(got[2].tolist(), got[3].tolist(), strict=True)) == sorted(zip(a.tolist(), b.tolist(), strict=True))


def test_near_passages_behind_a_shared_line_are_found():
    """Pairs of passages with edits, each behind a line that all have: pairing by stars finds nine of ten and more."""
    line = words(12)
    found, pairs = 0, 120
    texts = []
    for k in range(pairs):
        own = [f"p{k}x{i}" for i in range(60)]
        other = list(own)
        for _ in range(2):
            other[R.randrange(60)] = f"e{R.randrange(10**6)}"
        texts += [(2 * k, [*line, *own]), (2 * k + 1, [*line, *other])]
    entries = []
    for doc, w in texts:
        data = np.frombuffer(" ".join(w).encode(), np.uint8)
        hashes, rows = kernel.shingle_hashes(*kernel.word_hashes(data, np.array([0, len(data)])), 5)
        row, key, marks = substring_dedup.joint_keys(hashes, rows)
        entries.append((np.full(len(row), doc), key, marks))
    doc, key, marks = (np.concatenate(x) for x in zip(*entries, strict=True))
    a, b, _ = substring_dedup.star_pairs(key, doc, marks)
    linked = set(zip(a.tolist(), b.tolist(), strict=True))
    found = sum((2 * k + 1, 2 * k) in linked for k in range(pairs))
    assert found >= 0.9 * pairs


def test_near_passages_are_found():
    """At least nine of ten passages of similarity 0.75 or more, of any length and with edits anywhere."""
    import pyarrow as pa
    from tidemark.llm import kernel

    r = random.Random(3)
    fresh = lambda n: [f"z{r.randrange(10**9)}" for _ in range(n)]
    for n, edits, together in ((50, 1, False), (50, 2, True), (55, 2, True), (60, 2, False), (80, 2, False), (80, 3, True), (100, 3, False), (120, 3, False), (300, 9, False)):
        found = total = 0
        while total < 60:
            base = fresh(n)
            copy = list(base)
            at = r.randrange(n - edits + 1)
            for p in range(at, at + edits) if together else r.sample(range(n), edits):
                copy[p] = fresh(1)[0]
            x, y = brute.shingles(" ".join(base)), brute.shingles(" ".join(copy))
            if len(x & y) < 0.75 * len(x | y):
                continue
            total += 1
            texts = [" ".join([*fresh(40), *w, *fresh(40)]) for w in (base, copy)]
            hashes, rows = kernel.shingle_hashes(*kernel.word_hashes(*kernel.text_buffer(pa.array(texts))))
            row, key, _ = substring_dedup.joint_keys(hashes, rows)
            if set(key[row == 0].tolist()) & set(key[row == 1].tolist()):
                found += bool(substring_dedup.passages(hashes[rows[1] :], hashes[: rows[1]]))
        assert found >= 0.9 * total, (n, edits, found)


def test_passages_of_many_lengths(spark):
    """Pieces of popular passages that begin and end anywhere: what the earliest document lacks is found in others."""
    r = random.Random(5)
    pool = [f"p{k}" for k in range(3000)]
    passages, rows = [r.choices(pool, k=150) for _ in range(12)], []
    for d in range(500):
        text = r.choices(pool, k=r.randint(0, 60))
        for _ in range(r.randint(1, 2)):
            a = r.randint(0, 90)
            text += passages[min(int(r.paretovariate(0.7)) - 1, 11)][a : a + r.randint(30, 120)] + r.choices(pool, k=r.randint(0, 40))
        rows.append((d, " ".join(text)))
    r.shuffle(rows)
    covered = {}
    for x in substring_dedup.repeated_passages(frame(spark, rows)).collect():
        covered.setdefault(x.doc_id, set()).update(range(x.first_word, x.first_word + x.n_words))
    expected = brute.repeated_words(rows)
    left = sum(len(hit - covered.get(d, set())) for d, hit in expected.items())
    assert left <= 0.003 * sum(map(len, expected.values()))  # see the README: ends of a few words


def test_a_partner_that_stars_drop_is_found(spark):
    """Near copies under a key of many: each is paired with a document that is like it, not with the earliest ones of the key only."""
    r = np.random.default_rng(11)
    for _ in range(40):
        ranges, n = [], int(r.integers(3, 30))
        base = np.unique(r.integers(0, 1 << 32, 70, dtype=np.uint32))
        for _ in range(n):
            own = base.copy() if r.random() < 0.6 or not ranges else ranges[int(r.integers(len(ranges)))].copy()
            own = own[r.random(len(own)) < r.choice([0.6, 0.9, 1])]
            ranges.append(np.unique(np.concatenate([own, r.integers(0, 1 << 32, int(r.integers(0, 15)), dtype=np.uint32)])))
        doc = np.arange(n) * 3
        a, b, *_ = substring_dedup.shared_sets(doc, ranges)
        sets = [set(x.tolist()) for x in ranges]
        linked = {}
        for x, y in zip((a // 3).tolist(), (b // 3).tolist(), strict=True):
            assert y < x and len(sets[x] & sets[y]) >= substring_dedup.LOOSE
            linked.setdefault(x, []).append(sets[x] & sets[y])
        for x in range(n):
            for y in range(x):
                if len(sets[x] & sets[y]) >= substring_dedup.LOOSE:
                    assert any(sets[x] & sets[y] <= own for own in linked.get(x, [])), (x, y)


def test_all_near_partners_of_crowded_keys_are_paired(spark, monkeypatch):
    """Every two documents with a common key, and windows of it that are alike, are linked or like a document that is; so in cells of any size."""
    r = random.Random(8)
    base = [f"q{k}" for k in range(60)]
    rows = []
    for d in range(150):
        own = list(base)
        for p in r.sample(range(60), r.choice([0, 3, 6, 9])):
            own[p] = f"e{p}x{r.randrange(3)}"
        rows.append((d, " ".join([f"c{d}x{k}" for k in range(20)] + own + [f"d{d}x{k}" for k in range(20)])))
    entries = []
    for d, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        hashes, ends = kernel.shingle_hashes(*kernel.word_hashes(data, np.array([0, len(data)])), 5)
        _, key, marks, start, last = substring_dedup.joint_windows(hashes, ends)
        assert (last - start < substring_dedup.SPAN).all()
        entries += [(k, d, frozenset(hashes[s : e + substring_dedup.SPAN].tolist())) for k, s, e in zip(key.tolist(), start.tolist(), last.tolist(), strict=True)]
    by_key = {}
    for k, d, own in entries:
        by_key.setdefault(k, []).append((d, own))
    for cell in (substring_dedup.CELL, 10):
        monkeypatch.setattr(substring_dedup, "CELL", cell)
        pairs = {(x.a, x.b) for x in substring_dedup.candidates(frame(spark, rows)).collect()}
        missed = total = 0
        for group in by_key.values():
            for d, own in group:
                linked = [own & other for e, other in group if (d, e) in pairs]
                for e, other in group:
                    if e < d and len(own & other) >= substring_dedup.LOOSE:
                        total += 1
                        missed += not any(own & other <= x for x in linked)
        assert total > 1000 and not missed


def crc(doc):
    return zlib.crc32(str(doc).encode())


def test_language_id(spark):
    parts = {"aa": ["thing", "ness", "wh", "ould"], "bb": ["ción", "ñe", "llar", "que"]}
    rows = [(k, " ".join("".join(R.choices(parts[lang], k=3)) for _ in range(40)), lang) for k, lang in enumerate(R.choices(["aa", "bb"], k=160))]
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", "bb"), (903, "日本", None), (904, rows[0][1] * 300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    network = language_id.train(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    found = {r.doc_id: r for r in language_id.identify(docs, network).collect()}
    assert all(found[d].lang_pred == lang for d, text, lang in rows[:160] if crc(d) % 4 == 2)
    assert [(found[d].lang_pred, found[d].score) for d in (900, 901, 902)] == [("und", 0.0)] * 3
    assert found[903].lang_pred in ("aa", "bb") and found[904].lang_pred == rows[0][2]
    assert all(0 <= r.score <= 1 for r in found.values())
    none = language_id.train(docs.where("false"), F.lit(True))
    assert none is None and {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}


def test_windows_cover_every_byte():
    data = np.frombuffer(("a" * 700).encode(), np.uint8)
    x, row, size = language_id.windows(data, np.array([0, 0, 300, 700]))
    assert size.tolist() == [256, 44, 256, 144] and row.tolist() == [1, 1, 2, 2] and (x[:, : language_id.WINDOW] == 4).sum() == 700


def test_trie_and_automaton():
    terms = ["idiot", "worthless", "disgusting", "scum"]
    trie = toxicity.Trie(terms, ["vequ"])

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _step(row, i, x, b)
        return row[-1]

    def _step(row, i, x, b):
        new = [i]
        for k, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[k] + 1, row[k - 1] + (x != y)))
        return new

    letters = "abdgiorstuwhlen"
    for _ in range(4000):
        word = list(R.choice(terms))
        for _ in range(R.randint(0, 3)):
            at = R.randrange(len(word))
            word[at : at + R.randint(0, 1)] = R.choices(letters, k=R.randint(0, 1))
            word = word or ["a"]
        word = "".join(word)
        near = min((distance(word, t), k) for k, t in enumerate(terms) if distance(word, t) <= toxicity.reach(t)) if any(distance(word, t) <= toxicity.reach(t) for t in terms) else None
        assert trie.match(word) == ((near[1], near[0]) if near else (-1, 0)), word
    assert trie.match("vequxyz") == (4, 0) and trie.match("idiot", {"idiot"}) == (0, 0) and trie.match("idiott", {"idiott"}) == (-1, 0)


def test_toxicity(spark):
    clean = lambda n=60: " ".join(words(n))
    insult = lambda: R.choice(["moronic", "wretched"])
    rows = [(k, clean(30) + " " + insult() + " " + clean(30), 1) for k in range(60)] + [(100 + k, clean(), 0) for k in range(200)]
    tests = [(400, clean() + " moronik " + clean(), None), (401, 'she said " moronic " , and ' + clean(), None), (402, clean(), None), (403, None, None), (404, "", None), (405, clean(9000) + " Wretched", None)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in [*rows, *tests]], "doc_id long, text string").withColumn("n_hits", F.lit(-1))
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(None, 1), (100, None)], "doc_id long, toxic int")
    lexicon = toxicity.train(docs, labels, lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 3 != 1)
    found = {r.doc_id: r for r in toxicity.score(docs, lexicon).collect()}
    assert all((found[d].score >= 0.7) == bool(y) for d, _, y in rows)
    assert found[400].score >= 0.7 and 0 < found[401].score < 0.7 and found[405].score >= 0.7
    assert [found[d].score for d in (402, 403, 404)] == [0, 0, 0]
    empty = toxicity.train(docs.where("false"), labels.where("false"), lambda c: F.lit(True))
    assert {r.score for r in toxicity.score(docs, empty).collect()} == {0.0}


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_planes_round_trip(mode):
    r = np.random.default_rng(2)
    for ids in (np.zeros(0), np.zeros(1), r.integers(0, 2**32, 1000), r.integers(0, 50257, 70_001), np.array([2**32 - 1])):
        ids = ids.astype(np.uint32)
        assert (bitplane.joined(bitplane.planes(ids, mode), len(ids), mode) == ids).all()
        assert (bitplane.unpack_segment(*bitplane.pack_segment(ids, mode, 1), mode) == ids).all()


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_seek_by_chunk_index(monkeypatch, mode):
    monkeypatch.setattr(bitplane, "BLOCK_IDS", 64)
    ids = np.random.default_rng(3).integers(0, 50257, 1000).astype(np.uint32)
    row = dict(zip(("block_ids", "block_planes", "plane_bytes", "payload"), bitplane.pack_segment(ids, mode, 1), strict=True)) | {"mode": mode}
    for first, n in ((0, 0), (0, 1), (63, 2), (64, 64), (100, 500), (999, 1), (0, 1000)):
        assert (bitplane.unpack_range(row, first, n) == ids[first : first + n]).all()


@pytest.mark.parametrize("mode", ["byte", "bit"])
def test_write_and_read_ids(spark, tmp_path, monkeypatch, mode):
    encode = Tokenizer.from_file(BYTE)
    bitplane.write_ids(frame(spark).withColumn("part", F.lit("x")), f"file://{tmp_path}/ids", BYTE, mode=mode)
    found = bitplane.read_ids(spark, f"file://{tmp_path}/ids").select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    assert named(found, "start", "n_tokens", "crc") == brute.op4([(d, t) for d, t in DOCS], lambda t: encode.encode(t, add_special_tokens=False).ids)
    wanted = bitplane.seek_ids(spark, f"file://{tmp_path}/ids", [200, 21, 2, 999]).select("doc_id", "n_tokens", F.crc32("ids").alias("crc")).collect()
    assert named(wanted, "n_tokens", "crc") == {d: named(found, "n_tokens", "crc")[d] for d in (200, 21, 2)}
    bitplane.write_ids(frame(spark, []), f"file://{tmp_path}/none", BYTE)
    assert bitplane.read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_prefix_targets(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said), (1, 2, "assistant", "b: <x>\n#"), (1, 1, "user", "\\l\\\\h\\"), (1, 3, "user", None), (2, 0, "user", "only"), (3, 0, "assistant", ""), (4, 0, "assistant", "x"), (4, 0, "assistant", "x"), (5, None, None, "é</turn>\n### a: b"), (None, 1, "assistant", "n")]
    rows += [(9, k, ("user", "assistant")[k % 2], " ".join(words(20))) for k in range(301)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(0))
    examples = chat_format.expand_prefixes(turns)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(examples).collect()}
    assert found == brute.op5([(c, -1 if t is None else t, r, x) for c, t, r, x in rows])
    own = [r for r in examples.collect() if r.conv_id == 9]
    assert sum(r.loss_chars > 0 for r in own) == 150 and len(own) == 151
    first = min(own, key=lambda r: r.example)
    assert first.text.startswith("### user: ") and first.text[first.loss_start : first.loss_start + first.loss_chars] == rows[-300][3]
    assert chat_format.digests(chat_format.expand_prefixes(turns.where("false"))).count() == 0


def test_packing(spark):
    encode = Tokenizer.from_file(WORD)
    code = lambda t: encode.encode(t, add_special_tokens=False).ids
    pieces = packing.pack(frame(spark).withColumn("offset", F.lit(5)), WORD).collect()
    rows = [(p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, p.sequence_id, p.offset) for p in pieces]
    assert brute.op6_faults(DOCS, rows, code) == []
    assert len({p.sequence_id for p in pieces}) <= sum(p.length for p in pieces) / 2048 + 3
    assert packing.pack(frame(spark, []), WORD).count() == 0
    twice = packing.pack(frame(spark, [(1, "a"), (1, "a"), (None, None)]), WORD).collect()
    assert sorted((p.doc_id or 0, p.length) for p in twice) == [(0, 1), (1, 2), (1, 2)]


def test_sum_of_squares_takes_the_least_level():
    packer = packing.SumOfSquares(16)
    r = np.random.default_rng(4)
    for _ in range(400):
        size = int(r.integers(1, 16))
        n = packer.count.copy()
        cost = {}
        for h in range(0, 16 - size + 1):
            if h == 0 or n[h]:
                after = n.copy()
                if h:
                    after[h] -= 1
                if h + size < 16:
                    after[h + size] += 1
                cost[h] = int((after[1:16] ** 2).sum())
        assert cost[packer.level(size)] == min(cost.values())
        packer.place((0, 0, np.zeros(size, np.uint32), size))
        assert packer.count.sum() == sum(map(len, packer.open))


def test_attention_lm(spark):
    learn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(False))
    found = {r.doc_id: r for r in attention_lm.score(frame(spark).withColumn("score", F.lit(1)), learn, WORD, 49407, 49408).collect()}
    for doc, (n, known, total, base) in brute.op7_base(DOCS).items():
        r = found[doc]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.base_score == pytest.approx(base) and r.score < 0
    assert attention_lm.score(frame(spark, []), learn, WORD, 49407, 49408).count() == 0


def fitted(ids, vocabulary, steps):
    rows = np.array([0, len(ids)])
    model = attention_lm.AttentionModel(vocabulary)
    model.arrange(ids)
    model.prepare(model.tally(ids, rows))
    model.fit(ids, rows, steps)
    return model


@pytest.mark.parametrize("vocabulary", [300, 5000])
def test_lm_equals_a_plain_loop(vocabulary):
    r = np.random.default_rng(1)
    ids = np.minimum(r.geometric(0.01, 3000), vocabulary - 1).astype(np.uint32)
    model = fitted(ids, vocabulary, 30)
    sizes = [5, 0, 1, 24, 25, 100]
    rows = np.concatenate([[0], np.cumsum(sizes)])
    found = model.log_chances(ids[: rows[-1]], rows, batch=3)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        assert np.allclose(found[a:b], brute.lm_log_chances(model, ids[a:b].tolist()), atol=1e-4)
    for before in (ids[:0], ids[:1], ids[:40]):  # over the whole vocabulary chances add up to 1
        every = np.concatenate([np.append(before, np.uint32(i)) for i in range(vocabulary)]).astype(np.uint32)
        last = model.log_chances(every, np.arange(vocabulary + 1) * (len(before) + 1))[len(before) :: len(before) + 1]
        assert np.exp(last.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)


def test_lm_learns():
    ids = np.tile(np.arange(50, dtype=np.uint32), 60)
    assert fitted(ids, 200, 300).log_chances(ids[:200], np.array([0, 200]))[1:].mean() > -0.5
    r = np.random.default_rng(2)  # what stands two places before decides, which no table of neighbours knows
    pairs = np.stack([r.integers(0, 8, 4000), np.full(4000, 9)], axis=1)
    pairs[1:, 0] = (pairs[0, 0] + np.arange(1, 4000) * 3) % 8
    model = fitted(pairs.ravel().astype(np.uint32), 20, 600)
    assert model.log_chances(pairs[:200].ravel().astype(np.uint32), np.array([0, 400]))[40:].mean() > -0.6


def vectors():
    r = np.random.default_rng(6)
    base = r.normal(size=(40, 16))
    rows = [(k, (base[k % 40] + 0.3 * r.normal(size=16) / (1 + k % 5)).astype(np.float32).tolist()) for k in range(600)]
    rows += [(700 + k, rows[3][1]) for k in range(30)] + [(800, None), (801, []), (802, [0.0] * 16), (803, [float("nan")] * 16), (804, [1.0] + [float("inf")] * 15), (805, [1.0, None] + [0.0] * 14), (806, [1.0, 2.0]), (807, [2.0, 4.0]), (808, [2.0 * x for x in rows[3][1]])]
    return rows


def test_int8_tiles(spark, monkeypatch):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("k1", F.lit(0)).withColumn("rep", F.lit(1))
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in int8_tiles.cosine_components(frame).collect()}
    assert found == brute.op9(rows)
    assert int8_tiles.cosine_components(frame.where("false")).count() == 0
    odd = spark.createDataFrame([(None, [1.0]), (4, [1.0]), (4, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, int8_tiles.cosine_components(odd).collect()), key=str) == [(4, 1, 4, True), (4, 1, 4, True), (None, 0, None, False)]


def test_quantisation_bound_holds():
    r = np.random.default_rng(8)
    x = r.normal(size=(300, 32)) * 10.0 ** r.integers(-3, 3, (300, 1))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    q, scale, error = int8_tiles.quantised(unit)
    approx = (q @ q.T) * scale[:, None] * scale
    assert np.abs(q).max() <= 127 and (np.abs(approx - unit @ unit.T) <= error[:, None] * (1 + error) + error).all()
    i, j = int8_tiles.tile_links((unit, q, scale, error), (unit, q, scale, error), 0.3)
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(k.tolist() for k in np.nonzero(unit @ unit.T >= 0.3)), strict=True))


ITEMS = [(1, " ".join(WORDS[:30])), (2, " ".join(WORDS[20:50])), (3, "w5 w6 w7"), (4, "w9"), (5, ""), (6, None), (7, " ".join(WORDS[:12]) + " x y"), (10, "w5  W6, w7")]


def scanned(docs):
    hit = F.expr(decontaminate.HIT_WORDS)
    return docs.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"), (hit > 0).alias("bad"))


@pytest.mark.parametrize("per_pass", [250_000, 30])
def test_decontamination(spark, monkeypatch, per_pass):
    monkeypatch.setattr(decontaminate, "WORDS_PER_PASS", per_pass)
    rows = [(1, "pre " + " ".join(WORDS[3:18]) + "; post"), (2, " ".join(WORDS[:9])), (3, "W5,w6.w7 w5 w6"), (4, "w9"), (5, None), (6, ""), (7, " ".join(WORDS[10:45])), (8, " ".join(words(9000))), (9, " ".join(WORDS[2:40]) + " a " + " ".join(WORDS[25:36]))]
    rows += [(20 + k, " ".join(WORDS[k : k + R.randint(1, 25)] + words(10))) for k in range(40)]
    items = spark.createDataFrame([*ITEMS, ITEMS[0], (None, "w1")], "item_id long, text string")
    docs = frame(spark, rows).withColumn("spans", F.lit("clash"))
    found = named(scanned(decontaminate.scan(docs, items)).collect(), "n_words", "n_hit", "n_items", "sha", "bad")
    assert found == brute.op10(rows, [i for i in ITEMS])
    none = decontaminate.scan(docs, items.where("false")).collect()
    assert len(none) == len(rows) and all(r.spans == [] and r["items"] == [] for r in none)


@pytest.mark.parametrize("per_pass", [250_000, 3])
def test_decontaminate_cuts(spark, monkeypatch, per_pass):
    monkeypatch.setattr(decontaminate, "WORDS_PER_PASS", per_pass)
    rows = [(1, "Pre é " + " ".join(WORDS[3:18]) + "; post " + " ".join(words(60)).replace("w9 ", "")), (2, " ".join(WORDS[:20])), (3, None), (4, "clean é")]
    items = spark.createDataFrame([ITEMS[0], (2, "none of it"), (3, "nor of this")], "item_id long, text string")
    docs = frame(spark, rows).withColumn("odd name", F.col("doc_id"))
    out = decontaminate.decontaminate(docs, items)
    assert out.columns == docs.columns
    left = {r.doc_id: r.text for r in out.collect()}
    assert set(left) == {1, 3, 4} and left[3] is None and left[4] == "clean é" and left[1].startswith("Pre é ; post ")


def test_automaton_on_random_items():
    for seed in range(30):
        r = random.Random(seed)
        items = [[r.randrange(4) for _ in range(r.randint(1, 14))] for _ in range(r.randint(1, 6))]
        automaton = decontaminate.SuffixAutomaton(items, 4)
        text = [r.randrange(5) for _ in range(60)]
        found = set()
        for end, length, own in automaton.matches(text):
            found |= {(end - length, end, k) for k in own}
        expected = set()
        for k, item in enumerate(items):
            n = min(4, len(item))
            windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
            expected |= {(i, i + n, k) for i in range(len(text) - n + 1) if tuple(text[i : i + n]) in windows}
        assert found == expected
