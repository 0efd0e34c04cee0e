"""The registered queries of the operators on the smallest tables."""

import zlib

import brute
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def rows(spark, name):
    return queries.queries()[name](spark, SF).collect()


def coder(name):
    found = Tokenizer.from_file(str(public_tokenizers.path(name)))
    return lambda text: found.encode(text, add_special_tokens=False).ids


def crc(doc):
    return zlib.crc32(str(doc).encode())


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.execute(oracles.SQL[name])
    names = [c[0] for c in expected.description]
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(expected.fetchall())


def test_op1(spark, docs):
    covered = {}
    for r in rows(spark, "op1_compact_windows"):
        assert r.n_words >= 50 and r.similarity >= 0.75 and r.source_doc_id < r.doc_id
        covered.setdefault(r.doc_id, set()).update(range(r.first_word, r.first_word + r.n_words))
    expected = brute.repeated_words(list(docs.items()))
    assert sum(map(len, expected.values())) and all(hit <= covered.get(d, set()) for d, hit in expected.items())


def test_op2(spark, docs):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    found = {r.doc_id: r for r in rows(spark, "op2_byte_network")}
    assert set(found) == set(docs) and all(r.held_out == (crc(d) % 4 == 2) and 0 <= r.score <= 1 for d, r in found.items())
    held = [d for d, r in found.items() if r.held_out and langs[d] and any(map(str.isalpha, docs[d] or ""))]
    assert sum(found[d].lang_pred == langs[d] for d in held) >= 0.95 * len(held)


def test_op3(spark, docs):
    found = {r.doc_id: r for r in rows(spark, "op3_levenshtein_lexicon")}
    assert set(found) == set(docs)
    assert all(r.held_out == (crc(d) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in found.items())


def test_op4(spark, docs):
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op4_bit_planes")}
    assert found == brute.op4(list(docs.items()), coder("byte_bpe_50k.json"))


def test_op6(spark, docs):
    found = rows(spark, "op6_sum_of_squares_packing")
    pieces = [(p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens, p.sequence_id, p.offset) for p in found]
    assert brute.op6_faults(list(docs.items()), pieces, coder("word_bpe_49k.json")) == []


def test_op7(spark, docs, monkeypatch):
    monkeypatch.setattr(queries.attention_lm, "STEPS", 200)
    found = {r.doc_id: r for r in rows(spark, "op7_attention_lm")}
    expected = brute.op7_base(list(docs.items()))
    assert set(found) == set(expected)
    for d, (n, known, total, base) in expected.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(d) % 7 == 2, n, known, total) and r.base_score == pytest.approx(base) and r.score < 0


def test_op11(spark, docs):
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows(spark, "op11_trie_variants")}
    expected = brute.op11_forms(brute.op11_counts(docs.items()))
    assert found == expected and any(form for form, *_ in expected.values())


def test_op12(spark, docs):
    sources = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF}/documents.parquet'").fetchall())
    found = {r.doc_id: r for r in rows(spark, "op12_subset_sum_mix")}
    size = {d: len(brute.SPACED.findall(t or "")) for d, t in docs.items()}
    whole = {}
    for d, s in sources.items():
        whole[s] = whole.get(s, 0) + size[d]
    target = brute.op12_targets(whole)
    assert {d: (r.size, r.source_size) for d, r in found.items()} == {d: (size[d], whole[sources[d]]) for d in docs}
    assert all(r.target == pytest.approx(target[sources[d]]) and r.taken in (0, r.size, 2 * r.size) for d, r in found.items())
    for s in whole:
        own = [size[d] for d in docs if sources[d] == s]
        budget = target[s] % whole[s] if target[s] < 2 * whole[s] else 0
        assert abs(sum(r.taken for d, r in found.items() if sources[d] == s) - target[s]) <= brute.best_sum(own, round(budget)) + 0.5
    assert {r.doc_id: r.taken for r in rows(spark, "op12_subset_sum_mix")} == {d: r.taken for d, r in found.items()}


def test_op13(spark, docs):
    found = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows(spark, "op13_lpf_runs")}
    expected = brute.op13(docs.items())
    assert found == expected and sum(r[0] > 0 for r in expected.values()) > 5
