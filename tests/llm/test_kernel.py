"""The text kernels against plain Python."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import kernel as k

R = random.Random(5)
TEXTS = ["", None, "a", " ", "\n", "  x \n\n y  z  \n a\nb  <|endoftext|> 's don't<|endoftext|>", "　a b\tc\rd e  f", "É é ß", "\\### x"] + ["".join(R.choices("ab 1\n\t.é '<sZ|ß,日", k=R.randint(1, 70))) for _ in range(800)]


@pytest.mark.parametrize(("table", "pattern"), [(k.SPACED, brute.SPACED), (k.ALNUM, brute.ALNUM)])
def test_words(table, pattern):
    data, offsets = k.text_buffer(pa.array(TEXTS))
    starts, ends, rows = k.word_bounds(data, offsets, table)
    found = [k.LOWER[data[a:b]].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
    assert [found[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)] == [brute.words(t, pattern) for t in TEXTS]
    hashes, _ = k.word_hashes(data, offsets, table)
    assert len(set(hashes.tolist())) == len(set(found))


def test_shingles():
    data, offsets = k.text_buffer(pa.array(TEXTS))
    found, rows = k.shingle_hashes(*k.word_hashes(data, offsets))
    sizes = [len(set(found[a:b].tolist())) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert sizes == [len(brute.shingles(t)) for t in TEXTS]
    assert len(set(found.tolist())) == len(set().union(*(brute.shingles(t) for t in TEXTS)))


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
@pytest.mark.parametrize("capacity", [1_000_000, 50])
def test_memo_tokenizer_is_exact(name, kind, capacity):
    plain, memo = Tokenizer.from_file(public_tokenizers.path(name)), k.MemoTokenizer(public_tokenizers.path(name), kind)
    memo.capacity = capacity
    data, offsets = k.text_buffer(pa.array(TEXTS))
    found = []
    for i, j in k.row_blocks(offsets, 300):
        ids, rows = memo.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        found += [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert found == [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_long_text_in_blocks(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(60_000))
    data, offsets = k.text_buffer(pa.array([text]))
    whole, _ = k.word_hashes(data, offsets)
    monkeypatch.setattr(k, "BLOCK", 1000)
    parts, _ = k.word_hashes(data, offsets)
    assert (whole == parts).all() and len(np.unique(whole)) == 977


def test_sliced_arrays():
    column = pa.array(["aa", "bb cc", "dd"])[1:]
    data, offsets = k.text_buffer(column)
    assert data.tobytes() == b"bb ccdd" and offsets.tolist() == [0, 5, 7]


PIECES = ["a", "B", "J̌", "don't", "'s", "'S", "''re", "'ll", "I'M", "0", "12", "x0y", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "<", ">", ".", "$$$", "é", "É", "İ", "Σ", "́", " ", " ", "\n", "中", "٣", "\x00", "\x1c", "\x7f", " ", "K", "_", "‍", "ſ", "t", "d", "'ve"]


@pytest.mark.parametrize("control", [True, False])
def test_parts_of_words_are_exact(control):
    """Words are cut into parts and encoded together; the ids are those of the whole text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["".join(R.choices(PIECES, k=R.randrange(14))) for _ in range(3000)]
    texts = texts if control else [t.replace("<|", "<") for t in texts]
    ids, rows = k.MemoTokenizer(path, "word").encode(*k.text_buffer(pa.array(texts)))
    found = [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert found == [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]


def test_segments_of_one_place_are_all_kept():
    """Before, each segment had one place, and two of the same place were computed anew in every block."""

    class Lengths(k.Memo):
        SLOTS, computed = 1 << 12, 0

        def compute(self, texts):
            self.computed += len(texts)
            return [[len(x)] for x in texts]

    memo, words = Lengths(), [f"w{i}" * (1 + i % 3) for i in range(300)]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = np.append(0, ends[:-1])
    places = k.span_hashes(data, starts, ends, k.SAME) & np.uint64(memo.SLOTS - 1)
    assert len(set(places.tolist())) < len(words)
    for _ in range(6):
        before = memo.computed
        entry = memo.entries(data, starts, ends)
        assert memo.ids[memo.first[entry]].tolist() == [len(w) for w in words]
    assert memo.computed == before
