"""Vectorised text kernels over the raw UTF-8 buffers of Arrow batches.

Words are found at byte level: every separator that the contracts name is an ASCII byte, and an
ASCII byte never occurs inside a multi-byte UTF-8 sequence. A word's hash is a polynomial over
random 64-bit values of its bytes, taken from one running sum, so no Python string is made.
Rows are taken in blocks of about `BLOCK` bytes; a longer row is one block, whose arrays grow with it.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(salt))


_BYTE = seeds(256, 11)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for n places."""
    if not _POWERS or len(_POWERS[0]) < n:
        m = max(n, BLOCK + 4096)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, _U), np.full(m - 1, b, _U)])) for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def byte_table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], bool)


#: Words between ASCII white space.
SPACED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Words of digits, ASCII letters and all that is not ASCII.
ALNUM = byte_table(lambda b: b > 0x7F or chr(b).isalnum())
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
SAME = np.arange(256, dtype=np.uint8)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and row offsets of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK):
    """Ranges (i, j) of rows with at most `limit` bytes together, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of words before it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hashes of data[start:end] for ascending, disjoint spans."""
    out = np.empty(len(starts), _U)
    k = 0
    while k < len(starts):
        base = starts[k]
        m = max(k + 1, int(np.searchsorted(ends, base + BLOCK, "right")))
        part = fold[data[base : ends[m - 1]]]
        power, inverse = _powers(len(part))
        run = np.empty(len(part) + 1, _U)
        run[0] = 0
        np.cumsum(_BYTE[part] * power[: len(part)], out=run[1:])
        a, b = starts[k:m] - base, ends[k:m] - base
        out[k:m] = mix((run[b] - run[a]) * inverse[a] + (b - a).astype(_U))
        k = m
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and row offsets into them."""
    starts, ends, rows = word_bounds(data, offsets, table)
    return span_hashes(data, starts, ends), rows


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of `width` words, in order; a shorter row is one shingle, an empty one none."""
    factor = seeds(width, 23) | _U(1)
    n = np.diff(rows)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_rows = np.concatenate([[0], np.cumsum(count)])
    out = np.empty(out_rows[-1], _U)
    long = n >= width
    if len(words) >= width:
        total = words[: len(words) - width + 1] * factor[0]
        for k in range(1, width):
            total += words[k : len(words) - width + 1 + k] * factor[k]
        at = expand(rows[:-1][long], count[long])
        out[expand(out_rows[:-1][long], count[long])] = mix(total[at])
    for i in np.flatnonzero((n > 0) & ~long):
        w = words[rows[i] : rows[i + 1]]
        out[out_rows[i]] = mix((w * factor[: len(w)]).sum(keepdims=True) + _U(len(w)))[0]
    return out, out_rows


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of start, start + 1, ... (count values) over all pairs."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - first, counts)


def rows_of(rows: np.ndarray) -> np.ndarray:
    """The row index of every element under the given row offsets."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


class Memo:
    """Values of text segments, each computed once; a segment's value is a run of unsigned integers.

    Segments are told apart by a 64-bit hash, and each has two places where it may be kept. At
    `capacity` kept segments the memory starts anew.
    """

    SLOTS = 1 << 22

    def __init__(self, capacity: int = 2_000_000, fold: np.ndarray = SAME):
        self.capacity, self.fold = capacity, fold
        self.clear()

    def clear(self):
        self.keys, self.slot = np.zeros(self.SLOTS, _U), np.full(self.SLOTS, -1, np.int32)
        self.first, self.size, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def compute(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _places(self, keys: np.ndarray, shift: int) -> np.ndarray:
        return (keys >> _U(shift) & _U(self.SLOTS - 1)).astype(np.int64)

    def _held(self, keys: np.ndarray, shift: int) -> np.ndarray:
        place = self._places(keys, shift)
        return np.where(self.keys[place] == keys, self.slot[place], -1).astype(np.int64)

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The segments' places in `first` and `size`, valid until the next call."""
        if len(self.first) > self.capacity:
            self.clear()
        keys = span_hashes(data, starts, ends, self.fold)
        entry = self._held(keys, 0)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            entry[missing] = self._held(keys[missing], 40)
            missing = missing[entry[missing] < 0]
        if len(missing):
            new, at, back = np.unique(keys[missing], return_index=True, return_inverse=True)
            raw = self.fold[data].tobytes() if self.fold is not SAME else data.tobytes()
            at = missing[at]
            values = self.compute([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at], ends[at], strict=True)])
            size = np.fromiter(map(len, values), np.int64, len(values))
            flat = np.fromiter((i for ids in values for i in ids), np.uint32, int(size.sum()))
            base = len(self.first)
            self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(size) - size).astype(np.int32)])
            self.size, self.ids = np.concatenate([self.size, size.astype(np.int32)]), np.concatenate([self.ids, flat])
            entry[missing] = base + back
            first = self._places(new, 0)
            where, one = np.unique(np.where(self.slot[first] < 0, first, self._places(new, 40)), return_index=True)  # of two new keys of one place one stays
            self.keys[where], self.slot[where] = new[one], base + one
        return entry


class MemoTokenizer(Memo):
    """Exact ids of a public tokenizer, with the ids of recurring text segments kept.

    A text is cut only where the tokenizer's own pre-tokenizer always cuts, so the ids of a text
    are those of its segments one after another. `kind` "word" (white space is dropped by the
    tokenizer, which lower-cases) has words between ASCII white space as segments, and keeps the ids
    of their parts: letters, digits and marks, cut as `CUTS` allows. "byte" (white space belongs to
    tokens) cuts before a space, and around a lone line feed, that stands before a visible character.
    """

    #: Classes of bytes: 0 for those beside which no word is cut (white space, controls, the bar of
    #: the tokenizers' control strings, all that is not ASCII), then letters, digits, marks, apostrophe.
    KINDS = np.array([1 if chr(b).isalpha() else 2 if chr(b).isdigit() else 4 if b == 0x27 else 3 if 0x20 < b < 0x7F and b != 0x7C else 0 for b in range(128)] + [0] * 128, np.uint8)
    #: CUTS[8 * kind + next kind]: a part ends between the two. Marks and apostrophes are one run, and an apostrophe may belong to the letters after it.
    CUTS = np.array([1 <= a <= 4 and 1 <= b <= 4 and a != b and not (a > 2 and b > 2) and (a, b) != (4, 1) for a in range(8) for b in range(8)], bool)
    #: What stands between the parts that are encoded together: one id, and no part with it in it is among them.
    BETWEEN = "0"

    def __init__(self, path: str, kind: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        if kind == "word":  # for parts of a to z, which nothing before the model changes or divides
            self.letters = Tokenizer.from_file(path)
            self.letters.normalizer, self.letters.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        super().__init__()

    def compute(self, texts: list[str]) -> list[list[int]]:
        if self.kind == "word" and len(texts) > 1:
            return self._together(texts)
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, texts: list[str], batch: int = 512) -> list[list[int]]:
        """Ids of many short texts, which are encoded joined and divided at the ids of BETWEEN."""
        mark = self.tokenizer.encode(self.BETWEEN, add_special_tokens=False).ids
        out: list = [None] * len(texts)
        plain = [x.isascii() and x.islower() and x.isalpha() for x in texts]
        for tokenizer, fit in ((self.letters, True), (self.tokenizer, False)):
            held = [k for k, x in enumerate(texts) if plain[k] is fit and self.BETWEEN not in x] if len(mark) == 1 else []
            groups = [held[a : a + batch] for a in range(0, len(held), batch)]
            joined = tokenizer.encode_batch_fast([f" {self.BETWEEN} ".join([texts[k] for k in g]) for g in groups], add_special_tokens=False)
            for g, e in zip(groups, joined, strict=True):
                ids = e.ids
                ends = [k for k, i in enumerate(ids) if i == mark[0]]
                if len(ends) == len(g) - 1:
                    for k, a, b in zip(g, [0, *(x + 1 for x in ends)], [*ends, len(ids)], strict=True):
                        out[k] = ids[a:b]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
            out[k] = e.ids
        return out

    def _parts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes with letters lowered, the parts' starts and ends, and each word's first part.

        A letter before a byte that isn't ASCII keeps its case: the two may be one character to the tokenizer.
        With a control string's beginning in the bytes all letters keep theirs.
        """
        kinds = self.KINDS[data]
        cut = np.flatnonzero(self.CUTS[kinds[:-1] * 8 + kinds[1:]]) + 1
        first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        first[starts], last[ends] = True, True
        cut = cut[~first[cut]]
        first[cut], last[cut] = True, True
        begin = np.flatnonzero(first)
        if b"<|" not in data.tobytes():
            data = np.where(np.append(data[1:] < 0x80, True), LOWER[data], data)
        return data, begin, np.flatnonzero(last), np.searchsorted(begin, starts)

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.kind == "word":
            return word_bounds(data, offsets, SPACED)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        seen = ((data > 0x20) & (data < 0x7F)) | (data == 0xC3)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 0x20) & seen[1:]
        lone = np.flatnonzero((data[1:-1] == 0x0A) & seen[2:] & (data[:-2] > 0x20) & (data[:-2] < 0x7F)) + 1
        cut[lone] = True
        cut[lone + 1] = True
        cut[offsets] = True
        places = np.flatnonzero(cut)
        return places[:-1], places[1:], np.searchsorted(places, offsets)

    def encode_segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows one after another, each segment's number of ids, and row offsets into the segments."""
        starts, ends, rows = self.segments(data, offsets)
        if self.kind == "word" and len(starts):
            data, starts, ends, word = self._parts(data, starts, ends)
        else:
            word = None
        entry = self.entries(data, starts, ends)
        size = self.size[entry].astype(np.int64)
        ids = self.ids[expand(self.first[entry], size)]
        return ids, size if word is None else np.add.reduceat(size, word), rows

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and row offsets into them."""
        ids, size, rows = self.encode_segments(data, offsets)
        return ids, np.concatenate([[0], np.cumsum(size)])[rows]


_KEPT: dict = {}


def kept(key=None, make=None):
    """What a worker keeps from task to task: one object, made anew when another key is asked for.

    Every function that runs in a worker calls this first, without a key if it keeps nothing, so
    that the memory of one operator is free while the next one runs.
    """
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        if make:
            _KEPT[key] = make()
    return _KEPT.get(key)


def give_back() -> None:
    """Return freed memory of this worker to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def lean(run, key=None):
    """A function over Arrow batches that keeps nothing of former tasks but what has this key, and gives its memory back at its end."""

    def leaner(batches):
        kept(key)
        yield from run(batches)
        give_back()

    return leaner


def lean_group(run, key=None):
    """The same for a function of one group."""

    def leaner(group):
        kept(key)
        out = run(group)
        _GROUPS[0] += 1
        if _GROUPS[0] % 16 == 0:
            give_back()
        return out

    return leaner


_GROUPS = [0]


def tokenizer_key(path: str, kind: str) -> tuple:
    return "tokenizer", path, kind


def tokenizer(path: str, kind: str) -> MemoTokenizer:
    """This worker's tokenizer for the file."""
    return kept(tokenizer_key(path, kind), lambda: MemoTokenizer(path, kind))


def with_end(ids: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows, each with one more id at its end."""
    n = np.diff(rows)
    out_rows = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(out_rows[-1], end, np.uint32)
    out[expand(out_rows[:-1], n)] = ids
    return out, out_rows
