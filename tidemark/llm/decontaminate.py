"""Benchmark decontamination by a generalised suffix automaton over the words of test items.

The words of a text are streamed through the automaton, which keeps the longest suffix read so far
that occurs in any item. Where it is `window` words or longer, a window of an item ends. Items
shorter than a window count as a whole. Most text never enters the Python loop: a match consists of
neighbouring words that are neighbours in some item, so only runs of such pairs are streamed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import spill
from .kernel import ALNUM, kept, row_blocks, span_hashes, text_buffer, word_bounds, word_hashes

WINDOW = 10
#: Words of test items in one automaton; more items go through the text in further passes.
WORDS_PER_PASS = 250_000


class SuffixAutomaton:
    """Of several word sequences. States are numbers; state 0 is the empty string."""

    def __init__(self, items: list[list[int]], window: int = WINDOW):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        for words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        n = len(self.length)
        #: For each state, the items that hold its strings, and (state, length, item) of short items that are suffixes of it.
        self.items: list[set[int]] = [set() for _ in range(n)]
        whole: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(items):
            state = 0
            for w in words:
                state = self.next[state][w]
                up = state
                while up > 0 and k not in self.items[up]:
                    self.items[up].add(k)
                    up = self.link[up]
            if 0 < len(words) < window:
                whole.setdefault(state, []).append((len(words), k))
        self.short: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        if whole:
            for state in sorted(range(1, n), key=self.length.__getitem__):
                self.short[state] = whole.get(state, []) + self.short[self.link[state]]

    def _state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append({})
        return len(self.length) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of q for its strings up to length(p) + 1."""
        copy = self._state(self.length[p] + 1)
        self.next[copy], self.link[copy] = dict(self.next[q]), self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def matches(self, words: list[int]):
        """(end, length, items) of every window, and of every short item, that ends in the words."""
        state, length = 0, 0
        for end, w in enumerate(words, 1):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(w, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                yield end, self.window, self.items[at]
            for size, k in self.short[state]:
                if size <= length:
                    yield end, size, (k,)


class Matcher:
    """Finds the items' windows in the word hashes of texts."""

    def __init__(self, hashes: np.ndarray, rows: np.ndarray, window: int = WINDOW):
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        items = [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)]
        self.automaton = SuffixAutomaton(items, window)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.asarray(x[:-1], np.int64) * len(self.vocabulary) + x[1:] for x in items if len(x) > 1)]))
        self.single = np.unique([x[0] for x in items if len(x) == 1]).astype(np.int64)
        self.least = min([window, *(len(x) for x in items if len(x) > 1)])

    def find(self, hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Which words are hit, and for each row with hits its items."""
        hit, found = np.zeros(len(hashes), bool), {}
        if not len(hashes) or not len(self.vocabulary):
            return hit, found
        ids = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        ids = np.where(self.vocabulary[ids] == hashes, ids, -1)
        runs = []
        if len(self.pairs) and len(ids) > 1:
            pair = ids[:-1] * len(self.vocabulary) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            good = (self.pairs[at] == pair) & (ids[:-1] >= 0) & (ids[1:] >= 0)
            inner = rows[(rows > 0) & (rows < len(ids))]
            good[inner - 1] = False
            change = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
            runs += [(a, b + 1) for a, b in zip(change[::2], change[1::2], strict=True) if b - a + 1 >= self.least]
        if len(self.single):
            runs += [(a, a + 1) for a in np.flatnonzero(np.isin(ids, self.single))]
        for a, b in runs:
            row = int(np.searchsorted(rows, a, "right")) - 1
            for end, length, items in self.automaton.matches(ids[a:b].tolist()):
                hit[a + end - length : a + end] = True
                found.setdefault(row, set()).update(items)
        return hit, found


def item_blocks(items: DataFrame, id_col: str, text_col: str):
    """(ids, word hashes, row offsets) of at most WORDS_PER_PASS words, or one longer item, at a time."""
    ids, parts, total = [], [], 0

    def block():
        rows = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
        return ids, np.concatenate([np.zeros(0, np.uint64), *parts]), rows

    for row in items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("item_id is not null and text is not null").distinct().orderBy("item_id", "text").toLocalIterator():
        words, _ = word_hashes(*text_buffer(pa.array([row.text], pa.large_string())), ALNUM)
        if parts and total + len(words) > WORDS_PER_PASS:
            yield block()
            ids, parts, total = [], [], 0
        ids.append(row.item_id)
        parts.append(words)
        total += len(words)
    if parts:
        yield block()


def _each(matcher: Matcher, names: np.ndarray, column):
    """Of each text of an Arrow column, in order: its number of words, its spans, and the items that occur in it."""
    data, offsets = text_buffer(column)
    for i, j in row_blocks(offsets):
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, rows = word_bounds(part, bounds, ALNUM)
        hit, found = matcher.find(span_hashes(part, starts, ends), rows)
        for k in range(j - i):
            a, b = rows[k], rows[k + 1]
            spans = []
            if k in found:
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
                spans = [{"first": int(x), "last": int(y), "start": int(starts[a + x] - bounds[k]), "end": int(ends[a + y - 1] - bounds[k])} for x, y in zip(edge[::2], edge[1::2], strict=True)]
            yield b - a, spans, set(names[list(found.get(k, ()))])


class _Pass:
    """One block of test items, sent to all workers."""

    def __init__(self, docs: DataFrame, block, window: int):
        context = docs.sparkSession.sparkContext
        self.shared, self.window = context.broadcast(block), window
        self.key = f"{context.applicationId}-{self.shared._jbroadcast.id()}"

    def texts(self, column):
        ids, words, rows = self.shared.value
        return _each(kept(("matcher", self.key), lambda: Matcher(words, rows, self.window)), np.array(ids, object), column)


def _scan(one: _Pass, text_at: int, at: int):
    """Adds to each row's spans and items; the columns n_words, spans and items begin at `at`."""

    def run(batches):
        for batch in batches:
            old = zip(batch.column(at + 1).to_pylist(), batch.column(at + 2).to_pylist(), strict=True)
            new = [(n, [*(spans or []), *more], sorted({*(items or []), *seen})) for (n, more, seen), (spans, items) in zip(one.texts(batch.column(text_at)), old, strict=True)]
            new = [pa.array([x[k] for x in new], batch.schema.field(at + k).type) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *new], schema=batch.schema)

    return run


_SPANS = "array<struct<first:long,last:long,start:long,end:long>>"


def _hits(one: _Pass, schema: pa.Schema):
    """(two hashes of the text, spans, items) of the texts that have any; columns are the text and its hashes."""

    def run(batches):
        for batch in batches:
            found = [(k, spans, sorted(seen)) for k, (_, spans, seen) in enumerate(one.texts(batch.column(0))) if spans]
            at = pa.array([k for k, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1).take(at), batch.column(2).take(at), *(pa.array([x[k] for x in found], schema.field(k + 1).type) for k in (1, 2))], schema=schema)

    return run


def _last_pass(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str, window: int):
    """The rows before the last pass over the text, its function, and the schema that it gives.

    Passes before the last one read the texts and write hits only, by two hashes of the text; the
    rows get them by one join at the end. Copies of a text have one entry there.
    """
    ship(docs.sparkSession)
    out = docs.drop("n_words", "spans", "items")
    columns, text_at = out.columns, out.columns.index(text_col)
    text = F.col(_quoted(text_col)).cast("string")
    free = "_".join(["hits", *columns])  # no column of docs has this name
    names = [f"{free}{k}" for k in range(4)]
    kinds = ", ".join(f"{_quoted(n)} {kind}" for n, kind in zip(names, ("long", "long", _SPANS, "array<string>"), strict=True))
    span = pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")])
    schema = pa.schema(list(zip(names, (pa.int64(), pa.int64(), pa.list_(span), pa.list_(pa.string())), strict=True)))
    keys = [F.xxhash64(text), F.xxhash64(F.lit(1), text)]
    one, hits = None, None
    for block in item_blocks(items, item_id, item_text):
        if one:
            found = out.where(text.isNotNull()).select(text, *keys).mapInArrow(_hits(one, schema), kinds)
            found = spill(found.groupBy(*map(_quoted, names[:2])).agg(*(F.first(_quoted(n)).alias(n) for n in names[2:])), "hits")
            hits = found if hits is None else hits.union(found)
        one = _Pass(docs, block, window)
    one = one or _Pass(docs, ([], np.zeros(0, np.uint64), np.zeros(1, np.int64)), window)
    spans, seen = F.lit(None).cast(_SPANS), F.lit(None).cast("array<string>")
    if hits is not None:
        hits = hits.groupBy(*map(_quoted, names[:2])).agg(*(F.flatten(F.collect_list(_quoted(n))).alias(n) for n in names[2:]))  # one entry for each pass at most
        out = out.join(hits, (keys[0] == F.col(_quoted(names[0]))) & (keys[1] == F.col(_quoted(names[1]))), "left")
        spans, seen = (F.col(_quoted(n)).alias(m) for n, m in zip(names[2:], ("spans", "items"), strict=True))
    out = out.select(*map(_quoted, columns), F.lit(0).cast("long").alias("n_words"), spans.alias("spans"), seen.alias("items"))
    kind = out.schema
    for field in list(kind)[len(columns) :]:
        field.nullable = True
    return out, _scan(one, text_at, len(columns)), kind


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def scan(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """`docs` and the columns n_words, spans (words first to last - 1, bytes start to end), items (ids as strings).

    Null and empty texts have no words. Items without id or words match nothing; equal ids are one
    item. Spans of several passes may overlap. A text's own columns of these three names are
    replaced. An empty item table leaves all spans empty.
    """
    out, run, schema = _last_pass(docs, items, text_col, item_id, item_text, window)
    return out.mapInArrow(run, schema)


#: Hit words of a document, as the union of its spans.
HIT_WORDS = """aggregate(array_sort(spans), named_struct('n', 0L, 'at', 0L),
    (s, x) -> named_struct('n', s.n + greatest(0L, x.last - greatest(x.first, s.at)), 'at', greatest(s.at, x.last)), s -> s.n)"""


def _cut(scanned, text_at: int, at: int, coverage: float):
    """A pass and the cut after it, in one worker."""

    def run(batches):
        for batch in scanned(batches):
            texts, spans = batch.column(text_at), batch.column(at + 1).to_pylist()
            keep = [True] * len(batch)
            if any(spans):
                out, words = texts.to_pylist(), batch.column(at).to_pylist()
                for i, own in enumerate(spans):
                    if own:
                        raw, parts, end, hit, last = out[i].encode(), [], 0, 0, 0
                        for s in sorted(own, key=lambda s: s["start"]):
                            parts.append(raw[end : max(end, s["start"])])
                            end = max(end, s["end"])
                            hit += max(0, s["last"] - max(s["first"], last))
                            last = max(last, s["last"])
                        out[i] = b"".join([*parts, raw[end:]]).decode()
                        keep[i] = hit <= coverage * words[i]
                texts = pa.array(out, texts.type)
            columns = [texts if k == text_at else c for k, c in enumerate(batch.columns[:at])]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:at]).filter(pa.array(keep, pa.bool_()))

    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", coverage: float = 0.5, window: int = WINDOW) -> DataFrame:
    """`docs` with all hit spans cut out of the text; rows in which they are more than `coverage` of the words go.

    A row without hits keeps its text unchanged, null included. Columns stay as they are, but for
    columns named n_words, spans or items, which go.
    """
    plain = docs.drop("n_words", "spans", "items")
    out, run, _ = _last_pass(plain, items, text_col, "item_id", "text", window)
    return out.mapInArrow(_cut(run, plain.columns.index(text_col), len(plain.columns), coverage), plain.schema)
