"""Substring deduplication by compact windows.

For each of HASHES min-hash functions over a document's five-word shingles, the Cartesian tree of
the hash values splits the windows of SPAN shingles (50 words) into compact windows: runs of window
starts that share the same minimum. An interval join of the tilings of two functions gives joint
windows whose key is both minima; two passages of Jaccard similarity J have a key of the three in
common with a chance of J**2 (3 - 2 J) for each window of theirs, and 1 if they are equal.

Keys meet in buckets as packed columns. Each document is paired with the earliest one of its key;
and, so that a document that has only a part of the passage hides no other, with the earliest one
that shares a mark besides: the third minimum, the first window of the joint window, or its last.
Passages that begin or end differently in two documents still agree on one of those windows. A task
first does so within a block of documents and sends on the earliest only, so that a passage of any number
of documents stays small; which of several earlier documents is named depends on that. Blocks are
dealt by the id's hash and their number follows the text's bytes, so the rows are the same however
the table is partitioned.

Entries with the same key, first and last window hold the same words: they are a class, paired with its
earliest document. Stars leave nothing out for keys of one or two classes. For all other keys the
shingles of each class meet, and a class is paired with the earliest document for every set of its
shingles that an earlier class shares and that is part of no larger such set. Shingles that no other class of the
key has match nothing and are left out first, so that classes which differ in them alone are one. A key of many
classes is divided into cells, in which every two of its classes meet.
The pairs are verified on the whole texts: a passage is a run of words of the later document whose
shingles have a similarity of 0.75 or more with those of a run of the earlier one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import discard, parallel, spill
from .kernel import SPACED, lean, lean_group, mix, row_blocks, rows_of, seeds, shingle_hashes, text_buffer, word_bounds, word_hashes

_U = np.uint64
WIDTH = 5
SPAN = 46
HASHES = 3
PAIRS = tuple(combinations(range(HASHES), 2))
MARKS = 3
#: How many of the nearest earlier documents an entry is paired with whose windows no earlier document shares.
NEAREST = 1
#: Classes of one key in a part of it; two parts meet in a cell.
CELL = 2048
#: Bytes of text for one bucket of keys, and for one block of documents.
BUCKET_BYTES, BLOCK_BYTES = 1 << 24, 1 << 25
#: Blocks of a small table. Each names its own earliest documents, so that some more pairs are found than in one.
LEAST_BLOCKS = 4
_SEEDS = seeds(HASHES, 31)
#: Shingles of SPAN that must match where windows of that size have a similarity of 0.75.
NEEDED = -(-6 * SPAN // 7)
#: So many make a window part of a longer passage, whose similarity as a whole counts.
LOOSE = -(-2 * SPAN // 3)


def window_minima(values: np.ndarray, span: int = SPAN) -> np.ndarray:
    """The minimum of each window of `span` values, from running minima of blocks in both directions."""
    n = len(values)
    blocks = np.full((-(-n // span) + 1) * span, np.iinfo(_U).max, _U)
    blocks[:n] = values
    blocks = blocks.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def compact_windows(values: np.ndarray, rows: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, left, right) of every Cartesian-tree node whose subtree has `span` values or more.

    A node's subtree is the widest run around its centre without a smaller value, within the row.
    Only values that are some window's minimum can be such nodes, and only such can bound them, so
    the tree is built over those alone.
    """
    empty = np.zeros(0, np.int64)
    if len(values) < span:
        return empty, empty, empty
    least = window_minima(values, span)
    row = rows_of(rows)
    inside = row[: len(least)] == row[span - 1 :]
    new = inside.copy()
    new[1:] &= (least[1:] != least[:-1]) | ~inside[:-1] | (row[1 : len(least)] != row[: len(least) - 1])
    starts = np.flatnonzero(new)
    centre = np.unique(starts + np.argmax(values[starts[:, None] + np.arange(span)] == least[starts][:, None], axis=1))
    left, right = rows[row[centre]].tolist(), (rows[row[centre] + 1] - 1).tolist()
    stack: list[int] = []
    at, value, of = centre.tolist(), values[centre].tolist(), row[centre].tolist()
    for k in range(len(at)):
        while stack and (of[stack[-1]] != of[k] or value[stack[-1]] > value[k]):
            top = stack.pop()
            if of[top] == of[k]:
                right[top] = at[k] - 1
        if stack:
            left[k] = at[stack[-1]] + 1
        stack.append(k)
    left, right = np.array(left, np.int64), np.array(right, np.int64)
    keep = right - left + 1 >= span
    return centre[keep], left[keep], right[keep]


def joint_keys(shingles: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and marks of every joint window, see `joint_windows`."""
    return joint_windows(shingles, rows)[:3]


def joint_windows(shingles: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and marks of every joint window: a third function's minimum, and hashes of the first and of
    the last window of SPAN shingles in it (by the shingles at their ends); then where these two begin.
    Marks have 32 bits each. All windows hold the minimum, so the first and the last cover the joint window."""
    found = []
    for seed in _SEEDS:
        values = mix(shingles ^ seed)
        centre, left, _ = compact_windows(values, rows)
        start = np.maximum(left, centre - SPAN + 1)  # the first window of SPAN values with this minimum
        order = np.argsort(start, kind="stable")
        found.append((start[order], values[centre][order]))
    if not len(found[0][0]):
        return np.zeros(0, np.int64), np.zeros(0, _U), np.zeros((0, MARKS), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    row, key, marks, begin, end = [], [], [], [], []
    for i, j in PAIRS:
        start = np.union1d(found[i][0], found[j][0])
        own = np.searchsorted(rows, start, "right") - 1
        last = np.minimum(np.append(start[1:], len(shingles)), rows[own + 1] - SPAN + 1) - 1  # where the next one begins, or the row's last window
        a, b, c = (values[np.searchsorted(first, start, "right") - 1] for first, values in (found[i], found[j], found[(j + 1) % HASHES if (j + 1) % HASHES != i else (j + 2) % HASHES]))
        row.append(own)
        key.append(mix(a + mix(b ^ _SEEDS[i] ^ (_SEEDS[j] << _U(1)))))
        marks.append(np.stack([c >> _U(32), *(mix(shingles[at] + mix(shingles[at + SPAN - 1])) >> _U(32) for at in (start, last))], axis=1).astype(np.uint32))
        begin.append(start)
        end.append(last)
    return np.concatenate(row), np.concatenate(key), np.concatenate(marks), np.concatenate(begin), np.concatenate(end)


def star_pairs(key: np.ndarray, doc: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (later document, earlier one) of entries with the same key, and which entries are
    the earliest of a group with a mark.

    The earlier one is the earliest by key alone, by key with each mark, and of the entry's class. An entry that shares
    neither its first nor its last window with an earlier document is paired with the nearest
    earlier ones of its key and third minimum too: the earliest may have another passage there.
    """
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    shared = np.zeros(len(key), bool)
    shared[order[1:][same]] = shared[order[:-1][same]] = True
    among = np.flatnonzero(shared)  # most keys are alone: they pair nothing and need no further sorting
    a, b, first = _star_pairs(key[among], doc[among], marks[among])
    shared[among[first]] = False
    return a, b, np.flatnonzero(~shared)


def _star_pairs(key: np.ndarray, doc: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    marks = np.column_stack([marks.astype(_U), _class(marks)])
    a, b, first = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros(len(doc), bool)
    alone = np.ones(len(doc), bool)

    def add(later, earlier):
        a.append(doc[later])
        b.append(doc[earlier])

    for k in range(-1, marks.shape[1]):
        order = np.lexsort((doc, key) if k < 0 else (doc, marks[:, k], key))
        new = np.ones(len(order), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        if k >= 0:
            new[1:] |= marks[order, k][1:] != marks[order, k][:-1]
            first[order[new]] = True
        if not len(order):
            continue
        least = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        add(order, least)
        if k == 0:
            by_third, group = order, np.cumsum(new)
        elif 0 < k < MARKS:
            alone[order[doc[least] != doc[order]]] = False
    for step in range(1, NEAREST + 1 if len(doc) else 0):
        use = (group[step:] == group[:-step]) & alone[by_third[step:]]
        add(by_third[step:][use], by_third[:-step][use])
    a, b = np.concatenate(a), np.concatenate(b)
    return *_distinct(a[a != b], b[a != b]), np.flatnonzero(first)


def _class(marks: np.ndarray) -> np.ndarray:
    """The same for entries of a key with the same first and last window, which hold the same words."""
    return marks[:, 1].astype(_U) << _U(32) | marks[:, 2].astype(_U)


def open_classes(key: np.ndarray, doc: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The earliest entry of each class, where a key has three or more: of fewer, stars pair every two."""
    own = _class(marks)
    order = np.lexsort((doc, own, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (own[order][1:] != own[order][:-1])
    order = order[new]
    _, back, count = np.unique(key[order], return_inverse=True, return_counts=True)
    return order[count[back] > 2]


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, in ascending order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_PACKED = "bucket int, keys binary, docs binary, marks binary, a binary, b binary"


def _emit(buckets: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch | None:
    row = [np.concatenate(x) for x in zip(*parts, strict=True)]
    doc, key, marks = row
    a, b, first = star_pairs(key, doc, marks)
    doc, key, marks = doc[first], key[first], marks[first]

    to = [(mix(place) % _U(buckets)).astype(np.int64) for place in (key, a.view(_U))]
    used = np.unique(np.concatenate(to))  # buckets without an entry get no row, so that rows grow with the entries alone

    def split(place, columns):
        order = np.argsort(place, kind="stable")
        cut = np.append(np.searchsorted(place[order], used), len(place))
        columns = [c[order] for c in columns]
        return [[c[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)] for c in columns]

    packed = [*split(to[0], (key, doc, marks)), *split(to[1], (a, b))]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(x, pa.binary()) for x in packed)], [f.split()[0] for f in _PACKED.split(", ")])


def _keys(buckets: int):
    """Batches of block, doc_id and text, sorted by block: an emit for each block."""

    def run(batches):
        parts, now = [], None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            data, offsets = text_buffer(batch.column(2))
            docs = batch.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(blocks)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)], strict=True):
                if s == e:
                    continue
                if parts and blocks[s] != now:
                    yield _emit(buckets, parts)
                    parts = []
                now = blocks[s]
                for i, j in row_blocks(offsets[s : e + 1]):
                    i, j = i + s, j + s
                    words, rows = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                    row, key, marks = joint_keys(*shingle_hashes(words, rows, WIDTH))
                    parts.append((docs[i:j][row], key, marks))
        if parts:
            yield _emit(buckets, parts)

    return run


def _meet(group: pa.Table) -> pa.Table:
    key, doc, marks, a, b = (np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(name)]) for name, kind in (("keys", _U), ("docs", np.int64), ("marks", np.uint32), ("a", np.int64), ("b", np.int64)))
    x, y, _ = star_pairs(key, doc, marks.reshape(-1, MARKS))
    a, b = _distinct(np.concatenate([a, x]), np.concatenate([b, y]))
    rest = open_classes(key, doc, marks.reshape(-1, MARKS))
    n, m = len(a), len(rest)
    return pa.table([pa.array(np.concatenate([a, doc[rest]])), pa.concat_arrays([pa.array(b), pa.nulls(m, pa.int64())]), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(key[rest].view(np.int64))])], ["a", "b", "key"])


def _ranges(batches):
    """Batches of doc_id, text and keys: the shingles (32 bits of each, once, in ascending order) of the joint windows with these keys."""
    for batch in batches:
        docs, wanted = batch.column(0).to_numpy(), batch.column(2)
        data, offsets = text_buffer(batch.column(1))
        ends, values = wanted.offsets.to_numpy(), wanted.values.to_numpy().view(_U)
        for i, j in row_blocks(offsets):
            words, rows = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            shingles, rows = shingle_hashes(words, rows, WIDTH)
            row, key, _, start, last = joint_windows(shingles, rows)
            of = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))
            pair = lambda key, row: mix(key ^ mix(row.astype(_U)))
            use = np.flatnonzero(np.isin(pair(key, row), pair(values[ends[i] : ends[j]], of)))
            short = (shingles >> _U(32)).astype(np.uint32)
            own = [np.unique(short[s:e]).tobytes() for s, e in zip(start[use].tolist(), (last[use] + SPAN).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(key[use].view(np.int64)), pa.array(docs[i:j][row[use]]), pa.array(own, pa.binary())], ["key", "doc", "shingles"])


def shared_sets(doc: np.ndarray, ranges: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(later document, earlier one, and which of the later one's shingles they share, as two numbers of SPAN bits), from
    sets of shingles of one key in ascending order of documents. Of an entry, each shared set that is in no larger one comes once, with the earliest document."""
    n = len(doc)
    size = np.array([len(x) for x in ranges])
    owner, place = np.repeat(np.arange(n), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    _, value, count = np.unique(np.concatenate(ranges), return_inverse=True, return_counts=True)
    shared = count[value] > 1
    owner, place, value = owner[shared], place[shared], value[shared]
    bits = [np.where(place < SPAN, 2.0 ** np.minimum(place, SPAN), 0.0), np.where(place < SPAN, 0.0, 2.0 ** np.maximum(place - SPAN, 0))]
    held, own = np.bincount(owner, minlength=n), np.zeros(n, _U)
    np.add.at(own, owner, mix(value.astype(_U) + _U(1)))
    _, first, back = np.unique(own, return_index=True, return_inverse=True)
    copies = np.flatnonzero((first[back] != np.arange(n)) & (held >= LOOSE) & (doc[first[back]] != doc))
    a, b = [doc[copies]], [doc[first[back[copies]]]]
    sets = [[np.bincount(owner, x, n)[copies]] for x in bits]
    one = np.zeros(n, bool)
    one[first] = True
    use = one[owner]
    owner, value, bits = owner[use], value[use], [x[use] for x in bits]
    order = np.lexsort((owner, value))
    by_value, holders = value[order], owner[order]
    begin = np.searchsorted(owner, np.arange(n + 1))
    for k in np.flatnonzero(one & (held >= LOOSE)).tolist():
        s, e = begin[k], begin[k + 1]
        low, high = np.searchsorted(by_value, value[s:e]), np.searchsorted(by_value, value[s:e], "right")
        many = high - low
        at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - low, many)
        other, which = holders[at], np.repeat(np.arange(s, e), many)
        before = other < k
        other, which = other[before], which[before]
        common = np.bincount(other, minlength=1)
        near = np.flatnonzero(common >= LOOSE)
        near = near[doc[near] != doc[k]]
        if not len(near):
            continue
        x, y = (np.bincount(other, c[which])[near] for c in bits)
        _, once = np.unique(x + 1j * y, return_index=True)
        once = once[np.argsort(-common[near[once]], kind="stable")]
        x, y = x[once].astype(np.int64), y[once].astype(np.int64)
        kept: list[int] = []
        for i in range(len(once)):
            if not (((x[i] & ~x[kept]) | (y[i] & ~y[kept])) == 0).any():
                kept.append(i)
        a.append(np.full(len(kept), doc[k]))
        b.append(doc[near[once[kept]]])
        sets[0].append(x[kept])
        sets[1].append(y[kept])
    return np.concatenate(a), np.concatenate(b), *(np.concatenate(x).astype(np.int64) for x in sets)


_SETS = "a long, key long, x long, y long, b long"


def _rest(group: pa.Table) -> pa.Table:
    key, doc, own = (group.column(c) for c in ("key", "doc", "shingles"))
    key, doc = key.to_numpy(), doc.to_numpy()
    order = np.lexsort((doc, key))
    cut = np.flatnonzero(np.diff(key[order], prepend=key[order[0]] - 1, append=key[order[-1]] - 1))
    ranges = [np.frombuffer(x.as_buffer(), np.uint32) for x in own]
    out = []
    for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        a, b, x, y = shared_sets(doc[order[s:e]], [ranges[k] for k in order[s:e].tolist()])
        out.append((a, np.full(len(a), key[order[s]]), x, y, b))
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], [f.split()[0] for f in _SETS.split(", ")])


def _similar(a: np.ndarray, b: np.ndarray, match: np.ndarray, where: np.ndarray, s: int, e: int, divide: bool) -> list[tuple[int, int, float]]:
    """Those runs of a's shingles between s and e that are similar enough to a run of b; with `divide` a run is divided until it is, or too short."""
    out = []
    p = s + np.flatnonzero(match[s:e])
    parts = np.split(p, np.flatnonzero(np.abs(np.diff(where[p]) - np.diff(p)) > SPAN) + 1)
    whole = len(parts) == 1
    while parts:
        part = parts.pop()
        first, last = int(part[0]), int(part[-1])
        short = SPAN - (last - first + 1)
        if short > 0 and not whole:
            continue
        low, high = int(where[part].min()), int(where[part].max())
        if short > 0:  # edits near the ends of a window: it reaches beyond its first and last match, in both texts
            lead = min(short, first - s, low)
            first, low = first - lead, low - lead
            last, high = min(last + short - lead, e - 1), min(high + short - lead, len(b) - 1)
            if last - first + 1 < SPAN:
                continue
        whole = False
        x, y = np.unique(a[first : last + 1]), np.unique(b[low : high + 1])
        common = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * common >= 75 * (len(x) + len(y) - common):
            out.append((first, last + WIDTH, common / (len(x) + len(y) - common)))
        elif divide and len(part) > 1:  # too much lies between: divide where most does
            at = int(np.argmax(np.maximum(np.diff(part), np.abs(np.diff(where[part]))))) + 1
            parts += [part[:at], part[at:]]
    return out


def passages(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, float]]:
    """Runs of words (first, end, similarity) of text a, from its shingles in order, that have a near-duplicate in b."""
    if len(a) < SPAN or len(b) < SPAN:
        return []
    order = np.argsort(b, kind="stable")
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    where = order[at]
    match = b[where] == a
    for p in (np.flatnonzero(match[1:] & match[:-1] & (where[1:] != where[:-1] + 1)) + 1).tolist():
        k = int(where[p - 1]) + 1  # where b goes on as a does, that place counts and not an earlier one with the same words
        while p < len(a) and k < len(b) and a[p] == b[k] and where[p] != k:
            where[p] = k
            p, k = p + 1, k + 1
    total = np.concatenate([[0], np.cumsum(match)])
    out, seen = [], set()
    for least in (NEEDED, LOOSE):
        good = total[SPAN:] - total[:-SPAN] >= least
        edge = np.flatnonzero(np.diff(np.concatenate([[0], good.astype(np.int8), [0]])))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if (s, e) not in seen:  # a loose run that is a strict one is known already
                seen.add((s, e))
                out += _similar(a, b, match, where, s, e - 1 + SPAN, least == NEEDED)
    return out


def _verify(batches):
    for batch in batches:
        sides = []
        for c in (2, 3):
            data, offsets = text_buffer(batch.column(c))
            own = []
            for i, j in row_blocks(offsets):
                shingles, rows = shingle_hashes(*word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), WIDTH)
                own += [shingles[s:e] for s, e in zip(rows[:-1], rows[1:], strict=True)]
            sides.append(own)
        rows = [(k, *span) for k, (x, y) in enumerate(zip(*sides, strict=True)) for span in passages(x, y)]
        at = [r[0] for r in rows]
        names = (batch.column(k).take(pa.array(at, pa.int64())) for k in (0, 1, 4))
        yield pa.RecordBatch.from_arrays([*names, *(pa.array([r[k] for r in rows], kind) for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.float64())))], ["a", "b", "hash", "first", "end", "similarity"])


#: Overlapping runs of one pair become one, with the least similarity.
_MERGED = """aggregate(array_sort(x), cast(array() as array<struct<first:bigint,end:bigint,similarity:double>>),
    (s, v) -> if(size(s) > 0 and v.first <= element_at(s, -1).end,
        concat(slice(s, 1, size(s) - 1), array(named_struct('first', element_at(s, -1).first, 'end', greatest(v.end, element_at(s, -1).end), 'similarity', least(v.similarity, element_at(s, -1).similarity)))),
        concat(s, array(v))))"""


def candidates(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids, a the later one, of rows (doc_id, text) that share a key."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(LEAST_BLOCKS, -(-size // BLOCK_BYTES)), max(4 * parallel(rows), -(-size // BUCKET_BYTES))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block")
    dealt = rows.select(block, "doc_id", "text").repartition(blocks, "block").sortWithinPartitions("block", "doc_id", F.xxhash64("text"))
    packs = dealt.mapInArrow(lean(_keys(buckets)), _PACKED)
    met = spill(packs.groupBy("bucket").applyInArrow(lean_group(_meet), "a long, b long, key long"), "met")
    pairs = spill(met.where("key is null").select("a", "b").union(_rest_pairs(rows, met.where("key is not null"), buckets)).distinct(), "pairs")
    discard(met)
    return pairs


def _rest_pairs(rows: DataFrame, classes: DataFrame, buckets: int) -> DataFrame:
    """The pairs that stars leave out, of the classes (a, key) of keys with three or more."""
    wanted = classes.groupBy(F.col("a").alias("doc_id")).agg(F.collect_set("key").alias("keys"))
    ranges = rows.join(wanted, "doc_id").select("doc_id", "text", "keys").mapInArrow(lean(_ranges), "key long, doc long, shingles binary")
    crowded = classes.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CELL)  # one row for each CELL classes at most
    parts = F.ceil(F.col("n") / CELL).cast("int")
    own = F.pmod(F.xxhash64("doc"), parts).cast("int")
    cells = F.transform(F.sequence(F.lit(0), parts - 1), lambda other: F.xxhash64("key", F.least(own, other), F.greatest(own, other)))
    plain = F.array(F.pmod(F.xxhash64("key"), F.lit(buckets)))
    dealt = ranges.join(F.broadcast(crowded), "key", "left").select("key", "doc", "shingles", F.explode(F.when(F.col("n").isNull(), plain).otherwise(cells)).alias("cell"))
    found = dealt.groupBy("cell").applyInArrow(lean_group(_rest), _SETS)
    return found.groupBy("a", "key", "x", "y").agg(F.min("b").alias("b")).select("a", "b")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each passage of 50 words or more that an earlier document has too: doc_id,
    first_word, n_words, source_doc_id (the earlier document), similarity, text_hash (of the later one's text).

    Earlier means a smaller id. Rows of one id are one document and aren't compared with each other,
    but each text has its own passages; repeated rows have theirs once. Rows without an id, null texts
    and texts under 50 words have no passage. Passages with several earlier documents may overlap.
    Only the two named columns are read. An empty table gives no row.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and length(text) >= 99")
    pairs = candidates(rows)
    left = pairs.join(rows.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(rows.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    spans = both.select("a", "b", "text_a", "text_b", F.xxhash64("text_a")).mapInArrow(lean(_verify), "a long, b long, hash long, first long, end long, similarity double")
    merged = spans.groupBy("a", "b", "hash").agg(F.collect_set(F.struct("first", "end", "similarity")).alias("x")).select("a", "b", "hash", F.explode(F.expr(_MERGED)).alias("v"))
    return merged.select(F.col("a").alias("doc_id"), F.col("v.first").alias("first_word"), F.expr("v.end - v.first").alias("n_words"), F.col("b").alias("source_doc_id"), F.col("v.similarity").alias("similarity"), F.col("hash").alias("text_hash"))


def _cut(text_at: int, spans_at: int):
    def run(batches):
        for batch in batches:
            texts, spans = batch.column(text_at), batch.column(spans_at).to_pylist()
            keep = [True] * len(batch)
            if any(spans):
                out = texts.to_pylist()
                for i, own in enumerate(spans):
                    if own:
                        raw = np.frombuffer(out[i].encode(), np.uint8)
                        starts, ends, _ = word_bounds(raw, np.array([0, len(raw)]), SPACED)
                        left = np.ones(len(raw), bool)
                        for s in own:
                            left[starts[s["first"]] : ends[s["end"] - 1]] = False
                        out[i] = raw[left].tobytes().decode()
                        keep[i] = bool(SPACED[raw[left]].any())
                texts = pa.array(out, texts.type)
            columns = [texts if k == text_at else c for k, c in enumerate(batch.columns) if k != spans_at]
            yield pa.RecordBatch.from_arrays(columns, [n for k, n in enumerate(batch.schema.names) if k != spans_at]).filter(pa.array(keep))

    return run


def cut_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the passages of `repeated_passages`; a row of which no word is left goes. Columns stay as they are.

    A passage is cut from the text in which it was found and from no other text under that id; a
    repeated row is cut like its first. Rows without passages, without an id or with a null text stay unchanged.
    """
    ship(docs.sparkSession)
    span = F.struct(F.col("first_word").alias("first"), F.expr("first_word + n_words").alias("end"))
    free = "_".join(["passages", *docs.columns])  # no column of docs has this name
    names = [f"{free}{k}" for k in range(3)]
    spans = found.groupBy(F.col("doc_id").alias(names[0]), F.col("text_hash").alias(names[1])).agg(F.collect_set(span).alias(names[2]))
    same = (F.col(id_col).cast("long") == F.col(f"`{names[0]}`")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(f"`{names[1]}`"))
    both = docs.join(spans, same, "left").select(*(f"`{c}`" for c in (*docs.columns, names[2])))
    return both.mapInArrow(lean(_cut(docs.columns.index(text_col), len(docs.columns))), docs.schema)
