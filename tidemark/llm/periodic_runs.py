"""Periodic runs of words: maximal stretches that repeat a shortest period several times.

The words of a block of texts get numbers that differ from text to text. Prefix doubling sorts the
suffixes of the block and keeps, for every power of two, the rank of the stretch of that length at
each place; two stretches are compared, forwards or backwards, by those ranks. The nearest suffixes
that begin earlier in the text, before and after in suffix order, and their common prefixes give the
longest previous factor of each place, and with it the Lempel-Ziv blocks. A run that touches a
block's border is found there by extending a pair of places one period apart to both sides; a run
inside a block repeats one inside the block's earlier occurrence, and is copied from there.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .kernel import SAME, SPACED, expand, lean, row_blocks, rows_of, span_hashes, text_buffer, word_bounds

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def suffix_order(first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of a sequence, and for k = 0, 1, ... the ranks of all stretches of 2**k elements.

    Equal stretches have equal ranks. The levels end where no stretch occurs twice. Each has one more
    place at its end, whose rank is -1.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    ranks = np.full(n + 1, -1, np.int64)
    new = np.ones(n, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    ranks[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, width = [ranks], 1
    slots = np.flatnonzero(~new | ~np.append(new[1:], True))  # of stretches that occur twice or more
    while len(slots):
        at = order[slots]
        key = ranks[at] * (n + 2) + ranks[np.minimum(at + width, n)] + 1
        turn = np.argsort(key, kind="stable")
        order[slots], key = at[turn], key[turn]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        ranks = ranks.copy()
        ranks[order[slots]] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        levels.append(ranks)
        slots = slots[~new | ~np.append(new[1:], True)]
        width *= 2
    return order, levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many elements are equal from a and b on, or before a and b."""
    out = np.zeros(len(a), np.int64)
    top, rest = [], np.arange(len(a))

    def same(k: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if not back:
            return levels[k][x] == levels[k][y]
        x, y = x - (1 << k), y - (1 << k)
        return (levels[k][np.maximum(x, 0)] == levels[k][np.maximum(y, 0)]) & (np.minimum(x, y) >= 0)

    for k in range(len(levels)):
        rest = rest[same(k, a[rest], b[rest])]
        if not len(rest):
            break
        top.append(rest)
    sign = -1 if back else 1
    for k in range(len(top) - 1, -1, -1):
        own = top[k]
        grown = own[out[own] > 0]
        more = grown[same(k, a[grown] + sign * out[grown], b[grown] + sign * out[grown])]
        out[more] += 1 << k
        out[own[out[own] == 0]] = 1 << k
    return out


def _nearest_smaller(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it in its group with a smaller value, else -1. `start` and `size` are of the place's group."""
    at = np.arange(len(values))
    least, tables = values, [values]
    while 2 << (len(tables) - 1) < (size.max() if len(size) else 0):
        step = 1 << (len(tables) - 1)
        least = np.minimum(least[:-step], least[step:])
        tables.append(least)
    for k in range(len(tables) - 1, -1, -1):
        own = np.flatnonzero(at - (1 << k) >= start)
        own = own[tables[k][at[own] - (1 << k)] > values[own]]
        at[own] -= 1 << k
    return np.where(at > start, at - 1, -1)


def previous_factors(order: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each place's longest factor that also begins at an earlier place: its length, and that place (-1 if the length is 0)."""
    n = len(order)
    length, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    group = levels[0][order]
    new = np.ones(n, bool)
    new[1:] = group[1:] != group[:-1]
    several = np.flatnonzero(~new | ~np.append(new[1:], True))
    if not len(several):
        return length, source
    values, new = order[several], new[several]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(several)))
    start, sizes = np.repeat(first, size), np.repeat(size, size)
    before = _nearest_smaller(values, start, sizes)
    end = len(values) - start - sizes
    after = _nearest_smaller(values[::-1], end[::-1], sizes[::-1])[::-1]
    after = np.where(after < 0, -1, len(values) - 1 - after)
    for near in (before, after):
        own = np.flatnonzero(near >= 0)
        here, there = values[own], values[near[own]]
        found = _common(levels, here, there, False)
        better = found > length[here]
        length[here[better]], source[here[better]] = found[better], there[better]
    return length, source


def _blocks(length: np.ndarray) -> np.ndarray:
    """Where the Lempel-Ziv blocks begin."""
    steps, out, at = np.maximum(length, 1).tolist(), [], 0
    n = len(steps)
    while at < n:
        out.append(at)
        at += steps[at]
    return np.array(out, np.int64)


def find_runs(tokens: np.ndarray, rows: np.ndarray, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int, int]]:
    """All runs (row, start in the row, length, period), sorted, of at least `least` elements and `exponent` periods (2 or more)."""
    n = len(tokens)
    row = rows_of(rows)
    key = np.lexsort((tokens, row))
    differs = np.ones(n, bool)
    differs[1:] = (tokens[key[1:]] != tokens[key[:-1]]) | (row[key[1:]] != row[key[:-1]])
    first = np.empty(n, np.int64)
    first[key] = np.cumsum(differs)  # numbers of (row, word): nothing is equal across rows
    order, levels = suffix_order(first)
    length, source = previous_factors(order, levels)
    begin = _blocks(length)
    size = np.diff(np.append(begin, n))
    home = row[begin]
    last = np.append(home[1:] != home[:-1], True) if len(begin) else np.zeros(0, bool)
    before = np.concatenate([[0], size[:-1]])[: len(size)]
    before[home != np.concatenate([[-1], home[:-1]])[: len(home)]] = 0
    # borders: each block's begin, and each row's end. Pairs (i, i + p), with i + p or i at the border.
    border = np.concatenate([begin, begin[last] + size[last]])
    most = np.concatenate([before + size, size[last]]) // (exponent - 1)
    left = np.minimum(most, border - rows[np.concatenate([home, home[last]])])
    right = np.minimum(size // (exponent - 1), rows[home + 1] - begin - 1)
    period = np.concatenate([expand(np.ones(len(left), np.int64), left), expand(np.ones(len(right), np.int64), right)])
    at = np.concatenate([np.repeat(border, left), np.repeat(begin, right)])
    at[: left.sum()] -= period[: left.sum()]
    forward = _common(levels, at, at + period, False)
    backward = _common(levels, at, at + period, True)
    whole = forward + backward + period
    good = whole >= np.maximum(least, exponent * period)
    at, period, whole = (at - backward)[good], period[good], whole[good]
    found: dict[int, dict[tuple[int, int], int]] = {}
    for i, p, m in zip(at.tolist(), period.tolist(), whole.tolist(), strict=True):
        own = found.setdefault(int(row[i]), {})
        own[i, m] = min(p, own.get((i, m), p))  # of the periods of one stretch the shortest
    out = []
    for r, own in found.items():
        _copy_inside(own, begin[home == r], size[home == r], source, least)
        out += [(r, i - int(rows[r]), m, p) for (i, m), p in own.items()]
    return sorted(out)


def _copy_inside(own: dict[tuple[int, int], int], begin: np.ndarray, size: np.ndarray, source: np.ndarray, least: int) -> None:
    """Adds to a row's runs (start, length) -> period those inside its blocks, from the blocks' earlier occurrences."""
    starts: dict[int, list[tuple[int, int]]] = {}
    for (i, m), p in own.items():
        starts.setdefault(i, []).append((m, p))
    places = sorted(starts)
    long = size >= least + 2
    for b, m, s in zip(begin[long].tolist(), size[long].tolist(), source[begin[long]].tolist(), strict=True):
        k = bisect_right(places, s)
        while k < len(places) and places[k] < s + m:
            i, to = places[k], places[k] + b - s
            for length, p in list(starts[i]):
                if i + length < s + m and (to, length) not in own:
                    own[to, length] = p
                    if to not in starts:
                        starts[to] = []
                        insort(places, to)
                    starts[to].append((length, p))
            k += 1


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of each row with one space between: bytes, and row offsets."""
    size = ends - starts + 1
    upto = np.concatenate([[0], np.cumsum(size)])
    out = np.append(data, np.uint8(0x20))[expand(starts, size)]
    out[upto[1:] - 1] = 0x20
    some = np.diff(rows) > 0
    keep = np.ones(len(out), bool)
    keep[upto[rows[1:][some]] - 1] = False
    return out[keep], np.concatenate([[0], np.cumsum(np.diff(upto[rows]) - some)])


def _scan(exponent: int, least: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for i, j in row_blocks(offsets):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                starts, ends, rows = word_bounds(part, bounds, SPACED)
                runs = find_runs(span_hashes(part, starts, ends, SAME), rows, exponent, least) if len(starts) else []
                n = np.diff(rows)
                if runs:
                    r, a, m, p = np.array(runs, np.int64).T
                    change = np.zeros(len(starts) + 1, np.int64)
                    np.add.at(change, rows[r] + a + p, 1)
                    np.add.at(change, rows[r] + a + m, -1)
                    kept = np.cumsum(change)[:-1] == 0
                    starts, ends, rows = starts[kept], ends[kept], np.concatenate([[0], np.cumsum(kept)])[rows]
                else:
                    r = a = m = p = np.zeros(0, np.int64)
                text, upto = _joined(part, starts, ends, rows)
                listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(r, np.arange(j - i + 1)), pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (a, m, p)], fields=list(_RUN.value_type)))
                collapsed = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(upto.astype(np.int64).tobytes()), pa.py_buffer(text.tobytes())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), listed, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return lean(run)


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_words, runs (start word, length, shortest period; sorted by start, then
    period) and collapsed, the text without the repeats: of each run the first period stays, words are joined by one space.

    A run has at least `exponent` (2 or more) periods and `least` words, and no neighbouring word extends it. Words
    are what lies between ASCII white space, told apart by 64-bit hashes. Null and empty texts have no words, no runs
    and an empty text. Each row is taken by itself, repeated rows and ids too; a null id stays null. Only the two
    named columns are read. There is no shuffle; the arrays for one text take about 8 bytes for each word and
    doubling of its longest repeat, so a very long text needs memory in proportion to its own length alone.
    """
    if exponent < 2 or least < 2:
        raise ValueError("a run has at least two periods and two words")
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scan(exponent, least), RUNS)
