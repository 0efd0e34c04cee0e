"""Grouping of spelling variants: pairs of words at edit distance one, and the commoner form of each word.

Two words of m and m or m + 1 characters that differ by one edit share all before the edit and all after
it. The places of an edit are divided into segments; a word goes, for each segment, to the partition of
what it has before and after the segment. There a trie over what is left of the partition's words is
joined with itself: active pairs of nodes begin where two children part (one replaced character) or where
a child is set against its parent (one inserted character), move on along equal characters, and give a pair
of words where both nodes end one. A partition of too many words has its segment halved, down to segments
of one place, whose partitions hold no more than two characters' choices of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import spill
from .kernel import expand, lean

#: A partition of more words has its segment halved.
MOST_WORDS = 20_000
_CHUNK = 100_000
_SHIFT = np.int64(21)  # a code point has 21 bits
_KEYED = ("key", "word", "n", "longer", "a", "b", "final")


def near_in_groups(group: np.ndarray, chars: np.ndarray, bounds: np.ndarray, longer: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of entries of one group that are one edit apart, by a join of the groups' tries with themselves.

    `group` ascends from 0 without gaps; entry i has the characters chars[bounds[i]:bounds[i + 1]]. Within a group the
    entries that aren't `longer` have one length, and the others one more; pairs of two longer ones aren't
    given, nor those whose common prefix is `room` of the group or more. Entries of a group differ.
    """
    n_groups = int(group[-1]) + 1
    size = np.diff(bounds)
    node, alive = group.copy(), np.arange(len(group))
    edges, parents, depths, ends = [], [], [], np.full(n_groups, -1, np.int64)
    ends[node[size == 0]] = np.flatnonzero(size == 0)
    ends = [ends]
    short, long = [np.bincount(group[~longer], minlength=n_groups) > 0], [np.bincount(group[longer], minlength=n_groups) > 0]
    rooms, base, known, depth = [room], 0, n_groups, 0
    while True:
        alive = alive[size[alive] > depth]
        if not len(alive):
            break
        keys, back = np.unique(node[alive] << _SHIFT | chars[bounds[alive] + depth], return_inverse=True)
        parent = keys >> _SHIFT
        depth += 1
        edges.append(keys)
        parents.append(parent)
        depths.append(np.full(len(keys), depth))
        rooms.append(rooms[-1][parent - base])
        own = np.full(len(keys), -1, np.int64)
        full = size[alive] == depth
        own[back[full]] = alive[full]
        ends.append(own)
        for flags, which in ((short, ~longer), (long, longer)):
            flags.append(np.bincount(back[which[alive]], minlength=len(keys)) > 0)
        node[alive] = known + back
        base, known = known, known + len(keys)
    if not edges:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge, ends, short, long, rooms = (np.concatenate(x) for x in (edges, ends, short, long, rooms))
    parent, depth = np.concatenate(parents), np.concatenate([np.zeros(n_groups, np.int64), *depths])
    first = np.searchsorted(parent, np.arange(known)) + n_groups
    children = np.append(first[1:], known) - first

    # where pairs begin: brothers, one character replaced; a node and its child, one inserted
    open_ = depth[parent] < rooms[n_groups:]
    brother = np.flatnonzero(open_ & short[n_groups:])
    after = np.searchsorted(parent[brother], parent[brother], "right") - np.arange(len(brother)) - 1
    u, v = np.repeat(brother, after) + n_groups, brother[expand(np.arange(len(brother)) + 1, after)] + n_groups
    child = np.flatnonzero(open_ & short[parent] & long[n_groups:])
    inserted = np.concatenate([np.zeros(len(u), bool), np.ones(len(child), bool)])
    u, v = np.concatenate([u, parent[child]]), np.concatenate([v, child + n_groups])
    found = []
    while len(u):
        both = (ends[u] >= 0) & (ends[v] >= 0)
        found.append(np.stack([ends[u[both]], ends[v[both]]]))
        count = children[u]
        x, rest = expand(first[u], count), np.repeat(np.arange(len(u)), count)
        want = v[rest] << _SHIFT | (edge[x - n_groups] & ((1 << _SHIFT) - 1))
        at = np.minimum(np.searchsorted(edge, want), len(edge) - 1)
        y, inserted = at + n_groups, inserted[rest]
        # a node and its own child have begun anew further down
        good = (edge[at] == want) & short[x] & np.where(inserted, long[y] & (parent[at] != x), short[y])
        u, v, inserted = x[good], y[good], inserted[good]
    out = np.concatenate([np.zeros((2, 0), np.int64), *found], axis=1)
    return out[0], out[1]


def _join_tries(batches):
    """Batches sorted by key: pairs of near words, in both directions."""
    held: list[pa.Table] = []
    rows = 0

    def joined(table: pa.Table):
        keys = table.column("key").combine_chunks().dictionary_encode()
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        group = np.asarray(keys.indices).astype(np.int64)
        several = np.bincount(group)[group] > 1
        if not several.any():
            return
        table = table.filter(pa.array(several))
        _, at, group = np.unique(group[several], return_index=True, return_inverse=True)
        words = table.column("word").to_pylist()
        a, b, n = (np.asarray(table.column(x)).astype(np.int64) for x in ("a", "b", "n"))
        longer, final = (np.asarray(table.column(x)).astype(bool) for x in ("longer", "final"))
        middle = [w[x : y + z] for w, x, y, z in zip(words, a.tolist(), b.tolist(), longer.tolist(), strict=True)]
        chars = np.frombuffer("".join(middle).encode("utf-32-le"), np.uint32).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, middle), np.int64, len(middle)))])
        room = np.where(final, np.iinfo(np.int64).max, b - a)[at]
        i, j = near_in_groups(group, chars, bounds, longer, room)
        one, two = np.concatenate([i, j]), np.concatenate([j, i])
        word = table.column("word").combine_chunks()
        for k in range(0, len(one), 200_000):
            x, y = one[k : k + 200_000], two[k : k + 200_000]
            yield pa.RecordBatch.from_arrays([word.take(pa.array(x)), word.take(pa.array(y)), pa.array(n[y], pa.int64())], ["word", "near", "near_n"])

    for batch in batches:
        if not len(batch):
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += len(batch)
        if rows < _CHUNK:
            continue
        whole = pa.concat_tables(held)
        keys = whole.column("key")
        cut = rows - 1
        while cut and keys[cut - 1].as_py() == keys[rows - 1].as_py():
            cut -= 1
        if cut:  # the last group may go on
            yield from joined(whole.slice(0, cut))
        held = [whole.slice(cut)]
        rows -= cut
    if rows:
        yield from joined(pa.concat_tables(held))


def _segments(words: DataFrame) -> DataFrame:
    """Each word as the shorter or equal (m = its length) and as the longer of a pair (m = its length - 1), for both halves of the places."""
    length = F.char_length("word")
    roles = F.array(*[F.struct((length - k).alias("m"), F.lit(bool(k)).alias("longer")) for k in (0, 1)])
    rows = words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.m", "r.longer").where("m >= 0")
    half = (F.col("m") / 2).cast("int")
    # the last segment has no end: an edit may come after the last character
    places = F.array(*[F.struct(a.alias("a"), b.alias("b"), F.lit(last).alias("final")) for a, b, last in ((F.lit(0), half, False), (half, F.col("m"), True))])
    return rows.select("word", "n", "m", "longer", F.explode(places).alias("p")).select("word", "n", "m", "longer", "p.a", "p.b", "p.final").where("final or b > a")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the partition's name: lengths, and all before and after the segment."""
    after = F.substr("word", F.col("b") + F.col("longer").cast("int") + 1)
    return rows.withColumn("key", F.concat_ws(":", "m", "a", "b", F.concat(F.substr("word", F.lit(1), F.col("a")), after)))


def near_words(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Pairs (word, near, near_n) of distinct words, in both directions, that differ by one inserted, deleted or
    replaced code point. `words` has distinct, non-null `word`s and `n`. Pairs are complete: a partition
    of more than `most` words is divided by its segment's halves, which lose no pair.
    """
    found, rows = [], _segments(words)
    while True:
        rows = spill(_keyed(rows), "variant-keys")
        divisible = (F.col("b") - F.col("a")) > 1
        hot = spill(rows.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > most).select("key"), "variant-hot")
        crowded = bool(hot.take(1))
        mine = rows.join(hot, "key", "left_anti").unionByName(rows.where(~divisible).join(hot, "key", "left_semi")) if crowded else rows
        dealt = mine.select(*_KEYED).repartition("key").sortWithinPartitions("key")
        found.append(spill(dealt.mapInArrow(lean(_join_tries), "word string, near string, near_n long"), "variant-pairs"))
        if not crowded:
            break
        half = ((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.array(F.struct(F.col("a"), half.alias("b"), F.lit(False).alias("final")), F.struct(half.alias("a"), F.col("b"), F.col("final")))
        wide = rows.where(divisible).join(hot, "key", "left_semi")
        rows = wide.select("word", "n", "m", "longer", F.explode(halves).alias("p")).select("word", "n", "m", "longer", "p.a", "p.b", "p.final")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def group_variants(words: DataFrame, ratio: int = 10, most: int = MOST_WORDS) -> DataFrame:
    """One row for each word: word, n, n_near (words at distance one), form (the near word of largest n, ties by the
    smallest in code-point order, if its n is at least `ratio` times the word's, else null), form_n (its n or null) and root (where
    forms lead to in the end; the word itself if it has none).

    `words` has `word` string and `n` long; further columns are left out. Null words are dropped; a repeated word counts once
    with the sum of its n (null: 0). The empty word is a word. An empty table gives no rows. A chain of forms has at most as
    many steps as n can be multiplied by `ratio`, so the steps that follow it, each doubling the last, are few.
    """
    ship(words.sparkSession)
    if ratio < 2:
        raise ValueError("a form must occur at least twice as often")
    words = spill(words.where("word is not null").groupBy(F.col("word").cast("string").alias("word")).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")), "words")
    best = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    good = -F.col("best.less") >= F.col("n") * ratio
    joined = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"))
    named = spill(joined, "forms")
    steps = named.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = spill(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if not moved.where("moved").take(1):
            break
    return named.join(steps, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def runs_of(text: Column, pattern: str, least: int) -> Column:
    """All maximal runs of at least `least` characters of a class, A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(f"{pattern}{{{least},}}"), F.lit(0))


def count_words(occurrences: DataFrame, least: int = 2) -> DataFrame:
    """(word, n) of the words that occur at least `least` times in the column `word`; partial counts go before the shuffle."""
    return occurrences.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)
