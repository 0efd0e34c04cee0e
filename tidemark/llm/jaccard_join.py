"""N-gram Jaccard join by adaptive multi-match prefixes.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when
100 * |x & y| >= 75 * |x | y|. Equal sets form a class and only classes are joined.

1. `profile` hashes every document's set and counts shingles in a table of fixed size. Shingles
   whose slot stands out are *hot*; all sets are ordered with hot shingles last.
2. A class of size s must share l shingles of its first s - ceil(0.75 s) + l with any partner. Each
   document takes the l (1 to 4) of least estimated cost: candidates from the counted frequencies
   of the prefix, divided by the l matches that each then needs.
3. `live_prefixes` brings equal prefix shingles together as packed columns, drops those that only
   one class has there, and turns the rest back to one row per class. A class of which none of the
   first s - ceil(0.75 s) + 1 is left has no partner and goes. Dropped shingles bound no overlap:
   they may stand behind a partner's prefix, and a partner may have a smaller l.
4. A first join links each class with the fullest class under a few of its shingles; nearly all
   copies meet there. The second join compares, exactly and for all prefix shingles, what is still
   in different components. Members of one component are never paired, so a group of copies costs
   no squared work and yet no link between different components is lost.

Every candidate is verified on the whole sets, computed anew from the two texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import components, discard, parallel, spill
from .kernel import lean, lean_group, mix, row_blocks, shingle_hashes, text_buffer, word_hashes

_U = np.uint64
SLOT_BITS = 18
SLOT_PIECE = 4096
LONGEST = 4
STAR_KEYS = 6
VERIFY_COST = 50
ENTRIES_PER_BUCKET = 1_000_000
#: Logarithm of the sizes' ratio in a band, a little over 4/3, so that rounding puts no partner two bands on.
BAND = math.log(4 / 3) * (1 + 1e-6)
#: Sizes and parity bitmaps (two sets differ in as many shingles as bits at least) leave room for the
#: overlap that a link needs, 3 / 7 of both sizes together.
POSSIBLE = "100 * least(size_a, size_b) >= 75 * greatest(size_a, size_b) and " + "7 * ({}) <= size_a + size_b".format(" + ".join(f"bit_count(bits{k}_a ^ bits{k}_b)" for k in range(8)))
#: Only for the first join, which may leave pairs to the second: shingles that others have in their prefixes, too, make up the overlap.
LIKELY = f"7 * least(live_a, live_b) >= 3 * (size_a + size_b) and {POSSIBLE}"
#: Of prefixes with l = `need` matches, all shared shingles up to the end of one are counted in `shared`; behind it that set has needed(size) - l more.
ENOUGH = "shared >= need and 7 * (shared - need + (75 * greatest(size_a, size_b) + 99) div 100) >= 3 * (size_a + size_b)"


def needed(size):
    """The smallest overlap with any partner: ceil(0.75 * size)."""
    return (75 * size + 99) // 100


def document_sets(column, width: int = 5):
    """For each row of an Arrow string column, in order: its sorted distinct shingle hashes."""
    data, offsets = text_buffer(column)
    for i, j in row_blocks(offsets):
        words, rows = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        shingles, rows = shingle_hashes(words, rows, width)
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            yield np.unique(shingles[a:b])


def class_key(found: np.ndarray) -> int:
    """A 64-bit name of a set; 0 is the empty set's."""
    if not len(found):
        return 0
    total = mix(mix(found ^ _U(0x5851F42D4C957F2D)).sum(keepdims=True) + _U(len(found)))[0]
    return int(total.astype(np.int64)) or 1


#: Longs of a set's parity bitmap: bit k tells whether an odd number of its hashes fall on k.
BITS = 8
_BITS = [f"bits{k}" for k in range(BITS)]
_PROFILE = "doc_id long, text_hash long, n int, class long, slots int, counts binary, " + ", ".join(f"{b} long" for b in _BITS)


def parity(found: np.ndarray) -> np.ndarray:
    return np.packbits((np.bincount((found & _U(64 * BITS - 1)).astype(np.int64), minlength=64 * BITS) & 1).astype(np.uint8)).view(np.int64)


def _profile(width: int):
    def run(batches):
        counts = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            size, key, bits = [], [], [np.zeros((0, BITS), np.int64)]
            for found in document_sets(batch.column(1), width):
                size.append(len(found))
                key.append(class_key(found))
                bits.append(parity(found)[None])
                np.add.at(counts, (found >> _U(64 - SLOT_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(size))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size, pa.int32()), pa.array(key, pa.int64()), none.cast(pa.int32()), none.cast(pa.binary()), *(pa.array(x) for x in np.concatenate(bits).T)], ["doc_id", "text_hash", "n", "class", "slots", "counts", *_BITS])
        pieces = [(k, counts[k * SLOT_PIECE : (k + 1) * SLOT_PIECE]) for k in range(len(counts) // SLOT_PIECE)]
        pieces = [(k, x.tobytes()) for k, x in pieces if x.any()]
        none = pa.nulls(len(pieces))
        yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.int64()), pa.array([k for k, _ in pieces], pa.int32()), pa.array([x for _, x in pieces], pa.binary()), *[none.cast(pa.int64())] * BITS], ["doc_id", "text_hash", "n", "class", "slots", "counts", *_BITS])

    return run


def _sum_counts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            counts = np.frombuffer(x.as_buffer(), np.uint32)
            total[k] = total[k] + counts if k in total else counts.astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["slots", "counts"])


def profile(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, text_hash, n, class and the parity bitmap), written; and how far above the mean each slot's count stands.

    The counts cover all documents; their table has 2**SLOT_BITS slots at any input size, so what
    the driver takes in and sends out again is 2 MB. Slots below the noise of the mean count as 0.
    """
    both = spill(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col).cast("string"))).mapInArrow(lean(_profile(width)), _PROFILE), "profile")
    pieces = both.where("slots is not null").select("slots", "counts").repartition(parallel(docs), "slots").mapInArrow(lean(_sum_counts), "slots int, counts binary").collect()
    counts = np.zeros(1 << SLOT_BITS, np.float64)
    for k, x in pieces:
        counts[k * SLOT_PIECE : (k + 1) * SLOT_PIECE] = np.frombuffer(x, np.uint64)
    mean = np.median(counts)
    above = counts - mean
    return both.where("slots is null").drop("slots", "counts"), np.where(above >= max(64, 8 * np.sqrt(mean)), above, 0)


def ordered_prefix(found: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """A sorted set's prefix in the global order, each shingle's level, the chosen l, and which are hot."""
    count = above[(found >> _U(64 - SLOT_BITS)).astype(np.int64)]
    hot = count > 0
    if hot.any():
        order = np.concatenate([np.flatnonzero(~hot), np.flatnonzero(hot)[np.argsort(count[hot], kind="stable")]])
        found, count, hot = found[order], count[order], hot[order]
    base = len(found) - needed(len(found))
    best = 1
    if hot[: base + 1].any():
        sums = np.cumsum(count)
        cost = [sums[base + l - 1] * (1 + VERIFY_COST / l) for l in range(1, min(LONGEST, needed(len(found))) + 1)]
        best = 1 + int(np.argmin(cost))
    n = base + best
    return found[:n], np.maximum(1, np.arange(n) - base + 1).astype(np.uint8), best, hot[:n]


_PACKED = "bucket int, tokens binary, classes binary, sizes binary, levels binary"
_KINDS = (_U, np.int64, np.int32, np.uint8)


def _packs(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket with its entries, packed; entries keep their order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut, len(bucket))[1:]
    packed = [pa.array([x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()) for x in (c[order] for c in columns)]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int32()), *packed], ["bucket", "tokens", "classes", "sizes", "levels"])


def _unpacked(tables) -> list[np.ndarray]:
    rows = [[np.frombuffer(x.as_buffer(), kind) for x in tables.column(name)] for name, kind in zip(("tokens", "classes", "sizes", "levels"), _KINDS, strict=True)]
    return [np.concatenate(x) for x in rows]


def _prefixes(above, buckets: int, width: int):
    def run(batches):
        table = above.value
        for batch in batches:
            parts, seen = [], set()
            for found in document_sets(batch.column(0), width):
                if not len(found) or (key := class_key(found)) in seen:
                    continue
                seen.add(key)  # copies within a batch go once
                tokens, level, best, hot = ordered_prefix(found, table)
                parts.append((tokens, np.full(len(tokens), key), np.full(len(tokens), len(found), np.int32), level | (best << 3) | (hot.astype(np.uint8) << 7)))
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                place = np.where(columns[3] >> 7, columns[1].view(_U), columns[0])  # a hot shingle is live; it needs no meeting
                yield _packs((mix(place) % _U(buckets)).astype(np.int32), columns)

    return run


def _drop_single(buckets: int):
    def run(group: pa.Table) -> pa.Table:
        tokens, classes, sizes, levels = _unpacked(group)
        order = np.argsort(tokens, kind="stable")
        tokens, classes, sizes, levels = (x[order] for x in (tokens, classes, sizes, levels))
        first = np.flatnonzero(np.diff(tokens, prepend=tokens[:1] + _U(1)))
        size = np.diff(np.append(first, len(tokens)))
        other = np.add.reduceat((classes != np.repeat(classes[first], size)).astype(np.int64), first) > 0
        keep = np.repeat(other, size) | (levels >> 7 > 0)
        columns = [x[keep] for x in (tokens, classes, sizes, levels)]
        return pa.Table.from_batches([_packs((mix(columns[1].view(_U)) % _U(buckets)).astype(np.int32), columns)])

    return run


_LIVE = "class long, size int, best int, live int, tokens array<long>, levels array<int>"


def _by_class(group: pa.Table) -> pa.Table:
    tokens, classes, sizes, levels = _unpacked(group)
    order = np.lexsort((tokens, classes))
    tokens, classes, sizes, levels = (x[order] for x in (tokens, classes, sizes, levels))
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (classes[1:] != classes[:-1])
    tokens, classes, sizes, levels = (x[new] for x in (tokens, classes, sizes, levels))
    first = np.flatnonzero(np.diff(classes, prepend=classes[:1] ^ 1))
    n = np.diff(np.append(first, len(classes)))
    size, best = sizes[first].astype(np.int64), (levels[first] >> 3 & 7).astype(np.int64)
    live = needed(size) - best + n  # an estimate; it bounds no overlap
    keep = np.logical_or.reduceat((levels & 7) == 1, first) if len(first) else np.zeros(0, bool)
    at = np.repeat(keep, n)
    offsets = pa.array(np.concatenate([[0], np.cumsum(n[keep])]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[at], kind)) for x, kind in ((tokens.view(np.int64), pa.int64()), ((levels & 7).astype(np.int32), pa.int32()))]
    return pa.table([pa.array(classes[first][keep]), *(pa.array(x[keep], pa.int32()) for x in (size, best, live)), *lists], ["class", "size", "best", "live", "tokens", "levels"])


def live_prefixes(docs: DataFrame, above: np.ndarray, entries: int, text_col: str = "text", width: int = 5) -> DataFrame:
    """One row for each class that may have a partner, with those prefix shingles that other classes have too."""
    buckets = max(4 * parallel(docs), entries // ENTRIES_PER_BUCKET)
    table = docs.sparkSession.sparkContext.broadcast(above)
    packs = docs.select(text_col).mapInArrow(lean(_prefixes(table, buckets, width)), _PACKED)
    packs = packs.groupBy("bucket").applyInArrow(lean_group(_drop_single(buckets)), _PACKED)
    return spill(packs.groupBy("bucket").applyInArrow(lean_group(_by_class), _LIVE), "live")


def _linked(width: int):
    def run(batches):
        for batch in batches:
            left, right = document_sets(batch.column(2), width), document_sets(batch.column(3), width)
            keep = []
            for x, y in zip(left, right, strict=True):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and 100 * common >= 75 * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, docs: DataFrame, width: int = 5) -> DataFrame:
    """Those pairs (a, b) of ids whose whole texts link. docs: (doc_id, text), one row for each id."""
    left = pairs.join(docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(lean(_linked(width)), "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, hashed: bool = False) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, and `hashed` text_hash (Spark's xxhash64 of the text).

    component_id is the smallest id reachable by links, the document's own included. Null, empty and
    wordless texts have n_shingles 0 and link with nothing; a text of fewer than `width` words is one
    shingle. Repeated rows give repeated rows. A row without an id is kept with a null component
    unless it equals a document that has one. Only the two named columns are read. An empty table
    gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, above = profile(docs, "doc_id", "text", width)
    classes = spill(rows.where("n > 0 and doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), *(F.max(b).alias(b) for b in _BITS)), "classes")
    entries = classes.agg(F.sum("n")).first()[0] or 0
    live = live_prefixes(docs, above, entries, "text", width)
    live, by_class = spill(live.join(classes.drop("n"), "class").drop("class"), "live"), live
    discard(by_class)

    keys = live.select("rep", "size", "live", *_BITS, F.expr(f"named_struct('full', live / size, 'rep', -rep, 'size', size, 'live', live, {', '.join(f'{chr(39)}{b}{chr(39)}, {b}' for b in _BITS)})").alias("rank"), F.explode(F.slice("tokens", 1, STAR_KEYS)).alias("token"))
    keys = spill(keys, "keys")
    leader = keys.groupBy("token").agg(F.max("rank").alias("rank"), F.count("*").alias("members")).where("members > 1")
    leader = spill(leader.select("token", F.expr("-rank.rep").alias("b"), F.col("rank.size").alias("size_b"), F.col("rank.live").alias("live_b"), *(F.col(f"rank.{b}").alias(f"{b}_b") for b in _BITS)), "leaders")
    first = keys.selectExpr("token", "rep as a", "size as size_a", "live as live_a", *(f"{b} as {b}_a" for b in _BITS)).join(leader, "token").where(f"a <> b and {LIKELY}").select("a", "b").distinct()
    reps = docs.where("doc_id is not null")
    # the smallest id of a class may stand in several rows; only one of them may be of this class
    edges = spill(verified(first, reps, width).distinct(), "links")
    discard(keys, leader)
    linked = spill(components(edges), "linked")

    entry = live.join(linked, live.rep == linked.node, "left").select("rep", F.coalesce("component", "rep").alias("comp"), "size", "best", *_BITS, F.explode(F.arrays_zip("tokens", "levels")).alias("x"))
    entry = entry.select("rep", "comp", "size", "best", *_BITS, F.col("x.tokens").alias("token"), F.col("x.levels").alias("level"))
    mixed = entry.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("token")
    entry = spill(entry.join(mixed, "token"), "mixed")
    # a partner's size is at most 4/3 of the smaller one's: it lies in the same band of sizes or in the next
    banded = entry.withColumn("band", F.expr(f"cast(floor(ln(size) / {BAND}) as int)"))
    x, y = (banded.select("token", "band", *(F.col(c).alias(f"{c}_{s}") for c in ("rep", "comp", "size", "best", "level", *_BITS))) for s in "ab")
    x = x.withColumn("band", F.explode(F.expr("array(band, band + 1)")))
    pairs = x.join(y, ["token", "band"]).where(
        f"(size_a < size_b or size_a = size_b and rep_a < rep_b) and comp_a <> comp_b and {POSSIBLE} and greatest(level_a, level_b) <= least(best_a, best_b)"
    )
    # one id may name several classes: sizes keep them apart
    pairs = pairs.groupBy(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "size_a", "size_b", F.least("best_a", "best_b").alias("need")).agg(F.count("*").alias("shared")).where(ENOUGH).select("a", "b").distinct()
    pairs = spill(pairs, "pairs")
    discard(entry, live)
    if not pairs.isEmpty():
        more = spill(verified(pairs, reps, width).distinct(), "links")
        if not more.isEmpty():
            linked = spill(components(edges.union(more)), "linked")
    named = classes.join(linked, classes.rep == linked.node, "left").select("class", F.coalesce("component", "rep").alias("component_id"))
    named = spill(named, "named")
    discard(classes, edges, pairs)
    out = rows.join(named, "class", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"), *(["text_hash"] if hashed else []))
