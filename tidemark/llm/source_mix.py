"""Mixing sources to target weights, by subset sums over the documents' exact lengths.

A source's target is met with whole documents: each goes in once or not at all (or once and twice, where
the target exceeds the source's size). What is left of the budget is first spread over all lengths in
proportion to their numbers of documents, rounded down; a bounded-knapsack table over the lengths'
remaining documents then fits the rest to the word. Which documents of a length go in is
decided by a seeded order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .common import spill
from .kernel import SPACED, lean, row_blocks, text_buffer, word_bounds

#: The knapsack's table has at most twice so many places; longer documents fill the budget down to it.
CAPACITY = 1 << 17
WEIGHTS = (5, 2, 1)


def _sizes(batches):
    for batch in batches:
        data, offsets = text_buffer(batch.column(2))
        counts = [np.diff(word_bounds(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], SPACED)[2]) for i, j in row_blocks(offsets)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64())], ["doc_id", "source", "size"])


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that the sum of their lengths is as near to the budget as the
    table finds. `lengths` are positive, distinct and ascending; at most counts[k] of lengths[k] are taken.

    The same number for all lengths in proportion, then more of the longest while the rest exceeds what the table
    holds, then the table: for each sum the length by which it was first reached, which leads back from the
    sum chosen. Where a single longer document comes nearer, it is taken instead. Of two sums equally near the smaller one is taken.
    """
    whole = int((lengths * counts).sum())
    if not 0 < budget < whole:
        return counts.copy() if budget > 0 else np.zeros_like(counts)
    take = np.array([int(c) * budget // whole for c in counts.tolist()], np.int64)
    rest = budget - int((lengths * take).sum())
    for spared in (CAPACITY, 0):  # first leave the table its part, then come near where lengths are beyond its reach
        for k in range(len(lengths) - 1, -1, -1):
            if rest <= CAPACITY:
                break
            more = min(int(counts[k] - take[k]), max(0, rest - spared) // int(lengths[k]), int(counts[k]) if spared else 1)
            take[k] += more
            rest -= more * int(lengths[k])
    reach = min(2 * rest, 2 * CAPACITY)
    via = np.full(reach + 1, -1, np.int32)
    made = np.zeros(reach + 1, bool)
    made[0] = True
    for k in range(len(lengths)):
        size = int(lengths[k])
        spare = min(int(counts[k] - take[k]), reach // size)
        if size > reach or (rest <= reach and made[rest]):
            break
        before, part = made.copy(), 1
        while spare:  # 1, 2, 4, ... documents at once make every number up to the spare ones
            step = min(part, spare)
            if step * size <= reach:
                made[step * size :] |= made[: reach + 1 - step * size].copy()
            spare, part = spare - step, part * 2
        via[made & ~before] = k
    sums = np.flatnonzero(made)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    beyond = np.flatnonzero((lengths > reach) & (counts > take))
    if len(beyond) and int(lengths[beyond[0]]) - rest < abs(at - rest):
        take[beyond[0]] += 1
        return take
    while at:
        take[via[at]] += 1
        at -= int(lengths[via[at]])
    return take


def _ranked(sources: DataFrame) -> DataFrame:
    """With the row's number in code-point order of `source`, null last: partitions by range, and the rows before each."""
    order = F.col("source").asc_nulls_last()
    dealt = sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("at", F.monotonically_increasing_id())
    dealt = spill(dealt.withColumn("part", F.shiftrightunsigned("at", 33)), "sources")
    before, offsets = 0, []
    for part, n in sorted(map(tuple, dealt.groupBy("part").agg(F.count("*")).collect())):  # one row for each partition
        offsets.append((part, before))
        before += n
    parts = dealt.sparkSession.createDataFrame(offsets, "part long, before long")
    return dealt.join(F.broadcast(parts), "part").withColumn("number", F.col("at") - F.shiftleft("part", 33) + F.col("before")).drop("at", "part", "before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(source, source_size) with `target`: the sources, by code point and null last, have the weights in turn, and share
    `share` times all sizes; a target stops at `most` times its source's size, and the excess is shared again by weight
    until none is above."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    named = spill(_ranked(sizes).withColumn("weight", weight.cast("long")), "weighed")
    budget = (named.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # each round fills some sources up; the others' shares only grow
        above = F.col("source_size") * most <= F.lit(level) * F.col("weight")
        fixed, open_weight, n = named.agg(F.sum(F.when(above, F.col("source_size") * most)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        if n == full or not open_weight:
            break
        level, full = (budget - (fixed or 0)) / open_weight, n
    return named.withColumn("target", F.least(F.col("source_size") * most, F.lit(level) * F.col("weight")).cast("double")).drop("number", "weight")


def _fitted(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    own = group[group["size"] > 0]
    if len(own):
        group.loc[own.index, "taken_docs"] = fit(own["size"].to_numpy(), own["n"].to_numpy(), int(own["budget"].iloc[0]))
    return group[["source", "size", "taken_docs"]]


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each document: doc_id, size (words between ASCII white space), source_size, target (its source's),
    copies (how often the mix takes the document) and taken (copies x size).

    Null and empty texts have size 0 and are taken with the whole copies of their source. A null source is one source, the
    last; an empty table gives no rows. Documents of one length are taken in the order of a seeded hash of id and source, so that
    reruns agree; rows that agree in id, source and size are alike, whichever of them is taken. Extra columns aren't read.

    Lengths are counted for each source before anything is fitted; distinct lengths grow with the square root
    of a source's words at most, and only they meet in a task. Documents are dealt by range of source, length
    and hash, so that a hot source or a length that most documents have stays divided.
    """
    if not (1 <= share <= most):
        raise ValueError("the share lies between one and the most copies")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    sized = spill(rows.mapInArrow(lean(_sizes), "doc_id long, source string, size long"), "sizes")
    lengths = spill(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    aims = spill(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), "targets")

    same_source = F.col("l.source").eqNullSafe(F.col("r.source"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.round(F.col("target") - F.col("copies") * F.col("source_size")).cast("long")
    due = aims.withColumn("copies", whole.cast("long")).withColumn("budget", budget)
    asked = lengths.alias("l").join(due.alias("r"), same_source).select("l.source", "size", "n", "budget", F.lit(0).cast("long").alias("taken_docs"))
    fitted = spill(asked.groupBy("source").applyInPandas(_fitted, "source string, size long, taken_docs long"), "fitted")

    # each document's number among those of its source and length, in the seeded order
    hashed = sized.withColumn("hash", F.xxhash64(F.lit(seed), "doc_id", "source"))
    key = [F.col("source").asc_nulls_last(), F.col("size"), F.col("hash"), F.col("doc_id")]
    dealt = hashed.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id())
    dealt = spill(dealt.withColumn("part", F.shiftrightunsigned("at", 33)), "dealt")
    pieces = dealt.groupBy("source", "size", "part").agg(F.count("*").alias("here"), F.min("at").alias("first"))
    plan = _piece_plan(spill(pieces, "pieces"), fitted, due)
    joined = dealt.alias("l").join(plan.alias("r"), same_source & (F.col("l.size") == F.col("r.size")) & (F.col("l.part") == F.col("r.part")))
    copies = F.col("copies") + (F.col("at") - F.col("first") < F.col("extra")).cast("long")
    return joined.select("doc_id", "l.size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))


def _piece_plan(pieces: DataFrame, fitted: DataFrame, due: DataFrame) -> DataFrame:
    """How many of a (source, length)'s documents lie before each of its pieces, and so how many of the piece are taken.
    A group has one piece in each partition at most."""
    before = F.coalesce(F.sum("here").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = pieces.withColumn("before", before)
    same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col("l.size") == F.col("r.size"))
    asked = counted.alias("l").join(fitted.alias("r"), same).select("l.*", (F.col("taken_docs") - F.col("before")).alias("extra"))
    return asked.alias("l").join(due.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))).select("l.*", "source_size", "target", "copies")
