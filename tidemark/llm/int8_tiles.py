"""Embedding near-duplicates by int8 quantised tile products with rigorous error bounds.

Vectors are normalised and quantised to 8 bits. With x = s q + e, the cosine differs from the
quantised product by at most |e_x| (1 + |e_y|) + |e_y|, from residual norms that are computed for
each vector. Pairs surely above or below the threshold are decided by the bound, and only the rest
are recomputed in double precision. Equal vectors are one class, compared once.

Classes are dealt into groups of bounded size, near ones together; each pair of groups is one
cell of work that no pair leaves: a cell gives link counts and the edges of a spanning forest.
Vectors are sent only to cells whose pivots are near enough for their radii and the threshold,
and tiles whose centres are farther apart than theirs allow are skipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .common import components, spill
from .kernel import lean, lean_group

TILE = 1024
GROUP = (256, 8192)
PIVOTS = 64


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers up to 127 (as floats, whose products are then exact), scales and residual norms."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - q * scale[:, None]) ** 2).sum(1)) * (1 + 1e-9) + 1e-12
    return q.astype(np.float32 if unit.shape[1] <= 1000 else np.float64), scale, error


def tile_links(x, y, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold. x, y: (unit vectors, q, scale, error) of two tiles."""
    approx = (x[1] @ y[1].T).astype(np.float64)
    approx *= x[2][:, None]
    approx *= y[2][None, :]
    bound = x[3][:, None] * (1 + y[3][None, :]) + y[3][None, :]
    bound += 1e-9
    i, j = np.nonzero(approx + bound >= threshold)
    sure = approx[i, j] - bound[i, j] >= threshold
    open_ = np.flatnonzero(~sure)
    for k in range(0, len(open_), 1 << 16):
        at = open_[k : k + (1 << 16)]
        sure[at] = np.einsum("nd,nd->n", x[0][i[at]], y[0][j[at]]) >= threshold
    return i[sure], j[sure]


def hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of all pairs in place; a label is the smallest member."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]


class Tile:
    def __init__(self, unit: np.ndarray, first: int):
        self.first, self.parts = first, (unit, *quantised(unit))
        centre = unit.mean(0)
        norm = np.sqrt(centre @ centre)
        self.centre = centre / norm if norm > 1e-9 else None
        self.radius = np.arccos(np.clip((unit @ self.centre).min(), -1, 1)) + 1e-6 if self.centre is not None else np.pi

    def may_link(self, other: Tile, angle: float) -> bool:
        if self.centre is None or other.centre is None:
            return True
        return np.arccos(np.clip(self.centre @ other.centre, -1, 1)) <= self.radius + other.radius + angle + 1e-6


def _cell(threshold: float):
    angle = float(np.arccos(max(-1.0, threshold)))

    def run(cell: pa.Table) -> pa.Table:
        a, b = cell.column("a")[0].as_py(), cell.column("b")[0].as_py()
        group, pivot = cell.column("grp").to_numpy(), cell.column("pivot").to_numpy()
        name, copies = cell.column("rep").to_numpy(), cell.column("copies").to_numpy()
        vectors = np.concatenate([np.asarray(c.flatten()) for c in cell.column("v").chunks]).reshape(len(name), -1).astype(np.float64)
        order = np.lexsort((name, pivot, group))
        group, name, copies, vectors = group[order], name[order], copies[order], vectors[order]
        vectors /= np.abs(vectors).max(1, keepdims=True)
        unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
        rank = np.argsort(np.argsort(name, kind="stable"), kind="stable")
        links, label, names = np.zeros(len(name), np.int64), np.arange(len(name)), np.sort(name)
        tiles = {g: [Tile(unit[k : min(k + TILE, hi)], k) for k in range(lo, hi, TILE)] for g in {a, b} for lo, hi in [np.searchsorted(group, [g, g + 1])]}
        for m, s in enumerate(tiles[a]):
            for t in tiles[b][m if a == b else 0 :]:
                if not s.may_link(t, angle):
                    continue
                i, j = tile_links(s.parts, t.parts, threshold)
                i, j = i + s.first, j + t.first
                if s is t:
                    i, j = i[i < j], j[i < j]
                links += np.bincount(i, copies[j], len(name)).astype(np.int64) + np.bincount(j, copies[i], len(name)).astype(np.int64)
                hook(label, rank[i], rank[j])
        seen = links > 0
        return pa.table([pa.array(name[seen]), pa.array(links[seen]), pa.array(names[label[rank[seen]]])], ["rep", "links", "root"])

    return run


def _nearest(pivots: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            out, angle = np.full(len(batch), -1, np.int32), np.zeros(len(batch))
            size = np.diff(lists.offsets.to_numpy())
            flat = np.asarray(lists.flatten(), dtype=np.float64)
            at = np.concatenate([[0], np.cumsum(size)])
            for dim in np.unique(size):
                if (p := pivots.get(int(dim))) is not None:
                    own = np.flatnonzero(size == dim)
                    v = flat[at[own][:, None] + np.arange(dim)]
                    v = v / np.abs(v).max(1, keepdims=True)
                    product = v @ p.T
                    out[own] = np.argmax(product, axis=1)
                    angle[own] = np.arccos(np.clip(product.max(1) / np.sqrt((v * v).sum(1)), -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array(size.astype(np.int32)), pa.array(out), pa.array(angle)], ["rep", "copies", "v", "dim", "pivot", "angle"])

    return run


def may_reach(pivots: np.ndarray | None, p: int, q: int, radii: float, threshold: float) -> bool:
    """Whether vectors around pivot p and pivot q, at angles of `radii` together at most, can have a cosine of the threshold."""
    if pivots is None or min(p, q) < 0:
        return True
    apart = np.arccos(np.clip(pivots[p] @ pivots[q], -1, 1))
    return bool(apart <= radii + np.arccos(np.clip(threshold, -1, 1)) + 1e-6)


def _ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same whole numbers in ranges that don't overlap."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def cosine_components(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each row of `vectors`: vec_id, n_links, component_id, kept.

    Vectors of unlike length, null, empty or zero vectors, and such with null, NaN or infinite
    components link with nothing. Repeated rows link with each other. A row without an id links
    with nothing and has a null component. Only the two named columns are read.
    """
    ship(vectors.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = rows.withColumn("v", F.when(good, F.transform("v", lambda x: x + 0.0)))
    rows = spill(rows.select("vec_id", "v", F.when(good, F.xxhash64("v")).alias("k1"), F.when(good, F.xxhash64(F.lit(1), "v")).alias("k2")), "vectors")
    counted = rows.where("v is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    counted = spill(counted, "classes")
    reps = rows.where("v is not null").withColumnRenamed("vec_id", "rep").join(counted, ["k1", "k2", "rep"]).dropDuplicates(["k1", "k2"]).select("rep", "copies", "v")

    chosen: dict[int, list] = {}
    for r in reps.orderBy(F.xxhash64("rep")).limit(PIVOTS).collect():  # pivots order and skip work, exactly whatever they are
        chosen.setdefault(len(r.v), []).append(np.array(r.v) / np.sqrt(np.sum(np.square(np.array(r.v) / np.max(np.abs(r.v))))) / np.max(np.abs(r.v)))
    pivots = {dim: np.array(x) for dim, x in chosen.items()}
    reps = spill(reps.mapInArrow(lean(_nearest(pivots)), "rep long, copies long, v array<double>, dim int, pivot int, angle double"), "reps")

    # pivots in turn fill groups; a large one is split by hash. At most PIVOTS and as many lengths reach the driver.
    around = {(r["dim"], r.pivot): (r.n, r.radius) for r in reps.groupBy("dim", "pivot").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()}
    counts = {k: n for k, (n, _) in around.items()}
    size = int(np.clip(sum(counts.values()) // 8, *GROUP))
    groups, first, filled, before = [], 0, 0, None
    for (dim, pivot), n in sorted(counts.items()):
        if before != dim or filled and filled + n > size:
            first, filled = first + 1, 0
        before, parts = dim, -(-n // size)
        groups.append((dim, pivot, first, parts))
        first, filled = first + parts - 1, filled + n if parts == 1 else size
    if not groups:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    spark = vectors.sparkSession
    # a row goes only to those groups of whose pivots one has vectors near enough to its own pivot's
    radii = {k: r for k, (_, r) in around.items()}
    partners = [_ranges([(first, first + parts - 1) for d, q, first, parts in groups if d == dim and may_reach(pivots.get(dim), pivot, q, radii[dim, pivot] + radii[dim, q], threshold)]) for dim, pivot, *_ in groups]
    place = spark.createDataFrame([(*g, x) for g, x in zip(groups, partners, strict=True)], "dim int, pivot int, start int, parts int, partners array<struct<low:int,high:int>>")
    dealt = reps.join(F.broadcast(place), ["dim", "pivot"]).withColumn("grp", F.expr("start + cast(pmod(xxhash64(rep), parts) as int)"))
    others = F.explode(F.expr("flatten(transform(partners, x -> sequence(x.low, x.high)))"))
    cells = dealt.withColumn("other", others).select(F.least("grp", "other").alias("a"), F.greatest("grp", "other").alias("b"), "grp", "pivot", "rep", "copies", "v")
    found = spill(cells.groupBy("a", "b").applyInArrow(lean_group(_cell(threshold)), "rep long, links long, root long"), "links")
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    total = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = counted.join(total, "rep", "left").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    named = spill(named.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "named")
    out = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
