"""Token ids in a binary format of shuffled planes.

The ids of all documents, in ascending id order, are cut into blocks of a fixed number of ids. A
block is transposed into byte or bit planes (the planes above the largest id are left out) and each
plane is compressed with zstandard. A segment holds whole documents and some blocks; segments are
the rows of a Parquet table, whose commit protocol makes writing safe against lost executors on any
file system. A row's arrays are its chunk index: ids in each block, bytes in each plane, and the
documents with their numbers of ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .common import parallel
from .kernel import lean, row_blocks, text_buffer, tokenizer, with_end

BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 20
SEGMENTS = "part int, segment int, before long, n_ids long, mode string, doc_ids array<long>, doc_tokens array<long>, block_ids array<int>, block_planes array<int>, plane_bytes array<int>, payload binary"


def planes(ids: np.ndarray, mode: str) -> list[np.ndarray]:
    """The byte or bit planes of unsigned 32-bit ids, lowest first, up to the highest in use."""
    top = int(ids.max()) if len(ids) else 0
    if mode == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [np.ascontiguousarray(rows[:, k]) for k in range(max(1, (top.bit_length() + 7) // 8))]
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little") for k in range(max(1, top.bit_length()))]


def joined(found: list[np.ndarray], n: int, mode: str) -> np.ndarray:
    """The inverse of `planes` for n ids."""
    if mode == "byte":
        rows = np.zeros((n, 4), np.uint8)
        for k, x in enumerate(found):
            rows[:, k] = x
        return rows.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), np.uint8)
    for k, x in enumerate(found):
        bits[:, k] = np.unpackbits(x, count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


def pack_segment(ids: np.ndarray, mode: str, level: int) -> tuple[list[int], list[int], list[int], bytes]:
    """Block sizes, planes of each block, bytes of each plane, and the planes one after another."""
    import zstandard

    press, sizes, counts, lengths, out = zstandard.ZstdCompressor(level=level), [], [], [], []
    for i in range(0, len(ids), BLOCK_IDS):
        block = ids[i : i + BLOCK_IDS]
        own = [press.compress(x) for x in planes(block, mode)]
        sizes.append(len(block))
        counts.append(len(own))
        lengths += map(len, own)
        out += own
    return sizes, counts, lengths, b"".join(out)


def unpack_segment(sizes, counts, lengths, payload, mode: str) -> np.ndarray:
    import zstandard

    press, at, k, out = zstandard.ZstdDecompressor(), 0, 0, [np.zeros(0, "<u4")]
    for n, count in zip(sizes, counts, strict=True):
        own = []
        for length in lengths[k : k + count]:
            own.append(np.frombuffer(press.decompress(payload[at : at + length]), np.uint8))
            at += length
        k += count
        out.append(joined(own, n, mode))
    return np.concatenate(out)


def _write(path: str, kind: str, end_id: int, mode: str, level: int):
    names = [f.split()[0] for f in SEGMENTS.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()], strict=True)))

    def run(batches):
        from pyspark import TaskContext

        part, coder = TaskContext.get().partitionId(), tokenizer(path, kind)
        docs, tokens, held, n, before, segment = [], [], [], 0, 0, 0

        def close():
            nonlocal docs, tokens, held, n, before, segment
            index = pack_segment(np.concatenate(held), mode, level)
            row = [part, segment, before, n, mode, docs, tokens, *index]
            docs, tokens, held, before, segment, n = [], [], [], before + n, segment + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            data, offsets = text_buffer(batch.column(1))
            for i, j in row_blocks(offsets):
                ids, bounds = with_end(*coder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), end_id)
                held.append(ids)
                docs += doc_ids[i:j]
                tokens += np.diff(bounds).tolist()
                n += len(ids)
                if n >= SEGMENT_IDS:
                    yield close()
        if n:
            yield close()

    return run


def write_ids(docs: DataFrame, to: str, path: str, kind: str = "byte", end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", mode: str = "byte", level: int = 3) -> None:
    """Write the ids of all documents, in ascending id order, each with `end_id` after it.

    Null and empty texts have the end id alone; a null id comes first; rows of one id are ordered by
    text. Only the two named columns are read. An empty table gives an empty file set.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(parallel(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_write(path, kind, end_id, mode, level), SEGMENTS).write.option("compression", "none").parquet(to)


def unpack_range(row: dict, first: int, n: int) -> np.ndarray:
    """Ids `first` to `first + n` of a segment's row: by the chunk index only the blocks that hold them are decompressed."""
    ends = np.cumsum(row["block_ids"])
    a, b = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, first + n, "left")) + 1
    plane = np.concatenate([[0], np.cumsum(row["block_planes"])])
    at = np.concatenate([[0], np.cumsum(row["plane_bytes"])])
    own = row["plane_bytes"][plane[a] : plane[b]] if n else []
    payload = row["payload"][at[plane[a]] : at[plane[b]]] if n else b""
    ids = unpack_segment(row["block_ids"][a:b] if n else [], row["block_planes"][a:b] if n else [], own, payload, row["mode"])
    skip = first - int(ends[a - 1] if a else 0)
    return ids[skip : skip + n]


def _seek(wanted: list[int]):
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ends = np.cumsum(row["doc_tokens"])
                for k in np.flatnonzero(np.isin(np.array([-1 if d is None else d for d in row["doc_ids"]]), wanted)).tolist():
                    if row["doc_ids"][k] is not None:
                        n = row["doc_tokens"][k]
                        out.append((row["doc_ids"][k], n, unpack_range(row, int(ends[k]) - n, n).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "n_tokens", "ids"])

    return run


def seek_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, n_tokens, ids of a few documents. Segments whose range of ids holds none of them are
    not unpacked, and of the others only the blocks that the chunk index names. Repeated ids give all
    their rows, unknown ones none."""
    ship(spark)
    found = spark.read.schema(SEGMENTS).parquet(path)
    near = F.exists("doc_ids", lambda d: d.isin(*doc_ids)) if doc_ids else F.lit(False)
    return found.where(near).mapInArrow(lean(_seek(sorted(doc_ids))), "doc_id long, n_tokens long, ids binary")


def _read(shared):
    def run(batches):
        base = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_segment(row["block_ids"], row["block_planes"], row["plane_bytes"], row["payload"], row["mode"])
                tokens = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(tokens)
                starts = ends - tokens
                raw = ids.tobytes()
                first = base[row["part"]] + row["before"]
                for i in range(0, len(tokens), 2000):
                    s, e = starts[i : i + 2000], ends[i : i + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][i : i + 2000], pa.int64()), pa.array(first + s), pa.array(e - s), pa.array([raw[4 * a : 4 * b] for a, b in zip(s, e, strict=True)], pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return run


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit) of every document.

    The driver adds up one number for each part file; their count is the writer's partition count.
    """
    ship(spark)
    found = spark.read.schema(SEGMENTS).parquet(path)
    totals = {r.part: r.n for r in found.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(totals):
        base[part] = total
        total += totals[part]
    return found.mapInArrow(lean(_read(spark.sparkContext.broadcast(base))), "doc_id long, start long, n_tokens long, ids binary")
