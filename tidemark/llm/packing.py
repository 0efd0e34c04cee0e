"""Sum-of-squares online packing of tokenised documents into sequences of fixed capacity.

A document's ids fill whole sequences as far as they go. The rest goes where the sum of the squared
counts of partially filled sequences, held for every fill level in an array, grows least. What is
partially filled when a task's input ends is poured together, so a task leaves one padded sequence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .kernel import row_blocks, text_buffer, tokenizer, with_end

CAPACITY = 2048
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class SumOfSquares:
    """Open sequences by fill level. `place` gives those pieces that have become final."""

    def __init__(self, capacity: int = CAPACITY, first: int = 0):
        self.capacity, self.next = capacity, first
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(capacity)]

    def level(self, size: int) -> int:
        """The fill level whose use for `size` adds least to the sum of squares; 0 is a new sequence."""
        n, top = self.count, self.capacity - size
        cost = np.where(n[: top + 1] > 0, 2 * (n[size : self.capacity + 1] - n[: top + 1]) + 2, np.iinfo(np.int64).max)
        cost[0] = 2 * n[size] + 1
        if top and n[top]:
            cost[top] = 1 - 2 * n[top]  # it becomes full and counts no more
        best = len(cost) - 1 - int(np.argmin(cost[::-1]))  # of equal costs the fullest
        return best

    def place(self, piece: tuple) -> list[tuple]:
        """piece: (doc_id, start, ids, doc_tokens)."""
        size = len(piece[2])
        if size == self.capacity:
            self.next += 1
            return [(*piece, self.next - 1, 0)]
        at = self.level(size)
        if at:
            name, held = self.open[at].pop()
            self.count[at] -= 1
        else:
            name, held = self.next, []
            self.next += 1
        held.append((*piece, name, at))
        if at + size == self.capacity:
            return held
        self.open[at + size].append((name, held))
        self.count[at + size] += 1
        return []

    def rest(self) -> list[tuple]:
        """All open sequences poured together, the fullest first."""
        out, fill, name = [], self.capacity, -1
        for _, held in (x for level in reversed(self.open) for x in level):
            for doc, start, ids, total, _, _ in held:
                while len(ids):
                    if fill == self.capacity:
                        fill, name = 0, self.next
                        self.next += 1
                    n = min(len(ids), self.capacity - fill)
                    out.append((doc, start, ids[:n], total, name, fill))
                    start, ids, fill = start + n, ids[n:], fill + n
        self.open = [[] for _ in range(self.capacity)]
        self.count[:] = 0
        return out


def _pack(path: str, kind: str, end_id: int, capacity: int):
    def run(batches):
        from pyspark import TaskContext

        packer = SumOfSquares(capacity, TaskContext.get().partitionId() << 40)
        coder = tokenizer(path, kind)
        done: list[tuple] = []

        def rows():
            doc, start, ids, total, name, offset = zip(*done, strict=True)
            arrays = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(map(len, ids), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()), *(pa.array(x, pa.int64()) for x in (total, name, offset))]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in PIECES.split(", ")])

        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = text_buffer(batch.column(1))
            for i, j in row_blocks(offsets):
                ids, bounds = with_end(*coder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), end_id)
                for k in range(i, j):
                    own = ids[bounds[k - i] : bounds[k - i + 1]]
                    for start in range(0, len(own), capacity):
                        done += packer.place((names[k], start, own[start : start + capacity].copy(), len(own)))
                if len(done) > 2000:
                    yield rows()
        done += packer.rest()
        if done:
            yield rows()

    return run


def pack(docs: DataFrame, path: str, kind: str = "word", end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    The pieces of a sequence_id, by offset, are that sequence; a padded one lacks what is missing to
    `capacity`. Null and empty texts have the end id alone. Repeated rows are packed each by itself,
    a null id stays null. Only the two named columns are read. An empty table gives no sequence.
    A task's sequences depend on its input alone, so a task that runs again gives the same.
    """
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_pack(path, kind, end_id, capacity), PIECES)
