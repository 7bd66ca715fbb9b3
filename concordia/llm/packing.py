"""Token ids as packed binary rows.

Texts become token ids, texts longer than a row are split without loss, and the pieces are
packed best-fit-decreasing: longest first, each into the fullest row that still has room.
A segment tree over the capacities finds that row in logarithmic time.

Every task packs its own documents, ``group_tokens`` at a time, so token ids are never
shuffled, memory is bounded, and the result does not depend on other tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import values
from .pieces import PieceIds

WIDTH = 2048
#: Tokens that are packed together.
GROUP_TOKENS = 2 << 20


_ROWS = pa.schema(
    [
        ("matrix", pa.int64()),
        ("row", pa.int32()),
        ("n_tokens", pa.int32()),
        ("ids", pa.binary()),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("position_ids", pa.binary()),
        ("doc_ids", pa.list_(pa.string())),
        ("doc_offsets", pa.list_(pa.int64())),
    ]
)


class CapacityTree:
    """Rows by free capacity; finds the smallest capacity that is large enough."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.filled = bytearray(2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, row: int, capacity: int) -> None:
        self.rows[capacity].append(row)
        node = self.leaves + capacity
        while node and not self.filled[node]:
            self.filled[node] = 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The fullest row with room for ``length`` and its capacity, or None."""
        node, filled = self.leaves + length, self.filled
        if not filled[node]:
            # Up until a right-hand neighbour holds something, then down to its first leaf.
            while node & 1 or not filled[node + 1]:
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:
                node = 2 * node if filled[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            filled[node] = 0
            node >>= 1
            while node and not (filled[2 * node] or filled[2 * node + 1]):
                filled[node] = 0
                node >>= 1
        return row, capacity


def best_fit_decreasing(lengths: np.ndarray, width: int) -> list[list[int]]:
    """Rows as lists of piece numbers; equal lengths keep their order."""
    tree, rows = CapacityTree(width), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = tree.take(length)
        if found is None:
            rows.append([])
            found = len(rows) - 1, width
        row, capacity = found
        rows[row].append(piece)
        if capacity > length:
            tree.add(row, capacity - length)
    return rows


def pack(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    group_tokens: int = GROUP_TOKENS,
    pad_id: int = 0,
) -> DataFrame:
    """One row for each row of the packed id matrices.

    ``matrix`` and ``row`` name it; ``ids`` are ``width`` little-endian ids (two bytes
    each, four for vocabularies beyond 65,536), padded with ``pad_id``; ``n_tokens`` how
    many are not padding; ``cu_seqlens`` the cumulative segment lengths from 0 to
    ``n_tokens``; ``position_ids`` the position of every id in its segment, restarting at
    0, in the same bytes; ``doc_ids`` and ``doc_offsets`` each segment's document and the
    token of it with which the segment starts.

    Put in order of offset, the segments of a document are exactly the ids of its text.
    Null and empty texts have no segment.  Documents of equal or null ids are packed one
    by one.  Other columns are not read; an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        encoder = PieceIds(model_path)
        names, offsets, pieces, held = [], [], [], 0

        def matrix() -> pa.RecordBatch:
            packed = best_fit_decreasing(np.array([len(p) for p in pieces]), width)
            out = []
            for number, members in enumerate(packed):
                ends = np.cumsum([len(pieces[p]) for p in members])
                ids = np.full(width, pad_id, dtype=encoder.dtype)
                ids[: ends[-1]] = np.concatenate([pieces[p] for p in members])
                starts = np.r_[0, ends]
                position = np.arange(width) - np.repeat(starts, np.diff(np.r_[starts, width]))
                out.append(
                    {
                        "matrix": (part << 24) + serial,
                        "row": number,
                        "n_tokens": int(ends[-1]),
                        "ids": ids.tobytes(),
                        "cu_seqlens": starts.tolist(),
                        "position_ids": position.astype(encoder.dtype).tobytes(),
                        "doc_ids": [names[p] for p in members],
                        "doc_offsets": [offsets[p] for p in members],
                    }
                )
            for kept in (names, offsets, pieces):
                kept.clear()
            return pa.RecordBatch.from_pylist(out, schema=_ROWS)

        for batch in batches:
            for name, ids in zip(values(batch.column(0)), encoder.encode(batch.column(1))):
                for start in range(0, len(ids), width):
                    names.append(name)
                    offsets.append(start)
                    pieces.append(ids[start : start + width])
                    held += len(pieces[-1])
                    if held >= group_tokens:
                        yield matrix()
                        serial, held = serial + 1, 0
        if pieces:
            yield matrix()

    plain = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    packed = plain.mapInArrow(
        rows,
        "matrix long, row int, n_tokens int, ids binary, cu_seqlens array<int>, "
        "position_ids binary, doc_ids array<string>, doc_offsets array<long>",
    )
    return packed.withColumn("doc_ids", F.col("doc_ids").cast(T.ArrayType(kind)))


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet files; task by task, so a lost task is written again."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)
