"""Packing of token ids into fixed-length rows (operator 6).

Documents longer than a row are cut without loss: their full rows leave at
once, the rest is packed. Rests gather in windows of a bounded number of
tokens, and each window is packed best-fit decreasing: the longest piece first,
into the fullest open row that still holds it, found by a search in a segment
tree over the free lengths. A window never leaves its partition, so nothing is
shuffled, and a task that is run again packs the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import text_or_empty

EMIT_ROWS = 128         # packed rows of a result batch
BYTE_OFFSET = 3         # ids 0, 1 and 2 stay free: padding and two marks


class FreeLengths:
    """Open rows by their free length; a segment tree over the lengths counts
    them, so the smallest sufficient length is found in a walk up and down."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def _change(self, free: int, by: int):
        k = free + self.size
        while k:
            self.count[k] += by
            k >>= 1

    def add(self, free: int, row: int):
        self.rows.setdefault(free, []).append(row)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (free, row) of the fullest row with room for ``need``."""
        k, count = need + self.size, self.count
        while not count[k]:
            while k & 1:            # a right child: its sibling is smaller
                k >>= 1
            if not k:
                return None
            k += 1
            if not k & (k - 1):     # ran over the level's end
                return None
        while k < self.size:
            k = 2 * k if count[2 * k] else 2 * k + 1
        free = k - self.size
        self._change(free, -1)
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each row. Items of equal length keep their order."""
    rows, tree = [], FreeLengths(capacity)
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[item])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        free, row = found
        rows[row].append(item)
        if free > lengths[item]:
            tree.add(free - lengths[item], row)
    return rows


def _pack(capacity: int, pad: int, window_tokens: int, id_bytes: int, id_type: pa.DataType):
    wide = f"<u{id_bytes}"

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        made = 0
        waiting, size = [], 0       # (id, start, ids)

        def emit(packs):
            nonlocal made
            ids, positions, ends, owners, starts = [], [], [], [], []
            for pack in packs:
                row = np.full(capacity, pad, wide)
                pos = np.zeros(capacity, "<u2" if capacity <= 1 << 16 else "<u4")
                at, cu = 0, [0]
                for _, _, x in pack:
                    row[at:at + len(x)] = x
                    pos[at:at + len(x)] = np.arange(len(x))
                    at += len(x)
                    cu.append(at)
                ids.append(row.tobytes())
                positions.append(pos.tobytes())
                ends.append(cu)
                owners.append([p[0] for p in pack])
                starts.append([p[1] for p in pack])
            numbers = np.arange(made, made + len(packs)) + base
            made += len(packs)
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(ids, pa.binary()), pa.array(positions, pa.binary()),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(owners, pa.list_(id_type)),
                 pa.array(starts, pa.list_(pa.int64()))],
                ["pack_id", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_starts"])

        def packed():
            rows = best_fit_decreasing([len(x) for _, _, x in waiting], capacity)
            packs = [[waiting[k] for k in row] for row in rows]
            waiting.clear()
            return (emit(packs[k:k + EMIT_ROWS]) for k in range(0, len(packs), EMIT_ROWS))
        for batch in batches:
            full = []
            for doc, raw in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                x = np.frombuffer(raw, wide)
                whole = len(x) // capacity * capacity
                for at in range(0, whole, capacity):
                    full.append([(doc, at, x[at:at + capacity])])
                    if len(full) >= EMIT_ROWS:
                        yield emit(full)
                        full = []
                if len(x) > whole:
                    # a copy, else the whole document would wait with its rest
                    waiting.append((doc, whole, x[whole:].copy() if whole else x))
                    size += len(x) - whole
                if size >= window_tokens:
                    yield from packed()
                    size = 0
            if full:
                yield emit(full)
        if waiting:
            yield from packed()
    return run


def pack(tokens: DataFrame, id_col: str = "id", ids_col: str = "ids", capacity: int = 8192, pad: int = 0,
         window_tokens: int = 4_000_000, id_bytes: int = 2) -> DataFrame:
    """Pack rows (``id_col``, ``ids_col``: little-endian unsigned ids of
    ``id_bytes`` bytes each: 2, or 4 as ``encode`` gives them).

    Result: ``pack_id``; ``input_ids`` (``capacity`` ids as wide as they came);
    ``position_ids`` (``capacity`` values of 16 bits, 32 where ``capacity`` is
    over 65,536; they restart at 0 with every segment, padding has ``pad`` and 0); ``cu_seqlens`` (0 and the segments' ends); of each segment
    ``doc_ids`` and ``doc_starts`` (its first token's place in the document).

    Every token of every document is in exactly one segment. Documents without
    ids (null or empty) are in none. Repeated rows are packed as often as they
    occur; null document ids stay null in ``doc_ids``; extra columns are left
    aside; an empty table gives an empty result.
    """
    src = tokens.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{ids_col}`"), F.lit(b"")).alias("ids"))
    kind = src.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    return src.mapInArrow(
        _pack(capacity, pad, window_tokens, id_bytes, to_arrow_type(kind)),
        "pack_id long, input_ids binary, position_ids binary, cu_seqlens array<int>, "
        f"doc_ids array<{kind.simpleString()}>, doc_starts array<long>")


def byte_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the bytes of the text in UTF-8, plus ``BYTE_OFFSET``, as 16-bit ids."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("t"))

    def run(batches):
        for batch in batches:
            raw = batch.column("t").cast(pa.binary()).to_pylist()
            ids = [(np.frombuffer(x, np.uint8).astype("<u2") + BYTE_OFFSET).astype("<u2").tobytes() for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary())], ["id", "ids"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, ids binary")
