"""Token-id matrices: best-fit-decreasing packing of whole documents.

Documents are encoded, ended by ``END_ID`` and packed into rows of ``CAPACITY``
ids, longest first; a piece goes to the row with the least room that still
takes it, found in a segment tree over the amounts of room. A longer document
is cut into full rows and a rest, and no id is lost. A row of the result is a
row of the matrix (padded by ``PAD_ID``), with the cumulative lengths of its
segments, positions that start again with each segment, and what each segment
is, so documents can be put together again.

A task packs its rows of the table in blocks of ``BLOCK_IDS`` ids, so nothing
is shuffled, a block fits in memory, and no key can be hot.

Defined results: a null text counts as empty and an empty text is its closing
id alone; equal rows are packed as often as they occur; an empty table gives
an empty result. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.byte_bpe import Encoder, default_ranks

#: Production parameters.
CAPACITY = 2048
END_ID = 50256
PAD_ID = 0
BLOCK_IDS = 1 << 23


class Rooms:
    """Open rows by the room they have left; a node of the tree holds the
    largest amount of room below it, 0 for none."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _set(self, room: int, value: int) -> None:
        at = self.leaves + room
        self.tree[at] = value
        while at > 1:
            at //= 2
            self.tree[at] = max(self.tree[2 * at], self.tree[2 * at + 1])

    def put(self, row: int, room: int) -> None:
        if room:
            self.rows[room].append(row)
            if len(self.rows[room]) == 1:
                self._set(room, room)

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room that is ``need`` or more, and that room."""
        if self.tree[1] < need:
            return None
        at, low, half = 1, 0, self.leaves
        while at < self.leaves:
            half //= 2
            # The left half holds the smaller amounts; its largest tells whether one is enough.
            right = self.tree[2 * at] < need
            at, low = 2 * at + right, low + half * right
        row = self.rows[low].pop()
        if not self.rows[low]:
            self._set(low, 0)
        return row, low


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset of pieces of ``lengths``, none over ``capacity``."""
    rooms, rows, offsets, opened = Rooms(capacity), np.empty(lengths.size, np.int64), np.empty(lengths.size, np.int64), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = rooms.take(need)
        if found is None:
            found, opened = (opened, capacity), opened + 1
        row, room = found
        rows[piece], offsets[piece] = row, capacity - room
        rooms.put(row, room - need)
    return rows, offsets


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full rows, then a rest."""
    return [(at, min(capacity, n - at)) for at in range(0, n, capacity)]


def _matrix(documents: list[np.ndarray], capacity: int, pad_id: int) -> tuple:
    """Rows of ids and of positions, and the segments in the order of their places."""
    pieces = [(doc, k, start, length) for doc, ids in enumerate(documents) for k, (start, length) in enumerate(cut(ids.size, capacity))]
    table = np.array(pieces, dtype=np.int64).reshape(-1, 4)
    rows, offsets = best_fit_decreasing(table[:, 3], capacity)
    order = np.lexsort((offsets, rows))
    table, rows, offsets = table[order], rows[order], offsets[order]
    n = int(rows.max()) + 1 if rows.size else 0
    ids = np.full((n, capacity), pad_id, dtype="<u4")
    positions = np.zeros((n, capacity), dtype="<u4")
    for (doc, _, start, length), row, offset in zip(table.tolist(), rows.tolist(), offsets.tolist()):
        ids[row, offset:offset + length] = documents[doc][start:start + length]
        positions[row, offset:offset + length] = np.arange(length)
    return ids, positions, table, rows, offsets


def pack_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None, capacity: int = CAPACITY,
              end_id: int = END_ID, pad_id: int = PAD_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row for each row of the matrix: ``row_id``; ``ids`` and
    ``positions`` (``capacity`` little-endian unsigned 32-bit numbers each);
    ``cu_seqlens`` from 0 to the number of ids; ``segments`` (doc_id, piece,
    start, length) in order. ``row_id`` is unique, from the task and a number."""
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = pairs.schema["doc_id"].dataType.simpleString()
    ranks = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = Encoder(ranks), TaskContext.get().partitionId() << 32
        documents, names, held = [], [], 0

        def packed() -> pa.RecordBatch:
            ids, positions, table, rows, offsets = _matrix(documents, capacity, pad_id)
            n, counts = len(ids), np.bincount(rows, minlength=len(ids))
            ends = np.concatenate(([0], np.cumsum(counts)))
            # One number more than segments in each row: the starts, and the end of the last.
            last = ends[1:] - 1
            cumulative = np.insert(offsets, ends[1:], (offsets + table[:, 3])[last])
            segments = pa.StructArray.from_arrays(
                [pa.concat_arrays(names).take(pa.array(table[:, 0])), pa.array(table[:, 1], pa.int32()), pa.array(table[:, 2]),
                 pa.array(table[:, 3])], ["doc_id", "piece", "start", "length"])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n) + first), pa.array([r.tobytes() for r in ids], pa.binary()),
                 pa.array([r.tobytes() for r in positions], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends + np.arange(n + 1), pa.int32()), pa.array(cumulative, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), segments)],
                ["row_id", "ids", "positions", "cu_seqlens", "segments"])

        for batch in batches:
            begin = 0
            for row, text in enumerate(batch.column(1), 1):
                documents.append(np.append(encoder.ids(text.as_py()), end_id).astype("<u4"))
                held += documents[-1].size
                if held >= block_ids:
                    names.append(batch.column(0).slice(begin, row - begin))
                    out = packed()
                    yield out
                    first += out.num_rows
                    documents, names, held, begin = [], [], 0, row
            names.append(batch.column(0).slice(begin))
        if documents:
            yield packed()

    return pairs.mapInArrow(
        run, "row_id long, ids binary, positions binary, cu_seqlens array<int>, "
        f"segments array<struct<doc_id:{id_type},piece:int,start:long,length:long>>")


def write_rows(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", **how) -> None:
    """Writes the matrix as Parquet files, one record a row of it."""
    pack_rows(docs, doc_id, text, **how).write.parquet(path)
