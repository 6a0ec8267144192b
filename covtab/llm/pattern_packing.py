"""Best-fit packing by length patterns.

Documents become pieces of at most ``CAPACITY`` tokens. What is packed is the
histogram of the piece lengths, which has ``CAPACITY`` entries whatever the
input: patterns of two or three lengths that fill a sequence exactly are
enumerated, their repeat counts are fitted to the histogram by non-negative
least squares and rounded down. What remains, or the whole histogram where that
takes fewer sequences, gets patterns of any number of pieces and with some room
to spare, one generated at a time as the best for the prices of the lengths so
far; the repeat counts of as many patterns as there are lengths fit it exactly
and are rounded down again. The lengths that remain are packed best fit first,
in whole groups of equal sequences. The plan so found is a table of ranges of
ranks within a length; Spark numbers the pieces of each length, and every piece
finds its place by its length and rank.

A piece's rank is its rank in its shard plus the count of the shards before, so
a length that a third of all pieces have is still numbered by all tasks.

Defined results: a null text counts as empty and an empty text is its closing
id alone; equal rows are packed as often as they occur; an empty table gives an
empty result. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covtab.llm.byte_bpe import Encoder, default_ranks
from covtab.llm.common import cut_lineage

#: Production parameters: tokens of a sequence, and the id that ends a document.
CAPACITY = 1024
END_ID = 2
#: Steps of the least-squares fit, and patterns generated for what it leaves.
FIT_STEPS = 300
GENERATED = 150

PIECES = "doc_id {}, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens; the first
    takes what whole pieces leave over."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of each row of ``docs``, with the CRC-32 of their ids."""
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    ranks = ranks or default_ranks()
    schema = PIECES.format(pairs.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks)
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(encoder.ids(text.as_py()), end_id).astype("<u4")
                for piece, (start, length) in enumerate(cut(ids.size, capacity)):
                    rows.append(row)
                    found.append((piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            columns = np.array(found, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], pa.int32()),
                 *map(pa.array, columns[1:])],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return pairs.mapInArrow(run, schema)


def patterns(capacity: int) -> np.ndarray:
    """All pairs and triples of lengths (descending, 0 for none) whose sum is ``capacity``."""
    found = []
    for a in range(-(-capacity // 3), capacity):
        b = np.arange(-(-(capacity - a) // 2), min(a, capacity - a) + 1)
        found.append(np.stack([np.full(b.size, a), b, capacity - a - b], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def fit(shapes: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ||A x - histogram||, column p of A
    holding the lengths of pattern p; accelerated projected gradient."""

    def made(x: np.ndarray) -> np.ndarray:
        out = np.bincount(shapes.ravel(), weights=np.repeat(x, shapes.shape[1]), minlength=histogram.size)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[shapes].sum(axis=1)

    x = np.ones(len(shapes))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        x = back(made(x))
        size = np.linalg.norm(x)
        x /= size
    x, y, t = np.zeros(len(shapes)), np.zeros(len(shapes)), 1.0
    target = histogram.astype(float)
    target[0] = 0
    for _ in range(steps):
        new = np.maximum(0, y - back(made(y) - target) / size)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit decreasing on counts: [((length, times) ..., sequences)].

    Sequences filled alike are one group; a step fills groups, so the work
    depends on the number of lengths and not of pieces."""
    by_room: dict[int, list[list]] = {}
    for length in range(len(left) - 1, 0, -1):
        want = int(left[length])
        rooms = sorted(r for r in by_room if r >= length)
        while want and rooms:
            room = rooms.pop(0)
            each = room // length
            groups = by_room.pop(room)
            while groups and want:
                content, n = groups.pop()
                full = min(n, want // each)
                if full:
                    by_room.setdefault(room - each * length, []).append([content + ((length, each),), full])
                    want -= full * each
                if n - full and 0 < want < each:
                    by_room.setdefault(room - want * length, []).append([content + ((length, want),), 1])
                    full, want = full + 1, 0
                if n - full:
                    groups.append([content, n - full])
            if groups:
                by_room.setdefault(room, []).extend(groups)
        if want:
            each = capacity // length
            if want // each:
                by_room.setdefault(capacity - each * length, []).append([((length, each),), want // each])
            if want % each:
                rest = want % each
                by_room.setdefault(capacity - rest * length, []).append([((length, rest),), 1])
    return [(tuple(content), n) for groups in by_room.values() for content, n in groups]


def _dearest(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length stands in the pattern of the highest price."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(capacity + 1):
        if room:
            best[room] = best[room - 1]
        if fits[room]:
            worth = best[room - lengths[:fits[room]]] + prices[:fits[room]]
            k = int(worth.argmax())
            if worth[k] > best[room]:
                best[room], taken[room] = worth[k], k
    out, room = np.zeros(lengths.size, np.int64), capacity
    while room > 0:
        k = taken[room]
        if k < 0:
            room -= 1
        else:
            out[k] += 1
            room -= lengths[k]
    return out


def generated_patterns(left: np.ndarray, capacity: int, rounds: int = GENERATED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The present lengths, as many patterns (rows of how often each length
    stands in one) and their repeat counts, which fit the histogram exactly. A
    round adds the pattern that saves most at the prices of the lengths and takes
    out the one that it replaces."""
    lengths = np.flatnonzero(left[:capacity])
    each = capacity // lengths
    shapes, inverse, times = np.diag(each), np.diag(1 / each), left[lengths] / each
    for _ in range(rounds if lengths.size else 0):
        prices = inverse.sum(axis=0)
        fresh = _dearest(lengths, prices, capacity)
        if prices @ fresh <= 1 + 1e-9:
            break
        swap = inverse @ fresh
        room = np.where(swap > 1e-9, times / np.where(swap > 1e-9, swap, 1), np.inf)
        k = int(room.argmin())
        times = np.maximum(times - room[k] * swap, 0)
        times[k] = room[k]
        row = inverse[k] / swap[k]
        inverse -= np.outer(swap, row)
        inverse[k] = row
        shapes[k] = fresh
    return lengths, shapes, times


def _take(left: np.ndarray, uses: dict[int, int], wanted: float) -> int:
    """Takes a pattern out of ``left`` as often as wanted and possible."""
    n = min(int(wanted + 1e-6), *(int(left[v]) // m for v, m in uses.items()))
    for v, m in uses.items():
        left[v] -= n * m
    return n


def _exact(left: np.ndarray, capacity: int) -> list:
    """Groups of the patterns that fill a sequence exactly, taken out of ``left``."""
    groups = []
    shapes = patterns(capacity)
    shapes = shapes[((left[shapes] > 0) | (shapes == 0)).all(axis=1)]
    if len(shapes):
        times = fit(shapes, left)
        for p in np.argsort(-times, kind="stable"):
            uses = Counter(int(v) for v in shapes[p] if v)
            if (n := _take(left, uses, times[p])) > 0:
                groups.append((tuple(uses.items()), n))
    return groups


def _generated(left: np.ndarray, capacity: int) -> list:
    """Groups of generated patterns, taken out of ``left``."""
    groups = []
    lengths, shapes, times = generated_patterns(left, capacity)
    for p in np.argsort(-times, kind="stable"):
        uses = {int(lengths[k]): int(shapes[p][k]) for k in np.flatnonzero(shapes[p])[::-1]}
        if (n := _take(left, uses, times[p])) > 0:
            groups.append((tuple(uses.items()), n))
    return groups


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, end rank, first sequence, offset, pieces of
    that length in a sequence), sorted by length and rank."""
    start = histogram.astype(np.int64).copy()
    whole = [(((capacity, 1),), int(start[capacity]))] if start[capacity] else []
    start[capacity] = 0
    found = []
    for steps in ((_exact,), (_exact, _generated), (_generated,)):
        left = start.copy()
        groups = [g for step in steps for g in step(left, capacity)] + best_fit(left[:capacity], capacity)
        found.append((sum(n for _, n in groups), len(found), groups))
    groups = whole + min(found)[2]
    rows, used, sequence = [], Counter(), 0
    for content, n in groups:
        offset = 0
        for length, times in content:
            rows.append((length, used[length], used[length] + n * times, sequence, offset, times))
            used[length] += n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (pieces) with ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    columns = found.columns
    # Numbered and written once, so that rows without an id or with a repeated one are spread and stay where they are.
    found = cut_lineage(found.withColumn("_number", F.monotonically_increasing_id()))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = found.withColumn("shard", F.pmod(F.xxhash64(*columns, "_number"), F.lit(shards)).cast("int")).drop("_number")
    counts = found.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    histogram = np.zeros(capacity + 1, dtype=np.int64)  # one count for each length, whatever the input
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    table = plan(histogram, capacity)

    own = Window.partitionBy("length", "shard").orderBy(*columns)
    ranked = found.withColumn("own", F.row_number().over(own) - 1).join(firsts, ["length", "shard"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("own")).alias("rank"))
    # Lengths and ranks as one ascending number: at most 45 bits of rank.
    starts = (table[:, 0] << 45) + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = table[np.searchsorted(starts, (length << 45) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 3] + nth // row[:, 5], row[:, 4] + nth % row[:, 5] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    schema = PIECES.format(found.schema["doc_id"].dataType.simpleString())
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """One row for each piece of each row of ``docs``, with its place."""
    return pack(pieces(docs, doc_id, text, ranks))
