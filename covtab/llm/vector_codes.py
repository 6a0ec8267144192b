"""Vector code compression with norm-of-sum bounds.

A vector becomes whole numbers, ``floor(256 * x)``, and is cut into 16 equal
parts. Each part position has a codebook of 64 entries, found by rounds of
nearest-entry assignment and averaging; a vector's code is the number of the
nearest entry of each part. Everything is integer arithmetic, so results do not
depend on the order of rows.

A round measures the distance to a part's own entry, and to the others only if
it must. A part keeps the distance to its second nearest entry from the round
of its last full scan, and that round's number (its stamp). The history of the
codebooks is kept, so the bound of a later round takes off how far the entries
have really gone since the stamp, the norm of the summed moves, and not the sum
of the norms of each move. Only where the own entry is not surely nearer than
that bound, ties included, are all entries measured again.

Spark holds one row a vector, written to the shared folder after each round;
sums are added up in each task before they are shuffled. The driver holds
codebooks alone: 16 * 64 entries a round.

Defined results: vectors that are null or hold null or non-finite components
are dropped. The dimension is the most frequent one (the largest of those
equally frequent); a vector of another dimension, of one that the parts do not
divide, or with a component so large that a squared distance passes 64 bits, is
returned without code and error and plays no other part. Codebooks start at the
smallest ids, a null id being the largest, and of one id at the smallest vector;
with fewer vectors than entries there are fewer entries. Repeated rows are
vectors of their own. An empty table gives an empty result. Other columns,
whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import cut_lineage

#: Production parameters.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

#: Distances in floating point are compared with this much to spare; below
#: 2**53 whole numbers are exact in it.
_SPARE = 1e-6
_EXACT = 1 << 53


def _limit(width: int) -> int:
    """Largest component, so that squared distances of ``width`` components stay under 2**62."""
    return math.isqrt((1 << 60) // max(width, 1))


def _finite(vector: Column) -> Column:
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, good)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, exact."""
    width = x.shape[1]
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * width * (top + 1) ** 2 < _EXACT else np.int64
    x, entries = x.astype(kind), entries.astype(kind)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)).astype(np.int64)


def _moved(history: list[np.ndarray], part: int) -> np.ndarray:
    """For each stamp and own entry: how far at most another entry of the part has gone since."""
    now = history[-1][part].astype(float)
    net = np.array([np.sqrt(((now - then[part].astype(float)) ** 2).sum(axis=1)) for then in history])
    furthest = net.argmax(axis=1)
    rest = net.copy()
    rest[np.arange(len(net)), furthest] = 0
    out = np.repeat(net.max(axis=1)[:, None], net.shape[1], axis=1)
    out[np.arange(len(net)), furthest] = rest.max(axis=1)
    return out


def assign(x: np.ndarray, own: np.ndarray, lower: np.ndarray, stamp: np.ndarray,
           history: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Brings ``own``, ``lower`` and ``stamp`` (rows by parts) up to the last
    codebook of ``history``; returns squared distances to the own entries and
    the number of parts that were scanned in full. ``x`` is rows by parts by width."""
    now = len(history) - 1
    out = np.zeros(own.shape, np.int64)
    scans = 0
    for part in range(own.shape[1]):
        rows, entries = x[:, part], history[now][part]
        again = np.ones(len(rows), bool)
        if now:
            gap = rows - entries[own[:, part]]
            out[:, part] = (gap * gap).sum(axis=1)
            bound = lower[:, part].astype(float) - _moved(history, part)[stamp[:, part], own[:, part]]
            again = ~(np.sqrt(out[:, part].astype(float)) * (1 + _SPARE) + _SPARE < bound)
        at = np.flatnonzero(again)
        scans += at.size
        if at.size:
            far = _distances(rows[at], entries)
            best = far.argmin(axis=1)  # the first of equals
            row = np.arange(at.size)
            own[at, part], out[at, part] = best, far[row, best]
            far[row, best] = np.iinfo(np.int64).max
            second = far.min(axis=1)
            lower[at, part] = np.where(second == np.iinfo(np.int64).max, np.inf, np.sqrt(second.astype(float)) * (1 - _SPARE))
            stamp[at, part] = now
    return out, scans


def codebooks_text(entries: np.ndarray) -> str:
    return ",".join(map(str, entries.ravel().tolist()))


def _whole(values: np.ndarray) -> np.ndarray:
    return np.floor(values.astype(np.float64) * SCALE).astype(np.int64)


class _Rows:
    """The arrays of a batch of the state table."""

    def __init__(self, batch: pa.RecordBatch, parts: int, width: int):
        shape = batch.num_rows, parts
        flat = lambda name, kind: np.frombuffer(b"".join(batch.column(name).to_pylist()), kind)
        self.x = flat("x", "<i4").astype(np.int64).reshape(*shape, width)
        self.own, self.stamp = (flat(name, np.uint8).reshape(shape).copy() for name in ("own", "stamp"))
        self.lower = flat("lower", "<f4").reshape(shape).copy()


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, code, error, label_error, scans)`` for each vector that
    is not dropped, and the final codebooks (parts by entries by width).

    ``code`` has a byte for each part, ``error`` is the sum of the squared
    distances, ``label_error`` its sum over all rows of the label, and ``scans``
    the number of full scans that the vector took in all rounds.
    """
    if not (0 < entries <= 256 and 0 < rounds < 256 and parts > 0):
        raise ValueError("entries must be 1 to 256, rounds 1 to 255 and parts positive")
    kept = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(_finite(F.col("vector")))
    id_type, label_type = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    usual = kept.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = usual["size"] if usual else 0
    width = size // parts
    limit = min(_limit(width), (1 << 31) - 1)
    codable = F.lit(size % parts == 0) & (F.size("vector") == size) & F.forall(
        "vector", lambda x: (x * SCALE >= -limit) & (x * SCALE < limit + 1))
    first = kept.where(codable).orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = _whole(np.array([row[0] for row in first], dtype=np.float64).reshape(len(first), parts, width)).transpose(1, 0, 2)
    history = [np.ascontiguousarray(start)]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _whole(batch.column("vector").flatten().to_numpy()).reshape(n, parts, width)
            own, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.uint8)
            lower = np.zeros((n, parts), "<f4")
            scans = np.full(n, parts)
            assign(x, own, lower, stamp, history[:1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), *map(_binary, (x.astype("<i4"), own, lower, stamp)),
                 pa.array(scans, pa.int64())], names=state_columns)

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _Rows(batch, parts, width)
            before = rows.stamp.copy()
            assign(rows.x, rows.own, rows.lower, rows.stamp, history)
            scans = batch.column("scans").to_numpy() + (rows.stamp != before).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *map(_binary, (rows.own, rows.lower, rows.stamp)), pa.array(scans, pa.int64())],
                names=state_columns)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = history[-1].shape[1]
        sums, counts = np.zeros((parts * k, width), np.int64), np.zeros(parts * k, np.int64)
        for batch in batches:
            rows = _Rows(batch, parts, width)
            cell = rows.own.astype(np.int64) + np.arange(parts) * k
            counts += np.bincount(cell.ravel(), minlength=counts.size)
            np.add.at(sums, cell.ravel(), rows.x.reshape(cell.size, width))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width + 1)), pa.array(np.tile(np.arange(width + 1), used.size)),
             pa.array(np.concatenate([sums[used], counts[used, None]], axis=1).ravel())], names=["cell", "at", "value"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _Rows(batch, parts, width)
            before = rows.stamp.copy()
            error, _ = assign(rows.x, rows.own, rows.lower, rows.stamp, history)
            scans = batch.column("scans").to_numpy() + (rows.stamp != before).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], _binary(rows.own), pa.array(error.sum(axis=1)), pa.array(scans, pa.int64())],
                names=["vec_id", "label", "code", "error", "scans"])

    head = f"vec_id {id_type}, label {label_type}"
    state_schema = f"{head}, x binary, own binary, lower binary, stamp binary, scans long"
    state_columns = ["vec_id", "label", "x", "own", "lower", "stamp", "scans"]
    if first:
        state = cut_lineage(kept.where(codable).mapInArrow(begin, state_schema))
        for number in range(rounds):
            if number:
                state = cut_lineage(state.mapInArrow(advance, state_schema))
            sums = state.mapInArrow(add_up, "cell long, at long, value long").groupBy("cell", "at").agg(
                F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
            found = {(row.cell, row.at): int(row.value) for row in sums.collect()}  # parts * entries * (width + 1) at most
            fresh = history[-1].copy()
            for part in range(parts):
                for entry in range(fresh.shape[1]):
                    cell = part * fresh.shape[1] + entry
                    count = found.get((cell, width))
                    if count:
                        fresh[part, entry] = [found[cell, at] // count for at in range(width)]
            history.append(fresh)
        coded = state.mapInArrow(finish, f"{head}, code binary, error long, scans long")
    else:
        coded = kept.where("false").selectExpr("vec_id", "label", "cast(null as binary) AS code", "cast(null as long) AS error", "0L AS scans")
    other = kept.where(~codable).selectExpr("vec_id", "label", "cast(null as binary) AS code", "cast(null as long) AS error", "0L AS scans")
    return with_label_error(coded.union(other)), history[-1]


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``. A label goes to the rows by way of the
    tasks that hold some of it, so that one which very many rows have is never
    looked up by all of them in one task."""
    coded = cut_lineage(coded.withColumn("node", F.spark_partition_id()))
    own = coded.groupBy("label", "node").agg(F.sum("error").alias("label_error"))
    all_nodes = own.groupBy("label").agg(F.sum("label_error").alias("label_error"))
    at_node = own.select("label", "node").alias("n").join(all_nodes.alias("l"), F.expr("n.label <=> l.label")).selectExpr(
        "n.label AS of_label", "n.node AS of_node", "l.label_error")
    return coded.join(at_node, F.expr("label <=> of_label AND node = of_node")).drop("node", "of_label", "of_node")


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(codebooks_text(books).encode()).hexdigest()
