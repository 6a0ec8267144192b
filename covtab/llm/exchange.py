"""Asking for global facts about hashed keys. A shard of documents sends its
distinct keys, sorted and packed, to ranges of the key space, and each range
sends its answers back in the order of the keys. What is shuffled are rows
``(bucket, shard, level, data)``: one for each shard and range."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

ROWS = "bucket int, shard int, level int, data binary"


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def pack(*columns: np.ndarray) -> bytes:
    """Unsigned 64-bit columns of one length, compressed byte by byte of their places."""
    planes = np.concatenate([c.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel() for c in columns])
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True) + len(planes).to_bytes(8, "little")


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    size = int.from_bytes(data[-8:], "little")
    planes = np.frombuffer(pa.decompress(data[:-8], size, codec="zstd", asbytes=True), np.uint8)
    return [np.ascontiguousarray(p.reshape(8, -1).T).view("<u8").ravel() for p in np.split(planes, columns)]


def edges_of(bits: int, buckets: int) -> np.ndarray:
    """First keys of the ranges after the first."""
    width = -(-(1 << bits) // buckets)
    return np.array([min(b * width, (1 << bits) - 1) for b in range(1, buckets)], np.uint64)


def sent(keys: np.ndarray, extras: list[np.ndarray], bits: int, buckets: int, empty: bool = False) -> list[tuple[int, bytes]]:
    """Sorted ``keys`` of ``bits`` bits, as steps, with what goes with each, by
    range; ranges without a key only if ``empty``."""
    ends = [0, *np.searchsorted(keys, edges_of(bits, buckets)).tolist(), keys.size]
    return [(b, pack(np.diff(keys[i:j], prepend=np.uint64(0)), *[e[i:j] for e in extras]))
            for b, (i, j) in enumerate(zip(ends, ends[1:])) if empty or i < j]


def rows_of(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "shard": pa.array(columns[1], pa.int32()),
                     "level": pa.array(columns[2], pa.int32()), "data": pa.array(columns[3], pa.binary())})


def answers_of(table: pa.Table, level: int) -> list[tuple[int, bytes]]:
    """(bucket, data) of one level, by bucket."""
    rows = zip(table.column("level").to_pylist(), table.column("bucket").to_pylist(), table.column("data").to_pylist())
    return sorted((bucket, data) for at, bucket, data in rows if at == level)
