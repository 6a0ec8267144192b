"""Substring dedup with fixed-block anchors.

A window is ``WINDOW`` = 35 consecutive words. Every window holds a whole
reference block: the documents are cut into blocks of 18 words, and of 18
consecutive starts one is a block's. So a window that occurs twice holds a
block whose words also stand elsewhere, at any place.

1. *Index and probe.* Each shard of documents sends the hashes of all its
   rolling 18-word windows, marked where one is a reference block; a hash that
   is a block's and occurs twice is a hit.
2. *Extend.* Around the hit blocks of a document, each window of 35 words that
   holds one is a candidate; it is a repeat if another candidate has the same
   word sequence. Overlapping repeats make up the maximal exact repeats, and
   the words they cover go.

Both steps send each distinct hash of a shard once, sorted and packed, to a
range of hashes, and get one bit for each back in the same order. So a passage
that a third of all documents share costs a shard no more than any other, shards
are of id and text together, identical rows are one entry with their number, no
pairs of places are ever formed, and no task holds more than a shard or a
range. Blocks are found by 48 bits of hash, which only filters; windows are
equal by 96 bits.

Defined results: a null text has no words; texts shorter than a window lose
nothing; equal rows are two places of the same words, and both lose them; an
empty table gives an empty result. Other columns, whatever their names, play
no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import chunks_of_copies, merged, shard_count, sharded, with_copies
from covtab.llm.exchange import ROWS, answers_of, edges_of, rows_of, sent, unpack, word_hashes

#: Production parameter: words of a window. Blocks are the longest of which
#: every window holds one.
WINDOW = 35
BLOCK = (WINDOW + 1) // 2
#: Text in a shard: small enough for two tasks of 600 MB; larger executors take
#: larger shards, of which fewer rows are exchanged.
SHARD_BYTES = 8 << 20
#: Hash bits of a block.
BLOCK_BITS = 48


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at the six spaces only


def _mix(x: np.ndarray) -> np.ndarray:
    """Mixes the bits of ``x`` in place."""
    for shift, factor in ((32, 0x9E3779B97F4A7C15), (29, 0xBF58476D1CE4E5B9), (32, 1)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on; zero words past the end."""

    def joined(left: np.ndarray, right: np.ndarray, gap: int) -> np.ndarray:
        out = left * np.uint64(0xD6E8FEB86659FD93)
        out[:max(0, right.size - gap)] += right[gap:]
        return _mix(out)

    whole, done, power, size = None, 0, hashes, 1
    parts = []
    while size <= n:
        if n & size:
            parts.append((size, power))
        power, size = joined(power, power, size), size * 2
    for size, part in reversed(parts):
        whole = part if whole is None else joined(whole, part, done)
        done += size
    return whole


class Shard:
    """The distinct documents of a shard, in a fixed order, and the hashes of their words."""

    def __init__(self, table: pa.Table):
        self.table = merged(table)
        self.times = self.table.column("copies").to_numpy()
        hashes, sizes = [], []
        for text in self.table.column("text"):
            found = words(text.as_py())
            sizes.append(len(found))
            if found:
                hashes.append(word_hashes(found))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.array(sizes, dtype=np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        self.at = np.arange(self.hashes.size) - np.repeat(starts, self.sizes)  # of a word, in its document
        self.copies = np.repeat(self.times, self.sizes)
        self.left = np.repeat(self.sizes, self.sizes) - self.at  # words from it to the document's end

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the rolling windows of a block's length, their keys, and which are reference blocks."""
        starts = np.flatnonzero(self.left >= BLOCK)
        keys = rolling(self.hashes, BLOCK)[starts] >> np.uint64(64 - BLOCK_BITS)
        return starts, keys, self.at[starts] % BLOCK == 0

    def windows(self, candidate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, keys and check hashes of the candidate windows."""
        starts = np.flatnonzero(candidate)
        half = rolling(self.hashes, BLOCK)
        check = _mix(half[starts] * np.uint64(0xA0761D6478BD642F) + half[starts + WINDOW - BLOCK])
        return starts, rolling(self.hashes, WINDOW)[starts], check >> np.uint64(32)


def _distinct(keys: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of (key, check), and the number of the distinct pair at each."""
    order = np.lexsort((check, keys)) if check.any() else np.argsort(keys, kind="stable")
    new = np.ones(keys.size, dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (check[order][1:] != check[order][:-1])
    return order, np.cumsum(new) - 1


def _repeats(parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, bytes]]:
    """Of (shard, keys, checks, repeated in the shard, needed marks): a bit for each
    key, set if the pair of key and check occurs twice and some place has the mark."""
    if not parts:
        return
    shards, keys, check, often, mark = zip(*parts)
    sizes = [k.size for k in keys]
    keys, check, often, mark = map(np.concatenate, (keys, check, often, mark))
    order, number = _distinct(keys, check)
    n = int(number[-1]) + 1 if number.size else 0
    times = np.bincount(number, weights=1.0 + often[order], minlength=n)
    marked = np.bincount(number, weights=mark[order], minlength=n)
    found = np.empty(keys.size, dtype=bool)
    found[order] = ((times > 1) & (marked > 0))[number]
    for shard, bits in zip(shards, np.split(found, np.cumsum(sizes)[:-1])):
        yield shard, np.packbits(bits).tobytes()


def _bits(answers: list[tuple[int, bytes]], sent: list[tuple[int, int]], total: int) -> np.ndarray:
    """The answers' bits in the order in which the keys were sent."""
    by = dict(answers)
    found = [np.unpackbits(np.frombuffer(by[b], np.uint8), count=n) for b, n in sent]
    return np.concatenate(found).astype(bool) if found else np.zeros(total, dtype=bool)


_BLOCKS, _CANDIDATES, _WINDOWS = 1, 2, 3


class _Level:
    """Distinct keys of a shard at one level, as sent and as answered."""

    def __init__(self, keys: np.ndarray, check: np.ndarray, mark: np.ndarray, copies: np.ndarray, bits: int):
        self.order, self.number = _distinct(keys, check)
        self.n = int(self.number[-1]) + 1 if keys.size else 0
        first = np.flatnonzero(np.diff(self.number, prepend=-1))
        self.keys, self.check = keys[self.order][first], check[self.order][first]
        times = np.bincount(self.number, weights=copies[self.order], minlength=self.n)
        marked = np.bincount(self.number, weights=mark[self.order], minlength=self.n) > 0
        self.flags = (times > 1).astype(np.uint64) + np.uint64(2) * marked.astype(np.uint64)
        self.bits = bits

    def sent(self, buckets: int) -> list[tuple[int, bytes]]:
        return sent(self.keys, [(self.check << np.uint64(2)) | self.flags], self.bits, buckets)

    def found(self, answers: list[tuple[int, bytes]], buckets: int) -> np.ndarray:
        """For each place: whether its key was answered yes."""
        owner = np.searchsorted(edges_of(self.bits, buckets), self.keys, side="right")
        sizes = np.bincount(owner, minlength=buckets)
        yes = _bits(answers, [(b, int(n)) for b, n in enumerate(sizes) if n], self.n)
        out = np.zeros(self.order.size, dtype=bool)
        out[self.order] = yes[self.number]
        return out


def _block_level(shard: Shard) -> tuple[np.ndarray, _Level]:
    starts, keys, mark = shard.blocks()
    return starts, _Level(keys, np.zeros_like(keys), mark, shard.copies[starts], BLOCK_BITS)


def _window_level(shard: Shard, candidate: np.ndarray) -> tuple[np.ndarray, _Level]:
    starts, keys, check = shard.windows(candidate)
    return starts, _Level(keys, check, np.ones(starts.size), shard.copies[starts], 64)


def _match(bucket: tuple, table: pa.Table) -> pa.Table:
    """Answers of one range of keys; candidate marks are passed on to their shard."""
    rows, parts, level = [], [], 0
    for shard, at, data in zip(*(table.column(c).to_pylist() for c in ("shard", "level", "data"))):
        if at == _CANDIDATES:
            rows.append((bucket[0].as_py(), shard, at, data))
            continue
        steps, extra = unpack(data, 2)
        level = at
        parts.append((shard, np.cumsum(steps), extra >> np.uint64(2), extra & np.uint64(1), (extra >> np.uint64(1)) & np.uint64(1)))
    rows += [(bucket[0].as_py(), shard, level, data) for shard, data in _repeats(parts)]
    return rows_of(rows)


def mark_repeats(docs: DataFrame, doc_id: str, text: str, finish, schema: str) -> DataFrame:
    """Runs ``finish(doc_id, words, removed)`` over each document, ``removed``
    being a mark for each word, and returns its rows."""
    spark = docs.sparkSession
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    size = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = shard_count(spark, size, SHARD_BYTES)

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        _, level = _block_level(Shard(table))
        return rows_of([(b, key[0].as_py(), _BLOCKS, data) for b, data in level.sent(shards)])

    def extend(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table)
        starts, level = _block_level(shard)
        hit = np.zeros(shard.hashes.size + BLOCK, dtype=bool)
        hit[starts] = level.found(answers_of(answers, _BLOCKS), shards)
        inner = np.arange(shard.hashes.size) + (-shard.at) % BLOCK  # start of the first block from each word on
        candidate = (shard.left >= WINDOW) & hit[inner]
        me = key[0].as_py()
        marks = pa.compress(np.packbits(candidate).tobytes(), codec="zstd", asbytes=True)
        _, found = _window_level(shard, candidate)
        return rows_of([(shards + me, me, _CANDIDATES, marks)] + [(b, me, _WINDOWS, data) for b, data in found.sent(shards)])

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        shard = Shard(table)
        n = shard.hashes.size
        marks = [data for _, data in answers_of(answers, _CANDIDATES)]
        plain = pa.decompress(marks[0], -(-n // 8), codec="zstd", asbytes=True) if n else b""
        candidate = np.unpackbits(np.frombuffer(plain, np.uint8), count=n).astype(bool)
        starts, level = _window_level(shard, candidate)
        repeated = starts[level.found(answers_of(answers, _WINDOWS), shards)]
        change = np.bincount(repeated, minlength=n + WINDOW + 1) - np.bincount(repeated + WINDOW, minlength=n + WINDOW + 1)
        removed = np.cumsum(change)[:n] > 0
        rows = []
        for id_, body, gone in zip(shard.table.column("doc_id").to_pylist(), shard.table.column("text"),
                                   np.split(removed, np.cumsum(shard.sizes)[:-1])):
            rows.append((id_, *finish(words(body.as_py()), gone)))
        row, copies = chunks_of_copies(shard.times)
        return pa.table([*(list(c) for c in zip(*(rows[k] for k in row.tolist()))), copies], schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    id_type = pairs.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"doc_id {id_type}, {schema}, copies long")
    arrow_schema = to_arrow_schema(out)
    by_shard = sharded(pairs, shards).groupBy("shard")
    hits = by_shard.applyInArrow(probe, ROWS).groupBy("bucket").applyInArrow(_match, ROWS)
    windows = by_shard.cogroup(hits.groupBy("shard")).applyInArrow(extend, ROWS)
    repeats = windows.groupBy("bucket").applyInArrow(_match, ROWS)
    return with_copies(by_shard.cogroup(repeats.groupBy("shard")).applyInArrow(remove, out))


def _digest(found: list[bytes], removed: np.ndarray) -> tuple[int, int, str]:
    kept = found if not removed.any() else [w for w, gone in zip(found, removed.tolist()) if not gone]
    return len(found), len(found) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _cleaned(found: list[bytes], removed: np.ndarray) -> tuple[str, int]:
    kept = [w for w, gone in zip(found, removed.tolist()) if not gone]
    return b" ".join(kept).decode("utf-8", "surrogatepass"), len(found) - len(kept)


def removed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``
    and ``kept_sha256`` of the words that stay, joined by single spaces."""
    return mark_repeats(docs, doc_id, text, _digest, "n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``text`` of the words that
    stay, joined by single spaces, and ``n_removed``."""
    return mark_repeats(docs, doc_id, text, _cleaned, "text string, n_removed long")
