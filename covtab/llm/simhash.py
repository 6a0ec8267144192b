"""SimHash near-dedup over deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Of two fingerprints with at most
three differing bits, one half differs by at most one bit; such halves agree
once the right bit is left out. So each distinct fingerprint is indexed under
64 keys: half, left-out bit, remaining bits. Fingerprints with a key in common
are compared bit by bit, and groups are the connected components of the links.

Equal fingerprints are one row before the index, so copies cost nothing. The
fingerprints of a key are linked by a spanning forest, not by all pairs: a
found fingerprint leaves the set that is still to be searched, and large keys
are cut again by the bytes of the other half, one of which must be equal.

Defined results: a null or empty text has no words and the fingerprint zero,
which links like any other; fewer words than a shingle are one shingle; equal
rows get equal fingerprints and the same group; a null id counts for no
``component_id`` (null if a group has no other). An empty table gives an empty
result. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import cut_lineage
from covtab.llm.components import components

#: Production parameters: words in a shingle, seed of its hash, bits that may differ.
SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3

#: Halves of a fingerprint, so that one differs by ``MAX_BITS // 2`` = 1 bit at most.
HALF_BITS = 32
#: Keys with more fingerprints than this are cut by the bytes of the other half.
CUT_FROM = 256

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: bit set where over half of the shingle hashes have it."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle_words + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in spans), dtype="<u8", count=n)
    columns = hashes.view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long."""
    pairs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    id_type = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {id_type}, fp long")


def _signatures() -> Column:
    """The 64 keys of a fingerprint: 6 bits of half and left-out bit, 32 bits of the half without it."""
    keys = []
    for half in range(2):
        bits = F.shiftrightunsigned("fp", half * HALF_BITS).bitwiseAND(F.lit((1 << HALF_BITS) - 1))
        keys += [bits.bitwiseAND(F.lit(~(1 << out))).bitwiseOR(F.lit((half * HALF_BITS + out) << HALF_BITS))
                 for out in range(HALF_BITS)]
    return F.array(*keys)


def _forest(values: np.ndarray, edges: list[np.ndarray]) -> None:
    """Adds edges that join whatever links (directly or not) within ``values``."""
    left = values
    while left.size > 1:
        todo, left = [left[0]], left[1:]
        while todo and left.size:
            at = todo.pop()
            near = np.bitwise_count(left ^ at) <= MAX_BITS
            if near.any():
                found = left[near]
                left = left[~near]
                edges.append(np.stack([np.full(found.size, at, np.uint64), found], axis=1))
                todo.extend(found)


def _link_key(values: np.ndarray, half: int, edges: list[np.ndarray]) -> None:
    """Links the distinct fingerprints of one key of ``half``."""
    if values.size <= CUT_FROM:
        return _forest(values, edges)
    for byte in range(4):  # three bits cannot spoil all four bytes of the other half
        part = (values >> np.uint64((1 - half) * HALF_BITS + 8 * byte)) & np.uint64(255)
        order = np.argsort(part, kind="stable")
        for group in np.split(values[order], np.flatnonzero(np.diff(part[order])) + 1):
            _forest(group, edges)


def link_keys(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Edges (two columns) between the fingerprints of equal keys, verified."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.zeros(0, int)
    sizes = np.diff(np.append(starts, keys.size))
    edges: list[np.ndarray] = []
    two = starts[sizes == 2]
    near = two[np.bitwise_count(values[two] ^ values[two + 1]) <= MAX_BITS]
    edges.append(np.stack([values[near], values[near + 1]], axis=1))
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        _link_key(values[start:start + size], int(keys[start] >> (HALF_BITS + 5)), edges)
    return np.unique(np.concatenate(edges), axis=0)


def links(prints: DataFrame) -> DataFrame:
    """``(a, b)`` between distinct fingerprints: enough of the verified links to join all that link."""
    index = prints.select("fp").distinct().select("fp", F.explode(_signatures()).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if parts:
            values, keys = (np.concatenate(x) for x in zip(*parts))
            found = link_keys(keys, values.view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return index.repartition("key").mapInArrow(run, "a long, b long")


def _rooted(prints: DataFrame) -> DataFrame:
    """``(fp, least, root)`` of the distinct fingerprints: the smallest id of
    a fingerprint's own rows, and the fingerprint that stands for its group."""
    roots = components(links(prints))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``fp`` and
    ``component_id``, the smallest id that links lead to."""
    prints = cut_lineage(fingerprints(docs, doc_id, text, shingle_words))
    rooted = _rooted(prints)
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(component, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with its own columns: the one of the smallest
    id, a null id being the largest; of rows with that id, any one."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_id"),
                        F.col(f"`{text}`").cast("string").alias("_text"))
    # Written once with the numbers, so that a number names the same row in both reads.
    whole = cut_lineage(whole.withColumn("_number", F.monotonically_increasing_id()))
    ranked = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_number").alias("row"))
    prints = cut_lineage(fingerprints(whole.select(ranked.alias("_rank"), "_text"), "_rank", "_text"))
    best = _rooted(prints).groupBy("root").agg(F.min("least").alias("best"))
    stays = best.select(F.col("best.row").alias("_stays"))
    return whole.join(stays, F.col("_number") == F.col("_stays"), "left_semi").select("_row.*")
