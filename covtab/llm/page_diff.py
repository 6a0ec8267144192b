"""HTML extraction by differencing pages of near URLs.

A page becomes text lines (:mod:`page_lines`). Pages of one host are put in the
order of their URL's path, and each is paired with its neighbour of the nearest
path: the longer the common start, the nearer, and of two equally near ones the
one before. The lines of a pair are aligned by a longest common subsequence,
and lines that the two share are deleted, unless a page's markup says that they
are its article's. What two articles share (a quotation, a licence) is not
furniture, so the mark of an article is stronger than the comparison; the
comparison decides for pages that mark no article, or stand partly outside it.

A copy says nothing about furniture. Pages of a host with the same lines are
one page to the comparison, at the smallest of their paths, and a neighbour
that shares ``COPY_SHARE`` of the text of both is passed over for the one on
the other side.

Spark compares hashes of lines and moves no text but of pages that may lose
lines. Hosts, however large, are cut into ranges of paths, and the pages at the
ends of ranges find their neighbours in a table of two rows a range. Equal pages
are combined in their tasks first and get their answer by way of these tasks.

Defined results: null or empty html, and a page without a line, give the empty
text; without a URL or a host there is no neighbour and nothing is deleted but
by the markup; repeated rows are pages of their own and have the same text. An
empty table gives an empty result. Other columns, whatever their names, play
no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.llm.common import cut_lineage, written
from covtab.llm.exchange import word_hashes
from covtab.llm.page_lines import lines_of

#: Pages that share this much of the text of both are copies.
COPY_SHARE = 0.9

URL = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]+)([^?#]*)")


def place_of(url: str | None) -> tuple[str | None, str | None]:
    """Host and path of a URL; scheme, query, fragment and a last slash do not count."""
    found = URL.match(url or "")
    return (found[1].lower(), found[2].rstrip("/")) if found else (None, None)


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of
    ``b``, by whole rows of bits."""
    places: dict[int, int] = {}
    for k, value in enumerate(b):
        places[value] = places.get(value, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for value in a:
        hit = row & places.get(value, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _align(a: list[int], b: list[int], at: int, out: np.ndarray) -> None:
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    out[at:at + start] = True
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    out[at + len(a) - end:at + len(a)] = True
    a, b, at = a[start:len(a) - end], b[start:len(b) - end], at + start
    if not a or not b:
        return
    if len(a) == 1:
        out[at] = a[0] in b
        return
    half = len(a) // 2
    total = _prefix_lengths(a[:half], b) + _prefix_lengths(a[:half - 1:-1], b[::-1])[::-1]
    cut = int(total.argmax())
    _align(a[:half], b[:cut], at, out)
    _align(a[half:], b[cut:], at + half, out)


def shared_lines(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each of ``own`` is in the longest common subsequence of both (the
    same one each time), in space that follows their lengths."""
    out = np.zeros(own.size, bool)
    here = np.flatnonzero(np.isin(own, other))  # the others are in no common subsequence
    found = np.zeros(here.size, bool)
    _align(own[here].tolist(), other[np.isin(other, own)].tolist(), 0, found)
    out[here] = found
    return out


def _nearness(a: str, b: str) -> int:
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


def _lost(page: dict, neighbours: list[dict | None]) -> list[int]:
    """Numbers of the lines of a page that it shares with its nearest neighbour and that are not sure."""
    if all(page["sure"]):
        return []
    near = [n for n in neighbours if n is not None and n["host"] == page["host"]]
    near.sort(key=lambda n: -_nearness(page["path"], n["path"]))  # stable: the one before comes first
    own, sizes = (np.array(page[c], np.int64) for c in ("hashes", "sizes"))
    for other in near:
        hashes, other_sizes = (np.array(other[c], np.int64) for c in ("hashes", "sizes"))
        shared = shared_lines(own, hashes)
        if sizes[shared].sum() < COPY_SHARE * max(sizes.sum(), other_sizes.sum(), 1):
            return np.flatnonzero(shared & ~np.array(page["sure"], bool)).tolist()
    return []


def _with_neighbours(classes: DataFrame) -> DataFrame:
    """``classes`` (host, path, digest, hashes, sizes, sure) with the rows
    ``before`` and ``after`` in that order, over the whole table."""
    order = ["host", "path", "digest"]
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once: the bounds of ranges come from a sample, and must be the same for both windows.
    ranged = cut_lineage(classes.repartitionByRange(partitions, *order).withColumn("range", F.spark_partition_id()))
    me = F.struct("host", "path", "hashes", "sizes")
    own = Window.partitionBy("range").orderBy(*order)
    placed = ranged.withColumns({"before": F.lag(me).over(own), "after": F.lead(me).over(own)})
    placed = placed.withColumn("end", F.col("before").isNull() | F.col("after").isNull())
    ends = Window.orderBy("range", *order)  # two rows a range at most
    bounds = placed.where("end").withColumns({"before": F.coalesce("before", F.lag(me).over(ends)),
                                              "after": F.coalesce("after", F.lead(me).over(ends))})
    return placed.where("NOT end").union(bounds).drop("range", "end")


def _digest(column: Column) -> Column:
    return F.concat_ws("-", F.xxhash64(column), F.hash(column), F.size(column))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars, n_shared)`` for each row of ``pages``;
    ``n_shared`` lines were deleted because its nearest page has them too."""
    given = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                         F.col(f"`{html}`").cast("string").alias("html"))
    id_type = given.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                found = [lines_of(page.as_py()) for page in part.column("html")]
                places = [place_of(u.as_py()) for u in part.column("url")]
                lines = [[line for line, _ in page] for page in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"),
                     *(pa.array([p[c] for p in places], pa.string()) for c in (0, 1)),
                     pa.array(lines, pa.list_(pa.string())),
                     pa.array([word_hashes([w.encode() for w in page]).view(np.int64) if page else [] for page in lines], pa.list_(pa.int64())),
                     pa.array([[len(w) for w in page] for page in lines], pa.list_(pa.int32())),
                     pa.array([[sure for _, sure in page] for page in found], pa.list_(pa.bool_()))],
                    names=["page_id", "url", "host", "path", "lines", "hashes", "sizes", "sure"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lost = [], []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                gone = _lost(row, [row["before"], row["after"]])
                if gone:
                    keys.append((row["host"], row["digest"]))
                    lost.append(gone)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([key[c] for key in keys], pa.string()) for c in (0, 1)), pa.array(lost, pa.list_(pa.int64()))],
                names=["host", "digest", "lost"])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, shared = [], []
            for lines, lost in zip(batch.column("lines"), batch.column("lost")):
                gone = set(lost.as_py() or ())
                texts.append(" ".join(line for k, line in enumerate(lines.as_py()) if k not in gone))
                shared.append(len(gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64()), pa.array(shared, pa.int64())],
                names=["page_id", "url", "text", "n_chars", "n_shared"])

    parsed = given.mapInArrow(read, f"page_id {id_type}, url string, host string, path string, lines array<string>, "
                                    "hashes array<long>, sizes array<int>, sure array<boolean>")
    # The number names a row in every later read, and its upper half the task that wrote it.
    parsed = written(parsed.withColumn("row", F.monotonically_increasing_id()))
    rows = parsed.where("host IS NOT NULL AND size(hashes) > 0").select(
        "row", F.shiftright("row", 33).alias("node"), "host", "path", _digest(F.col("hashes")).alias("digest"))
    key = ["host", "digest"]
    at_node = rows.groupBy("node", *key).agg(F.min(F.struct("path", "row")).alias("least"))
    least = at_node.groupBy(*key).agg(F.min("least").alias("least")).select(*key, "least.path", F.col("least.row").alias("row"))
    classes = least.join(parsed.select("row", "hashes", "sizes", "sure"), "row").drop("row")
    answers = cut_lineage(_with_neighbours(classes).mapInArrow(compare, "host string, digest string, lost array<long>"))
    of_node = at_node.select("node", *key).join(answers, key)
    of_row = rows.drop("path").join(of_node, ["node", *key]).select("row", "lost")
    # Pages whose lines are all sure lose none and are not moved.
    unsure = F.exists("sure", lambda sure: ~sure)
    moved = parsed.where(unsure).select("row", "page_id", "url", "lines").join(of_row, "row", "left").drop("row")
    stays = parsed.where(~unsure).select("page_id", "url", "lines", F.lit(None).cast("array<long>").alias("lost"))
    return moved.union(stays).mapInArrow(put_together, f"page_id {id_type}, url string, text string, n_chars long, n_shared long")
