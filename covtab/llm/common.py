"""Helpers shared by the operators: reading tables, word handling, and
cutting lineage in the cluster's shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab.session import materialize, scratch_table

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read with Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(text: str) -> Column:
    """The text column as a string, null as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order: runs of characters that are no space."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and write it to the shared folder in
    ``spark.checkpoint.dir``; later readers survive lost executors."""
    return materialize(df)


def written(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` by a compressed table, of which readers read only the columns they use."""
    return scratch_table(df)


def shard_count(spark: SparkSession, total_bytes: int, bytes_per_shard: int) -> int:
    """Shards of about ``bytes_per_shard``, at least one for each shuffle partition."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // bytes_per_shard), 1)


def shard_of(shards: int) -> Column:
    """The shard of a row of ``(doc_id, text)``: of both, for rows without an
    id or with a repeated one must not meet in one shard."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")


def sharded(pairs: DataFrame, shards: int) -> DataFrame:
    """``(doc_id, text, copies, shard)`` of rows ``(doc_id, text)``. Identical
    rows cannot be told apart, so they share a shard; they become one row for
    each batch of the reader, with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(["doc_id", "text"], use_threads=False).aggregate([([], "count_all")])
            yield from found.select(["doc_id", "text", "count_all"]).rename_columns(["doc_id", "text", "copies"]).to_batches()

    id_type = pairs.schema["doc_id"].dataType.simpleString()
    return pairs.mapInArrow(run, f"doc_id {id_type}, text string, copies long").withColumn("shard", shard_of(shards))


def merged(table: pa.Table) -> pa.Table:
    """The distinct rows of a shard, sorted, so that each reading has them in the same order."""
    found = table.group_by(["doc_id", "text"], use_threads=False).aggregate([("copies", "sum")])
    return found.rename_columns({"copies_sum": "copies"}).sort_by([("doc_id", "ascending"), ("text", "ascending")])


#: Copies that one row stands for until :func:`with_copies`.
_COPIES = 4096


def chunks_of_copies(copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to take, and the number of copies that each stands for."""
    times = -(-copies // _COPIES)
    row = np.repeat(np.arange(copies.size), times)
    nth = np.arange(row.size) - np.repeat(np.cumsum(times) - times, times)
    return row, np.minimum(copies[row] - nth * _COPIES, _COPIES)


def with_copies(df: DataFrame) -> DataFrame:
    """``df`` with each row as often as its ``copies`` say, without that column."""
    kept = [F.col(c) for c in df.columns if c != "copies"]
    return df.select(*kept, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).select(*kept)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``, computed once a row. They come out of a
    generator of one row; a filter on a plain projection would be moved below
    it with the expressions written out again, as often as it names them."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    held = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select(*rest, held.alias("_held")).select(*rest, *[F.col(f"_held.`{c}`") for c in columns])
