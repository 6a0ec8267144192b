"""Exact dedup by a tree merge of sorted digest runs.

Two texts are equal when they are identical after their spaces are deleted.
Every document becomes a small entry: SHA-256 of the normalised text, and as a
check on it the normalised length and a second hash; entries merge only where
all three agree. No text is shuffled.

The entries live on ``fan_in ** rounds`` nodes. A row belongs to a node by its
row number, that is, by the task that wrote its entry, whatever its id. A node
first makes one sorted run of its own entries. Round *r* sets digit *r* of a
run entry's node number to digit *r* of its digest's, so ``fan_in`` nodes
exchange runs; the rows are dealt by node, sorted, and merged in that order
without another exchange: one entry for a digest, with the best row so far and
the number of rows. After the last round a digest has one entry. A node gets at
most ``fan_in`` entries of a digest in any round, whatever the number of its
copies. The answers go back the same way, one join a round, so no task ever
gathers a whole group of copies: the last join meets the copies that one node's
tasks wrote.

Defined results: a null text counts as empty, and all empty texts are one
group; of equal texts the row with the most code points stays, then the
smallest id (a null id is the largest), and of rows equal in all that, one.
An empty table gives an empty result. Other columns, whatever their names,
play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.llm.common import cut_lineage, text_or_empty, without_spaces, written

#: Nodes that exchange runs in a round.
FAN_IN = 8

_KEY = ["digest", "check_hash", "check_length"]


def _entries(docs: DataFrame, doc_id: str, text: str, *row: Column) -> DataFrame:
    raw = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(f"`{text}`").alias("body"), *[r.alias("row") for r in row])
    return raw.withColumn("bare", without_spaces(F.col("body"))).select(
        "doc_id",
        *["row"] * len(row),
        F.length("body").alias("n_chars"),
        F.unhex(F.sha2("bare", 256)).alias("digest"),
        F.xxhash64("bare").alias("check_hash"),
        F.octet_length("bare").alias("check_length"),
    )


def _rank(row: Column) -> Column:
    """Smaller is better: most code points, then the smallest id, then any."""
    return F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"),
                    row.alias("row"))


def _sorted_run(entries: DataFrame, *columns: Column) -> DataFrame:
    """``entries`` dealt by node and sorted by digest there, merged to one row a digest."""
    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartition(partitions, "node").sortWithinPartitions("node", *_KEY).groupBy("node", *_KEY).agg(*columns)


def _grouped(entries: DataFrame, fan_in: int) -> DataFrame:
    """``entries`` (with ``row``) with ``keep_id``, ``group_size`` and ``kept``."""
    partitions = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while fan_in ** rounds < partitions:
        rounds += 1
    nodes = fan_in ** rounds
    # The upper half of a row number is the task that wrote the row.
    entries = entries.withColumn("node", F.pmod(F.shiftright("row", 33), F.lit(nodes)))
    home = F.pmod(F.xxhash64("digest"), F.lit(nodes))

    def moved(digit: int) -> Column:
        """The node of an entry after the round for ``digit``."""
        low = fan_in ** digit
        at = lambda number: (F.floor(number / low) % fan_in) * low
        return (F.col("node") - at(F.col("node")) + at(home)).cast("long")

    # Own runs are merged in the tasks that read the entries, before anything moves.
    runs = [entries.groupBy("node", *_KEY).agg(F.min(_rank(F.col("row"))).alias("best"), F.count("*").alias("rows"))]
    for digit in range(rounds):
        runs.append(_sorted_run(runs[-1].withColumn("node", moved(digit)), F.min("best").alias("best"), F.sum("rows").alias("rows")))

    answers = runs[-1].select("node", *_KEY, F.col("best.doc_id").alias("keep_id"),
                              F.col("best.row").alias("keep_row"), F.col("rows").alias("group_size"))
    for digit in reversed(range(rounds)):
        asked = runs[digit].select(F.col("node").alias("from"), moved(digit).alias("node"), *_KEY)
        answers = asked.join(answers, ["node", *_KEY]).drop("node").withColumnRenamed("from", "node")
    return entries.join(answers, ["node", *_KEY]).withColumn("kept", F.col("row") == F.col("keep_row"))


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     fan_in: int = FAN_IN) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id``,
    ``group_size``, ``kept`` and ``digest`` (binary)."""
    # Written once, so that the row numbers stay what they are.
    entries = cut_lineage(_entries(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id()))
    return _grouped(entries, fan_in).select("doc_id", "keep_id", "group_size", "kept", "digest")


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns. Rows are numbered
    and written once; what goes is found by its number in a written list, so
    Spark moves no text while it can broadcast that list by its size."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").alias("_id"),
                        F.col(f"`{text}`").cast("string").alias("_text"))
    whole = cut_lineage(whole.withColumn("_number", F.monotonically_increasing_id()))
    entries = _entries(whole, "_id", "_text", F.col("_number"))
    gone = written(_grouped(written(entries), fan_in).where("NOT kept").select("row"))
    return whole.join(gone, F.col("_number") == F.col("row"), "left_anti").select("_row.*")
