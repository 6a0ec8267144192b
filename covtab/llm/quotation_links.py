"""Chat formatting by quotation linking.

Messages quote others in lines that start with ``>``, nested as ``> >``. Every
line is a passage: its level is the number of marks before it, and its hash is
that of its words in lower case. The original of a passage is the first
message of its conversation that has the line as its own, at level 0. A
message replies to the earlier message that is the original of most of its
lines at level 1, the latest such message if several are; where no line of that
level has an earlier original (the message it answers is missing), the next
level decides, and so on. Replies form trees;
a message's path, the turns from its root to it, sorts a conversation so that
each reply follows what it answers. A path is as long as its chain of replies,
so the paths of a chain of n messages have n * n / 2 entries; without them,
a message has its root and its position in the tree's depth-first order, which
sort the same and are of one size.

Everything is DataFrame expressions. Lines are joined to one original for each
conversation and line, found with partial aggregation, so a line that very
many messages share is one row on that side; paths and positions are built by
doubling, a join a round. No conversation is gathered in one place: its messages are rows,
and :func:`in_reply_order` writes them by ranges of (conversation, path) or (conversation, root, position).

Defined results: a null text counts as empty; a message without quoted lines,
or whose lines have no earlier original, is a root; messages without a
conversation or a turn are roots with a path of their turn alone; rows that
repeat a conversation's turn share a parent and a path; an empty table gives
an empty result. Columns other than the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covtab.llm.common import SPACE_RUN, cut_lineage, text_or_empty

MARKS = r"^(?:[ \t]*>)+"


def _lines(text: Column) -> Column:
    """(level, content) of each line."""
    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct((F.length(marks) - F.length(F.translate(marks, ">", ""))).alias("level"),
                        F.regexp_replace(line, MARKS + " ?", "").alias("content"))

    return F.transform(F.split(text, "\n"), parsed)


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, SPACE_RUN, " ")))


def without_quotes(lines: Column) -> Column:
    """The own lines of a message, without empty lines around them."""
    own = F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"]), "\n")
    return F.regexp_replace(own, r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", "")


def _paths(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, path)`` of distinct messages with their ``parent``, by doubling."""
    now = cut_lineage(links.select("conv_id", "turn", F.col("parent").alias("next"), F.array("turn").alias("path")))
    while not (todo := now.where("next IS NOT NULL")).isEmpty():
        above = now.select("conv_id", F.col("turn").alias("next"), F.col("next").alias("_next"), F.col("path").alias("_path"))
        # Only messages whose path has not reached its root are joined again.
        longer = todo.join(above, ["conv_id", "next"]).select(
            "conv_id", "turn", F.col("_next").alias("next"), F.concat("_path", "path").alias("path"))
        now = cut_lineage(now.where("next IS NULL").union(longer))
    return now.select("conv_id", "turn", "path")


def _positions(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, root_turn, position)`` of distinct messages with their
    ``parent``: the tour of a tree enters and leaves each message, and by
    doubling each step learns its end and the messages entered until then."""
    siblings = Window.partitionBy("conv_id", "parent").orderBy("turn")
    replies = links.where("parent IS NOT NULL").select("conv_id", "turn", F.lead("turn").over(siblings).alias("sibling"))
    first = links.where("parent IS NOT NULL").groupBy("conv_id", F.col("parent").alias("turn")).agg(F.min("turn").alias("first"))
    known = links.select("conv_id", "turn", "parent").join(replies, ["conv_id", "turn"], "left").join(first, ["conv_id", "turn"], "left")
    step = lambda turn, leaves: F.when(turn.isNotNull(), F.struct(turn.alias("turn"), F.lit(leaves).alias("leaves")))
    enter = F.struct(F.lit(False).alias("leaves"), F.lit(1).cast("long").alias("n"),
                     F.coalesce(step(F.col("first"), False), step(F.col("turn"), True)).alias("next"))
    leave = F.struct(F.lit(True).alias("leaves"), F.lit(0).cast("long").alias("n"),
                     F.coalesce(step(F.col("sibling"), False), step(F.col("parent"), True)).alias("next"))
    now = cut_lineage(known.select("conv_id", "turn", F.explode(F.array(enter, leave)).alias("s")).select(
        "conv_id", "turn", "s.leaves", "s.n", F.col("s.next.turn").alias("to_turn"), F.col("s.next.leaves").alias("to_leaves"),
        F.col("turn").alias("end")))
    while not (todo := now.where("to_turn IS NOT NULL")).isEmpty():
        ahead = now.select("conv_id", F.col("turn").alias("to_turn"), F.col("leaves").alias("to_leaves"), F.col("n").alias("_n"),
                           F.col("to_turn").alias("_turn"), F.col("to_leaves").alias("_leaves"), F.col("end").alias("_end"))
        further = todo.join(ahead, ["conv_id", "to_turn", "to_leaves"]).select(
            "conv_id", "turn", "leaves", (F.col("n") + F.col("_n")).alias("n"), F.col("_turn").alias("to_turn"),
            F.col("_leaves").alias("to_leaves"), F.col("_end").alias("end"))
        now = cut_lineage(now.where("to_turn IS NULL").union(further))
    # The more messages are entered until the tour's end, the earlier is a message's place.
    return now.where("NOT leaves").select("conv_id", "turn", F.col("end").alias("root_turn"), (-F.col("n")).alias("position"))


def link_replies(messages: DataFrame, paths: bool = True, positions: bool | None = None) -> DataFrame:
    """One row for each row of ``messages``: ``conv_id``, ``turn``, ``role``,
    ``parent_turn``, ``path``, numbers of quoted and of linked lines at level
    1 and deeper, and ``text`` without quotes. Without ``paths``, ``root_turn``
    and ``position`` (ascending in a tree) stand for ``path``; with
    ``positions`` they follow it."""
    positions = not paths if positions is None else positions
    read = messages.select("conv_id", "turn", "role", _lines(text_or_empty("text")).alias("lines"))
    lines = read.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", "turn", F.explode("lines").alias("line"))
    lines = lines.select("conv_id", "turn", "line.level", normalised(F.col("line.content")).alias("line"))
    lines = lines.where("line <> ''").select("conv_id", "turn", "level", F.xxhash64("line").alias("hash"), F.length("line").alias("size"))
    originals = lines.where("level = 0").groupBy("conv_id", "hash", "size").agg(F.min("turn").alias("origin"))
    quoted = lines.where("level > 0").groupBy("conv_id", "turn", "level", "hash", "size").agg(F.count("*").alias("n"))
    found = quoted.join(originals, ["conv_id", "hash", "size"], "left").withColumn(
        "origin", F.when(F.col("origin") < F.col("turn"), F.col("origin")))
    votes = found.groupBy("conv_id", "turn", "level", "origin").agg(F.sum("n").alias("n"))
    linked = F.when(F.col("origin").isNotNull(), F.col("n"))
    vote = F.struct((-F.col("level")).alias("nearer"), "n", "origin")
    parents = votes.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("origin").isNotNull(), vote))["origin"].alias("parent"),
        F.sum("n").alias("n_quoted"), F.coalesce(F.sum(linked), F.lit(0)).alias("n_linked"))
    everyone = read.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    parents = cut_lineage(everyone.join(parents, ["conv_id", "turn"], "left"))
    whole, place = parents, []
    if paths:
        whole = whole.join(_paths(parents), ["conv_id", "turn"])
        place += [F.coalesce("path", F.array_compact(F.array("turn"))).alias("path")]
    if positions:
        whole = whole.join(_positions(parents), ["conv_id", "turn"])
        place += [F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("position", F.lit(-1)).alias("position")]
    # Messages that belong nowhere are set aside: they would all meet in one task.
    own = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    nowhere = read.where(~own).select("*", *[F.lit(None).cast(whole.schema[c].dataType).alias(c) for c in whole.columns[2:]])
    placed = read.where(own).join(whole, ["conv_id", "turn"], "left").unionByName(nowhere)
    return placed.select(
        "conv_id", "turn", "role", F.col("parent").alias("parent_turn"),
        *place,
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        without_quotes(F.col("lines")).alias("text"))


def formatted(linked: DataFrame) -> DataFrame:
    """``linked`` with ``chat``: each message as one turn of a chat template."""
    return linked.withColumn("chat", F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n")))


def in_reply_order(linked: DataFrame) -> DataFrame:
    """The messages, sorted over all partitions by conversation, tree and place in it."""
    keys = ["conv_id", "path"] if "path" in linked.columns else ["conv_id", "root_turn", "position"]
    return linked.repartitionByRange(*keys).sortWithinPartitions(*keys)
