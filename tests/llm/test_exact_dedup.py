import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from covtab.llm import exact_dedup


def expected(rows):
    """(keep_id, size) of each group by normalised text."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i if i is not None else 0))
    return {k: (None if min(v)[1] else min(v)[2], len(v)) for k, v in groups.items()}


def check(df, rows):
    want = expected(rows)
    got = exact_dedup.duplicate_groups(df).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.group_size) for r in got))) == sorted(
        map(str, ((i, *want[re.sub(r"[\x20\x09-\x0D]", "", t or "")]) for i, t in rows)))
    kept = [r for r in got if r.kept]
    assert len(kept) == len(want) == len({bytes(r.digest) for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(table, odd_rows):
    for clashing in (False, True):
        check(table(odd_rows, clashing), odd_rows)


def test_empty(table):
    assert exact_dedup.duplicate_groups(table([])).collect() == []
    assert exact_dedup.drop_duplicates(table([])).collect() == []


def test_hot_group_and_ties(table):
    rows = [(k, "same text") for k in range(500)] + [(1000 + k, "same  text") for k in range(30)] + [(2000, "other")]
    check(table(rows), rows)
    stays = {r.doc_id for r in exact_dedup.drop_duplicates(table(rows)).collect()}
    assert stays == {1000, 2000}


def test_small_fan_in(table):
    rows = [(k, f"t{k % 7}") for k in range(200)]
    got = exact_dedup.duplicate_groups(table(rows), fan_in=2).collect()
    assert {r.keep_id for r in got if r.kept} == set(range(7)) and sum(r.kept for r in got) == 7


def test_drop_keeps_columns(table, odd_rows):
    df = table(odd_rows, clashing=True)
    out = exact_dedup.drop_duplicates(df)
    assert out.columns == df.columns
    assert out.count() == len(expected(odd_rows))


def test_no_task_gets_a_group(spark, table):
    """At most ``fan_in`` entries of a digest meet on a node in a round."""
    plan = exact_dedup.duplicate_groups(table([(1, "a")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan


@pytest.mark.parametrize("partitions", [1, 4, 5, 7])
def test_the_longest_spelling_stays_whatever_the_ids(spark, table, partitions):
    """One id, or none, for rows that are equal but for their spaces."""
    rows = [(1, "ab"), (1, "a b"), (1, "a  b"), (None, "xy"), (None, "x  y"), (None, "x y"), (1, "x"), (2, "a   b"), (3, "a   b")]
    df = table(rows).repartition(partitions)
    stays = sorted((r.text, r.doc_id) for r in exact_dedup.drop_duplicates(df).collect())
    assert stays == [("a   b", 2), ("x", 1), ("x  y", None)]
    some = df.where("doc_id = 1 OR doc_id IS NULL")
    assert sorted((r.text, r.doc_id) for r in exact_dedup.drop_duplicates(some).collect()) == [("a  b", 1), ("x", 1), ("x  y", None)]


def test_hot_rows_without_an_id_spread_over_the_nodes(spark, table):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text")).repartition(8)
    found = exact_dedup.duplicate_groups(df).collect()
    assert len(found) == 3000 and sum(r.kept for r in found) == 1 and {r.group_size for r in found} == {3000}
    stays = exact_dedup.drop_duplicates(df).collect()
    assert len(stays) == 1


def test_a_round_has_one_exchange_and_no_sort_of_its_own(spark, table):
    """Runs are dealt by node, sorted once, and merged without another exchange."""
    entries = exact_dedup._entries(table([(1, "a"), (2, "a")]), "doc_id", "text", F.monotonically_increasing_id())
    run = exact_dedup._sorted_run(entries.withColumn("node", F.xxhash64("digest") % 8), F.count("*").alias("rows"), F.min("doc_id").alias("best"))
    plan = run._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("hashpartitioning(node"):]
    above = plan[:plan.index("hashpartitioning(node")]
    assert above.count("Exchange") == 1 and "hashpartitioning(node" not in below[1:], plan


def test_the_stage_moves_no_text(spark, table):
    out = exact_dedup.drop_duplicates(table([(k, f"text {k % 5}") for k in range(50)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan, plan
