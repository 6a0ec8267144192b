"""Plans that keep time and memory of the staged resolution, the quality report
and the cube down: inputs are computed once, and the facts are not dealt by
their few concepts."""

import datetime as dt
import re

from pyspark.sql import functions as F

from covtab.operators import best_priority, drop_conflicts, latest_per_key, pair_counts, reduce_facts, register_pairs
from covtab.operators import counted_cube, registration_cube
from covtab.plans import queries

SF = "/root/testdata/sf0.001"
OBS = "entity_id string, category string, recorded_on date, source string, priority int"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_resolution_computes_its_input_once(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    rows = [("a", "A", day, "m", 1), ("a", "B", day, "m", 1), ("b", "A", day, "m", 2), ("b", "C", day, "d", 1), ("b", "C", None, "d", 0),
            ("c", "A", day, "m", 1), ("c", "A", day, "m", 1), ("d", "D", day, "m", None), ("e", None, day, "m", 1),
            ("f", "A", dt.date(2019, 1, 1), "m", 1), ("f", "B", day, "m", 2), (None, "A", day, "m", 1)]
    spark.createDataFrame(rows, OBS).write.parquet(f"{tmp_path}/obs")
    obs = spark.read.parquet(f"{tmp_path}/obs")
    got = drop_conflicts(best_priority(latest_per_key(obs)))
    assert got.columns == obs.columns
    p = executed(got)
    assert {tuple(r) for r in got.collect()} == {rows[3], rows[8], rows[10]}
    assert p.count("FileScan") == 1 and "Join" not in p, p
    assert "WindowGroupLimit" in p  # rows that cannot be first stay in the map tasks
    assert sorted(r.category for r in drop_conflicts(obs.where("entity_id IN ('d', 'f') OR entity_id IS NULL")).collect()) == ["D"]


def test_hot_key_is_limited_before_the_shuffle(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") % 100 != 0, F.lit("hot")).otherwise(F.lit("other")).alias("entity_id"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 500).cast("int")).alias("recorded_on"), "id")
    p = executed(latest_per_key(hot))
    assert p.rindex("WindowGroupLimit") > p.index("Exchange hashpartitioning(entity_id"), p
    assert latest_per_key(hot).count() == 80


def test_facts_are_not_shuffled_by_concept(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")  # less than the orders, from which the map is derived
    try:
        c = queries._Ctx(spark, SF)
        for df in (reduce_facts(c.facts, c.cmap), c.coded_dedup()):
            p = executed(df)
            assert not re.search(r"hashpartitioning\(concept_code#\d+, \d+\)", p) and "BroadcastHashJoin" in p, p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_quality_report_reads_written_counts(spark):
    report = queries.QUERIES["quality_report"](spark, SF)
    p = executed(report)
    assert "lineitem" not in p and "customer" not in p, p
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("covtab_registrations")]


def test_pairs_are_counted_before_they_meet_the_map(spark):
    pairs = spark.createDataFrame([("a", "F1"), ("a", "F2"), ("b", "F1"), ("b", None), (None, "F1"), (None, None), ("c", "F9"), ("d", "F2")],
                                  "entity_id string, facility_code string")
    orgs = spark.createDataFrame([("F1", "O1", "One"), ("F1", "O2", "Two"), ("F2", None, "None"), ("F3", "O3", "Three")],
                                 "facility_code string, org_code string, org_name string")
    p = spark.createDataFrame([("a", "A"), ("c", "C")], "entity_id string, category string")
    s = spark.createDataFrame([("b", "B"), ("d", "D"), ("a", "B")], "entity_id string, category string")
    held = pair_counts(pairs, p, s)
    got = counted_cube(register_pairs(held, orgs, apart=False))
    want = registration_cube(register_pairs(pairs, orgs), p, s)
    assert got.schema.names == want.schema.names
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert rows(got) == rows(want)
