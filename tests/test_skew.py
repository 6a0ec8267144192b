"""A hot entity holding a third of all rows: results stay exact and the hot
key is collapsed before any shuffle of row-level data."""

import datetime as dt

from pyspark.sql import functions as F

from covtab.operators import (
    attribute,
    candidate_observations,
    category_cells,
    org_map,
    population,
    registrations,
    entity_category,
    keep_living,
    living,
    reduce_facts,
    resolve_entities,
    resolve_reduced,
)
from covtab.params import JobParams
from covtab.plans import build_report
from covtab.plans.report import resolved_living
from tests.fixtures import ASOF, frame, inputs

N = 60_000


def _facts(spark):
    i = F.col("id")
    hot = (i % 3) == 0
    return spark.range(N).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("e"), (i % 5000).cast("string"))).alias("entity_id"),
        F.when(i % 7 == 0, F.lit("F1")).when(i % 7 == 1, F.lit("F2")).when(i % 7 == 2, F.lit("F5")).alias("facility_code"),
        F.when(i % 4 == 0, F.lit("c1")).when(i % 4 == 1, F.lit("c2")).alias("concept_code"),
        F.date_add(F.lit(dt.date(2021, 1, 1)), (i % 40).cast("int")).alias("record_date"),
        F.when(i % 5 == 0, F.lit("A")).when(i % 5 == 1, F.lit("Z")).alias("direct_category"),
        F.date_add(F.lit(dt.date(2021, 1, 1)), (i % 35).cast("int")).alias("period_end"),
        F.when(i % 11 == 0, F.lit(dt.date(2021, 3, 1))).alias("death_date"),
    )


def test_hot_entity_reduced_before_shuffle(spark):
    i = inputs(spark)
    facts = _facts(spark)
    reduced = reduce_facts(facts, i["concept_map"])
    hot_rows = reduced.where(F.col("entity_id") == "hot").count()
    # facilities (4 incl. null) x mapped (3 incl. null) x direct (2 incl. null)
    assert hot_rows <= 4 * 3 * 2
    fused = keep_living(resolve_entities(candidate_observations(facts, i["concept_map"])), living(facts))
    single = resolved_living(resolve_reduced(reduced))
    a = sorted(tuple(r) for r in fused.collect())
    b = sorted(tuple(r) for r in single.collect())
    assert a == b and len(a) > 1000


def test_report_with_hot_entity(spark):
    i = inputs(spark)
    facts = _facts(spark)
    hot_asset = spark.range(N // 3).select(
        F.lit("hot").alias("entity_id"), F.lit("A").alias("category"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 300).cast("int")).alias("attributed_on"),
        F.lit("s").alias("source"))
    other = frame(spark, "asset", [("e1", "B", dt.date(2020, 1, 1), "s")])
    asset = hot_asset.unionByName(other)
    per_entity = entity_category(asset)
    assert {(r.entity_id, r.category) for r in per_entity.collect()} == {("hot", "A"), ("e1", "B")}
    rep = build_report(dict(i, facts=facts, asset=asset), JobParams(asof=ASOF))
    # Cube path against the row-level operators on the same skewed data.
    regs = registrations(facts, org_map(i["facilities"], i["orgs"], ASOF))
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(str(v) for v in t))

    assert rows(rep.stages["population"]) == rows(population(regs))
    assert rows(rep.stages["cells_secondary"]) == rows(category_cells(attribute(asset, regs)))
    # The hot entity counts once per (facility, org) registration, not once per asset row.
    hot = {r.org_code: r.n for r in category_cells(attribute(asset, regs).where(F.col("entity_id") == "hot")).collect()}
    assert hot == {"O1": 2, "O4": 1}


def test_parity_cells_by_weights(spark):
    """A placeholder id with 100,000 asset rows and many facilities: its cells are
    a product of two counts and equal the row-level attribution's."""
    from covtab.operators import attributed_cells

    regs = spark.range(200).select(
        F.lit("hot").alias("entity_id"), F.concat(F.lit("F"), F.col("id")).alias("facility_code"),
        F.concat(F.lit("O"), F.col("id") % 7).alias("org_code"), F.concat(F.lit("Org"), F.col("id") % 7).alias("org_name"))
    big = spark.range(100_000).select(F.lit("hot").alias("entity_id"), F.when(F.col("id") % 10 != 0, F.lit("A")).alias("category"),
                                      F.lit(dt.date(2020, 1, 1)).alias("attributed_on"), F.lit("s").alias("source"))
    got = {(r.org_code, r.category): r.n for r in attributed_cells(big, regs).collect()}
    assert got["O0", "A"] == 90_000 * 29 and got["O6", None] == 10_000 * 28 and len(got) == 14
    small = big.where("attributed_on IS NOT NULL").limit(40)
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.select("org_code", "org_name", "category", "n").collect())))
    assert rows(attributed_cells(small, regs)) == rows(category_cells(attribute(small, regs, parity=True)))
