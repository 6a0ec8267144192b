"""Invariants of the report on the demo data, quality checks, and the
semi-join shape of the staged operators."""

import pytest
from pyspark.sql import functions as F

from covtab.operators import category_cells, coverage, known_by_org, living, keep_living, with_total
from covtab.params import CATEGORY_DOMAIN, JobParams
from covtab.plans import build_report
from covtab.plans.quality import quality_report
from covtab.sources import DEMO_ASOF, demo_inputs
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def report(spark):
    return build_report(demo_inputs(spark, SF), JobParams(asof=DEMO_ASOF))


def test_known_never_exceeds_alive(report):
    for name in ("coverage_primary", "coverage_secondary"):
        bad = report.stages[name].where((F.col("known") > F.col("alive")) | (F.col("unknown") < 0)).count()
        assert bad == 0, name


def test_total_row_is_sum_of_unrounded(report):
    cov = report.stages["coverage_secondary"]
    t = with_total(cov, ["known", "alive", "unknown"])
    total = t.where(F.col("org_name") == "TOTAL").first()
    sums = cov.agg(*[F.sum(c).alias(c) for c in ("known", "alive", "unknown")]).first()
    assert (total.known, total.alive, total.unknown) == (sums.known, sums.alive, sums.unknown)
    assert total.org_code == "ZZZTOTAL"


def test_published_counts_in_allowed_domain(report):
    for name in ("table_1", "table_2", "table_3a"):
        df = report.tables[name]
        measures = [c for c in df.columns if c not in ("org_name", "org_code", "percentage")]
        for r in df.select(*measures).collect():
            for v in r:
                assert v in ("0", "*") or (int(v) >= 10 and int(v) % 5 == 0), (name, v)


def test_every_table_has_total_and_fixed_columns(report):
    t3a = report.tables["table_3a"]
    assert t3a.columns == ["org_name", "org_code", *CATEGORY_DOMAIN, "other", "unknown"]
    for name in ("table_1", "table_2", "table_3a", "table_3b"):
        assert report.tables[name].where(F.col("org_name") == "TOTAL").count() == 1


def test_quality_reports_out_of_domain_and_negative(spark):
    cells = spark.createDataFrame([("O1", "Org One", "A", 10), ("O1", "Org One", "Q", 3), ("O1", "Org One", None, 2)],
                                  "org_code string, org_name string, category string, n long")
    pop = spark.createDataFrame([("O1", "Org One", 12)], "org_code string, org_name string, alive long")
    cov = coverage(pop, known_by_org(cells))
    mapping = spark.createDataFrame([("F1", "O1"), ("F1", "O1")], "facility_code string, org_code string")
    pop = pop.union(spark.createDataFrame([("O2", None, 5), (None, None, 9)], pop.schema))
    rows = {(r.check, r.subject, r.value) for r in quality_report(mapping, cells, cells, cov, cov, pop).collect()}
    assert ("nameless_org", "O2", 5) in rows and len([r for r in rows if r[0] == "nameless_org"]) == 1
    assert ("out_of_domain_primary", "Q", 3) in rows
    assert ("out_of_domain_primary", "<null>", 2) in rows
    assert ("negative_unknown_secondary", "Org One", -3) in rows
    assert ("facility_fanout", "F1", 2) in rows


def test_living_filter_is_a_semi_join(spark):
    from tests.fixtures import inputs

    i = inputs(spark)
    asset = spark.createDataFrame([("e01", "A")], "entity_id string, category string")
    p = plan(keep_living(asset, living(i["facts"])))
    assert "LeftSemi" in p


def test_freshness_flags_mismatch(report):
    row = report.stages["freshness"].first()
    assert row.ok is True and row.latest_period == DEMO_ASOF


def test_negative_unknown_stops_publication(spark):
    cells = spark.createDataFrame([("O1", "Org One", "A", 20)], "org_code string, org_name string, category string, n long")
    pop = spark.createDataFrame([("O1", "Org One", 12)], "org_code string, org_name string, alive long")
    from covtab.operators import coverage_table

    t = coverage_table(coverage(pop, known_by_org(category_cells(
        spark.createDataFrame([("x", "F", "O1", "Org One", "A", None, None)] * 20,
                              "entity_id string, facility_code string, org_code string, org_name string, "
                              "category string, attributed_on date, source string")))))
    with pytest.raises(Exception, match="negative count"):
        t.collect()
