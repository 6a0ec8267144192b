"""The original's key without separators, typed read-back, SQL by date, and
counts taken by the writing jobs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from covtab.operators import attribute, attributed_cells, category_cells
from covtab.params import JobParams
from covtab.plans import build_report
from covtab.plans.publish import open_published, publish_tables, read_typed
from covtab.plans.sql import RECORDS_BY_ORG, register_functions, register_inputs, run_sql
from tests.fixtures import ASOF, frame, inputs

D = dt.date(2021, 1, 1)
REGS = "entity_id string, facility_code string, org_code string, org_name string"


def colliding(spark):
    regs = spark.createDataFrame([
        ("1", "23", "O", "Org"), ("12", "3", "O", "Org"),  # '123O' twice, two categories
        ("4", "56", "O", "Org"), ("45", "6", "O", "Org"),  # '456O' twice, one category
        ("1", "9", "O", "Org"), ("12", "3", "P", "Other"), ("7", None, "O", "Org"), ("8", "1", None, None)], REGS)
    asset = frame(spark, "asset", [("1", "A", D, "s"), ("12", "B", D, "s"), ("4", "C", D, "s"), ("45", "C", D, "s"), ("45", "C", D, "s"),
                                   ("45", None, D, "s"), ("7", "A", D, "s"), ("8", "A", D, "s")])
    return asset, regs


def test_registrations_collide_without_separators(spark):
    asset, regs = colliding(spark)
    rows = lambda **given: sorted((r.entity_id, r.facility_code, r.org_code, str(r.category))
                                  for r in attribute(asset, regs, parity=True, **given).collect())
    own = rows()
    assert ("1", "23", "O", "A") in own and ("12", "3", "O", "B") in own
    assert rows(joined_key=True) == [r for r in own if r[:3] not in {("1", "23", "O"), ("12", "3", "O")}]
    assert len(own) == 4 + 1 + 3  # two in conflict, two others of these entities, and one category three times


def test_joined_key_cells_equal_the_rows(spark):
    asset, regs = colliding(spark)
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.select("org_code", "org_name", "category", "n").collect())))
    for joined in (False, True):
        assert rows(attributed_cells(asset, regs, joined)) == rows(category_cells(attribute(asset, regs, True, joined)))


def test_joined_key_belongs_to_parity():
    with pytest.raises(ValueError):
        JobParams(asof=ASOF, joined_key=True)


def test_joined_key_changes_a_parity_report(spark):
    i = inputs(spark)
    day = dt.date(2021, 6, 30)
    i["facilities"] = frame(spark, "facilities", [(f, "O1", day, None, day, None) for f in ("23", "3")])
    facts = [(e, f, None, None, None, day, None) for e, f in (("1", "23"), ("12", "3"))]
    i["facts"] = frame(spark, "facts", facts)
    i["asset"] = frame(spark, "asset", [("1", "A", D, "s"), ("12", "B", D, "s")])
    known = lambda **given: {r.org_code: r.known for r in build_report(
        i, JobParams(asof=ASOF, parity=True, **given), materialise=False).stages["coverage_secondary"].collect()}
    assert known() == {"O1": 2}
    assert known(joined_key=True) == {None: None}


def test_typed_read_back_leaves_labels(spark):
    df = spark.createDataFrame([("001", "1E5", "25", "0.125"), ("TOTAL", "12", "*", "*"), (None, "*", None, " 5 ")],
                               "org_name string, org_code string, known string, share string")
    root = tempfile.mkdtemp(prefix="covtab-typed-")
    publish_tables({"t": df}, root, "csv")
    back = read_typed(open_published(spark, root)["t"], counts=["known"], rates=["share"])
    assert back.dtypes == [("org_name", "string"), ("org_code", "string"), ("known", "bigint"), ("share", "double")]
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, [
        ("001", "1E5", 25, 0.125), ("TOTAL", "12", None, None), (None, "*", None, 5.0)]))


def test_published_tables_read_back_as_their_numeric_twins(spark):
    rep = build_report(inputs(spark, [("e01", "A", "2021-01-01", "s"), ("e10", "C", "2021-01-01", "s")]), JobParams(asof=ASOF))
    root = tempfile.mkdtemp(prefix="covtab-twin-")
    publish_tables(dict(rep.tables), root, "csv")
    found = open_published(spark, root)
    for name, rates in (("table_1", ["percentage"]), ("table_2", ["percentage"]), ("table_3a", []), ("table_3b", None)):
        measures = found[name].columns[2:]
        rates = measures if rates is None else rates
        typed = read_typed(found[name], counts=[m for m in measures if m not in rates], rates=rates)
        assert sorted(map(str, typed.collect())) == sorted(map(str, rep.numeric[name].collect())), name
    rep.close()


def test_one_sql_text_for_every_date(spark):
    i = inputs(spark)
    register_inputs(i)
    assert "covtab_valid_asof" in register_functions(spark)
    names = lambda day: {r.org_name for r in run_sql(spark, RECORDS_BY_ORG, day).collect()}
    assert names("2021-06-29") == {"Org One", "Org Three", "Org Four"}  # Org Two's facility opens the day after
    assert names(ASOF) == {"Org One", "Org Two", "Org Four"}
    assert names(dt.date(2010, 1, 1)) == set()
    with pytest.raises(ValueError):
        run_sql(spark, RECORDS_BY_ORG, "30/06/2021")
    row = run_sql(spark, "SELECT covtab_known_code(:code) AS k, covtab_suppress_round(3) AS s, covtab_suppress_round(24) AS r, "
                  "covtab_rounded(7) AS n, covtab_rate(5, 80) AS x, covtab_known_code(NULL) AS none", ASOF, code="Z ").first()
    assert tuple(row) == (True, "*", "25", None, 0.062, False)
    with pytest.raises(Exception, match="negative count"):
        run_sql(spark, "SELECT covtab_suppress_round(-1)", ASOF).collect()


def test_counts_of_the_writing_jobs_equal_the_checks(spark):
    i = inputs(spark, [("e01", "Q", "2021-01-01", "s"), ("e08", "A", "2021-01-01", "s"), ("e02", "Q", "2021-01-01", "s")])
    i["orgs"] = i["orgs"].union(i["orgs"].where("org_code = 'O1'").withColumn("org_name", F.lit("Org One again")))
    rep = build_report(i, JobParams(asof=ASOF))
    fresh = rep.stages["freshness"].first()
    assert (fresh.latest_period, fresh.ok) == (ASOF, True)
    assert set(rep.metrics()) == {"reduced_rows", "rows_without_entity", "latest_period"}  # the cube is not written yet
    quality = {(r.check, r.subject): r.value for r in rep.stages["quality"].collect()}
    found = rep.metrics()
    regs = rep.stages["registrations"]
    pairs = regs.select("entity_id", "facility_code").distinct().count()
    assert found["registrations"] == regs.count() and found["fanned_out"] == regs.count() - pairs
    at = {r.facility_code: r.n for r in regs.select("entity_id", "facility_code").distinct().groupBy("facility_code").agg(
        F.count("*").alias("n")).collect()}
    assert found["fanned_out"] == sum((v - 1) * at[s] for (c, s), v in quality.items() if c == "facility_fanout" and s in at)
    assert found["without_org"] == regs.where("org_code IS NULL").count()
    assert found["out_of_domain_secondary"] == quality["out_of_domain_secondary", "Q"] == 4
    assert found["out_of_domain_primary"] == 0 and found["rows_without_entity"] == 1
    rep.close()
