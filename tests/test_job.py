"""The batch job end to end on parquet role tables in a scratch folder."""

import pathlib
import tempfile

import pytest

from covtab.params import JobParams
from covtab.plans.job import ChecksFailed, _renames, run_job
from covtab.plans.publish import read_published
from covtab.sources import DEMO_ASOF, demo_inputs
from tests.fixtures import ASOF, inputs


def test_run_job_publishes_every_table(spark):
    root = tempfile.mkdtemp(prefix="covtab-job-")
    sources = {}
    for role, df in demo_inputs(spark, "/root/testdata/sf0.001").items():
        df.write.parquet(f"{root}/in/{role}")
        sources[role] = f"{root}/in/{role}"
    res = run_job(spark, sources, JobParams(asof=DEMO_ASOF), f"{root}/out", "csv")
    assert set(res["written"]) == {"table_1", "table_2", "table_3a", "table_3b", "org_reference",
                                   "publication_notes", "_freshness", "_quality", "_metrics"}
    t2 = read_published(spark, res["written"]["table_2"])
    assert t2.columns == ["org_name", "org_code", "known", "alive", "unknown", "percentage"]
    names = [r.org_name for r in t2.collect()]
    assert names == sorted(names) and "TOTAL" in names
    assert res["checks"]["freshness"].first().ok == "true"
    notes = {(r.section, r.item): r.text for r in read_published(spark, res["written"]["publication_notes"]).collect()}
    assert notes["contents", "table_2"] == f"{len(names)} rows, 6 columns"
    assert {r.metric for r in read_published(spark, res["written"]["_metrics"]).collect()} >= {"seconds", "seconds_tables"}
    assert not list(pathlib.Path(root).glob("out.staging-*"))


def test_negative_unknown_stops_before_publishing(spark):
    """More asset rows than registrations: the checks are there, no table is, and the scratch folder is empty."""
    root = tempfile.mkdtemp(prefix="covtab-neg-")
    i = inputs(spark, [(f"e{k:02d}", "A", "2021-01-01", "s") for k in (1, 2, 5, 8) for _ in range(9)])
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(f"{root}/scratch")
    try:
        with pytest.raises(ChecksFailed, match="negative_unknown_secondary"):
            run_job(spark, i, JobParams(asof=ASOF, parity=True), f"{root}/out", "csv")
        left = [p for p in pathlib.Path(root, "scratch").rglob("*") if p.is_file()]
    finally:
        spark.sparkContext.setCheckpointDir(before)
    assert left == []
    assert sorted(p.name for p in pathlib.Path(root, "out").iterdir()) == ["_freshness", "_quality"]
    rows = read_published(spark, f"{root}/out/_quality").collect()
    assert "negative_unknown_secondary" in {r.check for r in rows}


def test_catalog_tables_with_their_own_column_names(spark):
    """The original's shape: tables read by name, columns under other names."""
    root = tempfile.mkdtemp(prefix="covtab-cat-")
    renames, sources = {}, {}
    for role, df in inputs(spark, [("e01", "A", "2021-01-01", "s")]).items():
        renames[role] = {f"SRC_{c.upper()}": c for c in df.columns}
        df.toDF(*[f"SRC_{c.upper()}" for c in df.columns]).write.mode("overwrite").option(
            "path", f"{root}/{role}").saveAsTable(f"covtab_src_{role}")
        sources[role] = f"covtab_src_{role}"
    try:
        res = run_job(spark, sources, JobParams(asof=ASOF), f"{root}/out", "csv", renames=renames,
                      notes={"title": "Own title", "footnotes": ["One note"]})
        t1 = {r.org_name: r for r in read_published(spark, res["written"]["table_1"]).collect()}
        assert set(t1) == {"Org One", "Org Two", "Org Four", "TOTAL"}
        notes = {(r.section, r.item): r.text for r in read_published(spark, res["written"]["publication_notes"]).collect()}
        assert notes["cover", "title"] == "Own title" and notes["footnote", "1"] == "One note"
    finally:
        for table in sources.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_rename_options():
    assert _renames(["facts:A=entity_id", "concept-map:B=category", "facts:C=period_end"]) == {
        "facts": {"A": "entity_id", "C": "period_end"}, "concept_map": {"B": "category"}}


def test_register_views_for_sql(spark):
    from covtab.plans import build_report
    from covtab.plans.views import register_views

    rep = build_report(demo_inputs(spark, "/root/testdata/sf0.001"), JobParams(asof=DEMO_ASOF), materialise=False)
    views = register_views(rep, names=["population", "coverage_secondary", "table_2"])
    assert views == ["covtab_population", "covtab_coverage_secondary", "covtab_table_2"]
    alive = spark.sql("SELECT SUM(alive) AS a FROM covtab_coverage_secondary").first().a
    total = spark.sql("SELECT alive FROM covtab_table_2 WHERE org_name = 'TOTAL'").first().alive
    expected = (alive + 2) // 5 * 5 if alive > 7 else None
    assert total == (str(expected) if expected is not None else "*")
