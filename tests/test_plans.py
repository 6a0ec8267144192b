"""Plan shape: the facts are shuffled once, already combined; no Python
UDF anywhere; no driver-side collection in the library."""

import contextlib
import io
import pathlib
import tempfile

from pyspark.sql import functions as F

from covtab.operators import reduce_facts
from covtab.params import JobParams
from covtab.plans import build_report
from tests.fixtures import ASOF, inputs


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_facts_shuffled_once_with_map_side_combine(spark):
    i = inputs(spark)
    root = tempfile.mkdtemp(prefix="covtab-map-")
    i["concept_map"].write.parquet(f"{root}/map")  # a table has a size, by which Spark broadcasts it
    p = plan(reduce_facts(i["facts"], spark.read.parquet(f"{root}/map")))
    assert p.count("hashpartitioning(entity_id") == 1, p
    assert "partial_max" in p
    assert "HashAggregate" in p and "SortAggregate" not in p, p
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_no_python_udf_in_report(spark):
    i = inputs(spark)
    rep = build_report(i, JobParams(asof=ASOF), materialise=False)
    for name, df in rep.tables.items():
        p = plan(df)
        for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
            assert bad not in p, (name, bad)


def test_library_never_collects_to_driver():
    root = pathlib.Path(__file__).resolve().parents[1] / "covtab"
    for f in (f for f in root.rglob("*.py") if "llm" not in f.parts):
        text = f.read_text()
        for bad in (".collect(", ".toPandas(", "localCheckpoint", ".rdd"):
            assert bad not in text, (f, bad)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_reduced_rows_are_not_shuffled_again(spark):
    """Pairs, resolution and the join on entity use the layout of the written rows."""
    from covtab.operators import by_entity, resolve_reduced
    from covtab.operators.attribute import entity_category
    from covtab.plans.report import resolved_living
    from covtab.session import materialize_layout

    i = inputs(spark, [("e01", "A", "2021-01-01", "s")])
    reduced = materialize_layout(by_entity(reduce_facts(i["facts"], i["concept_map"])))
    resolved = resolve_reduced(reduced)
    assert "Exchange" not in executed(resolved)
    pairs = reduced.where("alive").select("entity_id", "facility_code").distinct()
    assert "Exchange" not in executed(pairs)
    joined = pairs.join(resolved_living(resolved).select("entity_id", "category").hint("merge"), "entity_id", "left")
    assert "Exchange" not in executed(joined)
    asset = entity_category(i["asset"]).select("entity_id", "category")
    # The asset is shuffled twice, combined by value and then by entity; the reduced rows are not.
    assert executed(asset).count("Exchange") == 2
    assert executed(joined.join(asset.hint("merge"), "entity_id", "left")).count("Exchange") == 2


def test_resolution_and_asset_use_hash_aggregates(spark):
    from covtab.operators import candidate_observations, resolve_entities, resolve_reduced
    from covtab.operators.attribute import attribute, entity_category, registrations
    from covtab.operators.dims import org_map

    i = inputs(spark, [("e01", "A", "2021-01-01", "s")])
    regs = registrations(i["facts"], org_map(i["facilities"], i["orgs"], ASOF))
    for df in (resolve_entities(candidate_observations(i["facts"], i["concept_map"])), entity_category(i["asset"]),
               resolve_reduced(reduce_facts(i["facts"], i["concept_map"])), attribute(i["asset"], regs, parity=True)):
        p = executed(df)
        assert "HashAggregate" in p and "SortAggregate" not in p, p
    p = executed(entity_category(i["asset"]))
    assert p.index("partial_max") > p.index("Exchange hashpartitioning(entity_id#"), p  # combined below the first exchange


def test_bucketed_stages_join_without_an_exchange(spark):
    """Reduced rows and asset values of a run: no exchange on either side of the
    joins on entity, nor in their aggregations, and no setting is changed."""
    from covtab.operators import asset_values, resolve_reduced, settled_values
    from covtab.plans.report import resolved_living
    from covtab.session import Scratch

    i = inputs(spark, [("e01", "A", "2021-01-01", "s"), ("e01", "A", "2021-02-01", "s")])
    before = dict(spark.sparkContext.getConf().getAll()) | {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    with Scratch(spark) as run:
        reduced = run.bucketed(reduce_facts(i["facts"], i["concept_map"]), "reduced")
        values = run.bucketed(asset_values(i["asset"]), "asset")
        assert reduced.count() == reduce_facts(i["facts"], i["concept_map"]).count()
        pairs = reduced.where("alive").select("entity_id", "facility_code").distinct()
        primary = resolved_living(resolve_reduced(reduced)).select("entity_id", "category")
        both = pairs.join(primary.hint("merge"), "entity_id", "left").join(
            settled_values(values).select("entity_id", F.col("category").alias("s_cat")).hint("merge"), "entity_id", "left")
        assert "Exchange" not in executed(both), executed(both)
        assert both.count() == pairs.count()
        tables = [t.name for t in spark.catalog.listTables() if run.id in t.name]
        assert len(tables) == 2
    assert not [t for t in spark.catalog.listTables() if run.id in t.name]
    assert before == dict(spark.sparkContext.getConf().getAll()) | {k: spark.conf.get(k) for k in (
        "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}


def test_table_3b_reads_the_facts_once(spark):
    root = tempfile.mkdtemp(prefix="covtab-plan-")
    i = inputs(spark, [("e01", "A", "2021-01-01", "s")])
    i["facts"].write.parquet(f"{root}/facts")
    i["facts"] = spark.read.parquet(f"{root}/facts")
    for name in ("table_2", "table_3a", "table_3b"):
        p = executed(build_report(i, JobParams(asof=ASOF), materialise=False).tables[name])
        assert p.count(f"{root}/facts") <= 2, (name, p.count(f"{root}/facts"))
