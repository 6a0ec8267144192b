"""Named queries over the demo mapping of the public test tables.

One entry per operator of the report, each ``(spark, sf_dir) -> DataFrame``.
The row-level operators are exercised through their standalone form (e.g.
registrations straight from the facts); the published tables go through the
fused report plan. All are lazy but ``published_order``, ``publication_notes``,
``publish_roundtrip``, ``publication_tables``, ``typed_readback`` and
``quality_report``, which write stages as a run would; those that use the
concept map write that first.
``covtab.sources.demo_sql.ORACLE`` holds the same queries as SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covtab.operators import (
    attribute,
    attributed_cells,
    best_priority,
    candidate_observations,
    category_cells,
    coverage,
    crosstab,
    dedupe_observations,
    direct_codes,
    drop_conflicts,
    keep_living,
    known_by_org,
    latest_per_key,
    living,
    mapped_codes,
    org_map,
    org_reference,
    population,
    reduce_facts,
    registrations,
    resolve_entities,
    resolve_reduced,
    suppress_table,
    to_text,
    union_observations,
    with_rate,
    with_total,
)
from covtab.functions import suppress_round
from covtab.params import JobParams, SOURCE_CODED, SOURCE_DIRECT
from covtab.plans.publish import (
    open_published,
    publication_notes,
    publish_tables,
    published_order,
    read_published,
    read_typed,
    scratch_folder,
)
from covtab.plans.quality import freshness, quality_report
from covtab.plans.report import build_report, resolved_living
from covtab.plans.sql import RECORDS_BY_ORG, register_functions, register_inputs, run_sql
from covtab.plans.views import register_views
from covtab.session import Scratch, scratch_table
from covtab.sources.demo import DEMO_ASOF, DEMO_DAYS, demo_asset_by_order, demo_inputs
from covtab.sources.tables import read_inputs

COVERAGE_MEASURES = ("known", "alive", "unknown")


class _Ctx:
    """Lazily built shared sub-plans of one query (nothing is executed)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.i = demo_inputs(spark, sf_dir)

    @property
    def facts(self):
        return self.i["facts"]

    @functools.cached_property
    def cmap(self):
        """The concept map, written: derived from all orders, it has no size by
        which Spark could see that it is small, and the facts would be shuffled
        by their few concepts."""
        return scratch_table(self.i["concept_map"], "concept_map")

    def inputs(self):
        return dict(self.i, concept_map=self.cmap)

    def org_map(self):
        return org_map(self.i["facilities"], self.i["orgs"], DEMO_ASOF)

    def coded_dedup(self):
        return dedupe_observations(mapped_codes(self.facts, self.cmap), date="record_date")

    def direct_dedup(self):
        return dedupe_observations(direct_codes(self.facts), date="period_end")

    def union_latest(self):
        coded = latest_per_key(self.coded_dedup(), date="record_date")
        direct = latest_per_key(self.direct_dedup(), date="period_end")
        return union_observations(coded, direct)

    def prioritised(self):
        return best_priority(latest_per_key(self.union_latest(), date="recorded_on"))

    def resolved(self):
        return resolve_entities(candidate_observations(self.facts, self.cmap))

    def resolved_living(self):
        return keep_living(self.resolved(), living(self.facts))

    def regs(self):
        return registrations(self.facts, self.org_map())

    def attr_primary(self):
        return attribute(self.resolved_living(), self.regs())

    def attr_secondary(self):
        return attribute(self.i["asset"], self.regs())

    def cells_p(self):
        return category_cells(self.attr_primary())

    def cells_s(self):
        return category_cells(self.attr_secondary())

    def cov_p(self):
        return coverage(population(self.regs()), known_by_org(self.cells_p()))

    def cov_s(self):
        return coverage(population(self.regs()), known_by_org(self.cells_s()))

    def rounded_s(self):
        return suppress_table(with_total(self.cov_s(), COVERAGE_MEASURES), COVERAGE_MEASURES)

    def report(self, parity: bool = False, materialise: bool = False, joined_key: bool = False):
        return build_report(self.inputs(), JobParams(asof=DEMO_ASOF, parity=parity, joined_key=joined_key), materialise=materialise)


def _dedupe_both(c: _Ctx) -> DataFrame:
    coded = c.coded_dedup().select("entity_id", F.col("record_date").alias("recorded_on"), "category",
                                   F.lit(SOURCE_CODED).alias("source"), "n_records")
    direct = c.direct_dedup().select("entity_id", F.col("period_end").alias("recorded_on"), "category",
                                     F.lit(SOURCE_DIRECT).alias("source"), "n_records")
    return coded.unionByName(direct)


def _notes(c: _Ctx) -> DataFrame:
    rep = c.report(materialise=True)
    return publication_notes(c.spark, dict(rep.tables))


def _roundtrip(c: _Ctx) -> DataFrame:
    """Tables 1 and 2 as they are read back after publishing, a row as JSON."""
    folder = scratch_folder(c.spark, "published")
    rep = c.report(materialise=True)
    written = publish_tables(dict(rep.tables), folder, "csv")
    rep.close()
    back = [read_published(c.spark, written[name], "csv").select(
        F.lit(name).alias("name"), F.to_json(F.struct("org_name", "org_code", "known", "alive", "unknown", "percentage")).alias("row"))
        for name in ("table_1", "table_2")]
    return back[0].union(back[1])


def _publication(c: _Ctx) -> DataFrame:
    """All five tables as readers find them after two publications, a row as text."""
    folder = scratch_folder(c.spark, "published")
    rep = c.report(materialise=True)
    publish_tables({"table_1": rep.tables["table_2"]}, folder, "parquet")
    publish_tables(dict(rep.tables), folder, "csv")
    names = list(rep.tables)
    rep.close()
    tables = open_published(c.spark, folder)
    text = lambda df: F.concat_ws("|", *[F.coalesce(F.col(f"`{x}`"), F.lit("")) for x in df.columns])
    parts = [tables[name].select(F.lit(name).alias("name"), text(tables[name]).alias("row")) for name in names]
    return functools.reduce(DataFrame.union, parts)


def _typed(c: _Ctx) -> DataFrame:
    """Table 3a as published text, with its counts as numbers again."""
    folder = scratch_folder(c.spark, "published")
    rep = c.report(materialise=True)
    publish_tables({"table_3a": rep.tables["table_3a"]}, folder, "csv")
    rep.close()
    back = open_published(c.spark, folder)["table_3a"]
    return read_typed(back, counts=back.columns[2:])


def _by_date(c: _Ctx) -> DataFrame:
    """One SQL text over the role tables, run for several dates."""
    register_inputs(c.inputs())
    register_functions(c.spark)
    return functools.reduce(DataFrame.union, [run_sql(c.spark, RECORDS_BY_ORG, day) for day in DEMO_DAYS])


def _quality(c: _Ctx) -> DataFrame:
    """The facts are built once for their four readers, the registrations once
    for three; the counts, of which each is read several times, stay."""
    with Scratch(c.spark, "quality") as run:
        c.i["facts"] = run.table(c.facts, "facts")
        regs = run.bucketed(c.regs(), "registrations")
        cells_p = scratch_table(category_cells(attribute(c.resolved_living(), regs)), "cells")
        cells_s = scratch_table(category_cells(attribute(c.i["asset"], regs)), "cells")
        alive = scratch_table(population(regs), "population")
    cov_p, cov_s = coverage(alive, known_by_org(cells_p)), coverage(alive, known_by_org(cells_s))
    return quality_report(c.org_map(), cells_p, cells_s, cov_p, cov_s, alive)


def _by_name(c: _Ctx) -> DataFrame:
    """Table 1 from sources read by name, with columns under names of their own."""
    names, renames = {}, {}
    for role, df in c.inputs().items():
        names[role] = f"covtab_source_{role}"
        renames[role] = {f"src_{column}": column for column in df.columns}
        df.toDF(*renames[role]).createOrReplaceTempView(names[role])
    inputs = read_inputs(c.spark, names, renames)
    return build_report(inputs, JobParams(asof=DEMO_ASOF), materialise=False).tables["table_1"]


def _by_view(c: _Ctx) -> DataFrame:
    """SQL over named stages of the report."""
    register_views(c.report(), names=["coverage_primary", "cells_primary"])
    return c.spark.sql(
        "SELECT v.org_name, v.org_code, v.alive, count(k.category) AS categories FROM covtab_coverage_primary v "
        "LEFT JOIN covtab_cells_primary k ON k.org_code = v.org_code AND k.org_name = v.org_name GROUP BY ALL")


def _negative(c: _Ctx, sf_dir: str) -> DataFrame:
    """The quality report of parity counts over an asset with a row per order, which must stop a run."""
    cells = attributed_cells(demo_asset_by_order(c.spark, sf_dir), c.regs())
    cover = coverage(population(c.regs()), known_by_org(cells), parity=True)
    report = quality_report(c.org_map(), cells, cells, cover, cover, population(c.regs()))
    return report.where(F.col("check") == "negative_unknown_secondary")


_BUILDERS: dict[str, Callable[[_Ctx], DataFrame]] = {
    "asof_org_map": lambda c: c.org_map(),
    "mapped_codes": lambda c: mapped_codes(c.facts, c.cmap),
    "direct_codes": lambda c: direct_codes(c.facts),
    "dedupe_observations": _dedupe_both,
    "latest_per_key": lambda c: latest_per_key(c.coded_dedup(), date="record_date"),
    "union_observations": lambda c: c.union_latest(),
    "best_priority": lambda c: c.prioritised(),
    "drop_conflicts": lambda c: drop_conflicts(c.prioritised()),
    "resolve_entities": lambda c: c.resolved(),
    "living_entities": lambda c: resolved_living(resolve_reduced(reduce_facts(c.facts, c.cmap))),
    "registrations": lambda c: c.regs(),
    "attribute_primary": lambda c: c.attr_primary(),
    "attribute_secondary": lambda c: c.attr_secondary(),
    "population": lambda c: population(c.regs()),
    "category_cells": lambda c: c.cells_p(),
    "known_by_org": lambda c: known_by_org(c.cells_p()),
    "coverage_primary": lambda c: c.cov_p(),
    "coverage_secondary": lambda c: c.cov_s(),
    "crosstab_counts": lambda c: crosstab(c.cells_s(), c.cov_s()),
    "total_row": lambda c: with_total(c.cov_s(), COVERAGE_MEASURES),
    "suppress_round": lambda c: to_text(c.rounded_s(), counts=COVERAGE_MEASURES),
    "coverage_rate": lambda c: with_rate(c.rounded_s()).select("org_name", "org_code", "percentage"),
    "table_1": lambda c: c.report().tables["table_1"],
    "table_2": lambda c: c.report().tables["table_2"],
    "table_3a": lambda c: c.report().tables["table_3a"],
    "table_3b": lambda c: c.report().tables["table_3b"],
    "org_reference": lambda c: org_reference(c.org_map()),
    "freshness": lambda c: freshness(c.facts, DEMO_ASOF),
    "quality_report": _quality,
    "table_2_parity": lambda c: c.report(parity=True).tables["table_2"],
    "table_3b_parity": lambda c: c.report(parity=True).tables["table_3b"],
    "total_row_parity": lambda c: with_total(c.report(parity=True).stages["coverage_secondary"], COVERAGE_MEASURES, parity=True),
    "quality_negative_unknown": lambda c: _negative(c, c.sf_dir),
    "suppress_value": lambda c: c.cov_s().select(
        "org_name", "org_code", *[suppress_round(f"coalesce({m}, 0)").alias(m) for m in COVERAGE_MEASURES]),
    "sources_by_name": _by_name,
    "stage_views": _by_view,
    "published_order": lambda c: published_order(c.report().tables["table_1"]),
    "publication_notes": _notes,
    "publish_roundtrip": _roundtrip,
    "publication_tables": _publication,
    "typed_readback": _typed,
    "sql_by_date": _by_date,
    "attribute_joined_key": lambda c: attribute(c.i["asset"], c.regs(), parity=True, joined_key=True),
    "table_2_joined_key": lambda c: c.report(parity=True, joined_key=True).tables["table_2"],
}


def _bind(builder: Callable[[_Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return builder(_Ctx(spark, sf_dir))

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _bind(v) for k, v in _BUILDERS.items()}
