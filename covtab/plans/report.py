"""The full coverage report as one Spark plan.

Physical shape (see README "Plan"):

1. ``reduce_facts``: the only pass over the facts. Hash aggregate on
   (entity, facility, mapped category, direct category), combined map-side.
2. The reduced rows, and the distinct values of the asset's entities, are
   written as tables bucketed by entity. The (entity, facility) pairs, both
   resolutions and the joins on entity read them and shuffle on neither side.
3. ``pair_counts``: the pairs joined on entity, where they lie, with the
   resolved primary category and the secondary asset's per-entity category (both
   one row per entity), counted per (facility, primary, secondary category).
   Only the counts meet the org map; ``counted_cube`` adds them up per (org,
   primary, secondary category), which is written.
4. ``cube_summary``: one aggregation of the cube has everything the tables say
   of an org; tables are projections of it with a total row.

The jobs that write the reduced rows and the cube also count what the checks
need of them (``Report.metrics``): the newest period, and rows without an
entity, without an organisation, or added by facilities with several.

With ``parity=True`` the tables follow the original's joins, and duplicate and
null-category asset rows count, as weights (``attributed_cells``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from covtab.functions.predicates import day_literal
from covtab.operators.attribute import (
    asset_values,
    attribute,
    attributed_cells,
    register_pairs,
    registrations_reduced,
    settled_values,
)
from covtab.operators.dims import org_map, org_reference
from covtab.operators.disclose import (
    coverage_table,
    crosstab_table,
    publish_coverage,
    publish_crosstab,
    publish_rates,
    rate_crosstab,
    rate_table,
)
from covtab.operators.measure import (
    counted_cube,
    coverage,
    crosstab,
    cube_cells,
    cube_population,
    cube_summary,
    known_by_org,
    pair_counts,
    population,
    summary_coverage,
    summary_crosstab,
)
from covtab.operators.resolve import RESOLVED_COLUMNS, reduce_facts, resolve_reduced
from covtab.params import JobParams
from covtab.plans.quality import freshness, quality_report
from covtab.session import Scratch


class Lazy(Mapping):
    """A read-only mapping whose values are built on first access (and kept).

    Building a DataFrame costs driver time even before anything runs; a
    caller that needs one table should not pay for all of them.
    """

    def __init__(self, builders: dict):
        self._builders = builders
        self._done: dict = {}

    def __getitem__(self, key):
        if key not in self._done:
            self._done[key] = self._builders[key]()
        return self._done[key]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


@dataclass
class Report:
    """Published text tables, their numeric twins, the named stages, and the
    run that holds the stages that were written (``None`` without any)."""

    tables: Mapping
    numeric: Mapping
    stages: Mapping
    scratch: Scratch | None = None
    observed: dict = field(default_factory=dict)

    def metrics(self) -> dict[str, int | str | None]:
        """What the writing jobs counted so far: ``reduced_rows``,
        ``rows_without_entity``, ``latest_period``; and with the cube
        ``registrations``, ``fanned_out`` (those beyond one for an entity and
        facility), ``without_org`` and ``out_of_domain_primary`` and
        ``_secondary`` (registrations counted outside the domain)."""
        found = {}
        for observation in self.observed.values():
            found |= observation.get
        return found

    def close(self) -> None:
        """Deletes the written stages; the report's frames cannot be used after."""
        if self.scratch is not None:
            self.scratch.close()


def resolved_living(per_entity: DataFrame) -> DataFrame:
    """Entities that are living and have exactly one category."""
    return per_entity.where(F.col("alive") & F.col("category").isNotNull()).select(*RESOLVED_COLUMNS)


def build_report(inputs: dict, params: JobParams, materialise: bool = True, scratch: Scratch | None = None) -> Report:
    """Build every table of the report from the five role tables.

    ``inputs``: ``facts``, ``concept_map``, ``facilities``, ``orgs``,
    ``asset`` (see :mod:`covtab.sources`). Stages and tables are built on
    first access. With ``materialise=True`` the reused stages (reduced facts,
    asset values and cube, or cells and population in parity) are computed once
    when first needed and written to ``scratch``, a run of the report's own if
    none is given (then :meth:`Report.close` ends it); with
    ``materialise=False`` nothing runs until an action on a returned DataFrame.
    """
    if materialise and scratch is None:
        scratch = Scratch(inputs["facts"].sparkSession)
    scratch = scratch if materialise else None
    p, joined, domain = params.parity, params.joined_key, params.domain
    observed: dict[str, Observation] = {}
    st: Lazy
    num: Lazy

    def keep(name: str, df: DataFrame) -> DataFrame:
        return scratch.table(df, name) if scratch else df

    def lay_out(name: str, df: DataFrame) -> DataFrame:
        return scratch.bucketed(df, name) if scratch else df

    def watch(name: str, df: DataFrame, *counts) -> DataFrame:
        """``df`` that counts while it is written."""
        if not scratch:
            return df
        observed[name] = Observation()
        return df.observe(observed[name], *counts)

    def reduced() -> DataFrame:
        rows = reduce_facts(inputs["facts"], inputs["concept_map"])
        return lay_out("reduced", watch("reduced", rows, F.count("*").alias("reduced_rows"),
                                        F.count_if(F.col("entity_id").isNull()).alias("rows_without_entity"),
                                        F.max("direct_on").alias("latest_period")))

    def how_fresh() -> DataFrame:
        if not scratch:
            return freshness(st["reduced"], params.asof, period="direct_on")
        st["reduced"]  # its job has seen the newest period
        latest, day = F.lit(observed["reduced"].get["latest_period"]).cast("date"), day_literal(params.asof)
        return inputs["facts"].sparkSession.range(1).select(
            latest.alias("latest_period"), day.alias("asof"), F.coalesce(latest == day, F.lit(False)).alias("ok"))

    def cube() -> DataFrame:
        pairs = st["reduced"].where("alive").select("entity_id", "facility_code").distinct()
        held = pair_counts(pairs, resolved().select("entity_id", "category"),
                           settled_values(st["asset_values"]).select("entity_id", "category"))
        total = lambda c: F.coalesce(F.sum(F.when(c, F.col("pairs"))), F.lit(0))
        regs = watch("registrations", register_pairs(held, st["org_map"], nth="nth", apart=False),
                     total(F.lit(True)).alias("registrations"), total(F.col("org_code").isNull()).alias("without_org"),
                     total(F.col("nth") > 1).alias("fanned_out"))
        counted = counted_cube(regs)
        outside = lambda c: F.sum(F.when(F.col(c).isNotNull() & ~F.col(c).isin(*domain), F.col("n")).otherwise(0))
        return keep("cube", watch("cube", counted, outside("p_cat").alias("out_of_domain_primary"),
                                  outside("s_cat").alias("out_of_domain_secondary")))

    def resolved():
        return resolved_living(st["per_entity"])

    stage_builders = {
        "org_map": lambda: org_map(inputs["facilities"], inputs["orgs"], params.asof),
        "reduced": reduced,
        "per_entity": lambda: resolve_reduced(st["reduced"]),
        "registrations": lambda: registrations_reduced(st["reduced"], st["org_map"]),
        "freshness": how_fresh,
        "quality": lambda: quality_report(st["org_map"], st["cells_primary"], st["cells_secondary"], st["coverage_primary"],
                                          st["coverage_secondary"], st["population"], domain),
    }
    if p:
        stage_builders |= {
            "registrations": lambda: lay_out("registrations", registrations_reduced(st["reduced"], st["org_map"])),
            "attributed_primary": lambda: attribute(resolved(), st["registrations"], p, joined),
            "attributed_secondary": lambda: attribute(inputs["asset"], st["registrations"], p, joined),
            "cells_primary": lambda: keep("cells_primary", attributed_cells(resolved(), st["registrations"], joined)),
            "cells_secondary": lambda: keep("cells_secondary", attributed_cells(inputs["asset"], st["registrations"], joined)),
            "population": lambda: keep("population", population(st["registrations"])),
            "coverage_primary": lambda: coverage(st["population"], known_by_org(st["cells_primary"]), p),
            "coverage_secondary": lambda: coverage(st["population"], known_by_org(st["cells_secondary"]), p),
            "crosstab": lambda: crosstab(st["cells_secondary"], st["coverage_secondary"], domain, p),
        }
    else:
        stage_builders |= {
            "asset_values": lambda: lay_out("asset", asset_values(inputs["asset"])),
            "cube": cube,
            "summary": lambda: cube_summary(st["cube"], domain),
            "population": lambda: cube_population(st["cube"]),
            "cells_primary": lambda: cube_cells(st["cube"], "p"),
            "cells_secondary": lambda: cube_cells(st["cube"], "s"),
            "coverage_primary": lambda: summary_coverage(st["summary"], "p"),
            "coverage_secondary": lambda: summary_coverage(st["summary"], "s"),
            "crosstab": lambda: summary_crosstab(st["summary"], domain),
        }
    st = Lazy(stage_builders)
    num = Lazy({
        "table_1": lambda: coverage_table(st["coverage_primary"], p),
        "table_2": lambda: coverage_table(st["coverage_secondary"], p),
        "table_3a": lambda: crosstab_table(st["crosstab"], domain, p),
        "table_3b": lambda: rate_crosstab(num["table_3a"], num["table_2"], domain, p) if p else rate_table(st["summary"], domain),
    })
    tables = Lazy({
        "table_1": lambda: publish_coverage(num["table_1"]),
        "table_2": lambda: publish_coverage(num["table_2"]),
        "table_3a": lambda: publish_crosstab(num["table_3a"], domain),
        "table_3b": lambda: publish_rates(num["table_3b"], domain),
        "org_reference": lambda: org_reference(st["org_map"]),
    })
    return Report(tables=tables, numeric=num, stages=st, scratch=scratch, observed=observed)
