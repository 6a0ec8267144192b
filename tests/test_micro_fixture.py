"""FIXTURES.md section 3: every stage of the report on 16 hand-worked rows."""

from covtab.operators import (
    attribute,
    candidate_observations,
    category_cells,
    coverage,
    keep_living,
    known_by_org,
    living,
    org_map,
    population,
    reduce_facts,
    registrations,
    registrations_reduced,
    resolve_entities,
    resolve_reduced,
    resolve_staged,
)
from covtab.operators.observe import direct_codes, mapped_codes, dedupe_observations, union_observations
from covtab.operators.resolve import latest_per_key
from covtab.plans.report import resolved_living
from tests.fixtures import ASOF, inputs

RESOLVED = {("e01", "B", 2), ("e02", "A", 1), ("e05", "A", 1), ("e07", "A", 1),
            ("e08", "A", 1), ("e10", "C", 2), ("e12", "A", 1)}
PRIO = {"coded_record": 1, "direct_field": 2}


def _resolved_set(df):
    return {(r.entity_id, r.category, PRIO[r.source]) for r in df.collect()}


def test_org_map(spark):
    i = inputs(spark)
    m = org_map(i["facilities"], i["orgs"], ASOF)
    assert {(r.facility_code, r.org_code) for r in m.collect()} == {
        ("F1", "O1"), ("F2", "O1"), ("F3", "O2"), ("F5", "O4")}
    assert len(m.columns) == 18


def test_resolution_three_ways(spark):
    i = inputs(spark)
    obs = candidate_observations(i["facts"], i["concept_map"])
    alive = living(i["facts"])
    fused = keep_living(resolve_entities(obs), alive)
    assert _resolved_set(fused) == RESOLVED
    staged_obs = union_observations(
        latest_per_key(dedupe_observations(mapped_codes(i["facts"], i["concept_map"])), date="record_date"),
        latest_per_key(dedupe_observations(direct_codes(i["facts"]), date="period_end"), date="period_end"),
    )
    staged = keep_living(resolve_staged(staged_obs), alive)
    assert _resolved_set(staged) == RESOLVED
    reduced = resolved_living(resolve_reduced(reduce_facts(i["facts"], i["concept_map"])))
    assert _resolved_set(reduced) == RESOLVED


def test_registrations_population_cells_coverage(spark):
    i = inputs(spark)
    m = org_map(i["facilities"], i["orgs"], ASOF)
    regs = registrations(i["facts"], m)
    rows = {tuple(r) for r in regs.collect()}
    assert len(rows) == 13
    assert (None, "F1", "O1", "Org One") in rows
    assert ("e07", "F9", None, None) in rows and ("e12", "F4", None, None) in rows
    regs2 = registrations_reduced(reduce_facts(i["facts"], i["concept_map"]), m)
    assert {tuple(r) for r in regs2.collect()} == rows

    pop = population(regs)
    assert {(r.org_code, r.alive) for r in pop.collect()} == {(None, 2), ("O1", 8), ("O2", 1), ("O4", 1)}

    resolved = keep_living(resolve_entities(candidate_observations(i["facts"], i["concept_map"])),
                           living(i["facts"]))
    cells = category_cells(attribute(resolved, regs))
    assert {(r.org_code, r.category, r.n) for r in cells.collect()} == {
        ("O1", "A", 4), ("O1", "B", 1), ("O2", "C", 1)}

    known = known_by_org(cells)
    default = {tuple(r) for r in coverage(pop, known).collect()}
    assert default == {("Org Four", "O4", 0, 1, 1), ("Org One", "O1", 5, 8, 3), ("Org Two", "O2", 1, 1, 0)}
    parity = {tuple(r) for r in coverage(pop, known, parity=True).collect()}
    assert parity == {("Org Four", None, None, 1, None), ("Org One", "O1", 5, 8, 3), ("Org Two", "O2", 1, 1, 0)}


def test_secondary_attribution_modes(spark):
    # e01: duplicate rows of one category; e02: a null next to a category;
    # e05: two categories (conflict); e10: only a null; e06: not living.
    asset = [
        ("e01", "A", "2021-01-01", "s1"), ("e01", "A", "2021-01-01", "s1"),
        ("e02", "B", "2021-01-01", "s1"), ("e02", None, "2021-02-01", "s2"),
        ("e05", "A", "2021-01-01", "s1"), ("e05", "C", "2021-01-01", "s1"),
        ("e10", None, "2021-01-01", "s1"),
        ("e06", "A", "2021-01-01", "s1"),
    ]
    i = inputs(spark, asset)
    regs = registrations(i["facts"], org_map(i["facilities"], i["orgs"], ASOF))
    default = sorted((r.entity_id, r.category) for r in attribute(i["asset"], regs).collect())
    assert default == [("e01", "A"), ("e02", "B")]
    parity = sorted((r.entity_id, r.category or "") for r in attribute(i["asset"], regs, parity=True).collect())
    assert parity == [("e01", "A"), ("e01", "A"), ("e02", ""), ("e02", "B")]
