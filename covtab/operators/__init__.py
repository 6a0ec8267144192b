"""DataFrame -> DataFrame operators. Each works alone on any table with the
named columns; :mod:`covtab.plans.report` wires them into the full report."""

from covtab.operators.attribute import (
    attribute,
    attributed_cells,
    asset_values,
    entity_category,
    register_pairs,
    settled_values,
    keep_living,
    living,
    registrations,
    registrations_reduced,
)
from covtab.operators.dims import facility_orgs, org_map, org_reference
from covtab.operators.disclose import (
    coverage_table,
    crosstab_table,
    publish_coverage,
    publish_crosstab,
    publish_rates,
    rate_crosstab,
    rate_table,
    suppress_table,
    to_text,
    with_rate,
    with_total,
)
from covtab.operators.measure import (
    category_cells,
    counted_cube,
    coverage,
    crosstab,
    cube_cells,
    cube_population,
    cube_summary,
    known_by_org,
    pair_counts,
    population,
    registration_cube,
    summary_coverage,
    summary_crosstab,
)
from covtab.operators.observe import (
    candidate_observations,
    dedupe_observations,
    direct_codes,
    known_concepts,
    mapped_codes,
    tag,
    union_observations,
)
from covtab.operators.resolve import (
    best_priority,
    by_entity,
    drop_conflicts,
    latest_per_key,
    reduce_facts,
    resolve_entities,
    resolve_reduced,
    resolve_staged,
)

__all__ = [n for n in dir() if not n.startswith("_")]
