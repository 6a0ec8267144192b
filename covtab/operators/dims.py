"""Dimension operators: the as-of facility -> org map and the org reference list."""

from __future__ import annotations

from pyspark.sql import DataFrame

from covtab.functions.predicates import valid_asof
from covtab.params import ORG_ATTRIBUTES

ORG_MAP_COLUMNS = ("facility_code", "org_code") + ORG_ATTRIBUTES
ORG_REFERENCE_COLUMNS = ("org_code",) + ORG_ATTRIBUTES


def org_map(facilities: DataFrame, orgs: DataFrame, asof) -> DataFrame:
    """Facilities open on ``asof`` joined to the org that is open on ``asof``.

    Both the open/close interval and the record start/end interval must be
    valid (half-open, see :func:`valid_asof`) on both sides. The join is an
    equi-join on the org code; a facility whose org is missing, closed, or has
    a null code drops out. A facility can map to several org rows if the org
    table holds several valid records for one code (they all stay).

    Both sides are dimensions, so no hint is given: Spark broadcasts by its
    own size estimate, and the result is checked where it meets large data.
    """
    f = facilities.where(
        valid_asof("open_date", "close_date", asof) & valid_asof("record_start", "record_end", asof)
    ).select("facility_code", "org_code")
    o = orgs.where(
        valid_asof("open_date", "close_date", asof) & valid_asof("record_start", "record_end", asof)
    ).select(*ORG_REFERENCE_COLUMNS)
    return f.join(o, "org_code", "inner").select(*ORG_MAP_COLUMNS)


def org_reference(mapping: DataFrame) -> DataFrame:
    """Distinct org rows of the map (the published reference list)."""
    return mapping.select(*ORG_REFERENCE_COLUMNS).distinct()


def facility_orgs(mapping: DataFrame) -> DataFrame:
    """The part of the map a registration needs: facility, org code, org name."""
    return mapping.select("facility_code", "org_code", "org_name").distinct()
