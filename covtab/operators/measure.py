"""Counts per organisation: population, category cells, known, coverage,
and the category cross-tab. Everything after the cells is a few rows per
organisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covtab.params import CATEGORY_DOMAIN, OTHER


def population(regs: DataFrame) -> DataFrame:
    """Registrations per org: ``count(entity_id)``.

    Counts registrations, not distinct people: an entity registered at two
    facilities of one org counts twice (kept from the original). The row
    with a null org collects registrations that map nowhere.
    """
    return regs.groupBy("org_code", "org_name").agg(F.count("entity_id").alias("alive"))


def category_cells(attributed: DataFrame) -> DataFrame:
    """Attributed rows per (org, category)."""
    return attributed.groupBy("org_code", "org_name", "category").agg(F.count("entity_id").alias("n"))


def known_by_org(cells: DataFrame) -> DataFrame:
    """Sum of the category cells per org."""
    return cells.groupBy("org_name", "org_code").agg(F.sum("n").cast("long").alias("known"))


def _org_join(left: DataFrame, right: DataFrame, parity: bool):
    if parity:
        return left["org_name"] == right["_r_name"]
    return left["org_name"].eqNullSafe(right["_r_name"]) & left["org_code"].eqNullSafe(right["_r_code"])


def coverage(pop: DataFrame, known: DataFrame, parity: bool = False) -> DataFrame:
    """Known, alive and unknown per named org (unrounded Table 1 / Table 2).

    Orgs without a name are dropped. ``parity=False``: joined on
    (org name, org code); an org with no known entity gets its code from the
    population side, known 0 and unknown = alive. ``parity=True`` reproduces
    the original join on the name alone, where such an org has a null code,
    known and unknown.
    """
    k = known.select(F.col("org_name").alias("_r_name"), F.col("org_code").alias("_r_code"), "known")
    p = pop.where(F.col("org_name").isNotNull())
    j = p.join(k, _org_join(p, k, parity), "left")
    if parity:
        return j.select(
            "org_name",
            F.col("_r_code").alias("org_code"),
            F.col("known"),
            F.col("alive"),
            (F.col("alive") - F.col("known")).alias("unknown"),
        )
    known_or_zero = F.coalesce(F.col("known"), F.lit(0).cast("long"))
    return j.select(
        "org_name",
        "org_code",
        known_or_zero.alias("known"),
        F.col("alive"),
        (F.col("alive") - known_or_zero).alias("unknown"),
    )


def _by_category(category: Column, domain, other: bool = True, present: Column | None = None) -> list[Column]:
    """Sums of ``n`` by category of the domain, and of what lies outside."""
    present = F.lit(True) if present is None else present
    outside = present & ~F.coalesce(category.isin(*domain), F.lit(False))
    sums = [F.sum(F.when(category == c, F.col("n"))).cast("long").alias(c) for c in domain]
    return sums + [F.sum(F.when(outside, F.col("n"))).cast("long").alias(OTHER)] * other


def crosstab(cells: DataFrame, cover: DataFrame, domain=CATEGORY_DOMAIN, parity: bool = False) -> DataFrame:
    """Category counts as columns, one row per org with cells, plus the
    unknown count from the coverage table (unrounded Table 3a).

    The domain is explicit, so no extra job discovers it and the column set is
    fixed; counts of categories outside it, which the coverage table has as
    known, are in the column ``other``. An empty cell is null. Orgs without a
    name are dropped, as from the coverage table. ``parity=True`` has neither:
    only the domain's columns, and nameless orgs stay.
    """
    named = cells if parity else cells.where(F.col("org_name").isNotNull())
    wide = named.groupBy("org_name", "org_code").agg(*_by_category(F.col("category"), domain, other=not parity))
    u = cover.select(F.col("org_name").alias("_r_name"), F.col("org_code").alias("_r_code"), "unknown")
    j = wide.join(u, _org_join(wide, u, parity), "left")
    return j.select("org_name", "org_code", *wide.columns[2:], "unknown")


def _with_categories(rows: DataFrame, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    p = primary.select("entity_id", F.col("category").alias("p_cat"))
    s = secondary.select("entity_id", F.col("category").alias("s_cat"))
    return rows.join(p, "entity_id", "left").join(s, "entity_id", "left")


def pair_counts(pairs: DataFrame, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """(entity, facility) pairs counted per (facility, whether they have an
    entity, primary category, secondary category): ``pairs``. Pairs that lie by
    entity meet the categories where they are, and only counts go on to the map."""
    return _with_categories(pairs, primary, secondary).groupBy(
        "facility_code", F.col("entity_id").isNotNull().alias("named"), "p_cat", "s_cat").agg(F.count("*").alias("pairs"))


def counted_cube(regs: DataFrame) -> DataFrame:
    """:func:`registration_cube` of :func:`pair_counts` that were looked up in the map."""
    keyed = F.col("named") & F.col("facility_code").isNotNull() & F.col("org_code").isNotNull()
    return regs.groupBy(
        "org_code", "org_name", keyed.alias("keyed"),
        F.when(keyed, F.col("p_cat")).alias("p_cat"), F.when(keyed, F.col("s_cat")).alias("s_cat"),
    ).agg(F.sum(F.when(F.col("named"), F.col("pairs")).otherwise(0)).alias("n"))


def registration_cube(regs: DataFrame, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """All per-org counts of the report in one aggregation.

    ``primary`` and ``secondary``: one row per entity, ``(entity_id,
    category)``, category null when the entity does not count. Each
    registration is tagged with both categories (two joins on entity; both
    sides are aggregates already partitioned by entity, and one row per
    entity, so a hot entity cannot skew them) and counted per
    (org, keyed, primary category, secondary category). The result has at
    most orgs x categories^2 rows; population, both cell tables and known
    are sums over it (:func:`cube_population`, :func:`cube_cells`).

    ``keyed``: the registration has an entity, a facility and an org, so it
    can carry a category (the original dropped the rest from the cells but
    kept them in the population).
    """
    keyed = F.col("entity_id").isNotNull() & F.col("facility_code").isNotNull() & F.col("org_code").isNotNull()
    return _with_categories(regs, primary, secondary).groupBy(
        "org_code", "org_name", keyed.alias("keyed"),
        F.when(keyed, F.col("p_cat")).alias("p_cat"), F.when(keyed, F.col("s_cat")).alias("s_cat"),
    ).agg(F.count("entity_id").alias("n"))


def cube_population(cube: DataFrame) -> DataFrame:
    """:func:`population` from :func:`registration_cube` output."""
    return cube.groupBy("org_code", "org_name").agg(F.sum("n").cast("long").alias("alive"))


def cube_cells(cube: DataFrame, side: str) -> DataFrame:
    """:func:`category_cells` of the primary (``side="p"``) or secondary
    (``side="s"``) categories from :func:`registration_cube` output."""
    c = f"{side}_cat"
    return (
        cube.where(F.col(c).isNotNull())
        .groupBy("org_code", "org_name", F.col(c).alias("category"))
        .agg(F.sum("n").cast("long").alias("n"))
    )


def cube_summary(cube: DataFrame, domain=CATEGORY_DOMAIN) -> DataFrame:
    """Everything the tables say of a named org, in one aggregation of
    :func:`registration_cube` output: ``alive``, ``known_p``, ``known_s`` (null
    without any) and the secondary counts by category."""
    p, s = F.col("p_cat"), F.col("s_cat")
    return cube.where(F.col("org_name").isNotNull()).groupBy("org_name", "org_code").agg(
        F.sum("n").cast("long").alias("alive"),
        F.sum(F.when(p.isNotNull(), F.col("n"))).cast("long").alias("known_p"),
        F.sum(F.when(s.isNotNull(), F.col("n"))).cast("long").alias("known_s"),
        *_by_category(s, domain, present=s.isNotNull()))


def summary_coverage(summary: DataFrame, side: str) -> DataFrame:
    """:func:`coverage` of the primary (``side="p"``) or secondary (``"s"``) source."""
    known = F.coalesce(F.col(f"known_{side}"), F.lit(0).cast("long"))
    return summary.select("org_name", "org_code", known.alias("known"), "alive", (F.col("alive") - known).alias("unknown"))


def summary_crosstab(summary: DataFrame, domain=CATEGORY_DOMAIN) -> DataFrame:
    """:func:`crosstab` of the secondary source."""
    return summary.where(F.col("known_s").isNotNull()).select(
        "org_name", "org_code", *domain, OTHER, (F.col("alive") - F.col("known_s")).alias("unknown"))
