"""Living entities, registrations, and attribution of a category asset to
the organisations an entity is registered with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.operators.dims import facility_orgs

REGISTRATION_COLUMNS = ("entity_id", "facility_code", "org_code", "org_name")
ATTRIBUTION_COLUMNS = ("entity_id", "facility_code", "org_code", "org_name", "category", "attributed_on", "source")


def living(facts: DataFrame) -> DataFrame:
    """Distinct entities with at least one fact row without a death date.

    The test is per row: an entity with one dated and one undated row is
    living. A null entity can appear here but never matches a join.
    """
    return facts.where(F.col("death_date").isNull()).select("entity_id").distinct()


def keep_living(asset: DataFrame, living_ids: DataFrame) -> DataFrame:
    """Asset rows of living entities (semi-join)."""
    return asset.join(living_ids, "entity_id", "left_semi")


def register_pairs(pairs: DataFrame, mapping: DataFrame, nth: str | None = None, apart: bool = True) -> DataFrame:
    """Distinct (entity, facility) pairs looked up in the map. Pairs without a
    facility are set aside first: they match nothing, and there may be very many
    of them; not so (``apart=False``) if pairs are counted by facility already.
    With ``nth``, a column of that name counts a facility's org rows from 1."""
    orgs = facility_orgs(mapping)
    extra = ["org_code", "org_name"]
    if nth:
        orgs = orgs.withColumn(nth, F.row_number().over(Window.partitionBy("facility_code").orderBy(*extra)))
        extra.append(nth)
    columns = [*pairs.columns, *extra]
    if not apart:
        return pairs.join(orgs, "facility_code", "left").select(*columns)
    named = pairs.where(F.col("facility_code").isNotNull()).join(orgs, "facility_code", "left")
    nowhere = pairs.where(F.col("facility_code").isNull()).select(
        "*", *[F.lit(None).cast(orgs.schema[c].dataType).alias(c) for c in extra])
    return named.select(*columns).union(nowhere.select(*columns))


def registrations(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct (entity, facility, org code, org name) over living fact rows.

    The living test is per row here too. A facility missing from the map
    keeps its row with a null org; a facility mapped to several org rows
    yields one registration per org row. Distinct (entity, facility) pairs
    are formed first (hash aggregate, combined per map task), then looked up,
    so the map never meets the raw facts.
    """
    pairs = facts.where(F.col("death_date").isNull()).select("entity_id", "facility_code").distinct()
    return register_pairs(pairs, mapping)


def registrations_reduced(reduced: DataFrame, mapping: DataFrame) -> DataFrame:
    """:func:`registrations` from :func:`covtab.operators.resolve.reduce_facts` output."""
    pairs = reduced.where(F.col("alive")).select("entity_id", "facility_code").distinct()
    return register_pairs(pairs, mapping)


def asset_values(asset: DataFrame) -> DataFrame:
    """The distinct (entity, category, source) of an asset with the latest
    attribution date of each, without null categories: a hash aggregate,
    combined in the map tasks, so an entity with very many rows is a few here."""
    return asset.where(F.col("category").isNotNull()).groupBy("entity_id", "category", "source").agg(
        F.max("attributed_on").alias("attributed_on"))


def settled_values(values: DataFrame) -> DataFrame:
    """One row per entity of :func:`asset_values`: its category if it has only
    one, with the latest attribution date and that row's source (of several, the
    largest); entities with several categories are dropped."""
    own = Window.partitionBy("entity_id")
    latest = own.orderBy(F.col("attributed_on").desc_nulls_last(), F.col("source").desc_nulls_last())
    ranked = values.withColumns({"_nth": F.row_number().over(latest), "_lo": F.min("category").over(own), "_hi": F.max("category").over(own)})
    return ranked.where("_nth = 1 AND _lo = _hi").select("entity_id", "category", "attributed_on", "source")


def entity_category(asset: DataFrame) -> DataFrame:
    """One row per entity of an asset: its category if the entity's non-null
    categories are all the same, with the latest attribution date and that
    row's source; entities with several categories are dropped."""
    return settled_values(asset_values(asset))


def _one_category(values: DataFrame, key: str) -> DataFrame:
    """The ``key`` of rows (key, category) that have exactly one distinct non-null category."""
    distinct = values.groupBy(key, "category").agg(F.lit(1).alias("_one"))
    return distinct.groupBy(key).agg(F.count("category").alias("_values")).where("_values = 1").select(key)


def _joined_key() -> Column:
    """The registration as one text without separators: ('1', '23') and ('12', '3') are the same."""
    return F.concat("entity_id", "facility_code", "org_code")


def attribute(asset: DataFrame, regs: DataFrame, parity: bool = False, joined_key: bool = False) -> DataFrame:
    """Attach an entity-level category asset to its registrations.

    An entity counts for a (facility, org) registration only if its asset
    rows hold exactly one distinct non-null category. Registrations without
    a facility or an org are dropped (the original key was a concatenation
    that is null when a part is null). Entities without registrations drop
    out, which also removes entities that are not living.

    ``parity=False`` (default): null categories are ignored and each
    registration yields one row, with the latest attribution date and its
    source; the conflict test is an aggregation per entity, so one row per
    entity meets the registrations.

    ``parity=True`` reproduces the original rows: every asset row of an
    unambiguous entity (exact duplicates and null-category rows included)
    joined to every registration. The conflict test depends only on the
    entity's asset rows, so it is computed per entity before the join and not
    per registration; the result is the same. ``joined_key=True`` (with
    ``parity``) makes the test by the original's key, entity, facility and org
    written together, where registrations of several entities can collide; it
    must see every registration of an asset entity.
    """
    keyed = regs.where(
        F.col("entity_id").isNotNull() & F.col("facility_code").isNotNull() & F.col("org_code").isNotNull()
    ).select(*REGISTRATION_COLUMNS)
    if joined_key:
        held = asset.join(keyed, "entity_id", "inner").withColumn("_key", _joined_key())
        return held.join(_one_category(held.select("_key", "category"), "_key"), "_key", "left_semi").select(*ATTRIBUTION_COLUMNS)
    if parity:
        rows = asset.join(_one_category(asset, "entity_id"), "entity_id", "left_semi")
    else:
        rows = entity_category(asset)
    return rows.join(keyed, "entity_id", "inner").select(*ATTRIBUTION_COLUMNS)


def attributed_cells(asset: DataFrame, regs: DataFrame, joined_key: bool = False) -> DataFrame:
    """Counts per (org, category) of :func:`attribute` with ``parity=True``,
    by weights: an entity's asset rows and its registrations are counted
    before they meet, so their product is a number and not rows. With
    ``joined_key`` each registration has a weight of its own."""
    weights = asset.groupBy("entity_id", "category").agg(F.count("*").alias("rows"))
    keyed = regs.where("entity_id IS NOT NULL AND facility_code IS NOT NULL AND org_code IS NOT NULL")
    if joined_key:
        held = weights.join(keyed.select(*REGISTRATION_COLUMNS), "entity_id").withColumn("_key", _joined_key())
        counted = held.join(_one_category(held.select("_key", "category"), "_key"), "_key", "left_semi").withColumn("places", F.lit(1))
    else:
        places = keyed.groupBy("entity_id", "org_code", "org_name").agg(F.count("*").alias("places"))
        counted = weights.join(_one_category(weights, "entity_id"), "entity_id", "left_semi").join(places, "entity_id")
    return counted.groupBy("org_code", "org_name", "category").agg(F.sum(F.col("rows") * F.col("places")).alias("n"))
