"""Entity resolution: one category per entity.

Rule (kept from the original job): among all observations of an entity keep
those at its latest date; among those keep the lowest priority; keep the
entity only if exactly one (category, source) is left. Null entities and
null dates never take part.

Two forms are provided:

* the staged building blocks :func:`latest_per_key`, :func:`best_priority`
  and :func:`drop_conflicts`, each usable on any table;
* the fused form :func:`resolve_entities`, without a self-join. Level one
  groups by (entity, priority, source, category) with only a date in the
  buffer, so it runs as a hash aggregate with map-side combining; a hot entity
  is reduced inside each map task before anything is shuffled. Level two sees a
  handful of rows per entity, ordered by one long that holds day and priority:
  the first row is the entity's, unless the second has the same key.

:func:`reduce_facts` goes one step further for the full report: a single
scan of the fact table yields everything the report needs per
(entity, facility, mapped category, direct category), so the facts are read
and shuffled once, already combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covtab.functions.predicates import known_code
from covtab.operators.observe import known_concepts
from covtab.params import PRIORITY_CODED, PRIORITY_DIRECT, SOURCE_CODED, SOURCE_DIRECT

RESOLVED_COLUMNS = ("entity_id", "category", "attributed_on", "source")


# --- staged building blocks -------------------------------------------------

def _first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    ranked = df.withColumn("_rank", F.rank().over(Window.partitionBy(key).orderBy(order)))
    return ranked.where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str = "entity_id", date: str = "recorded_on") -> DataFrame:
    """Rows at the latest ``date`` of their ``key``; ties all stay.

    ``df`` is computed once, where a join with the best of each key computed it
    twice at each step. Only rows of rank 1 are asked for, so Spark limits the
    groups of the window in the map tasks: of a very large key only the rows at
    the latest date that a task has seen are shuffled.
    """
    return _first_per_key(df.where(F.col(key).isNotNull() & F.col(date).isNotNull()), key, F.col(date).desc())


def best_priority(df: DataFrame, key: str = "entity_id", priority: str = "priority") -> DataFrame:
    """Rows at the lowest ``priority`` of their ``key``; ties all stay."""
    return _first_per_key(df.where(F.col(key).isNotNull() & F.col(priority).isNotNull()), key, F.col(priority).asc())


def drop_conflicts(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """Rows of keys that have exactly one row. Null keys are dropped.

    One aggregation, combined in the map tasks: a key's number of rows, and one
    of them, which is the row where there is no other.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
    return counted.where("_n = 1").select("_row.*")


def resolve_staged(obs: DataFrame) -> DataFrame:
    """Staged resolution of an observation table (the original plan shape)."""
    r = drop_conflicts(best_priority(latest_per_key(obs)))
    return r.select("entity_id", "category", F.col("recorded_on").alias("attributed_on"), "source")


# --- fused resolution ---------------------------------------------------------

def _order_key(day: Column, priority: Column) -> Column:
    """One long: larger for a later day, and on a day for a lower priority number."""
    return F.unix_date(day).cast("long") * F.lit(1 << 32) - priority


def _first_of_entity(values: DataFrame) -> DataFrame:
    """The row of the largest ``_key`` of each entity, and ``_single``: no other row has that key."""
    by_key = Window.partitionBy("entity_id").orderBy(F.col("_key").desc_nulls_last())
    ranked = values.withColumns({"_nth": F.row_number().over(by_key), "_next": F.lead("_key").over(by_key)})
    single = F.col("_key").isNotNull() & (F.col("_next").isNull() | (F.col("_next") < F.col("_key")))
    return ranked.where("_nth = 1").withColumn("_single", single).drop("_nth", "_next", "_key")


def resolve_entities(obs: DataFrame) -> DataFrame:
    """Fused resolution of an observation table
    ``(entity_id, category, recorded_on, source, priority)``.

    Same rows as :func:`resolve_staged`: a hash aggregate to the values of an
    entity, and a window over the few that are left of each.
    """
    valid = obs.where(
        F.col("entity_id").isNotNull() & F.col("recorded_on").isNotNull() & F.col("category").isNotNull()
    )
    values = valid.groupBy("entity_id", "priority", "source", "category").agg(F.max("recorded_on").alias("attributed_on"))
    first = _first_of_entity(values.withColumn("_key", _order_key(F.col("attributed_on"), F.col("priority"))))
    return first.where("_single").select(*RESOLVED_COLUMNS)


# --- single-scan reduction of the facts ---------------------------------------

REDUCED_COLUMNS = ("entity_id", "facility_code", "mapped_category", "direct_category",
                   "mapped_on", "direct_on", "alive")


def reduce_facts(facts: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Collapse the fact table to one row per
    (entity, facility, mapped category, direct category).

    Unknown codes become null keys, so all uninformative rows of a
    registration collapse into one. Per row: latest record date of the mapped
    category, latest period end of the direct category, and whether any
    source row has no death date. This is the only pass over the facts;
    resolution, living test and registrations all derive from it. Rows without
    an entity have no category to settle, so they are one row for a facility,
    however many they are.
    """
    joined = facts.join(known_concepts(concept_map), "concept_code", "left")
    named = F.col("entity_id").isNotNull()
    mapped = F.when(named, F.col("category"))
    direct = F.when(named & known_code("direct_category"), F.col("direct_category"))
    return joined.groupBy(
        "entity_id", "facility_code", mapped.alias("mapped_category"), direct.alias("direct_category")
    ).agg(
        F.max("record_date").alias("mapped_on"),
        F.max("period_end").alias("direct_on"),
        F.bool_or(F.col("death_date").isNull()).alias("alive"),
    )


def by_entity(reduced: DataFrame) -> DataFrame:
    """:func:`reduce_facts` output laid out by entity: one partitioning and one
    sort that the (entity, facility) pairs, the resolution and the join on
    entity all use. Its rows are combined already, so an entity that many facts
    name is a few rows per facility here."""
    # A given number of partitions is kept as it is; later steps ask for the same.
    partitions = int(reduced.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return reduced.repartition(partitions, "entity_id").sortWithinPartitions("entity_id", "facility_code")


def resolve_reduced(reduced: DataFrame) -> DataFrame:
    """Per entity: the resolved category (null if none or ambiguous) and the
    living flag, from :func:`reduce_facts` output. A hash aggregate to the
    values of an entity and a window over them; rows that are laid out by entity
    are not shuffled."""

    def value(category: str, day: str, priority: int, source: str) -> Column:
        ok = F.col(category).isNotNull() & F.col(day).isNotNull()
        return F.struct(F.when(ok, F.col(category)).alias("category"), F.when(ok, F.lit(source)).alias("source"),
                        F.when(ok, F.col(day)).alias("day"), F.when(ok, _order_key(F.col(day), F.lit(priority))).alias("key"))

    both = F.array(value("mapped_category", "mapped_on", PRIORITY_CODED, SOURCE_CODED),
                   value("direct_category", "direct_on", PRIORITY_DIRECT, SOURCE_DIRECT))
    seen = reduced.where(F.col("entity_id").isNotNull()).select("entity_id", "alive", F.explode(both).alias("v"))
    values = seen.groupBy("entity_id", F.col("v.category").alias("category"), F.col("v.source").alias("source")).agg(
        F.max("v.day").alias("attributed_on"), F.max("v.key").alias("_key"), F.bool_or("alive").alias("alive"))
    any_row = F.max("alive").over(Window.partitionBy("entity_id"))
    first = _first_of_entity(values.withColumn("alive", any_row))
    picked = [F.when(F.col("_single"), F.col(c)).alias(c) for c in ("category", "attributed_on", "source")]
    return first.select("entity_id", *picked, "alive")
