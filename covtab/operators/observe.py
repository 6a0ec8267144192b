"""Observation operators: turn coded facts into (entity, date, category) rows.

Two sources feed the resolution: the coded concept of a record mapped to a
category (priority 1), and the category written directly on the record
(priority 2). Each is cleaned of unknown codes and de-duplicated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.functions.predicates import known_code
from covtab.params import PRIORITY_CODED, PRIORITY_DIRECT, SOURCE_CODED, SOURCE_DIRECT

OBS_COLUMNS = ("entity_id", "category", "recorded_on", "source", "priority")


def known_concepts(concept_map: DataFrame) -> DataFrame:
    """The distinct (concept, known category) pairs of the map; repeated map
    rows and unknown categories never meet the facts."""
    return concept_map.where(known_code("category")).select("concept_code", "category").distinct()


def mapped_codes(facts: DataFrame, concept_map: DataFrame) -> DataFrame:
    """Fact rows whose concept maps to a known category.

    The original left join plus a not-null filter is an inner join. A concept
    mapped to two categories yields two rows (a conflict later on). No hint is
    given: Spark broadcasts the map by its size in bytes.
    """
    return (
        facts.select("entity_id", "concept_code", "record_date")
        .join(known_concepts(concept_map), "concept_code", "inner")
        .select("entity_id", "concept_code", "record_date", "category")
    )


def direct_codes(facts: DataFrame) -> DataFrame:
    """Fact rows whose direct category field is a known code.

    No concept-map join is needed here; it only duplicated rows that the
    de-duplication removes anyway.
    """
    return (
        facts.where(known_code("direct_category"))
        .select("entity_id", "period_end", F.col("direct_category").alias("category"))
    )


def dedupe_observations(rows: DataFrame, entity: str = "entity_id", date: str = "record_date",
                        value: str = "category") -> DataFrame:
    """One row per (entity, date, value), with the number of source rows."""
    return rows.groupBy(entity, date, value).agg(F.count(F.lit(1)).alias("n_records"))


def tag(rows: DataFrame, date: str, source: str, priority: int, entity: str = "entity_id",
        value: str = "category") -> DataFrame:
    """Observation rows in the common shape, tagged with source and priority."""
    return rows.select(
        F.col(entity).alias("entity_id"),
        F.col(value).alias("category"),
        F.col(date).alias("recorded_on"),
        F.lit(source).alias("source"),
        F.lit(priority).alias("priority"),
    )


def union_observations(coded: DataFrame, direct: DataFrame) -> DataFrame:
    """Both tagged sources as one observation table.

    The source tags differ, so on rows that are distinct within a source a
    plain union equals the original ``UNION`` without its extra shuffle.
    """
    return tag(coded, "record_date", SOURCE_CODED, PRIORITY_CODED).unionByName(
        tag(direct, "period_end", SOURCE_DIRECT, PRIORITY_DIRECT)
    )


def candidate_observations(facts: DataFrame, concept_map: DataFrame) -> DataFrame:
    """All observations of both sources in the common shape. Not deduplicated:
    resolution takes the latest date per value anyway, in its first aggregation."""
    return union_observations(mapped_codes(facts, concept_map), direct_codes(facts))
