"""Readers for the five role tables.

A source is a DataFrame, a catalog table name, or a parquet path. Each
reader renames (optional) and casts to the library's schema once, at the
edge, so every operator downstream can rely on the types: identifiers and
codes are strings, dates are ``date`` (timestamps are cut to the day).
Only the listed columns are selected, so parquet scans read nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_SCHEMA = {
    "entity_id": "string",
    "facility_code": "string",
    "concept_code": "string",
    "record_date": "date",
    "direct_category": "string",
    "period_end": "date",
    "death_date": "date",
}

CONCEPT_MAP_SCHEMA = {"concept_code": "string", "category": "string"}

FACILITY_SCHEMA = {
    "facility_code": "string",
    "org_code": "string",
    "open_date": "date",
    "close_date": "date",
    "record_start": "date",
    "record_end": "date",
}

ORG_SCHEMA = {
    "org_code": "string",
    "org_name": "string",
    "national_grouping": "string",
    "high_level_geography": "string",
    "address_line_1": "string",
    "address_line_2": "string",
    "address_line_3": "string",
    "address_line_4": "string",
    "address_line_5": "string",
    "postcode": "string",
    "open_date": "date",
    "close_date": "date",
    "sub_type_code": "string",
    "record_start": "date",
    "record_end": "date",
    "created_on": "date",
    "updated_on": "date",
}

ASSET_SCHEMA = {
    "entity_id": "string",
    "category": "string",
    "attributed_on": "date",
    "source": "string",
}

SCHEMAS = {
    "facts": FACT_SCHEMA,
    "concept_map": CONCEPT_MAP_SCHEMA,
    "facilities": FACILITY_SCHEMA,
    "orgs": ORG_SCHEMA,
    "asset": ASSET_SCHEMA,
}


def load(spark: SparkSession, source) -> DataFrame:
    """DataFrame as is; ``*.parquet`` / path with a slash via parquet; else a catalog table."""
    if isinstance(source, DataFrame):
        return source
    text = str(source)
    if "/" in text or text.endswith(".parquet"):
        return spark.read.parquet(text)
    return spark.table(text)


def conform(df: DataFrame, schema: Mapping[str, str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """Rename ``{source_column: role_column}`` and cast to ``schema``.

    Fails early with the list of missing columns.
    """
    if rename:
        df = df.select([F.col(c).alias(rename.get(c, c)) for c in df.columns])
    missing = [c for c in schema if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}; has {df.columns}")
    out = []
    for name, typ in schema.items():
        col = F.col(name)
        if typ == "date":
            col = F.to_date(col)
        else:
            col = col.cast(typ)
        out.append(col.alias(name))
    return df.select(out)


def read_role(spark: SparkSession, role: str, source, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Read one role table (``facts``, ``concept_map``, ``facilities``, ``orgs``, ``asset``)."""
    return conform(load(spark, source), SCHEMAS[role], rename)


def read_inputs(spark: SparkSession, sources: Mapping[str, object],
                renames: Mapping[str, Mapping[str, str]] | None = None) -> dict[str, DataFrame]:
    """Read all role tables given as ``{role: source}``."""
    renames = renames or {}
    return {role: read_role(spark, role, src, renames.get(role)) for role, src in sources.items()}
