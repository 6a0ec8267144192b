"""Run checks: data freshness against the as-of parameter, and a quality
report of the conditions the original job either failed on or passed
silently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.functions.predicates import day_literal
from covtab.params import CATEGORY_DOMAIN

QUALITY_COLUMNS = ("check", "subject", "value")


def freshness(facts: DataFrame, asof, period: str = "period_end") -> DataFrame:
    """One row: newest period end in the facts, the as-of day, and whether
    they agree. The as-of day limits only the dimensions, so a mismatch means
    facts and dimensions describe different days. The reduced facts do as
    well, with ``period="direct_on"``: they have each group's newest period."""
    day = day_literal(asof)
    latest = F.max(period)
    return facts.agg(
        latest.alias("latest_period"),
        day.alias("asof"),
        F.coalesce(latest == day, F.lit(False)).alias("ok"),
    )


def _rows(df: DataFrame, check: str, subject, value) -> DataFrame:
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"),
                     value.cast("long").alias("value"))


def quality_report(mapping: DataFrame, cells_primary: DataFrame, cells_secondary: DataFrame,
                   cover_primary: DataFrame, cover_secondary: DataFrame, alive: DataFrame,
                   domain=CATEGORY_DOMAIN) -> DataFrame:
    """``(check, subject, value)`` rows; an empty report means all clear.

    * ``out_of_domain_primary`` / ``out_of_domain_secondary``: counted rows
      whose category is not in the domain (null included); they are published
      in the column ``other``.
    * ``negative_unknown_primary`` / ``negative_unknown_secondary``: orgs
      where known exceeds alive (suppression would fail on them).
    * ``facility_fanout``: facilities that map to more than one org row on
      the as-of day (their registrations are counted once per org row).
    * ``nameless_org``: orgs of the population ``alive`` that have a code but
      no name; they are in no table.
    """
    dom = [F.lit(c) for c in domain]

    def ood(cells: DataFrame, name: str) -> DataFrame:
        bad = cells.where(F.col("category").isNull() | ~F.col("category").isin(*dom))
        g = bad.groupBy("category").agg(F.sum("n").alias("v"))
        return _rows(g, name, F.coalesce(F.col("category"), F.lit("<null>")), F.col("v"))

    def neg(cover: DataFrame, name: str) -> DataFrame:
        return _rows(cover.where(F.col("unknown") < 0), name, F.col("org_name"), F.col("unknown"))

    fan = (
        mapping.groupBy("facility_code").agg(F.count(F.lit(1)).alias("v")).where(F.col("v") > 1)
    )
    return (
        ood(cells_primary, "out_of_domain_primary")
        .unionByName(ood(cells_secondary, "out_of_domain_secondary"))
        .unionByName(neg(cover_primary, "negative_unknown_primary"))
        .unionByName(neg(cover_secondary, "negative_unknown_secondary"))
        .unionByName(_rows(fan, "facility_fanout", F.col("facility_code"), F.col("v")))
        .unionByName(_rows(alive.where("org_name IS NULL AND org_code IS NOT NULL"), "nameless_org", F.col("org_code"),
                           F.col("alive")))
    )


#: Checks that stop publication: suppression fails on a negative count.
BLOCKING = ("negative_unknown_primary", "negative_unknown_secondary")


def blocking(quality: DataFrame) -> DataFrame:
    return quality.where(F.col("check").isin(*BLOCKING))
