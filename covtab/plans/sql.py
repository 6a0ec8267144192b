"""SQL with parameters over the role tables and the report's stages.

The original job pasted its reporting date into the text of its SQL cells. Here
the text stays as it is and the date is bound (``spark.sql(text, args=...)``),
so one text serves every date and a malformed one fails before anything runs.
The rules of the report are SQL functions, so a check written in SQL uses the
same ones as the library; Spark inlines them into the plan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from covtab.functions.disclosure import rate_sql, suppress_sql
from covtab.params import UNKNOWN_CODES, as_date

PREFIX = "covtab_"

#: Facilities and orgs valid on a day, with the records that name them and the
#: share of those with a known direct category.
RECORDS_BY_ORG = """
WITH places AS (
    SELECT f.facility_code, o.org_code, o.org_name
    FROM covtab_facilities f JOIN covtab_orgs o ON o.org_code = f.org_code
    WHERE covtab_valid_asof(f.open_date, f.close_date, :asof) AND covtab_valid_asof(f.record_start, f.record_end, :asof)
      AND covtab_valid_asof(o.open_date, o.close_date, :asof) AND covtab_valid_asof(o.record_start, o.record_end, :asof)
), seen AS (
    SELECT facility_code, count(*) AS n, count_if(covtab_known_code(direct_category)) AS known
    FROM covtab_facts GROUP BY facility_code
), by_org AS (
    SELECT org_code, org_name, sum(n) AS n, sum(known) AS known FROM places JOIN seen USING (facility_code) GROUP BY org_code, org_name
)
SELECT :asof AS as_of, org_code, org_name, covtab_suppress_round(n) AS records, covtab_suppress_round(known) AS known,
       covtab_rate(covtab_rounded(known), covtab_rounded(n)) AS share
FROM by_org
"""


def register_functions(spark: SparkSession) -> list[str]:
    """The report's rules as temporary SQL functions of the session:
    ``covtab_known_code(code)``, ``covtab_valid_asof(start, end, day)``,
    ``covtab_suppress_round(count)``, ``covtab_rounded(count)`` (the number, null
    where suppressed) and ``covtab_rate(part, whole)``. Returns their names."""
    codes = ", ".join(f"'{c}'" for c in UNKNOWN_CODES)
    bodies = {
        "known_code(c STRING) RETURNS BOOLEAN": f"c IS NOT NULL AND c NOT IN ({codes})",
        "valid_asof(since DATE, until DATE, day DATE) RETURNS BOOLEAN": "since <= day AND (until IS NULL OR until > day)",
        "suppress_round(n BIGINT) RETURNS STRING": suppress_sql("n"),
        "rounded(n BIGINT) RETURNS BIGINT": suppress_sql("n", text=False),
        "rate(part DOUBLE, whole DOUBLE) RETURNS DOUBLE": rate_sql("part", "whole"),
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {PREFIX}{head} RETURN {body}")
    return [PREFIX + head.split("(")[0] for head in bodies]


def register_inputs(inputs: Mapping[str, DataFrame]) -> list[str]:
    """The role tables as temporary views ``covtab_facts``, ``covtab_orgs`` ..."""
    for role, df in inputs.items():
        df.createOrReplaceTempView(PREFIX + role)
    return [PREFIX + role for role in inputs]


def run_sql(spark: SparkSession, text: str, asof, **args) -> DataFrame:
    """``text`` with ``:asof`` bound to a date, parsed here, and other named
    parameters to ``args``. Views and functions are the session's."""
    return spark.sql(text, args={"asof": as_date(asof), **args})
