"""Total row, disclosure control, rates and published text.

The original job did these steps in pandas on the driver. Here each is a
DataFrame operator over the (tiny) per-org tables, so the report never
leaves Spark. Measures stay numeric until :func:`to_text`: a suppressed
count is null in the numeric form and ``*`` in the text form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covtab.functions.disclosure import rate, rate_text, rounded_or_null
from covtab.params import CATEGORY_DOMAIN, OTHER, SUPPRESSED, TOTAL_CODE, TOTAL_NAME

LABELS = ("org_name", "org_code")


def with_total(df: DataFrame, measures: Sequence[str], labels: Sequence[str] = LABELS,
               parity: bool = False) -> DataFrame:
    """Add a grand-total row: column sums of the unrounded measures.

    One pass with ``GROUPING SETS ((row), ())``: rows are grouped by a number
    of their own, so rows with equal labels stay apart. Sums skip nulls; a
    column that is null everywhere stays null (fill it afterwards). The
    total row is labelled ``TOTAL`` / ``ZZZTOTAL``. ``parity=True`` fills the
    labels of *every* row that has a null label, as the original did.
    """
    labels = list(labels)
    own = [*labels, "_row"]
    g = df.withColumn("_row", F.monotonically_increasing_id()).groupingSets([own, []], *own).agg(
        *[F.expr(f"CAST(sum(`{m}`) AS BIGINT) AS `{m}`") for m in measures], F.grouping_id().alias("_g"))
    total = F.col("_g") > 0
    fills = [TOTAL_NAME, TOTAL_CODE] + [TOTAL_NAME] * max(0, len(labels) - 2)
    out = []
    for lab, fill in zip(labels, fills):
        if parity:
            out.append(F.coalesce(F.col(lab), F.lit(fill)).alias(lab))
        else:
            out.append(F.when(total, F.lit(fill)).otherwise(F.col(lab)).alias(lab))
    return g.select(*out, *measures)


def _measures(df: DataFrame, domain) -> list[str]:
    """The measure columns of a cross-tab, with or without ``other``."""
    return [c for c in (*domain, OTHER, "unknown") if c in df.columns]


def suppress_table(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Nulls filled with 0, then counts suppressed and rounded (numeric form:
    suppressed = null). A negative count or one above the limit fails the
    job with a clear message, as the original rule did."""
    repl = {m: rounded_or_null(f"coalesce(`{m}`, 0)").alias(m) for m in measures}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def with_rate(df: DataFrame, num: str = "known", den: str = "alive", out: str = "percentage") -> DataFrame:
    """Rate of two rounded counts, 3 dp half-even; null if either is
    suppressed or the denominator is 0 (the original failed instead)."""
    return df.withColumn(out, rate(num, den))


def rate_crosstab(t3a: DataFrame, t2: DataFrame, domain=CATEGORY_DOMAIN, parity: bool = False,
                  measures: Sequence[str] | None = None) -> DataFrame:
    """Table 3b: each rounded cross-tab count divided by the rounded alive
    count of the same org in Table 2 (the TOTAL rows meet each other)."""
    measures = list(measures) if measures is not None else _measures(t3a, domain)
    a = t2.select(F.col("org_name").alias("_r_name"), F.col("org_code").alias("_r_code"), F.col("alive").alias("_alive"))
    if parity:
        cond = t3a["org_name"] == a["_r_name"]
    else:
        cond = t3a["org_name"].eqNullSafe(a["_r_name"]) & t3a["org_code"].eqNullSafe(a["_r_code"])
    j = t3a.join(a, cond, "left")
    return j.select("org_name", "org_code", *[rate(m, "_alive").alias(m) for m in measures])


def to_text(df: DataFrame, counts: Sequence[str] = (), rates: Sequence[str] = (), rc: str = SUPPRESSED) -> DataFrame:
    """Published text form: every column a string; a null count or rate is ``rc``."""
    rc_sql = "'" + rc.replace("'", "''") + "'"
    cols = []
    for c in df.columns:
        if c in rates:
            cols.append(rate_text(c, rc).alias(c))
        elif c in counts:
            cols.append(F.expr(f"coalesce(CAST(`{c}` AS STRING), {rc_sql}) AS `{c}`"))
        else:
            cols.append(F.expr(f"CAST(`{c}` AS STRING) AS `{c}`"))
    return df.select(*cols)


def coverage_table(cover: DataFrame, parity: bool = False) -> DataFrame:
    """Table 1 / Table 2 in numeric form: total row, suppression, rate."""
    m = ["known", "alive", "unknown"]
    return with_rate(suppress_table(with_total(cover, m, parity=parity), m))


def crosstab_table(xtab: DataFrame, domain=CATEGORY_DOMAIN, parity: bool = False) -> DataFrame:
    """Table 3a in numeric form: total row and suppression."""
    m = _measures(xtab, domain)
    return suppress_table(with_total(xtab, m, parity=parity), m)


def publish_coverage(t: DataFrame) -> DataFrame:
    return to_text(t, counts=("known", "alive", "unknown"), rates=("percentage",))


def publish_crosstab(t: DataFrame, domain=CATEGORY_DOMAIN) -> DataFrame:
    return to_text(t, counts=_measures(t, domain))


def publish_rates(t: DataFrame, domain=CATEGORY_DOMAIN) -> DataFrame:
    return to_text(t, rates=_measures(t, domain))


def rate_table(summary: DataFrame, domain=CATEGORY_DOMAIN) -> DataFrame:
    """Table 3b in numeric form from :func:`covtab.operators.measure.cube_summary`
    alone: counts and the alive count of each org are rounded side by side. The
    TOTAL row divides sums over orgs with cells by the alive count of all orgs."""
    m = [*domain, OTHER, "unknown"]
    has = F.col("known_s").isNotNull()
    wide = summary.select("org_name", "org_code", *domain, OTHER, F.when(has, F.col("alive") - F.col("known_s")).alias("unknown"),
                          "alive", F.when(has, F.lit(1)).alias("has"))
    rounded = suppress_table(with_total(wide, [*m, "alive", "has"]), [*m, "alive"])
    return rounded.where("has > 0").select("org_name", "org_code", *[rate(c, "alive").alias(c) for c in m])
