"""Disclosure control and rates as Column expressions.

The original job applied a Python function cell by cell on the driver; here
the same rule is a SQL ``CASE`` expression, so it runs wherever the column
lives, inside whole-stage codegen. The rule is written once as SQL text and
parsed on the JVM side in one call (a report applies it to dozens of
columns, and building it node by node from Python costs far more driver time
than running it).

Arguments are column names or SQL expressions over column names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covtab.params import RATE_DECIMALS, ROUND_BASE, SUPPRESS_MAX, SUPPRESSED, UPPER_LIMIT


def _sql(c) -> str:
    if isinstance(c, Column):
        raise TypeError("pass a column name or a SQL expression string")
    c = str(c)
    return f"`{c}`" if c.replace("_", "").isalnum() else f"({c})"


def _checked_case(v: str, inside: str, upper: int, given: str) -> str:
    # Fractions, negative counts and counts above ``upper`` fail the job, as
    # in the original rule (every negative value failed there too).
    return (
        f"CASE WHEN {v} IS NULL THEN NULL "
        f"WHEN CAST({given} AS DOUBLE) <> rint(CAST({given} AS DOUBLE)) "
        f"THEN raise_error(concat('suppress_round: not a whole number ', CAST({given} AS STRING))) "
        f"WHEN {v} < 0 THEN raise_error(concat('suppress_round: negative count ', CAST({v} AS STRING))) "
        f"WHEN {v} > {upper} THEN raise_error(concat('suppress_round: count above {upper}: ', CAST({v} AS STRING))) "
        f"ELSE {inside} END"
    )


def _nearest(v: str, base: int) -> str:
    # floor((v + base div 2) / base) * base in integer arithmetic. Integers
    # never sit exactly halfway between two multiples of an odd base, so this
    # equals both half-up and half-even rounding of v / base.
    return f"(({v} + {base // 2}) - pmod({v} + {base // 2}, {base}))"


def suppress_sql(c, rc: str = SUPPRESSED, base: int = ROUND_BASE, threshold: int = SUPPRESS_MAX, upper: int = UPPER_LIMIT,
                 text: bool = True) -> str:
    """The disclosure rule as SQL text over a column name or SQL expression: the
    published text, or the number (null where suppressed)."""
    v = f"CAST({_sql(c)} AS BIGINT)"
    if text:
        hidden = "'" + rc.replace("'", "''") + "'"
        inside = f"CASE WHEN {v} = 0 THEN '0' WHEN {v} <= {threshold} THEN {hidden} ELSE CAST({_nearest(v, base)} AS STRING) END"
    else:
        inside = (f"CASE WHEN {v} = 0 THEN CAST(0 AS BIGINT) WHEN {v} <= {threshold} THEN CAST(NULL AS BIGINT) "
                  f"ELSE {_nearest(v, base)} END")
    return _checked_case(v, inside, upper, _sql(c))


def rounded_or_null(c, base: int = ROUND_BASE, threshold: int = SUPPRESS_MAX, upper: int = UPPER_LIMIT) -> Column:
    """Numeric twin of :func:`suppress_round`: 0 stays 0, ``1..threshold`` is
    null (suppressed), larger counts are rounded to the nearest ``base``.
    Negative counts and counts above ``upper`` raise. Null stays null."""
    return F.expr(suppress_sql(c, base=base, threshold=threshold, upper=upper, text=False))


def suppress_round(c, rc: str = SUPPRESSED, base: int = ROUND_BASE, threshold: int = SUPPRESS_MAX,
                   upper: int = UPPER_LIMIT) -> Column:
    """Published text of a count: ``'0'``, ``rc`` for ``1..threshold``, else
    the count rounded to the nearest ``base``. A fraction, a negative count or
    one above ``upper`` raises, as in the original rule. Null input gives null
    (fill first)."""
    return F.expr(suppress_sql(c, rc, base, threshold, upper))


def rate_sql(num, den, decimals: int = RATE_DECIMALS) -> str:
    """:func:`rate` as SQL text."""
    scale = float(10 ** decimals)
    q = f"try_divide(CAST({_sql(num)} AS DOUBLE), nullif(CAST({_sql(den)} AS DOUBLE), 0.0D))"
    return f"rint({q} * {scale}D) / {scale}D"


def rate(num, den, decimals: int = RATE_DECIMALS) -> Column:
    """``num / den`` rounded half to even to ``decimals`` places.

    Null when either side is null (suppressed) or the denominator is 0.
    ``rint(x * 10^d) / 10^d`` is the same arithmetic as numpy's round.
    """
    return F.expr(rate_sql(num, den, decimals))


def rate_text(c, rc: str = SUPPRESSED) -> Column:
    """Published text of a rate: the decimal text, or ``rc`` when null."""
    rc_sql = "'" + rc.replace("'", "''") + "'"
    return F.expr(f"coalesce(CAST({_sql(c)} AS STRING), {rc_sql})")
