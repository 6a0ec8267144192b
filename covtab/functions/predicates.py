"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covtab.params import UNKNOWN_CODES, as_date


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known_code(c) -> Column:
    """A category code that is present and not an "unknown" sentinel.

    Null is rejected (three-valued logic of the original chained ``!=``
    filters). The match is exact: two spaces or ``"Z "`` are *not* unknown.
    """
    c = _col(c)
    return c.isNotNull() & ~c.isin(*UNKNOWN_CODES)


def day_literal(asof) -> Column:
    """The as-of day as a typed ``date`` literal (parsed once, on the driver)."""
    return asof if isinstance(asof, Column) else F.lit(as_date(asof))


def valid_asof(start, end, asof) -> Column:
    """Half-open validity ``[start, end)`` on day ``asof``.

    A null end means "still open"; a null start is never valid. Timestamps
    are compared as dates, so a start later on the as-of day still counts.
    """
    day = day_literal(asof)
    s = F.to_date(_col(start))
    e = F.to_date(_col(end))
    return (s <= day) & (e.isNull() | (e > day))
