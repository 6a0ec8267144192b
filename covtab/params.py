"""Fixed values and the job parameter object.

Everything a run needs besides the tables lives here, so a caller can see the
whole contract of the report in one place.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written: the published tables are
# only comparable between runs (and with earlier publications) if the codes,
# the category domain, the labels and the disclosure rule are unchanged.
# ---------------------------------------------------------------------------

# Codes that mean "category not known", matched exactly (case and spaces count).
UNKNOWN_CODES = ("Z", "z", "X", "x", "99", "9", "", " ")

# The published category domain, in column order of the cross-tab.
CATEGORY_DOMAIN = (
    "A", "B", "C", "D", "E", "F", "G", "H", "J",
    "K", "L", "M", "N", "P", "R", "S", "T", "W",
)

# Column of the cross-tab for categories outside the domain.
OTHER = "other"

# Observation sources and their priority (lower wins on a date tie).
SOURCE_CODED = "coded_record"
SOURCE_DIRECT = "direct_field"
PRIORITY_CODED = 1
PRIORITY_DIRECT = 2

# Disclosure control: 0 stays 0, 1..SUPPRESS_MAX becomes SUPPRESSED, larger
# values are rounded to the nearest ROUND_BASE, values above UPPER_LIMIT and
# negative values are errors.
SUPPRESS_MAX = 7
ROUND_BASE = 5
UPPER_LIMIT = 100_000_000_000
SUPPRESSED = "*"

# Labels of the grand-total row.
TOTAL_NAME = "TOTAL"
TOTAL_CODE = "ZZZTOTAL"

# Rates are published with this many decimals, rounded half to even.
RATE_DECIMALS = 3

# ---------------------------------------------------------------------------
# Column names of the role tables (see README "Data model").
# ---------------------------------------------------------------------------

ENTITY = "entity_id"
FACILITY = "facility_code"
CONCEPT = "concept_code"
RECORD_DATE = "record_date"
DIRECT = "direct_category"
PERIOD_END = "period_end"
DEATH = "death_date"
CATEGORY = "category"
ORG = "org_code"
ORG_NAME = "org_name"
ATTRIBUTED_ON = "attributed_on"
SOURCE = "source"
PRIORITY = "priority"

ORG_ATTRIBUTES = (
    "org_name", "national_grouping", "high_level_geography",
    "address_line_1", "address_line_2", "address_line_3", "address_line_4",
    "address_line_5", "postcode", "open_date", "close_date", "sub_type_code",
    "record_start", "record_end", "created_on", "updated_on",
)

# Measure columns of the coverage tables.
KNOWN = "known"
ALIVE = "alive"
UNKNOWN = "unknown"
PERCENTAGE = "percentage"


def as_date(value) -> _dt.date:
    """Parse the as-of parameter once; a malformed value fails here, not mid-job."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if isinstance(value, str):
        return _dt.date.fromisoformat(value.strip())
    raise TypeError(f"as-of date must be a date or ISO text, got {type(value).__name__}")


@dataclass(frozen=True)
class JobParams:
    """Parameters of one report run.

    ``asof`` limits the dimensions only (facilities and orgs valid on that
    day); facts are not cut at it. ``parity`` reproduces the original job's
    quirks where this library deliberately differs (see README "Semantics").
    ``joined_key`` (in parity) also makes its conflict test by the original's
    key without separators, in which registrations can collide.
    """

    asof: _dt.date
    domain: tuple = CATEGORY_DOMAIN
    parity: bool = False
    joined_key: bool = False

    def __post_init__(self):
        object.__setattr__(self, "asof", as_date(self.asof))
        object.__setattr__(self, "domain", tuple(self.domain))
        if self.joined_key and not self.parity:
            raise ValueError("joined_key is a quirk of parity mode")
