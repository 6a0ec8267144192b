"""The registered queries as DuckDB SQL over the test tables.

Written from the rules in the README ("Semantics") and the demo mapping in
FIXTURES.md, for checking the Spark operators: resolution is one window over
all observations, attribution one join of registrations with each entity's
category, and each organisation one row of filtered sums. The parity queries
follow the name joins that parity mode stands for.
"""

from __future__ import annotations

from covtab.params import CATEGORY_DOMAIN, ORG_ATTRIBUTES, OTHER, ROUND_BASE, SUPPRESS_MAX, UNKNOWN_CODES
from covtab.sources.demo import (
    ASSET_SOURCE,
    CONCEPT_TO_CATEGORY,
    DEMO_ASOF,
    DEMO_DAYS,
    GUEST_PRIORITY,
    GUEST_STATUS,
    REGIONS,
    RETURN_FLAGS,
    SEGMENT_TO_ASSET,
    STATUS_TO_DIRECT,
)

DAY = f"DATE '{DEMO_ASOF.isoformat()}'"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _open(table: str, day: str = DAY) -> str:
    """Both intervals of a dimension row hold the as-of day."""
    return " AND ".join(f"{table}.{a} <= {day} AND coalesce({table}.{b} > {day}, true)"
                        for a, b in (("open_date", "close_date"), ("record_start", "record_end")))


_GUEST = f"(o_orderpriority = '{GUEST_PRIORITY}' AND o_orderstatus = '{GUEST_STATUS}' AND o_orderkey % 7 = 0)"
_KNOWN = f"NOT IN ({_list(UNKNOWN_CODES)})"
_SINCE = "DATE '1990-01-01'"

# --- the five roles -----------------------------------------------------------

_ROLES = f"""
facts AS (
    SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN {_GUEST} THEN 'G' || o_custkey ELSE o_custkey::VARCHAR END AS entity_id,
           CASE WHEN {_GUEST} THEN 'R' || o_custkey % {REGIONS} ELSE l_suppkey::VARCHAR END AS facility_code,
           CASE WHEN l_linenumber = 7 AND l_quantity > 45 AND NOT {_GUEST} THEN 'RARE'
                ELSE concat_ws('/', o_orderpriority, l_returnflag) END AS concept_code,
           CASE WHEN o_orderkey % 89 <> 0 THEN date_trunc('month', o_orderdate)::DATE END AS record_date,
           {_case('o_orderstatus', STATUS_TO_DIRECT)} AS direct_category,
           date_trunc('month', o_orderdate)::DATE AS period_end,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN o_orderdate::DATE END AS death_date
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
), concepts AS (
    SELECT concept_code, {_case('concept_code', CONCEPT_TO_CATEGORY)} AS category FROM (
        SELECT concat_ws('/', o_orderpriority, flag) AS concept_code
        FROM (SELECT DISTINCT o_orderpriority FROM orders), (VALUES (NULL), {', '.join(f"('{m}')" for m in RETURN_FLAGS)}) flags (flag)
        UNION ALL SELECT 'RARE')
), facilities AS (
    SELECT s_suppkey::VARCHAR AS facility_code, 'N' || s_nationkey AS org_code, ({_SINCE} + (s_suppkey % 7)::INT)::DATE AS open_date,
           CASE WHEN s_suppkey % 10 = 0 THEN DATE '2000-01-01' END AS close_date, open_date AS record_start, close_date AS record_end
    FROM supplier
    UNION ALL
    SELECT 'R' || r_regionkey, 'R' || r_regionkey, {_SINCE}, NULL, {_SINCE}, NULL FROM region
), nations AS (
    SELECT CASE WHEN n_nationkey <> 24 THEN 'N' || n_nationkey END AS org_code,
           CASE WHEN n_nationkey IN (20, 21) THEN 'SHARED NAME' WHEN n_nationkey <> 19 THEN n_name END AS org_name,
           r_name AS national_grouping, n_regionkey AS region, n_nationkey AS number, CASE n_nationkey WHEN 23 THEN {DAY} END AS close_date
    FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
), orgs AS (
    SELECT org_code, org_name, national_grouping, 'G' || region AS high_level_geography, org_name || ' HOUSE' AS address_line_1,
           'STREET ' || number AS address_line_2, NULL::VARCHAR AS address_line_3, NULL::VARCHAR AS address_line_4,
           NULL::VARCHAR AS address_line_5, 'PC' || lpad(number::VARCHAR, 3, '0') AS postcode, {_SINCE} AS open_date, close_date,
           'C' AS sub_type_code, {_SINCE} AS record_start, NULL::DATE AS record_end, {_SINCE} AS created_on,
           DATE '2000-01-01' AS updated_on
    FROM (
        FROM nations
        UNION ALL SELECT org_code, org_name || ' (SECOND RECORD)', national_grouping, region, number, close_date FROM nations WHERE number = 5
        UNION ALL SELECT 'R' || r_regionkey, r_name, r_name, r_regionkey, r_regionkey + 100, NULL FROM region
    )
), asset_by_order AS (
    SELECT o_custkey, o_custkey::VARCHAR AS entity_id,
           CASE WHEN o_orderkey % 5 = 0 THEN 'E' WHEN o_orderkey % 499 <> 0 THEN {_case('c_mktsegment', SEGMENT_TO_ASSET)} END AS category,
           o_orderdate::DATE AS attributed_on
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
), asset_once AS (
    SELECT o_custkey, entity_id, category, max(attributed_on) AS attributed_on FROM asset_by_order GROUP BY ALL
), asset AS (
    FROM asset_once UNION ALL FROM asset_once WHERE o_custkey % 40 = 0
)"""

# --- the rules ----------------------------------------------------------------

_COUNTS = ",\n           ".join(
    [f"sum(n) FILTER (s_cat = '{c}')::BIGINT AS \"{c}\"" for c in CATEGORY_DOMAIN]
    + [f"sum(n) FILTER (s_cat NOT IN ({_list(CATEGORY_DOMAIN)}))::BIGINT AS {OTHER}"])

_RULES = f"""
places AS (
    SELECT facility_code, o.* FROM facilities f JOIN orgs o ON o.org_code = f.org_code WHERE {_open('f')} AND {_open('o')}
), coded AS (
    SELECT entity_id, concept_code, record_date, category FROM facts JOIN concepts USING (concept_code) WHERE category {_KNOWN}
), direct AS (
    SELECT entity_id, period_end, direct_category AS category FROM facts WHERE direct_category {_KNOWN}
), seen AS (
    SELECT entity_id, category, record_date AS recorded_on, 'coded_record' AS source, 1 AS priority, count(*) AS n_records
    FROM coded GROUP BY ALL
    UNION ALL
    SELECT entity_id, category, period_end, 'direct_field', 2, count(*) FROM direct GROUP BY ALL
), newest_by_source AS (
    FROM seen WHERE entity_id IS NOT NULL AND recorded_on IS NOT NULL
    QUALIFY recorded_on = max(recorded_on) OVER (PARTITION BY entity_id, source)
), best AS (
    FROM newest_by_source QUALIFY rank() OVER (PARTITION BY entity_id ORDER BY recorded_on DESC, priority) = 1
), settled AS (
    FROM best QUALIFY count(*) OVER (PARTITION BY entity_id) = 1
), living AS (
    SELECT entity_id, facility_code FROM facts WHERE death_date IS NULL GROUP BY ALL
), settled_living AS (
    FROM settled WHERE entity_id IN (SELECT entity_id FROM living)
), registered AS (
    SELECT DISTINCT entity_id, facility_code, org_code, org_name FROM living LEFT JOIN places USING (facility_code)
), prepared AS (
    SELECT entity_id, any_value(category) AS category, max(attributed_on) FILTER (category IS NOT NULL) AS attributed_on
    FROM asset GROUP BY entity_id HAVING count(DISTINCT category) = 1
), held AS (
    SELECT r.*, p.category AS p_cat, s.category AS s_cat, r.facility_code IS NOT NULL AND r.org_code IS NOT NULL AS counts
    FROM registered r LEFT JOIN settled_living p USING (entity_id) LEFT JOIN prepared s USING (entity_id)
), cube AS (
    SELECT org_name, org_code, CASE WHEN counts THEN p_cat END AS p_cat, CASE WHEN counts THEN s_cat END AS s_cat,
           count(entity_id) AS n
    FROM held GROUP BY ALL
), by_org AS (
    SELECT org_name, org_code, sum(n)::BIGINT AS alive, coalesce(sum(n) FILTER (p_cat IS NOT NULL), 0)::BIGINT AS known_p,
           coalesce(sum(n) FILTER (s_cat IS NOT NULL), 0)::BIGINT AS known_s, count(*) FILTER (s_cat IS NOT NULL) > 0 AS in_cross,
           {_COUNTS}
    FROM cube WHERE org_name IS NOT NULL GROUP BY ALL
)"""

_CROSS = [*CATEGORY_DOMAIN, OTHER, "unknown"]


def _rounded(value: str) -> str:
    """The disclosed number: null where it is suppressed."""
    v = f"coalesce({value}, 0)"
    return f"CASE WHEN {v} BETWEEN 1 AND {SUPPRESS_MAX} THEN NULL ELSE ({v} + {ROUND_BASE // 2}) // {ROUND_BASE} * {ROUND_BASE} END"


def _rate(part: str, whole: str) -> str:
    return f"round_even({part}::DOUBLE / nullif({whole}::DOUBLE, 0), 3)"


def _shown(value: str) -> str:
    return f"coalesce(({value})::VARCHAR, '*')"


def _with_total(source: str, sums: list[str]) -> str:
    added = ", ".join(f'sum("{m}")::BIGINT AS "{m}"' for m in sums)
    kept = ", ".join(f'"{m}"' for m in sums)
    return f"SELECT org_name, org_code, {kept} FROM {source} UNION ALL SELECT 'TOTAL', 'ZZZTOTAL', {added} FROM {source}"


def _tables() -> str:
    """Stages named ``cover_*``, ``total_*``, ``round_*`` for both sources, and the cross-tab's."""
    parts = []
    for side in "ps":
        parts += [
            f"cover_{side} AS (SELECT org_name, org_code, known_{side} AS known, alive, alive - known_{side} AS unknown FROM by_org)",
            f"total_{side} AS ({_with_total(f'cover_{side}', ['known', 'alive', 'unknown'])})",
            f"round_{side} AS (SELECT org_name, org_code, "
            + ", ".join(f"{_rounded(m)} AS {m}" for m in ("known", "alive", "unknown")) + f" FROM total_{side})"]
    parts += [
        f"cross_tab AS (SELECT org_name, org_code, {', '.join(chr(34) + m + chr(34) for m in _CROSS[:-1])}, alive - known_s AS unknown "
        "FROM by_org WHERE in_cross)",
        f"cross_total AS ({_with_total('cross_tab', _CROSS)})",
        f"cross_round AS (SELECT org_name, org_code, " + ", ".join(f'{_rounded(chr(34) + m + chr(34))} AS "{m}"' for m in _CROSS)
        + " FROM cross_total)",
        f"cross_rate AS (SELECT c.org_name, c.org_code, "
        + ", ".join(f'{_rate(f"c.{chr(34)}{m}{chr(34)}", "r.alive")} AS "{m}"' for m in _CROSS)
        + " FROM cross_round c JOIN round_s r ON r.org_name = c.org_name AND r.org_code = c.org_code)"]
    return ",\n".join(parts)


_STAGES = f"WITH {_ROLES},{_RULES},\n{_tables()}"


def q(select: str) -> str:
    return f"{_STAGES}\n{select}"


_ATTRS = ", ".join(ORG_ATTRIBUTES)
_COVER = "org_name, org_code, known, alive, unknown"
_COVER_TEXT = (f"org_name, org_code, {_shown('known')} AS known, {_shown('alive')} AS alive, {_shown('unknown')} AS unknown, "
               f"{_shown(_rate('known', 'alive'))} AS percentage")


def _cross_text(columns) -> str:
    return "org_name, org_code, " + ", ".join(f'{_shown(chr(34) + m + chr(34))} AS "{m}"' for m in columns)


def _held(category: str, attributed: str, source: str) -> str:
    table = "settled_living" if category == "p" else "prepared"
    return q(f"SELECT entity_id, facility_code, org_code, org_name, category, {attributed} AS attributed_on, {source} AS source "
             f"FROM registered JOIN {table} USING (entity_id) WHERE facility_code IS NOT NULL AND org_code IS NOT NULL")


def _out_of_domain(side: str, name: str) -> str:
    return (f"SELECT '{name}' AS \"check\", {side}_cat AS subject, sum(n)::BIGINT AS value FROM cube "
            f"WHERE {side}_cat NOT IN ({_list(CATEGORY_DOMAIN)}) GROUP BY ALL")


ORACLE = {
    "asof_org_map": q(f"SELECT facility_code, org_code, {_ATTRS} FROM places"),
    "mapped_codes": q("FROM coded"),
    "direct_codes": q("FROM direct"),
    "dedupe_observations": q("SELECT entity_id, recorded_on, category, source, n_records FROM seen"),
    "latest_per_key": q("SELECT entity_id, recorded_on AS record_date, category, n_records FROM newest_by_source WHERE priority = 1"),
    "union_observations": q("SELECT entity_id, category, recorded_on, source, priority FROM newest_by_source"),
    "best_priority": q("SELECT entity_id, category, recorded_on, source, priority FROM best"),
    "drop_conflicts": q("SELECT entity_id, category, recorded_on, source, priority FROM settled"),
    "resolve_entities": q("SELECT entity_id, category, recorded_on AS attributed_on, source FROM settled"),
    "living_entities": q("SELECT entity_id, category, recorded_on AS attributed_on, source FROM settled_living"),
    "registrations": q("FROM registered"),
    "attribute_primary": _held("p", "recorded_on", "source"),
    "attribute_secondary": _held("s", "attributed_on", f"'{ASSET_SOURCE}'"),
    "population": q("SELECT org_code, org_name, sum(n)::BIGINT AS alive FROM cube GROUP BY ALL"),
    "category_cells": q("SELECT org_code, org_name, p_cat AS category, sum(n)::BIGINT AS n FROM cube WHERE p_cat IS NOT NULL GROUP BY ALL"),
    "known_by_org": q("SELECT org_name, org_code, sum(n)::BIGINT AS known FROM cube WHERE p_cat IS NOT NULL GROUP BY ALL"),
    "coverage_primary": q(f"SELECT {_COVER} FROM cover_p"),
    "coverage_secondary": q(f"SELECT {_COVER} FROM cover_s"),
    "crosstab_counts": q("FROM cross_tab"),
    "total_row": q(f"SELECT {_COVER} FROM total_s"),
    "suppress_round": q("SELECT org_name, org_code, " + ", ".join(f"{_shown(m)} AS {m}" for m in ("known", "alive", "unknown"))
                        + " FROM round_s"),
    "coverage_rate": q(f"SELECT org_name, org_code, {_rate('known', 'alive')} AS percentage FROM round_s"),
    "table_1": q(f"SELECT {_COVER_TEXT} FROM round_p"),
    "table_2": q(f"SELECT {_COVER_TEXT} FROM round_s"),
    "table_3a": q(f"SELECT {_cross_text(_CROSS)} FROM cross_round"),
    "table_3b": q(f"SELECT {_cross_text(_CROSS)} FROM cross_rate"),
    "org_reference": q(f"SELECT DISTINCT org_code, {_ATTRS} FROM places"),
    "freshness": q(f"SELECT max(period_end) AS latest_period, {DAY} AS asof, coalesce(max(period_end) = {DAY}, false) AS ok FROM facts"),
    "quality_report": q(
        _out_of_domain("p", "out_of_domain_primary") + " UNION ALL " + _out_of_domain("s", "out_of_domain_secondary")
        + " UNION ALL SELECT 'facility_fanout', facility_code, count(*) FROM places GROUP BY ALL HAVING count(*) > 1"
        + " UNION ALL SELECT 'negative_unknown_primary', org_name, unknown FROM cover_p WHERE unknown < 0"
        + " UNION ALL SELECT 'negative_unknown_secondary', org_name, unknown FROM cover_s WHERE unknown < 0"
        + " UNION ALL SELECT 'nameless_org', org_code, sum(n)::BIGINT FROM cube WHERE org_name IS NULL AND org_code IS NOT NULL GROUP BY ALL"),
    "published_order": q(f"SELECT {_COVER_TEXT}, row_number() OVER (ORDER BY org_name, org_code) AS rank FROM round_p"),
}
ORACLE["publish_roundtrip"] = q(
    f"SELECT 'table_1' AS name, to_json(struct_pack(org_name, org_code, known, alive, unknown, percentage))::VARCHAR AS row "
    f"FROM (SELECT {_COVER_TEXT} FROM round_p) "
    "UNION ALL SELECT 'table_2', to_json(struct_pack(org_name, org_code, known, alive, unknown, percentage))::VARCHAR "
    f"FROM (SELECT {_COVER_TEXT} FROM round_s)")

ORACLE["sources_by_name"] = ORACLE["table_1"]
ORACLE["stage_views"] = q(
    "SELECT b.org_name, b.org_code, b.alive, count(DISTINCT p_cat) AS categories "
    "FROM by_org b JOIN cube c ON c.org_name = b.org_name AND c.org_code = b.org_code GROUP BY ALL")


def _notes() -> str:
    from covtab.plans.publish import DEFAULT_NOTES

    quote = lambda t: "'" + t.replace("'", "''") + "'"
    fixed = [("cover", k, DEFAULT_NOTES[k]) for k in ("title", "organisation")]
    fixed += [("interpretation", k, v) for k, v in DEFAULT_NOTES["interpretation"].items()]
    fixed += [("footnote", str(n), t) for n, t in enumerate(DEFAULT_NOTES["footnotes"], 1)]
    rows = [f"SELECT {quote(a)} AS section, {quote(b)} AS item, {quote(c)} AS text" for a, b, c in fixed]
    wide = len(_CROSS) + 2
    for name, source, width in (("table_1", "round_p", 6), ("table_2", "round_s", 6), ("table_3a", "cross_round", wide),
                                ("table_3b", "cross_rate", wide), ("org_reference", f"(SELECT DISTINCT org_code, {_ATTRS} FROM places)", 17)):
        rows.append(f"SELECT 'contents', '{name}', count(*) || ' rows, {width} columns' FROM {source} t")
    return q(" UNION ALL ".join(rows))


ORACLE["publication_notes"] = _notes()

# --- parity: asset rows counted one by one, tables joined on the name ----------

_DOMAIN_COLUMNS = [*CATEGORY_DOMAIN, "unknown"]


def _name_join(counts: str, joined_key: bool = False) -> str:
    """Parity stages over ``counts`` (an asset relation); the conflict test is
    by entity, or by the key of a registration written together."""
    held = (f"SELECT r.*, a.category, r.entity_id || facility_code || org_code AS place FROM registered r JOIN {counts} a USING (entity_id) "
            "WHERE facility_code IS NOT NULL AND org_code IS NOT NULL")
    key = "place" if joined_key else "entity_id"
    cells = ", ".join(f"sum(n) FILTER (category = '{c}')::BIGINT AS \"{c}\"" for c in CATEGORY_DOMAIN)
    rounded = lambda ms: ", ".join(f'{_rounded(chr(34) + m + chr(34))} AS "{m}"' for m in ms)
    labels = "coalesce(org_name, 'TOTAL') AS org_name, coalesce(org_code, 'ZZZTOTAL') AS org_code"
    rates = ", ".join(f'{_rate(f"c.{chr(34)}{m}{chr(34)}", "t.alive")} AS "{m}"' for m in _DOMAIN_COLUMNS)
    return f""",
raw_held AS ({held}
), raw_cells AS (
    SELECT org_name, org_code, category, count(*) AS n
    FROM raw_held WHERE {key} IN (SELECT {key} FROM raw_held GROUP BY {key} HAVING count(DISTINCT category) = 1)
    GROUP BY ALL
), raw_known AS (
    SELECT org_name, org_code, sum(n)::BIGINT AS known FROM raw_cells GROUP BY ALL
), heads AS (
    SELECT org_name, sum(n)::BIGINT AS alive FROM cube WHERE org_name IS NOT NULL GROUP BY org_name, org_code
), named AS (
    SELECT h.org_name, k.org_code, k.known, h.alive, h.alive - k.known AS unknown FROM heads h LEFT JOIN raw_known k USING (org_name)
), named_total AS ({_with_total('named', ['known', 'alive', 'unknown'])}
), named_round AS (
    SELECT {labels}, {rounded(['known', 'alive', 'unknown'])} FROM named_total
), raw_cross AS (
    SELECT w.*, d.unknown FROM (SELECT org_name, org_code, {cells} FROM raw_cells GROUP BY ALL) w LEFT JOIN named d USING (org_name)
), raw_cross_total AS ({_with_total('raw_cross', _DOMAIN_COLUMNS)}
), raw_cross_round AS (
    SELECT {labels}, {rounded(_DOMAIN_COLUMNS)} FROM raw_cross_total
), raw_cross_rate AS (
    SELECT c.org_name, c.org_code, {rates} FROM raw_cross_round c LEFT JOIN named_round t USING (org_name)
)
"""


ORACLE["table_2_parity"] = f"{_STAGES}{_name_join('asset')} SELECT {_COVER_TEXT} FROM named_round"
ORACLE["table_3b_parity"] = f"{_STAGES}{_name_join('asset')} SELECT {_cross_text(_DOMAIN_COLUMNS)} FROM raw_cross_rate"
ORACLE["total_row_parity"] = f"{_STAGES}{_name_join('asset')} SELECT coalesce(org_name, 'TOTAL') AS org_name, " \
    "coalesce(org_code, 'ZZZTOTAL') AS org_code, known, alive, unknown FROM named_total"
ORACLE["quality_negative_unknown"] = (
    f"{_STAGES}{_name_join('asset_by_order')} SELECT 'negative_unknown_secondary' AS \"check\", org_name AS subject, unknown AS value "
    "FROM named WHERE unknown < 0")
ORACLE["suppress_value"] = q(
    "SELECT org_name, org_code, " + ", ".join(f"{_shown(_rounded(m))} AS {m}" for m in ("known", "alive", "unknown")) + " FROM cover_s")

# --- the original's key, SQL by date, published tables read back ------------------

ORACLE["table_2_joined_key"] = f"{_STAGES}{_name_join('asset', joined_key=True)} SELECT {_COVER_TEXT} FROM named_round"
ORACLE["attribute_joined_key"] = q(
    "SELECT entity_id, facility_code, org_code, org_name, category, attributed_on, "
    f"'{ASSET_SOURCE}' AS source FROM registered JOIN asset USING (entity_id) WHERE facility_code IS NOT NULL AND org_code IS NOT NULL "
    "WINDOW same_place AS (PARTITION BY entity_id || facility_code || org_code) "
    "QUALIFY max(category) OVER same_place = min(category) OVER same_place")


def _records_by_org(day: str) -> str:
    return (
        f"SELECT {day} AS as_of, o.org_code, o.org_name, count(*) AS n, count(*) FILTER (x.direct_category {_KNOWN}) AS known "
        f"FROM facilities f JOIN orgs o ON o.org_code = f.org_code JOIN facts x ON x.facility_code = f.facility_code "
        f"WHERE {_open('f', day)} AND {_open('o', day)} GROUP BY ALL")


ORACLE["sql_by_date"] = q(
    f"SELECT as_of, org_code, org_name, {_shown(_rounded('n'))} AS records, {_shown(_rounded('known'))} AS known, "
    f"{_rate(_rounded('known'), _rounded('n'))} AS share FROM ("
    + " UNION ALL ".join(_records_by_org(f"DATE '{d.isoformat()}'") for d in DEMO_DAYS) + ")")
ORACLE["typed_readback"] = q("FROM cross_round")


def _row_text(columns) -> str:
    return " || '|' || ".join(f"coalesce(CAST(\"{c}\" AS VARCHAR), '')" for c in columns)


_COVER_COLUMNS = ["org_name", "org_code", "known", "alive", "unknown", "percentage"]
ORACLE["publication_tables"] = q(" UNION ALL ".join(
    f"SELECT '{name}' AS name, {_row_text(columns)} AS row FROM ({select})" for name, columns, select in (
        ("table_1", _COVER_COLUMNS, f"SELECT {_COVER_TEXT} FROM round_p"),
        ("table_2", _COVER_COLUMNS, f"SELECT {_COVER_TEXT} FROM round_s"),
        ("table_3a", ["org_name", "org_code", *_CROSS], f"SELECT {_cross_text(_CROSS)} FROM cross_round"),
        ("table_3b", ["org_name", "org_code", *_CROSS], f"SELECT {_cross_text(_CROSS)} FROM cross_rate"),
        ("org_reference", ["org_code", *ORG_ATTRIBUTES], f"SELECT DISTINCT org_code, {_ATTRS} FROM places"))))
