"""Hand-worked micro fixture (FIXTURES.md section 3)."""

import datetime as dt

from covtab.sources.tables import SCHEMAS

D = dt.date.fromisoformat
ASOF = D("2021-06-30")

FACTS = [
    # entity, facility, concept, record_date, direct, period_end, death
    ("e01", "F1", "c1", "2021-05-01", "B", "2021-06-30", None),
    ("e02", "F1", "c1", "2021-06-30", "B", "2021-06-30", None),
    ("e03", "F1", "c1", "2021-05-01", "Z", "2021-06-30", None),
    ("e03", "F1", "c2", "2021-05-01", "Z", "2021-06-30", None),
    ("e04", "F1", "c9", "2021-05-01", "", "2021-06-30", None),
    ("e05", "F1", "c1", "2021-05-01", None, "2021-06-30", "2021-06-01"),
    ("e05", "F1", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e06", "F1", "c1", "2021-05-01", None, "2021-06-30", "2021-06-01"),
    ("e07", "F9", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e08", "F1", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e08", "F2", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e09", "F1", "c1", None, None, "2021-06-30", None),
    ("e10", "F3", None, None, "C", "2021-06-30", None),
    (None, "F1", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e12", "F4", "c1", "2021-05-01", None, "2021-06-30", None),
    ("e13", "F5", None, None, None, "2021-06-30", None),
]
CONCEPTS = [("c1", "A"), ("c2", "B"), ("c9", "Z")]
FACILITIES = [
    ("F1", "O1", "2013-04-01", None),
    ("F2", "O1", "2013-04-01", "2021-07-01"),
    ("F3", "O2", "2021-06-30", None),
    ("F4", "O3", "2013-04-01", None),
    ("F5", "O4", "2013-04-01", None),
]
ORGS = [
    ("O1", "Org One", "2013-04-01", None),
    ("O2", "Org Two", "2013-04-01", None),
    ("O3", "Org Three", "2013-04-01", "2021-06-30"),
    ("O4", "Org Four", "2013-04-01", None),
]


def _d(v):
    return D(v) if v else None


def frame(spark, role, rows):
    schema = ", ".join(f"`{k}` {v}" for k, v in SCHEMAS[role].items())
    return spark.createDataFrame(rows, schema)


def inputs(spark, asset_rows=()):
    facts = frame(spark, "facts", [(e, f, c, _d(r), di, _d(p), _d(x)) for e, f, c, r, di, p, x in FACTS])
    cmap = frame(spark, "concept_map", CONCEPTS)
    fac = frame(spark, "facilities", [(f, o, _d(a), _d(b), _d(a), _d(b)) for f, o, a, b in FACILITIES])
    orgs = frame(spark, "orgs", [
        (c, n, "G", "H", None, None, None, None, None, None, _d(a), _d(b), "X", _d(a), _d(b), None, None)
        for c, n, a, b in ORGS])
    asset = frame(spark, "asset", [(e, c, _d(d), s) for e, c, d, s in asset_rows])
    return {"facts": facts, "concept_map": cmap, "facilities": fac, "orgs": orgs, "asset": asset}
