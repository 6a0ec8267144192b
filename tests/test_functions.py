"""FIXTURES.md section 4: scalar goldens, and error behaviour."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from covtab.functions import rate, rounded_or_null, suppress_round, valid_asof
from covtab.functions.predicates import known_code
from covtab.params import JobParams


def _one(spark, expr, value, typ="long"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr("v").alias("o")).first().o


@pytest.mark.parametrize("v,out", [
    (0, "0"), (1, "*"), (7, "*"), (8, "10"), (12, "10"), (13, "15"), (17, "15"), (18, "20"), (24, "25"),
    (10**11, "100000000000"),
])
def test_suppress_round(spark, v, out):
    assert _one(spark, suppress_round, v) == out
    assert _one(spark, rounded_or_null, v) == (None if out == "*" else int(out))


def test_suppress_round_matches_python_rounding(spark):
    df = spark.range(0, 5000).select(suppress_round("id").alias("s"), F.col("id"))
    for r in df.collect():
        v = r.id
        expected = "0" if v == 0 else "*" if v <= 7 else str(5 * round(v / 5))
        assert r.s == expected


@pytest.mark.parametrize("v", [-1, -11, 10**11 + 1])
def test_suppress_round_errors(spark, v):
    with pytest.raises(Exception, match="suppress_round"):
        _one(spark, suppress_round, v)


def test_rate(spark):
    df = spark.createDataFrame([(5, 80), (None, 100), (0, 100), (10, None), (3, 0), (125, 165)], "k long, a long")
    got = [r.r for r in df.select(rate("k", "a").alias("r")).collect()]
    assert got == [0.062, None, 0.0, None, None, 0.758]


def test_rate_half_even_matches_numpy(spark):
    import numpy as np

    pairs = [(k, a) for a in range(5, 400, 5) for k in range(0, a + 1, 5)]
    df = spark.createDataFrame(pairs, "k long, a long").select("k", "a", rate("k", "a").alias("r"))
    for r in df.collect():
        assert r.r == float(np.round(r.k / r.a, 3)), (r.k, r.a)


def test_valid_asof(spark):
    d = dt.date
    rows = [(d(2021, 6, 30), None, True), (d(2021, 1, 1), d(2021, 6, 30), False),
            (d(2021, 1, 1), d(2021, 7, 1), True), (None, None, False)]
    df = spark.createDataFrame(rows, "s date, e date, want boolean")
    got = df.select((F.coalesce(valid_asof("s", "e", "2021-06-30"), F.lit(False)) == F.col("want")).alias("ok"))
    assert all(r.ok for r in got.collect())


def test_known_code(spark):
    vals = ["Z", "z", "X", "x", "99", "9", "", " ", None, "A", "  ", "Z "]
    df = spark.createDataFrame([(v,) for v in vals], "c string")
    got = [r.k for r in df.select(F.coalesce(known_code("c"), F.lit(False)).alias("k")).collect()]
    assert got == [False] * 9 + [True, True, True]


def test_bad_asof():
    with pytest.raises(ValueError):
        JobParams(asof="2021-13-45")


@pytest.mark.parametrize("v", [3.7, 8.9, 0.4])
def test_suppress_round_rejects_fractions(spark, v):
    for rule in (suppress_round, rounded_or_null):
        with pytest.raises(Exception, match="not a whole number"):
            _one(spark, rule, v, "double")


def test_suppress_round_takes_whole_doubles(spark):
    assert _one(spark, suppress_round, 12.0, "double") == "10"
