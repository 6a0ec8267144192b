import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from covtab.llm import vector_codes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def plain(rows, parts=16, entries=64, rounds=2):
    """Brute force with Python integers: {row: (code, error)}, codebooks."""
    good = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [[int(np.floor(np.float64(np.float32(x)) * 256)) for x in r[1]] for r in good]
    width = len(whole[0]) // parts
    split = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for v in whole]
    first = sorted(range(len(good)), key=lambda i: (good[i][0] is None, good[i][0] or 0, list(map(float, good[i][1]))))[:entries]
    books = [[split[i][p] for i in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda: [[min(range(len(books[p])), key=lambda e: (far(v[p], books[p][e]), e)) for p in range(parts)] for v in split]
    for _ in range(rounds):
        own = near()
        for p in range(parts):
            for e in range(len(books[p])):
                members = [v[p] for v, o in zip(split, own) if o[p] == e]
                if members:
                    books[p][e] = tuple(sum(c) // len(members) for c in zip(*members))
    out = [(r[0], r[2], bytes(o), sum(far(v[p], books[p][o[p]]) for p in range(parts))) for r, v, o in zip(good, split, near())]
    text = ",".join(str(c) for p in books for e in p for c in e)
    return out, text


def check(spark, rows, **given):
    found, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **given)
    want, text = plain(rows, **given)
    got = found.collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in got), key=key) == sorted(want, key=key)
    assert vector_codes.codebooks_text(books) == text
    assert vector_codes.codebooks_sha256(books) == hashlib.sha256(text.encode()).hexdigest()
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert all(r.label_error == sums[r.label] for r in got)
    return got


def vectors(n, size=32, spread=1.0, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (12, size))
    return [(k, [float(x) for x in (centres[k % 12] + rng.normal(0, spread / 6, size)).astype(np.float32)], k % 3 or None) for k in range(n)]


def test_against_brute_force(spark):
    got = check(spark, vectors(300))
    assert sum(r.scans for r in got) < 300 * 16 * 3  # the bounds spare some full scans


def test_more_rounds_and_other_shapes(spark):
    check(spark, vectors(80, size=12, seed=3), parts=4, entries=8, rounds=5)


def test_odd_rows(spark):
    rows = vectors(40, size=16)
    rows += [(None, rows[0][1], None), (None, rows[1][1], 1), (5, rows[5][1], 2), (5, [0.0] * 16, 2), (5, rows[5][1], 2)]
    rows += [(100, None, 1), (101, [float("nan")] + [0.0] * 15, 1), (102, [float("inf")] + [0.0] * 15, 1), (103, [None] + [0.0] * 15, 1)]
    random.Random(2).shuffle(rows)
    check(spark, rows)


def test_ties_and_copies(spark):
    rows = [(k, [0.5 * (k % 2)] * 16, None) for k in range(200)]
    got = check(spark, rows, entries=4)
    assert {bytes(r.code) for r in got} == {b"\0" * 16, b"\1" * 16}


def test_large_components(spark):
    rows = [(k, [float(x) for x in np.float32(np.linspace(-9000, 9000, 16) * (k % 7 + 1))], 1) for k in range(90)]
    check(spark, rows)


def test_other_sizes_have_no_code(spark):
    rows = vectors(20, size=16) + [(50, [1.0] * 32, 1), (51, [], 1), (52, [3.0e38] * 16, 1)]
    got = {r.vec_id: r for r in vector_codes.compress(spark.createDataFrame(rows, SCHEMA))[0].collect()}
    assert len(got) == 23 and all(got[k].code is None and got[k].error is None for k in (50, 51, 52))
    assert all(got[k].code is not None for k in range(20))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)]])
def test_empty(spark, rows):
    found, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA))
    assert found.collect() == [] and books.size == 0


def test_vectors_without_components(spark):
    found, books = vector_codes.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], SCHEMA))
    assert sorted((r.vec_id, bytes(r.code), r.error) for r in found.collect()) == [(1, bytes(16), 0), (2, bytes(16), 0)]


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    rows = vectors(30, size=16)
    df = spark.createDataFrame(rows, SCHEMA)
    clash = df.select("*", *[F.lit(1).alias(c) for c in ("x", "own", "lower", "stamp", "node", "code", "error", "vector", "size")])
    a = {(r.vec_id, bytes(r.code)) for r in vector_codes.compress(df)[0].collect()}
    assert a == {(r.vec_id, bytes(r.code)) for r in vector_codes.compress(clash)[0].collect()}


def test_net_displacement_is_tighter_than_drift():
    there = np.array([[[0], [100], [200]]])
    out = np.array([[[0], [150], [200]]])
    back = np.array([[[0], [101], [200]]])
    moved = vector_codes._moved([there, out, back], 0)
    assert moved[0].tolist() == [1.0, 0.0, 1.0]  # 50 + 49 by accumulated drifts
