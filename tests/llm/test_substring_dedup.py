import hashlib
import random
from collections import Counter

import pytest

from covtab.llm import substring_dedup as S


def plain(rows):
    texts = [(t or "").encode().split() for _, t in rows]
    times = Counter(tuple(w[i:i + 35]) for w in texts for i in range(len(w) - 34))
    out = []
    for (id_, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if times[tuple(w[i:i + 35])] > 1:
                gone[i:i + 35] = [True] * 35
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((id_, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def check(df, rows):
    got = [tuple(r) for r in S.removed_words(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows)))


def test_odd_rows(table, odd_rows):
    for clashing in (False, True):
        check(table(odd_rows, clashing), odd_rows)


def test_empty(table):
    assert S.removed_words(table([])).collect() == []


def test_planted_passages(table):
    rng = random.Random(11)
    fresh = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    passages = [fresh(n) for n in (34, 35, 36, 52, 53, 70, 200)]
    rows = []
    for k in range(80):
        words = fresh(rng.randrange(40))
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(3)
            words += p[cut:len(p) - rng.randrange(3)] + fresh(rng.randrange(25))
        rows.append((k, " ".join(words)))
    rows += [(100, " ".join(["same"] * 36)), (101, " ".join(["same"] * 35)), (102, " ".join(["other"] * 37)), (103, "tail")]
    check(table(rows), rows)


def test_every_offset_of_a_repeat(table):
    """A repeat of exactly 35 words is found wherever it stands in both documents."""
    passage = [f"p{k}" for k in range(35)]
    rows = [(k, " ".join([f"a{k}_{j}" for j in range(k)] + passage + [f"b{k}"])) for k in range(40)]
    check(table(rows), rows)


def test_cleaned_text(table):
    rows = [(1, "keep " + " ".join(f"p{k}" for k in range(40)) + "\n\nend"), (2, " ".join(f"p{k}" for k in range(40)))]
    got = {r.doc_id: (r.text, r.n_removed) for r in S.without_repeats(table(rows)).collect()}
    assert got == {1: ("keep end", 40), 2: ("", 40)}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    try:
        docs = spark.read.parquet(f"{sf}/documents.parquet")
    except Exception:
        pytest.skip("test data not present")
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_rows_without_an_id_and_of_one_id_are_spread_over_shards(spark, table):
    from covtab.llm import common

    for id_ in (None, 7):
        rows = table([(id_, f"text {k}") for k in range(800)] + [(id_, "same")] * 400).select("doc_id", "text")
        got = common.sharded(rows, 16).groupBy("shard").sum("copies").collect()
        assert len(got) == 16 and sum(r[1] for r in got) == 1200
        largest = max(r.n for r in common.sharded(rows, 16).groupBy("shard").agg({"*": "count"}).toDF("shard", "n").collect())
        assert largest < 150


def test_copies_beyond_one_chunk(table):
    body = " ".join(f"w{k}" for k in range(40))
    rows = [(None, body)] * 9000 + [(1, "short")] * 4097 + [(2, "other")]
    got = Counter(tuple(r) for r in S.removed_words(table(rows)).collect())
    assert got == Counter({
        (None, 40, 40, hashlib.sha256(b"").hexdigest()): 9000,
        (1, 1, 0, hashlib.sha256(b"short").hexdigest()): 4097, (2, 1, 0, hashlib.sha256(b"other").hexdigest()): 1})
