import math
import random
from collections import Counter

from covtab.llm import lm_scoring as L


def plain_scores(rows, target_ids):
    docs = [(i, (t or "").encode().split() + [b" end"], i is not None and i in target_ids) for i, t in rows]
    counts = Counter(w for _, words, good in docs if good for w in words)
    vocabulary = {w for w, n in counts.items() if n >= L.MIN_COUNT} | {b" end"}
    mapped = [(i, [w if w in vocabulary else b" unknown" for w in words], good) for i, words, good in docs]
    models = {}
    for name, keep in (("t", lambda good: good), ("b", lambda good: True)):
        one, two, starts, n = Counter(), Counter(), 0, 0
        for _, words, good in mapped:
            if keep(good):
                one.update(words)
                two.update(zip([b" start"] + words, words))
                starts, n = starts + 1, n + len(words)
        one[b" start"] = starts
        models[name] = (one, two, n)
    k = len(vocabulary) + 1
    scale = models["t"][2] / models["b"][2] if models["b"][2] else 0
    out = []
    for i, words, good in mapped:
        pairs = list(zip([b" start"] + words, words))
        own1, own2 = Counter(words), Counter(pairs)
        own1[b" start"] = 1
        losses = []
        for name, s, mine in (("t", 1.0, good), ("b", scale, True)):
            one, two, n = models[name]
            loss = 0
            for v, w in pairs:
                p1 = (s * (one[w] - mine * own1[w]) + L.ALPHA) / (s * (n - mine * len(words)) + L.ALPHA * k)
                loss -= math.log((s * (two[v, w] - mine * own2[v, w]) + L.MU * p1) / (s * (one[v] - mine * own1[v]) + L.MU))
            losses.append(loss / len(words))
        out.append((i, len(words), *losses))
    return out


def check(spark, df, rows, targets):
    named = spark.createDataFrame([(t,) for t in targets], "doc_id long")
    got = [(r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in L.score(df, named).collect()]
    key = lambda r: (str(r[0]), r[1], round(r[2], 6), round(r[3], 6))
    assert sorted(map(key, got)) == sorted(map(key, plain_scores(rows, set(targets))))


def test_odd_rows(spark, table, odd_rows):
    rows = [(i, t if t is None or len(t) < 1000 else t[:40000]) for i, t in odd_rows]
    for clashing in (False, True):
        check(spark, table(rows, clashing), rows, [1, 7, 8, 8, 99])


def test_no_targets_scores_zero(spark, table):
    rows = [(1, "a b"), (2, None)]
    got = L.score(table(rows), spark.createDataFrame([], "doc_id long")).collect()
    assert all(abs(r.difference) < 1e-12 for r in got) and len(got) == 2


def test_empty(spark, table):
    assert L.score(table([]), spark.createDataFrame([(1,)], "doc_id long")).collect() == []


def test_target_like_documents_score_lower(spark, table):
    rng = random.Random(8)
    good, other = [f"g{k}" for k in range(60)], [f"o{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choice(good if k % 2 else other) for _ in range(80))) for k in range(200)]
    targets = [k for k in range(100) if k % 2]
    check(spark, table(rows), rows, targets)
    named = spark.createDataFrame([(t,) for t in targets], "doc_id long")
    got = {r.doc_id: r.difference for r in L.score(table(rows), named).collect()}
    assert max(got[k] for k in range(101, 200, 2)) < min(got[k] for k in range(100, 200, 2))


def test_rows_without_an_id_and_of_one_id(spark, table):
    rng = random.Random(5)
    text = lambda: " ".join(f"w{rng.randrange(40)}" for _ in range(12))
    rows = [(None, text()) for _ in range(60)] + [(7, text()) for _ in range(60)] + [(k, text()) for k in range(20, 40)]
    rows += [(None, "w1 w2")] * 30 + [(7, "w1 w3")] * 30
    check(spark, table(rows), rows, [7, 21, 22])
    shards = L.sharded(table(rows).select("doc_id", "text"), 8).groupBy("shard").count().collect()
    assert len(shards) == 8 and max(r["count"] for r in shards) < 60
