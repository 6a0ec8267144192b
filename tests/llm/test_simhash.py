import random

import numpy as np
import xxhash

from covtab.llm import simhash
from covtab.llm.components import components


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    groups = {}
    for i in range(len(prints)):
        if ids[i] is not None:
            groups[find(i)] = min(ids[i], groups.get(find(i), ids[i]))
    return [groups.get(find(i)) for i in range(len(prints))]


def check(df, rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    want = [(i, p, c) for (i, _), p, c in zip(rows, prints, plain_components(prints, [i for i, _ in rows]))]
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicate_groups(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_odd_rows(table, odd_rows):
    for clashing in (False, True):
        check(table(odd_rows, clashing), odd_rows)


def test_empty(table):
    assert simhash.near_duplicate_groups(table([])).collect() == []
    assert simhash.keep_representatives(table([])).collect() == []


def test_near_copies(table):
    rng = random.Random(3)
    words = [f"v{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([20, 150, 600]))] for _ in range(12)]
    rows = []
    for k in range(240):
        doc = list(base[k % 12])
        for _ in range(rng.randrange(3)):
            doc[rng.randrange(len(doc))] = rng.choice(words)
        rows.append((k, " ".join(doc).upper() if k % 5 == 0 else " ".join(doc)))
    check(table(rows), rows)
    stays = simhash.keep_representatives(table(rows)).collect()
    want = plain_components([plain_fingerprint(t) for _, t in rows], [i for i, _ in rows])
    assert sorted(r.doc_id for r in stays) == sorted(set(want))


def test_one_row_stays_of_groups_without_ids_and_of_repeated_ids(table):
    rng = random.Random(8)
    texts = [" ".join(f"{name}{rng.randrange(300)}" for _ in range(400)) for name in "abcd"]
    rows = [(None, texts[0])] * 4 + [(5, texts[1])] * 3 + [(6, texts[1]), (None, texts[1])] + [(None, texts[2]), (9, texts[2])] + [(5, texts[3])]
    for clashing in (False, True):
        stays = simhash.keep_representatives(table(rows, clashing)).collect()
        assert sorted((str(r.doc_id), r.text) for r in stays) == sorted(
            [("None", texts[0]), ("5", texts[1]), ("9", texts[2]), ("5", texts[3])])


def test_links_join_all_within_three_bits(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(300):  # dense: hundreds of fingerprints under one key
            values.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
    values |= {int(v) for v in rng.integers(0, 2**63, 200, dtype=np.uint64)}
    values = sorted(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v, v) for v in signed], "doc_id long, fp long")
    links = simhash.links(df)
    for r in links.collect():
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3
    root = {r.node: r.root for r in components(links).collect()}
    got = [root.get(v, v) for v in signed]
    want = plain_components(values, signed)
    same = lambda labels: sorted(map(sorted, {l: [i for i, x in enumerate(labels) if x == l] for l in set(labels)}.values()))
    assert same(got) == same(want)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100}
