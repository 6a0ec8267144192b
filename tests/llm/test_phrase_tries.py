import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from covtab.llm import phrase_tries
from tests.llm.conftest import SCHEMA


def plain(rows, least, top):
    """Brute force in plain Python over (lang, text) rows."""
    counts = {}
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            own = counts.setdefault(lang if lang is not None else "und", Counter())
            for k in (1, 2, 3):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        longer = {}
        for p, c in found.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer.get(part, 0), c)
        scored = []
        for p, a in found.items():
            if 100 * longer.get(p, 0) >= 50 * a:
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (score, _, phrase, a, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, n, -score))
    return sorted(out)


def documents(spark, rows):
    return spark.createDataFrame([(k, t, lang, "s", None) for k, (lang, t) in enumerate(rows)], SCHEMA).repartition(4)


def texts(n, seed=1, vocabulary=60):
    rng = random.Random(seed)
    words = [f"W{k}é" if k % 5 else f"w{k}" for k in range(vocabulary)]
    for _ in range(n):
        body = [words[min(int(rng.expovariate(0.12)), vocabulary - 1)] + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(rng.randrange(80))]
        yield rng.choice(["en", "de", None, "und"]), rng.choice([" ", "  ", "\t"]).join(body)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("given", [{}, {"shard_bytes": 500}, {"trie_phrases": 7}, {"broadcast_words": 0}])
def test_against_brute_force(spark, given):
    rows = list(texts(150))
    assert result(phrase_tries.collocations(documents(spark, rows), least=4, top=60, **given)) == plain(rows, 4, 60)


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, " \t. ,"), ("en", "a b c " * 400), ("en", "a b c " * 400), ("und", "A\x0bB. a b"), (None, "A B " * 12),
            ("xx", "é\x1cù é\x1cù! " * 15), ("de", "x" * 300000 + " y"), ("de", ("long " * 50000).strip())]
    df = documents(spark, rows)
    clash = df.select("*", *[F.lit("x").alias(c) for c in ("shard", "words", "counts", "ids", "word", "n", "id", "w1", "a")])
    assert result(phrase_tries.collocations(df)) == result(phrase_tries.collocations(clash)) == plain(rows, 10, 2000)


def test_empty(spark):
    assert result(phrase_tries.collocations(documents(spark, []))) == []
    assert result(phrase_tries.collocations(documents(spark, [("en", "few words here")]))) == []


def test_frequent_above_what_a_sketch_counts(spark):
    rows = [("en", "p q " * 200)] * 3 + [("en", "r s. " * 280)]
    assert result(phrase_tries.collocations(documents(spark, rows), least=300)) == plain(rows, 300, 2000)


@pytest.mark.parametrize("length, n, words", [(2, 1, 2), (2, 5000, 300), (3, 20000, 5000), (2, 30000, 30000), (3, 3000, 12)])
def test_trie_holds_its_phrases_and_no_other(length, n, words):
    rng = np.random.default_rng(length * n)
    keys = np.unique(rng.integers(1, 1 << 60, words))
    phrases = np.unique(keys[np.minimum(rng.exponential(words / 5, (n, length)).astype(int), keys.size - 1)], axis=0)
    trie = phrase_tries.build(rng.permutation(phrases))
    assert trie.check.size < 8 * len(phrases) * length + 4 * phrase_tries.RADIX + 8192
    ids = rng.integers(-1, keys.size, 20000).astype("<i4")
    ids[:2 * length] = np.searchsorted(keys, np.concatenate([phrases[0], phrases[-1]]))
    shard = phrase_tries._Shard(phrase_tries._packed(ids), phrase_tries._packed(keys.astype("<i8")))
    place, state = trie.advance(shard)
    known = set(map(tuple, phrases.tolist()))
    want = [(i, tuple(shard.key[i:i + length].tolist())) for i in range(ids.size - length + 1) if tuple(shard.key[i:i + length].tolist()) in known]
    assert list(zip(place.tolist(), zip(*(w.tolist() for w in trie.words(state))))) == want


def test_packed_numbers_take_little_room():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 200_000), 60_000).astype("<i4")
    keys = (rng.integers(0, 8, 50_000) * (1 << 33) + rng.integers(0, 3000, 50_000)).astype("<i8")
    for values in (ids, keys, ids[:0], ids[:1], ids.astype(np.uint8)):
        assert np.array_equal(phrase_tries._unpacked(phrase_tries._packed(values), values.dtype.str), values)
    plain = len(pa.compress(ids.tobytes(), codec="zstd", asbytes=True))
    assert len(phrase_tries._packed(ids)) < 0.8 * plain
