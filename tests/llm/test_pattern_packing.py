import json
import zlib
from collections import defaultdict

import numpy as np
import pytest

from covtab.llm import pattern_packing as P
from covtab.llm.byte_bpe import Encoder, default_ranks


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_pieces(rows, library):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check(df, rows, library):
    got = P.pack_documents(df).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, plain_pieces(rows, library)))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by), sum(r.length for r in got)


def test_long_runs_of_whitespace(library):
    encoder = Encoder(default_ranks())
    blanks, lines = " " * 2_000_000, "\n" * 2_000_000
    mixed = " \t\u3000\x85" * 300_000
    texts = [blanks, lines, f"a{blanks}b", f"a {lines}b", f"{lines} 1", f"{blanks}\u00a0!", f"x{mixed}\x1cy{blanks}z" + lines,
             f"{blanks}<|endoftext|>{lines}c", "\x1c" * 70_000 + "d", " " * 65_535 + "e", " " * 65_536 + "f"]
    for text in texts:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_odd_rows(table, odd_rows, library):
    for clashing in (False, True):
        check(table(odd_rows, clashing), odd_rows, library)


def test_empty(table):
    assert P.pack_documents(table([])).collect() == []


def test_hot_length(table, library):
    rows = [(k, "one two three") for k in range(3000)] + [(5000 + k, "word " * (k % 900 + 1)) for k in range(300)]
    sequences, tokens = check(table(rows), rows, library)
    assert sequences <= -(-tokens // 1024) * 1.01 + 1


def test_ids_are_the_librarys(library):
    encoder = Encoder(default_ranks())
    texts = ["", " ", "a  b\n\n c", "<|endoftext|>x", "é漢😀\x00\x85 　z", "it's 1234 don't!?  ", "▁ ~~", " " * 3000 + "x", "ab" * 5000]
    for text in texts + [json.dumps(texts)]:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 7, 300, 20_000, 300_000])
def test_plan_is_near_the_bound(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.gamma(1.5, 400, n).astype(int) % 1025, 1, 1024)
    histogram = np.bincount(lengths, minlength=1025)
    table = P.plan(histogram)
    assert np.array_equal(np.bincount(table[:, 0], weights=table[:, 2] - table[:, 1], minlength=1025), histogram)
    fill = defaultdict(int)
    for length, first, end, sequence, offset, times in table.tolist():
        assert (end - first) % times == 0
        for s in range(sequence, sequence + (end - first) // times):
            fill[s] += length * times
            assert offset + length * times <= 1024
    bound = -(-int(lengths.sum()) // 1024)
    assert all(v <= 1024 for v in fill.values()) and len(fill) <= 1.02 * bound + 1


def test_fit_recovers_an_exact_mixture():
    shapes = P.patterns(64)
    assert (shapes.sum(axis=1) == 64).all() and len({tuple(s) for s in shapes.tolist()}) == len(shapes)
    histogram = np.zeros(65)
    for p, n in ((3, 500), (40, 300), (200, 900)):
        for v in shapes[p]:
            histogram[v] += n * (v > 0)
    x = P.fit(shapes, histogram, steps=2000)
    made = np.bincount(shapes.ravel(), weights=np.repeat(x, 3), minlength=65)
    assert (x >= 0).all() and np.abs(made[1:] - histogram[1:]).max() < 5


def test_rows_of_one_id_are_packed_whole(table, library):
    rows = [(None, f"text {k % 7}") for k in range(300)] + [(7, "same")] * 300
    check(table(rows), rows, library)


def sequences(table):
    """Sequences of a plan, by the rule that places a piece."""
    last = table[:, 2] - table[:, 1] - 1
    return int((table[:, 3] + last // table[:, 5]).max()) + 1


def test_patterns_with_room_to_spare_and_of_many_pieces():
    few = np.zeros(1025, int)
    few[[400, 300, 250]] = 1000
    assert sequences(P.plan(few)) == 1000  # one of each; best fit alone takes 1,084
    short = np.zeros(1025, int)
    short[[90, 130, 170, 210]] = [4000, 3000, 2500, 2000]
    least = -(-int((np.arange(1025) * short).sum()) // 1024)
    assert least <= sequences(P.plan(short)) <= min(least + 20, sum(n for _, n in P.best_fit(short[:1024], 1024)))


def test_generated_patterns_fit_the_histogram():
    rng = np.random.default_rng(4)
    left = np.zeros(1025, int)
    left[rng.choice(np.arange(20, 700), 25, replace=False)] = rng.integers(1, 5000, 25)
    lengths, shapes, times = P.generated_patterns(left, 1024)
    assert (times >= 0).all() and (shapes @ lengths <= 1024).all()
    assert np.allclose(times @ shapes, left[lengths])
    assert times.sum() <= (left[lengths] / (1024 // lengths)).sum()
