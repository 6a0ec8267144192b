import random

import numpy as np
import pytest

from covtab.llm import matrix_output as M
from covtab.llm.byte_bpe import Encoder, default_ranks


def check(df, rows, **how):
    capacity = how.get("capacity", M.CAPACITY)
    found = M.pack_rows(df, **how).collect()
    encoder = Encoder(default_ranks())
    pieces = {}
    for r in found:
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) == capacity and r.cu_seqlens[0] == 0 and len(r.cu_seqlens) == len(r.segments) + 1
        assert not ids[r.cu_seqlens[-1]:].any() and not positions[r.cu_seqlens[-1]:].any()
        for s, a, b in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            assert b - a == s.length and (positions[a:b] == np.arange(b - a)).all()
            pieces.setdefault((s.doc_id, s.piece, s.start), []).append(ids[a:b].tolist())
    want = {}
    for i, t in rows:
        ids = np.append(encoder.ids(t), M.END_ID).tolist()
        for k, (start, length) in enumerate(M.cut(len(ids), capacity)):
            want.setdefault((i, k, start), []).append(ids[start:start + length])
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert len({r.row_id for r in found}) == len(found)
    return found


def test_odd_rows(table, odd_rows):
    for clashing in (False, True):
        check(table(odd_rows, clashing), odd_rows)


def test_small_rows_and_blocks(table):
    rng = random.Random(1)
    rows = [(k, "word " * rng.randrange(60)) for k in range(200)]
    check(table(rows), rows, capacity=16, block_ids=300)


def test_empty(table):
    assert M.pack_rows(table([])).collect() == []


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 2048])
def test_best_fit_decreasing_equals_a_plain_search(capacity):
    rng = np.random.default_rng(capacity)
    lengths = rng.integers(1, capacity + 1, 400)
    rows, offsets = M.best_fit_decreasing(lengths, capacity)
    rooms = []
    for piece in np.argsort(-lengths, kind="stable"):
        fits = [room for room in rooms if room >= lengths[piece]]
        before = min(fits) if fits else capacity
        if fits:
            rooms.remove(before)
        rooms.append(before - int(lengths[piece]))
        assert offsets[piece] == capacity - before
    assert len(rooms) == rows.max() + 1
    assert (np.bincount(rows, weights=lengths) <= capacity).all()


def test_written_rows(spark, table, tmp_path):
    M.write_rows(table([(1, "a b c"), (2, None)]), f"{tmp_path}/rows", capacity=8)
    back = spark.read.parquet(f"{tmp_path}/rows")
    assert back.columns == ["row_id", "ids", "positions", "cu_seqlens", "segments"] and back.count() >= 1
