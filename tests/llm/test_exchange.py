import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covtab.llm import exchange as X

numbers = st.lists(st.integers(0, 2**64 - 1), max_size=50)


@settings(max_examples=50, deadline=None)
@given(numbers)
def test_pack_and_unpack(values):
    a = np.array(values, np.uint64)
    b = a[::-1].copy()
    got = X.unpack(X.pack(a, b), 2)
    assert (got[0] == a).all() and (got[1] == b).all()


@pytest.mark.parametrize("bits", [8, 48, 64])
@pytest.mark.parametrize("buckets", [1, 2, 7, 211])
def test_ranges_hold_every_key_once(bits, buckets):
    rng = np.random.default_rng(bits + buckets)
    keys = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64) >> np.uint64(max(0, 63 - bits)))
    keys = np.unique(np.concatenate((keys, np.array([0, (1 << bits) - 1], np.uint64))))
    rows = X.sent(keys, [keys ^ np.uint64(5)], bits, buckets)
    parts = [X.unpack(data, 2) for _, data in rows]
    back = np.concatenate([np.cumsum(p[0]) for p in parts])
    assert (back == keys).all() and (np.concatenate([p[1] for p in parts]) == keys ^ np.uint64(5)).all()
    owner = np.searchsorted(X.edges_of(bits, buckets), keys, side="right")
    assert [b for b, _ in rows] == sorted(set(owner.tolist()))
    assert len(X.sent(keys, [], bits, buckets, empty=True)) == buckets


def test_word_hashes_do_not_depend_on_what_stands_beside():
    words = [b"a", b"", b"\xc3\xa9", b"word" * 50, b"a"]
    alone = [X.word_hashes([w])[0] for w in words]
    assert X.word_hashes(words).tolist() == alone and alone[0] == alone[4] and len(set(alone)) == 4
