import hashlib
import random

import pytest

from covtab.llm import piece_bpe as B

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    return B.Codec(B.default_model()), sentencepiece.SentencePieceProcessor(model_file=B.default_model())


def test_random_texts(both):
    codec, library = both
    rng = random.Random(5)
    letters = list(" ▁\n\tab cdethe 012  .,!éü漢字😀<s>0x")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice(c) for _ in range(rng.randrange(300))) for c in ("ab", " a", "th e", "aA") for _ in range(100)]
    texts += [" " * n for n in range(70)] + ["x" + " " * n + "y" for n in range(70)] + ["a" * n for n in range(1, 100)]
    texts += ["the" * 3000, " " * 5000 + "q", "=-" * 5000, "0" * 9000, "<0x0A></s><unk>", "", "\x00", "▁▁x▁", "ก" * 50]
    for text in texts:
        ids = library.encode(text)
        assert codec.encode(text) == ids, text[:80]
        assert codec.decode(ids) == library.decode(ids), text[:80]


def test_decoding_any_ids(both):
    codec, library = both
    rng = random.Random(6)
    for _ in range(1500):
        ids = [rng.randrange(3, 259) if rng.random() < 0.5 else rng.randrange(3, 32000) for _ in range(rng.randrange(12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_unsafe_merges_in_a_long_word(both):
    codec, library = both
    rng = random.Random(7)
    for _ in range(30):
        text = "".join(rng.choice(["ab", "aba", "ing", "in", "g", "the", "th", "he", "ere"]) for _ in range(400))
        assert codec.encode(text) == library.encode(text)


def test_tables(table, odd_rows, both):
    _, library = both
    for clashing in (False, True):
        got = [tuple(r) for r in B.digests(table(odd_rows, clashing)).collect()]
        want = []
        for i, t in odd_rows:
            ids = library.encode(t or "")
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(library.decode(ids).encode()).hexdigest()))
        assert sorted(map(str, got)) == sorted(map(str, want))
    rows = {r.doc_id: r for r in B.encoded(table([(1, "a b"), (2, None)])).collect()}
    assert rows[1].ids == library.encode("a b") and rows[1].decoded == "a b"
    assert rows[2].ids == [] and rows[2].decoded == ""
    assert B.digests(table([])).collect() == []


def test_forgetting_does_not_change_results(both, monkeypatch):
    codec, library = both
    monkeypatch.setattr(B, "REMEMBERED", 5)
    monkeypatch.setattr(B, "BLOCK_CHARS", 40)
    texts = [f"some words number {k} and {k % 3} more" for k in range(50)]
    got = [[i for ids, in found for i in ids] for found in B._encoded(iter(texts), codec, lambda ids: (ids,))]
    assert got == [library.encode(t) for t in texts]
