"""The pipeline's stages against plain Python, each on what the one before kept."""

import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from covtab.llm import quality_rules, secret_scan
from covtab.llm.byte_bpe import Encoder, default_ranks
from covtab.llm.common import read_table
from covtab.llm.pattern_packing import cut
from tests.llm.test_secret_scan import plain_base
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage returns, written and read again as a run does."""
    try:
        docs = read_table(spark, SF, "documents")
    except Exception:
        pytest.skip("test data not present")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "SimHash near-dedup", "secret scans", "best-fit packing"]
    for df in kept[1:5]:
        assert df.columns == kept[0].columns and df.dtypes == kept[0].dtypes


def test_quality(kept):
    good = {r.doc_id for r in quality_rules.judge(kept[0]).where("kept").collect()}
    assert set(texts(kept[1])) == good and 0 < len(good) < kept[0].count()


def test_exact(kept):
    groups = {}
    for i, t in texts(kept[1]).items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i))
    assert set(texts(kept[2])) == {min(g)[1] for g in groups.values()}


def test_near(kept):
    rows = sorted(texts(kept[2]).items())
    prints = [plain_fingerprint(t) for _, t in rows]
    assert set(texts(kept[3])) == set(plain_components(prints, [i for i, _ in rows]))


def test_secrets(kept):
    before, after = texts(kept[3]), texts(kept[4])
    assert set(before) == set(after)
    random = {r.doc_id for r in secret_scan.scan(kept[3]).where("n_random > 0").collect()}
    for i, text in before.items():
        if i in random:
            continue
        out, at = [], 0
        for start, _, end in plain_base(text):
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        assert after[i] == "".join(out) + text[at:]
        assert not plain_base(after[i])
    assert {r.doc_id: r.n_chars for r in kept[4].select("doc_id", "n_chars").collect()} == {i: len(t) for i, t in after.items()}


def test_packing(kept):
    encoder, want = Encoder(default_ranks()), []
    for i, t in texts(kept[4]).items():
        ids = np.append(encoder.ids(t), 2).astype("<u4")
        want += [(i, k, a, n, zlib.crc32(ids[a:a + n].tobytes())) for k, (a, n) in enumerate(cut(ids.size))]
    assert sorted(tuple(r)[:5] for r in kept[5].collect()) == sorted(want)


def test_run_equals_the_stages(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == kept[5].columns
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, kept[5].select(*key).collect()))
