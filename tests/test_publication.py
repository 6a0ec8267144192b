"""Publications are all or nothing, whenever a run fails and whoever reads."""

import json
import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from covtab.plans import publish
from covtab.plans.publish import Publication, open_published, prune_published, publish_tables, published_versions
from covtab.session import Scratch, create_file, list_path


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="covtab-publication-")


def tables(spark, mark, n=3):
    return {name: spark.range(n).select(F.lit(mark).alias("org_name"), F.col("id").cast("string").alias("org_code"))
            for name in ("table_1", "table_2")}


def marks(spark, root):
    found = open_published(spark, root)
    return {r.org_name for name in ("table_1", "table_2") for r in found[name].collect()}


def folders(root):
    return sorted(p.name for p in pathlib.Path(root, "versions").iterdir())


def test_readers_see_the_last_whole_run(spark, root):
    with pytest.raises(FileNotFoundError):
        open_published(spark, root)
    publish_tables(tables(spark, "old"), root, asof="2021-06-30")
    publish_tables(tables(spark, "new", 5), root, "parquet")
    assert marks(spark, root) == {"new"}
    versions = published_versions(spark, root)
    assert list(versions) == [1, 2] and versions[1]["asof"] == "2021-06-30"
    assert versions[2]["tables"]["table_1"] | {"folder": ""} == {
        "folder": "", "format": "parquet", "columns": ["org_name", "org_code"], "rows": 5}
    old = open_published(spark, root, 1)
    assert old["table_1"].count() == 3 and {"contents", "cover"} <= {r.section for r in old["publication_notes"].collect()}
    notes = {(r.section, r.item): r.text for r in open_published(spark, root)["publication_notes"].collect()}
    assert notes["contents", "table_2"] == "5 rows, 2 columns"


@pytest.mark.parametrize("step", ["first table", "second table", "notes", "manifest"])
def test_failure_at_any_step_leaves_the_old_run(spark, root, step, monkeypatch):
    publish_tables(tables(spark, "old"), root)
    before = folders(root)
    new = tables(spark, "new")
    broken = new["table_1"].withColumn("org_code", F.raise_error(F.lit("broken")).cast("string"))
    if step == "first table":
        new["table_1"] = broken
    elif step == "second table":
        new["table_2"] = broken
    else:
        def fail(*args, **kwargs):
            raise RuntimeError("broken")

        monkeypatch.setattr(*((Publication, "add_notes") if step == "notes" else (publish, "create_file")), fail)
    with pytest.raises(Exception, match="broken"):
        publish_tables(new, root)
    monkeypatch.undo()
    assert marks(spark, root) == {"old"} and folders(root) == before and list(published_versions(spark, root)) == [1]
    publish_tables(tables(spark, "later"), root)
    assert marks(spark, root) == {"later"}


def test_a_run_that_was_killed_between_steps(spark, root):
    """Nothing cleans up after it: its folder has no manifest, and half a manifest is none."""
    publish_tables(tables(spark, "old"), root)
    dead = Publication(spark, root)
    dead.add("table_1", tables(spark, "dead")["table_1"])
    assert marks(spark, root) == {"old"}
    pathlib.Path(root, "manifests", "000000000002.json").write_text('{"version": "x", "tab')
    assert marks(spark, root) == {"old"}
    publish_tables(tables(spark, "new"), root)
    assert marks(spark, root) == {"new"} and list(published_versions(spark, root)) == [1, 3]


def test_two_runs_at_once_are_both_whole(spark, root):
    a, b = Publication(spark, root), Publication(spark, root)
    for name in ("table_1", "table_2"):
        a.add(name, tables(spark, "a")[name])
        b.add(name, tables(spark, "b")[name])
    assert b.commit() == 1
    assert marks(spark, root) == {"b"}
    assert a.commit() == 2
    assert marks(spark, root) == {"a"}
    assert {r.org_name for r in open_published(spark, root, 1)["table_2"].collect()} == {"b"}


def test_a_taken_number_is_not_written_over(spark, root):
    path = f"{root}/manifests/000000000001.json"
    assert create_file(spark, path, "1") and not create_file(spark, path, "2")
    assert pathlib.Path(path).read_text() == "1"
    assert [p.rsplit("/", 1)[-1] for p in list_path(spark, f"{root}/manifests")] == ["000000000001.json"]


def test_prune_keeps_what_has_no_manifest(spark, root):
    for mark in "abcd":
        publish_tables(tables(spark, mark), root)
    under_way = Publication(spark, root)
    under_way.add("table_1", tables(spark, "e")["table_1"])
    assert prune_published(spark, root, keep=2) == [1, 2]
    assert marks(spark, root) == {"d"} and len(folders(root)) == 3
    under_way.add("table_2", tables(spark, "e")["table_2"])
    assert under_way.commit() == 5 and marks(spark, root) == {"e"}


def test_scratch_runs_do_not_touch_each_other(spark):
    before = spark.sparkContext.getCheckpointDir()
    with Scratch(spark) as a, Scratch(spark) as b:
        x, y = a.table(spark.range(5), "x"), b.bucketed(spark.range(7).withColumnRenamed("id", "entity_id"), "y")
        b.close()
        assert x.count() == 5
        z = a.bucketed(spark.range(9).withColumnRenamed("id", "entity_id"), "y")
        assert z.count() == 9
    assert spark.sparkContext.getCheckpointDir() == before
    assert list_path(spark, a.path) == list_path(spark, b.path) == []
    assert y is not None


def test_manifest_is_json(spark, root):
    publish_tables(tables(spark, "x"), root)
    assert json.loads(pathlib.Path(root, "manifests", "000000000001.json").read_text())["number"] == 1
