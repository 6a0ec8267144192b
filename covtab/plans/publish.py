"""Publishing: presentation order, the written tables, and the notes that
go with them.

The original job built a styled workbook on the driver. Here each table is
written by Spark to its own folder (CSV with a header, or parquet), sorted
for presentation, plus a ``publication_notes`` table that carries the cover,
interpretation and footnote text and the size of every table. Workbook
styling is out of scope (see README).

A publication is all or nothing. Its tables go to a folder of their own,

    path/versions/<version>/<table>/...

which nobody is told of until its manifest is there:

    path/manifests/<number>.json

The manifest names the version, its tables with their formats, columns and
numbers of rows, and is written last, in one step, under the next free number.
Readers (:func:`open_published`) take the manifest of the highest number and go
to the folders it names, so they see all of one run and nothing of another, also
while a run is writing, after one that failed at any point, and when two runs
publish at once: both are whole, and the one with the higher number is current.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from covtab.session import create_file, delete_path, ensure_checkpoint_dir, list_path, materialize, read_file

SORT_KEYS = {"org_reference": ("org_code",)}
DEFAULT_SORT = ("org_name", "org_code")

# Fixed text of the publication notes (a caller can pass their own).
DEFAULT_NOTES = {
    "title": "Category coverage by organisation",
    "organisation": "",
    "interpretation": {
        "table_1": "Living registered entities per organisation with a known category, primary source only.",
        "table_2": "As table 1, using the combined category asset.",
        "table_3a": "Combined asset: registrations per organisation and category.",
        "table_3b": "Table 3a divided by the living registrations of the organisation in table 2.",
        "org_reference": "Organisations valid on the reporting date.",
    },
    "footnotes": (
        "Counts from 1 to 7 are shown as *; other counts are rounded to the nearest 5.",
        "Totals are summed before rounding, so they need not equal the sum of the published cells.",
        "Rates use the rounded counts; a rate with a suppressed count is shown as *.",
    ),
}


def published_order(df: DataFrame, keys: Sequence[str] = DEFAULT_SORT, rank: str = "rank") -> DataFrame:
    """Add a 1-based ``rank`` in presentation order: ascending, nulls first,
    binary string order (the TOTAL row sorts in with the names).

    Distributed: the sort range-partitions the rows; each partition numbers
    its own rows and adds the row count of the partitions before it (a table
    with one row per partition, so its size is bounded by the partition
    count). Nothing is gathered into one task. The range-partitioned rows are
    materialised first: range bounds come from sampling, so two separate
    evaluations could split the rows differently, and both the numbering and
    the counting must see the same partitions.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    ranged = materialize(df.orderBy(*order).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = local.join(F.broadcast(offsets), "_pid").withColumn(rank, (F.col("_off") + F.col("_lr")).cast("long"))
    return out.drop("_pid", "_lr", "_off")


def _fixed_notes(notes: Mapping | None, names: Sequence[str]) -> list[tuple[str, str, str]]:
    notes = dict(DEFAULT_NOTES, **(notes or {}))
    fixed = [("cover", "title", notes["title"]), ("cover", "organisation", notes["organisation"])]
    fixed += [("interpretation", k, v) for k, v in notes["interpretation"].items() if k in names]
    return fixed + [("footnote", str(i + 1), t) for i, t in enumerate(notes["footnotes"])]


NOTES_SCHEMA = "section string, item string, text string"


def publication_notes(spark: SparkSession, tables: Mapping[str, DataFrame], notes: Mapping | None = None) -> DataFrame:
    """``(section, item, text)`` rows: cover, interpretation, footnotes, and
    a contents row per table with its row and column counts (counted by
    Spark, one small aggregation per table)."""
    out = spark.createDataFrame(_fixed_notes(notes, list(tables)), NOTES_SCHEMA)
    for name, df in tables.items():
        text = F.concat(F.count(F.lit(1)).cast("string"), F.lit(f" rows, {len(df.columns)} columns"))
        out = out.unionByName(df.agg(F.lit("contents").alias("section"), F.lit(name).alias("item"), text.alias("text")))
    return out


class Publication:
    """A version that is being written. ``add`` writes tables, ``commit`` makes
    them current, ``abandon`` deletes them."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "csv"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        now = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S")
        self.version = f"{now}-{uuid.uuid4().hex[:12]}"
        self.folder = f"{self.path}/versions/{self.version}"
        self.tables: dict[str, dict] = {}

    def add(self, name: str, df: DataFrame, one_file: bool = True) -> str:
        """Writes one table, sorted for presentation; its rows are counted by
        the job that writes them. Returns its folder."""
        keys = [F.col(k).asc_nulls_first() for k in SORT_KEYS.get(name, DEFAULT_SORT) if k in df.columns]
        counted = Observation()
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
        if one_file:
            df = df.repartition(1).sortWithinPartitions(*keys) if keys else df.repartition(1)
        elif keys:
            df = df.orderBy(*keys)
        folder = f"{self.folder}/{name}"
        df.write.format(self.fmt).options(**({"header": True} if self.fmt == "csv" else {})).save(folder)
        self.tables[name] = {"folder": f"versions/{self.version}/{name}", "format": self.fmt, "columns": df.columns,
                             "rows": counted.get["rows"]}
        return folder

    def add_notes(self, notes: Mapping | None = None) -> str:
        """``publication_notes`` of the tables added so far, from their counts."""
        names = [n for n in self.tables if not n.startswith("_")]
        rows = _fixed_notes(notes, names) + [
            ("contents", n, f"{self.tables[n]['rows']} rows, {len(self.tables[n]['columns'])} columns") for n in names]
        return self.add("publication_notes", self.spark.createDataFrame(rows, NOTES_SCHEMA))

    def commit(self, **about) -> int:
        """Writes the manifest, with ``about``, and returns its number. Another
        run that took the number first only moves this one to the next."""
        manifest = {"version": self.version, "tables": self.tables, **about}
        number = max(published_versions(self.spark, self.path), default=0) + 1
        while not create_file(self.spark, f"{self.path}/manifests/{number:012d}.json", json.dumps(manifest | {"number": number}, indent=1)):
            number += 1
        return number

    def abandon(self) -> None:
        delete_path(self.spark, self.folder)


def publish_tables(tables: Mapping[str, DataFrame], path: str, fmt: str = "csv", notes: Mapping | None = None,
                   one_file: bool = True, **about) -> dict[str, str]:
    """Publish the tables, and ``publication_notes`` with ``notes``, as one
    version below ``path``; ``about`` goes into the manifest.

    ``one_file=True``: a table is one file, sorted; tables have a row for an
    organisation, so one task writes them. ``one_file=False``: range-partitioned
    files, each sorted, for very many organisations. A run that fails publishes
    nothing and leaves nothing. Returns the folder of each table.
    """
    out = Publication(next(iter(tables.values())).sparkSession, path, fmt)
    try:
        written = {name: out.add(name, df, one_file) for name, df in tables.items()}
        written["publication_notes"] = out.add_notes(notes)
        out.commit(**about)
    except BaseException:
        out.abandon()
        raise
    return written


def published_versions(spark: SparkSession, path: str) -> dict[int, dict]:
    """The manifests below ``path`` by number, oldest first. A file that is no
    whole manifest (a writer died in it) does not count."""
    out = {}
    for file in sorted(list_path(spark, f"{path.rstrip('/')}/manifests")):
        name = file.rsplit("/", 1)[-1]
        if name.endswith(".json") and name[:-5].isdigit():
            try:
                out[int(name[:-5])] = json.loads(read_file(spark, file))
            except ValueError:
                continue
    return out


def open_published(spark: SparkSession, path: str, number: int | None = None) -> dict[str, DataFrame]:
    """The tables of the current publication below ``path``, or of manifest
    ``number``, all of one run."""
    found = published_versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    manifest = found[max(found) if number is None else number]
    return {name: read_published(spark, f"{path.rstrip('/')}/{t['folder']}", t["format"]) for name, t in manifest["tables"].items()}


def prune_published(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Deletes all but the last ``keep`` publications: the manifest first, so
    that no reader is sent to a folder that is going. Versions without a
    manifest may be under way and stay. Returns the deleted numbers."""
    found = published_versions(spark, path)
    gone = sorted(found)[:max(len(found) - max(keep, 1), 0)]
    for number in gone:
        delete_path(spark, f"{path.rstrip('/')}/manifests/{number:012d}.json")
        delete_path(spark, f"{path.rstrip('/')}/versions/{found[number]['version']}")
    return gone


def read_published(spark: SparkSession, folder: str, fmt: str = "csv") -> DataFrame:
    """Read one published table back (all columns as text for CSV)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", False)
    return r.load(folder)


def read_typed(df: DataFrame, counts: Sequence[str] = (), rates: Sequence[str] = ()) -> DataFrame:
    """A published table, all text, with its measures as numbers again: counts
    are longs, rates doubles, and what is no number (the suppression mark) is
    null, as in the numeric twin. Every other column, codes that look like
    numbers included, stays the text it is."""
    kinds = {**dict.fromkeys(counts, "bigint"), **dict.fromkeys(rates, "double")}
    return df.select(*[F.expr(f"try_cast(trim(`{c}`) AS {kinds[c]}) AS `{c}`") if c in kinds else F.col(f"`{c}`") for c in df.columns])


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
