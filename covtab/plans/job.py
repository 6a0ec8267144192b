"""The report as one batch job: read the five role tables, check them, and
publish the tables with their notes.

    spark-submit -m covtab ... (or python -m covtab) --asof 2024-03-31 \\
        --facts facts_table --concept-map concept_map_table \\
        --facilities facility_table --orgs org_table --asset asset_table \\
        --out /shared/reports/2024-03-31 [--format csv|parquet] [--parity] [--force] \\
        [--rename facts:PERSON_ID=entity_id ...] [--domain A,B,C] \\
        [--title TEXT] [--organisation TEXT] [--footnote TEXT ...] [--keep N]

Sources are catalog table names or parquet paths. The session's
``spark.checkpoint.dir`` must name a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Mapping

from pyspark.sql import SparkSession

from covtab.params import CATEGORY_DOMAIN, JobParams
from covtab.plans.publish import Publication, prune_published, read_published
from covtab.plans.quality import blocking
from covtab.plans.report import build_report
from covtab.session import Scratch
from covtab.sources import read_inputs


class ChecksFailed(RuntimeError):
    """The checks found what must not be published; they are written, the tables are not."""


def run_job(spark: SparkSession, sources: dict, params: JobParams, out: str, fmt: str = "csv",
            renames: Mapping[str, Mapping[str, str]] | None = None, notes: Mapping | None = None,
            force: bool = False) -> dict:
    """Check, then publish as one version (see :mod:`covtab.plans.publish`).
    Returns the written folders, the checks as DataFrames over what was
    written, the manifest's number, and the elapsed seconds.

    The version holds the tables, their notes, ``_freshness``, ``_quality`` and
    ``_metrics``: the seconds of each step, and what the writing jobs counted.
    If the quality report has a blocking row (see :mod:`covtab.plans.quality`)
    the job stops with :class:`ChecksFailed` and publishes nothing, unless
    ``force``; its checks are then in ``{out}/_freshness`` and ``{out}/_quality``.
    Stages that the run writes to the checkpoint folder are deleted at its end.
    """
    out = out.rstrip("/")
    written: dict[str, str] = {}
    seconds: dict[str, float] = {}
    started = last = time.perf_counter()

    def lap(step: str) -> None:
        nonlocal last
        now = time.perf_counter()
        seconds[step], last = round(now - last, 3), now

    with Scratch(spark, "job") as scratch:
        report = build_report(read_inputs(spark, sources, renames), params, scratch=scratch)
        checks = {name: scratch.table(report.stages[name], name) for name in ("freshness", "quality")}
        lap("checks")
        bad = blocking(checks["quality"])
        if not force and not bad.isEmpty():
            for name, df in checks.items():
                df.repartition(1).write.mode("overwrite").format(fmt).option("header", True).save(f"{out}/_{name}")
            first = bad.orderBy("check", "subject").first()
            raise ChecksFailed(f"{first['check']} of {first['subject']}: {first['value']}; see {out}/_quality")
        version = Publication(spark, out, fmt)
        try:
            for name, df in report.tables.items():
                written[name] = version.add(name, df)
            written["publication_notes"] = version.add_notes(notes)
            for name, df in checks.items():
                written[f"_{name}"] = version.add(f"_{name}", df)
            lap("tables")
            counted = {k: v for k, v in report.metrics().items() if isinstance(v, int)}
            rows = [(f"seconds_{k}", v) for k, v in seconds.items()] + [("seconds", round(time.perf_counter() - started, 3))]
            rows += [(k, float(v)) for k, v in counted.items()]
            written["_metrics"] = version.add("_metrics", spark.createDataFrame(rows, "metric string, value double"))
            number = version.commit(asof=params.asof.isoformat(), parity=params.parity)
        except BaseException:
            version.abandon()
            raise
    checks = {name: read_published(spark, written[f"_{name}"], fmt) for name in ("freshness", "quality")}
    return {"written": written, "checks": checks, "number": number, "seconds": round(time.perf_counter() - started, 3)}


def _renames(given: list[str]) -> dict[str, dict[str, str]]:
    """``role:SOURCE=column`` options by role."""
    out: dict[str, dict[str, str]] = {}
    for text in given:
        role, _, pair = text.partition(":")
        source, _, column = pair.partition("=")
        out.setdefault(role.replace("-", "_"), {})[source] = column
    return out


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="covtab", description="Category coverage report")
    ap.add_argument("--asof", required=True)
    for role in ("facts", "concept-map", "facilities", "orgs", "asset"):
        ap.add_argument(f"--{role}", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv", choices=("csv", "parquet"))
    ap.add_argument("--parity", action="store_true")
    ap.add_argument("--force", action="store_true", help="publish although a check stops the run")
    ap.add_argument("--rename", action="append", default=[], metavar="ROLE:SOURCE=COLUMN")
    ap.add_argument("--domain", default=",".join(CATEGORY_DOMAIN))
    ap.add_argument("--title")
    ap.add_argument("--organisation")
    ap.add_argument("--footnote", action="append")
    ap.add_argument("--keep", type=int, help="delete older publications but for the last N")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("covtab").getOrCreate()
    sources = {"facts": a.facts, "concept_map": a.concept_map, "facilities": a.facilities,
               "orgs": a.orgs, "asset": a.asset}
    given = {"title": a.title, "organisation": a.organisation, "footnotes": a.footnote}
    res = run_job(spark, sources, JobParams(asof=a.asof, parity=a.parity, domain=tuple(a.domain.split(","))), a.out, a.format,
                  _renames(a.rename), {k: v for k, v in given.items() if v is not None}, a.force)
    if a.keep:
        prune_published(spark, a.out, a.keep)
    print({"written": res["written"], "seconds": res["seconds"]})


if __name__ == "__main__":
    main()
