"""Benchmark: the coverage report on the demo mapping of the test tables.

Prints one JSON line. Environment:
  BENCH_SF_DIR   test-data folder (default /root/testdata/sf0.1)
  BENCH_CPUS     local cores (default 8)
  BENCH_REPEATS  timed runs per query after one warm-up (default 3; median kept)

The five role tables are first derived from the TPC-H-like tables and
written to a scratch parquet folder (timed as ``prepare_inputs``, not part
of the headline), because the job itself reads prepared tables. Each query
is then run to completion into Spark's ``noop`` sink, so nothing is
collected. The headline ``value`` is ``full_report``: the whole report with
its reused stages materialised once. ``full_job`` is the batch job: checks,
tables, notes and metrics, written. The ``_x10`` runs have ten times the
facts (every entity ten times under names of its own), once each after the
others, so that they measure data and not the number of jobs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from covtab.operators import (  # noqa: E402
    attribute,
    candidate_observations,
    category_cells,
    coverage,
    coverage_table,
    crosstab,
    crosstab_table,
    known_by_org,
    org_reference,
    population,
    publish_coverage,
    publish_crosstab,
    publish_rates,
    rate_crosstab,
    direct_codes,
    living,
    keep_living,
    mapped_codes,
    org_map,
    reduce_facts,
    registrations,
    resolve_entities,
    resolve_reduced,
    resolve_staged,
)
from covtab.operators.observe import dedupe_observations, union_observations  # noqa: E402
from covtab.operators.resolve import latest_per_key  # noqa: E402
from covtab.params import JobParams  # noqa: E402
from covtab.plans import build_report, run_job  # noqa: E402
from covtab.plans.report import resolved_living  # noqa: E402
from covtab.session import local_session  # noqa: E402
from covtab.sources import DEMO_ASOF, demo_inputs, read_role  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeats):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="covtab-bench")
    scratch = tempfile.mkdtemp(prefix="covtab-bench-")

    t = time.perf_counter()
    for role, df in demo_inputs(spark, sf_dir).items():
        df.write.mode("overwrite").parquet(f"{scratch}/{role}")
    prepare = round(time.perf_counter() - t, 3)
    inp = {role: read_role(spark, role, f"{scratch}/{role}") for role in
           ("facts", "concept_map", "facilities", "orgs", "asset")}
    facts, cmap = inp["facts"], inp["concept_map"]
    params = JobParams(asof=DEMO_ASOF)

    def staged():
        obs = union_observations(
            latest_per_key(dedupe_observations(mapped_codes(facts, cmap)), date="record_date"),
            latest_per_key(dedupe_observations(direct_codes(facts), date="period_end"), date="period_end"),
        )
        run(keep_living(resolve_staged(obs), living(facts)))

    def fused():
        run(keep_living(resolve_entities(candidate_observations(facts, cmap)), living(facts)))

    def single_scan():
        run(resolved_living(resolve_reduced(reduce_facts(facts, cmap))))

    def regs():
        run(registrations(facts, org_map(inp["facilities"], inp["orgs"], DEMO_ASOF)))

    def lazy_table(name):
        return lambda: run(build_report(inp, params, materialise=False).tables[name])

    def full_report(inp=inp):
        rep = build_report(inp, params, materialise=True)
        for df in rep.tables.values():
            run(df)
        rep.close()

    def full_job():
        run_job(spark, {role: f"{scratch}/{role}" for role in inp}, params, f"{scratch}/out", "parquet", force=True)

    def original_shape(inp=inp, facts=facts):
        # The original plan shape end to end: staged self-join resolution,
        # row-level attribution, separate cell and population jobs, and
        # every published table re-running its whole lineage.
        mapping = org_map(inp["facilities"], inp["orgs"], DEMO_ASOF)
        obs = union_observations(
            latest_per_key(dedupe_observations(mapped_codes(facts, cmap)), date="record_date"),
            latest_per_key(dedupe_observations(direct_codes(facts), date="period_end"), date="period_end"),
        )
        resolved = keep_living(resolve_staged(obs), living(facts))
        regs_ = registrations(facts, mapping)
        pop = population(regs_)
        cells_p = category_cells(attribute(resolved, regs_))
        cells_s = category_cells(attribute(inp["asset"], regs_))
        cov_p = coverage(pop, known_by_org(cells_p))
        cov_s = coverage(pop, known_by_org(cells_s))
        t2 = coverage_table(cov_s)
        t3a = crosstab_table(crosstab(cells_s, cov_s))
        for df in (publish_coverage(coverage_table(cov_p)), publish_coverage(t2), publish_crosstab(t3a),
                   publish_rates(rate_crosstab(t3a, t2)), org_reference(mapping)):
            run(df)

    queries = {
        "resolve_staged": timed(staged, repeats),
        "resolve_fused": timed(fused, repeats),
        "resolve_single_scan": timed(single_scan, repeats),
        "registrations": timed(regs, repeats),
        "table_2": timed(lazy_table("table_2"), repeats),
        "table_3b": timed(lazy_table("table_3b"), repeats),
        "full_report": timed(full_report, repeats),
        "full_job": timed(full_job, repeats),
        "original_shape_report": timed(original_shape, repeats),
    }
    copies = facts.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(9))))
    many = copies.withColumn("entity_id", F.concat("entity_id", F.lit("-"), F.col("_copy").cast("string"))).drop("_copy")
    many.write.parquet(f"{scratch}/facts_x10")
    ten = inp | {"facts": read_role(spark, "facts", f"{scratch}/facts_x10")}
    for name, fn in (("full_report_x10", lambda: full_report(ten)), ("original_shape_report_x10", lambda: original_shape(ten, ten["facts"]))):
        t = time.perf_counter()
        fn()
        queries[name] = round(time.perf_counter() - t, 3)
    facts_rows = facts.count()
    print(json.dumps({
        "metric": "full_report",
        "value": queries["full_report"],
        "unit": "sec",
        "queries": queries,
        "sf": sf,
        "prepare_inputs": prepare,
        "facts_rows": facts_rows,
        "speedup_vs_original_shape": round(queries["original_shape_report"] / queries["full_report"], 2),
        "speedup_vs_original_shape_x10": round(queries["original_shape_report_x10"] / queries["full_report_x10"], 2),
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
