"""Benchmark: headline queries on $BENCH_SF_DIR at local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
Each query is executed fully (``write.format("noop")``, no collect) and timed
as the median of ``$BENCH_REPEAT`` runs (default 3) after one warm-up run.
``value`` is the sum of the medians.

The raw layer is first landed once as Parquet (untimed) from the driver tables,
as the loader would leave it; the models read it like the reference's models
read its raw tables.  Queries:

  reconciliation      M-10 from the raw layer
  reconciliation_e2e  M-10 end to end from the driver tables (fixture included)
  dedup               M-1 / W-1 retry removal
  fact_order_lines    M-8 / W-4 with distributed dense keys
  fact_settlements    M-9 / W-5
  dim_date            M-5
  daily_revenue       R-1
  bank_by_day         A-9 from the ground-truth lines
  checks              C-1..C-6 gate (21 checks in one plan)
  full_build          the production build (intermediates written, then marts
                      from them, concurrent jobs) + the 21 checks on the result
  load_first          exactly-once loader on the four messy feeds (written once,
                      untimed, from the driver tables) into a fresh warehouse
  load_rerun          the same load again: every file skipped by content hash
  pipeline_night      the nightly job end to end on the landing files into a
                      fresh warehouse: sense, load, build (written), 21 checks
                      on the written tables, publish  (one run)
  pipeline_rerun      the next night with no new files (one run)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = {
    "reconciliation": "revenue_reconciliation",
    "dedup": "orders_deduplicated",
    "fact_order_lines": "fact_order_lines",
    "fact_settlements": "fact_settlements",
    "dim_date": "dim_date",
    "daily_revenue": "daily_revenue",
}
RAW = ("shopify_orders", "amazon_settlements", "pos_transactions", "product_master",
       "bank_deposits")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def land_raw(spark, sf_dir: str, root: str):
    """Write the raw layer (and the ground-truth lines) once; return readers."""
    from tallyhouse.operators.bank import truth_from_fixture
    from tallyhouse.sources.tables import RawTables, adapter_raw
    raw = adapter_raw(spark, sf_dir)
    for name in RAW:
        getattr(raw, name).write.mode("overwrite").parquet(f"{root}/{name}")
    truth_from_fixture(raw.truth_lines).write.mode("overwrite").parquet(f"{root}/truth_lines")
    return lambda: RawTables(**{n: spark.read.parquet(f"{root}/{n}") for n in RAW},
                             truth_lines=spark.read.parquet(f"{root}/truth_lines"))


def full_build(spark, landed, root: str) -> None:
    """The production build on the landed raw layer: intermediates written,
    marts built from them and written, then the 21 checks on the written tables."""
    from tallyhouse.operators import checks as chk
    from tallyhouse.plans import jobs
    from tallyhouse.plans.registry import DATA_CATEGORIES
    paths = {n: f"{root}/{n}" for n in jobs.BUILT_TABLES}
    jobs.write_build(spark, landed(), None, paths)
    run(chk.check_results(chk.gate_checks(jobs.Built(spark, paths=paths), DATA_CATEGORIES)))


def write_landing(spark, sf_dir: str, root: str) -> None:
    from tallyhouse.plans.registry import DRIFT_DATE
    from tallyhouse.sources import writers as wr
    from tallyhouse.sources.tables import adapter_raw
    raw = adapter_raw(spark, sf_dir)
    wr.write_order_pages(raw.shopify_orders, f"{root}/shopify", DRIFT_DATE)
    wr.write_settlements(raw.amazon_settlements, f"{root}/amazon", DRIFT_DATE)
    wr.write_pos(spark, raw.pos_transactions, f"{root}/pos")
    wr.write_workbooks(raw.product_master, root)


def main() -> None:
    from tallyhouse import catalog
    from tallyhouse.session import build_session, scratch_path

    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from tallyhouse.operators import checks as chk
    from tallyhouse.operators.bank import bank_by_channel_day
    from tallyhouse.plans.models import Models
    from tallyhouse.plans.registry import DATA_CATEGORIES

    q = catalog.queries()
    scratch = scratch_path(spark, "bench")
    landed = land_raw(spark, SF_DIR, f"{scratch}/raw")
    # warm-up: JVM, codegen and the parquet footers
    run(Models(landed()).revenue_reconciliation)
    run(q["revenue_reconciliation"](spark, SF_DIR))

    def med(fn) -> float:
        return round(statistics.median([timed(fn) for _ in range(REPEAT)]), 3)

    results: dict[str, float] = {}
    for key, name in HEADLINE.items():
        results[key] = med(lambda: run(Models(landed()).model(name)))
    results["reconciliation_e2e"] = med(lambda: run(q["revenue_reconciliation"](spark, SF_DIR)))
    results["bank_by_day"] = med(lambda: run(bank_by_channel_day(landed().truth_lines)))
    results["checks"] = med(lambda: run(chk.check_results(chk.gate_checks(
        Models(landed(), materialize="table"), DATA_CATEGORIES))))
    builds = iter(range(REPEAT))
    results["full_build"] = med(lambda: full_build(spark, landed, f"{scratch}/build{next(builds)}"))

    from tallyhouse.sources.manifest import Warehouse, ingest
    landing = f"{scratch}/landing"
    write_landing(spark, SF_DIR, landing)
    first, rerun, load_stats = [], [], {}
    for i in range(REPEAT):
        wh = Warehouse(f"{scratch}/wh{i}")
        t = time.perf_counter()
        load_stats = ingest(spark, wh, landing, nested=True)
        first.append(time.perf_counter() - t)
        rerun.append(timed(lambda: ingest(spark, wh, landing, nested=True)))
    results["load_first"] = round(statistics.median(first), 3)
    results["load_rerun"] = round(statistics.median(rerun), 3)
    import datetime as dt

    from tallyhouse.operators.bank import bank_by_channel
    from tallyhouse.plans import jobs
    bank = bank_by_channel(landed().bank_deposits)
    wh = Warehouse(f"{scratch}/wh-pipeline")
    results["pipeline_night"] = round(timed(lambda: jobs.run_pipeline(
        spark, landing, wh, dt.date(2001, 8, 1), bank, categories=DATA_CATEGORIES, nested=True)), 3)
    results["pipeline_rerun"] = round(timed(lambda: jobs.run_pipeline(
        spark, landing, wh, dt.date(2001, 8, 2), bank, categories=DATA_CATEGORIES, nested=True)), 3)
    files = sum(v["files_seen"] for v in load_stats.values())
    rows = sum(v["loaded_rows"] for v in load_stats.values())

    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": CPUS,
        "repeat": REPEAT,
        "spark": spark.version,
        "load_files": files,
        "load_rows": rows,
        "load_files_per_sec": round(files / results["load_first"], 1),
        "load_rows_per_sec": round(rows / results["load_first"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
