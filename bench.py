"""Benchmark: the mart's headline jobs over stored tables.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line.  Setup (not timed) lands the staging tables and
builds the mart once; then each query runs several times and the median of
the warm runs is reported:

  daily_sales        C1 over the stored orders staging table
  weekly_retention   C2 over the stored daily fact and item dimension
  dedup_orders       M5 over the raw orders staging input (with later copies)
  daily_increment    C4 for one business day (delete, append, de-dup, checks,
                     dimensions, fact days, retention) -- idempotent, so every
                     run starts from the same state

Compute-only queries write to Spark's no-op sink (full execution, no output
files); the increment performs its real writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from martwright.operators import staging  # noqa: E402
from martwright.plans import jobs  # noqa: E402
from martwright.plans import retention as R  # noqa: E402
from martwright.plans import sales as C1  # noqa: E402
from martwright.session import build_session, scratch_path  # noqa: E402
from martwright.sources import fixtures as fx  # noqa: E402
from martwright.sources.landing import landing_path, write_landing  # noqa: E402
from martwright.sources.store import Warehouse, stage  # noqa: E402

INCREMENT_DS = "2001-07-15"
RUNS = int(os.environ.get("BENCH_RUNS", "4"))


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app_name="martwright-bench",
                          shuffle_partitions=int(cpus) * 2)

    # ---- setup: stored staging + mart (initial load without landing CSVs)
    # month grain: the test history is 2,400 sparse days (see Warehouse)
    wh = Warehouse(spark, scratch_path(spark, "bench-wh"), grain="month")
    wh.init_tables(["dq_checks_results"])
    raw_orders = stage(fx.user_orders_log(spark, sf_dir), "bench-raw-orders")
    cats = stage(fx.item_categories(spark, sf_dir), "bench-categories")
    wh.overwrite("user_orders_log", staging.dedupe_entity(raw_orders, "user_orders_log"))
    wh.overwrite("user_activity_log", fx.user_activity_log(spark, sf_dir))
    wh.overwrite("customer_research", fx.customer_research(spark, sf_dir))
    for t in ("user_orders_log", "user_activity_log", "customer_research"):
        wh.set_max_id(t, wh.read(t).agg(F.max("id")).first()[0] or 0)
    jobs.refresh_mart(wh, cats)

    land = scratch_path(spark, "bench-landing")
    day = F.to_date("date_time")
    inc = raw_orders.where(day >= F.lit(INCREMENT_DS).cast("date")).drop("id")
    write_landing(inc, landing_path(land, "user_orders_log", INCREMENT_DS, increment=True))

    queries = {
        "daily_sales": lambda: _noop(C1.daily_sales(wh.read("user_orders_log"))),
        "weekly_retention": lambda: _noop(
            R.weekly_retention(wh.read("f_daily_sales"), wh.read("d_item"))),
        "dedup_orders": lambda: _noop(staging.dedupe_entity(raw_orders, "user_orders_log")),
        "daily_increment": lambda: jobs.daily_increment(
            spark, land, wh, INCREMENT_DS, categories=cats, expected=("user_orders_log",)),
    }
    times = {}
    for name, fn in queries.items():
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            fn()
            runs.append(time.perf_counter() - t0)
        warm = runs[1:] if len(runs) > 1 else runs
        times[name] = round(statistics.median(warm), 3)
        print(f"# {name}: runs={[round(r, 2) for r in runs]}", file=sys.stderr)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_warm_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
