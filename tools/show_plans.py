"""Print the physical plans of the headline steps over a stored warehouse.

usage: python tools/show_plans.py [--sf DIR] > docs/PLANS.md

For each step: the formatted plan tree, the shuffles (Exchange) and
broadcasts it contains, and what the Parquet scans push down.
"""

from __future__ import annotations

import argparse
import contextlib
import datetime as dt
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarize(name: str, why: str, df) -> str:
    text = plan_text(df)
    tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    shuffles = re.findall(r"Arguments: (hashpartitioning\([^\n]*?, \d+\)|rangepartitioning[^\n]*|SinglePartition[^\n]*|RoundRobinPartitioning[^\n]*)", text)
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\n]*)\]", text)))
    parts = sorted(set(re.findall(r"PartitionFilters: \[([^\n]*)\]", text)))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    out = [f"## {name}", "", why, "", "```", tree.rstrip(), "```", ""]
    out.append(f"* shuffles: {len(shuffles)}" + "".join(f"\n  * `{s[:140]}`" for s in shuffles))
    out.append(f"* broadcasts: {text.count('BroadcastExchange (')}")
    for p in parts:
        if p:
            out.append(f"* partition filters: `{p[:200]}`")
    for p in pushed:
        if p:
            out.append(f"* pushed filters: `{p[:200]}`")
    for s in schemas:
        out.append(f"* read schema: `{s[:200]}`")
    return "\n".join(out) + "\n"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()

    from pyspark.sql import functions as F

    from martwright.operators import dims, staging
    from martwright.plans import jobs
    from martwright.plans import retention as R
    from martwright.plans import sales as C1
    from martwright.session import build_session, scratch_path
    from martwright.sources import fixtures as fx
    from martwright.sources.store import Warehouse

    spark = build_session("local[4]", shuffle_partitions=8)
    wh = Warehouse(spark, scratch_path(spark, "plans-wh"), grain="month")
    wh.init_tables(["dq_checks_results"])
    cats = fx.item_categories(spark, a.sf)
    wh.overwrite("user_orders_log", fx.user_orders_log(spark, a.sf))
    wh.overwrite("user_activity_log", fx.user_activity_log(spark, a.sf))
    jobs.refresh_mart(wh, cats)

    days = [dt.date(2001, 7, 15), dt.date(2001, 7, 16)]
    periods = sorted({R.period_of(d) for d in days})
    print("# Physical plans of the headline steps\n")
    print(f"Generated by `tools/show_plans.py` over sf `{a.sf}` (local mode, 8 shuffle "
          "partitions, AQE on: the plans below are the initial ones; AQE may still "
          "coalesce partitions, split skewed ones, or turn a sort-merge join into a "
          "broadcast at run time).\n")
    steps = [
        ("C1 daily sales (full)", "One shuffle: the DISTINCT, with map-side partial aggregation.",
         C1.daily_sales(wh.read("user_orders_log"))),
        ("C2 weekly retention (full)",
         "Item lookup (broadcast if its bytes allow), DISTINCT, per-customer pre-aggregate, "
         "customer window, final aggregate; no Expand.",
         R.weekly_retention(wh.read("f_daily_sales"), wh.read("d_item"))),
        ("M5 orders de-dup", "One hash aggregate (fixed-width buffers thanks to the status code).",
         staging.dedupe_entity(wh.read("user_orders_log"), "user_orders_log")),
        ("C4 staging read of the touched days",
         "Only the touched partitions' directories are read (paths, not discovery + pruning).",
         staging.delete_business_day(wh.read("user_orders_log", days=days), days[0])),
        ("C4 fact rows of the touched days", "Touched partitions, pruned columns, then C1.",
         C1.daily_sales(wh.read("user_orders_log", with_partition=True, days=days)
                        .where(wh.days_filter(days)))),
        ("C4 retention groups of the touched weeks",
         "Only the fact days of the touched periods are re-grouped.",
         R.customer_period_groups(R.sales_enriched(
             wh.read("f_daily_sales", with_partition=True, days=R.days_of_periods(periods))
             .where(wh.days_filter(R.days_of_periods(periods))).drop("dt"),
             wh.read("d_item")))),
        ("C4 retention of the affected periods",
         "Stored groups of the affected periods joined to the cohorts, then the final aggregate.",
         R.final_aggregate(R.attach_cohorts(
             wh.read("retention_groups", values=periods),
             wh.read("customer_cohorts")))),
        ("D3 customer dimension from partition summaries",
         "Reduces the per-partition latest rows, not staging.",
         dims.d_customer(wh.read("d_customer_parts"))),
    ]
    for name, why, df in steps:
        print(summarize(name, why, df))
    spark.stop()


if __name__ == "__main__":
    main()
