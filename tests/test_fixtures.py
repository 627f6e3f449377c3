import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwright.operators import staging
from martwright.sources import fixtures as fx

ORDERS = (7, 8_500_000, 9_500_000, 60_000_000)


@pytest.fixture(scope="module")
def far_orders(spark):
    """Orders of few and of many millions, three lines each, two on one line number."""
    from martwright.session import scratch_path
    root = scratch_path(spark, "far")
    lines = [(o, n, p, 3, 2.0, 10.0 * p, "N") for o in ORDERS for n, p in ((1, 1), (1, 2), (2, 1))]
    lines.append((ORDERS[1], None, 1, 3, 2.0, 5.0, "R"))
    tables = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                            "l_extendedprice double, l_returnflag string"),
        "orders": ([(o, 10, dt.datetime(2000, 1, 1)) for o in ORDERS], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "customer": ([(10, "C#1", 0)], "c_custkey long, c_name string, c_nationkey int"),
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "part": ([(1, "a", "t"), (2, "b", "t")], "p_partkey long, p_name string, p_type string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_order_ids_beyond_the_formula(spark, far_orders):
    """The copies of orders from 8.2 million on overflowed a bigint, their sales from 9.2 million on."""
    rows = [r for r in fx.user_orders_log(spark, far_orders).collect() if r["id"] is not None]
    sales = sorted(r["id"] for r in rows if r["status"] == "shipped")
    copies = sorted(r["id"] for r in rows if r["status"] == "refunded")
    assert len(rows) == 24 and len({*sales, *copies}) == 24
    small = [7 * 10**12 + n * 10**11 + p * 10**5 + 3 for n, p in ((1, 1), (1, 2), (2, 1))]
    assert sales[:3] == small and copies[:3] == [i + 10**18 for i in small]
    assert sales[3:6] == [i + 8_499_993 * 10**12 for i in small]
    assert min(sales[6:]) > sales[5]


def test_sales_win_over_their_copies_at_any_key(spark, far_orders):
    left = staging.dedupe_entity(fx.user_orders_log(spark, far_orders), "user_orders_log").collect()
    # the four orders are alike but for their ids: one sale each of (item, amount), and the line without a number
    assert sorted((r["item_id"], r["status"], r["id"]) for r in left if r["id"] is not None) == [
        (1, "shipped", 7 * 10**12 + 10**11 + 100_003), (2, "shipped", 7 * 10**12 + 10**11 + 200_003)]
    assert [(r["item_id"], r["status"]) for r in left if r["id"] is None] == [(1, "refunded")]


def test_queries_run_in_small_tasks(spark):
    """The memory of a task followed the input: joined 64 MB of shuffled rows took 2 GB."""
    from martwright import registry
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(key)
    registry.QUERIES["retention_groups"](spark, "/root/testdata/sf0.001")
    assert spark.conf.get(key) == "16m"


def test_copies_and_unknowns_come_from_one_pass(spark, far_orders):
    """The copies were a second join of all tables, the unknown sales two more."""
    from martwright import registry
    for df in (fx.user_orders_log(spark, far_orders), registry._with_unknowns(spark, far_orders)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("Relation" in line and "l_returnflag" in line for line in plan.splitlines()) == 1
    rows = registry._with_unknowns(spark, far_orders).collect()
    known = fx.user_orders_log(spark, far_orders).collect()
    refunded = [r for r in known if r["status"] == "refunded"]
    unknown = [r for r in rows if r["item_id"] < 0]
    assert len(rows) == len(known) + len(refunded) and len(unknown) == len(refunded)
    shifted = sorted((-r["customer_id"], -r["item_id"], r["date_time"] + dt.timedelta(days=36500), r["quantity"]) for r in refunded)
    assert sorted((r["customer_id"], r["item_id"], r["date_time"], r["quantity"]) for r in unknown) == shifted
    assert all(r["id"] == -k for r, k in zip(sorted((r for r in unknown if r["id"] is not None), key=lambda r: -r["id"]),
                                             sorted(r["id"] for r in refunded if r["id"] is not None)))


def test_lines_of_unknown_parts_count_for_the_places(spark, far_orders, tmp_path):
    """The parts are joined before the places are known, so that the lines are shuffled twice, not three times."""
    root = str(tmp_path)
    for name in ("orders", "customer", "nation"):
        fx.table(spark, far_orders, name).write.parquet(f"{root}/{name}.parquet")
    li = fx.table(spark, far_orders, "lineitem").where("l_orderkey = 60000000")
    unknown = li.where("l_linenumber = 1 and l_partkey = 1").withColumn("l_partkey", F.lit(0).cast("long"))
    li.unionByName(unknown).write.parquet(f"{root}/lineitem.parquet")
    parts = fx.table(spark, far_orders, "part")
    parts.unionByName(parts.where("p_partkey = 1")).write.parquet(f"{root}/part.parquet")     # a key that repeats
    first = fx.LAST_FORMULA_ID + 60_000_000 * fx.LINES_PER_ORDER * 2
    rows = fx.fx_orders(spark, root)
    # line (1, 0) of the unknown part is the first place and has no row
    assert sorted(r["id"] - first for r in rows.collect()) == [4, 4, 6, 8, 8]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fx.fx_orders(spark, root)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lines by part and by order; parts; orders by customer and by order; customers
    assert plan.count("Exchange hashpartitioning") == 6


def test_inputs_of_staged_lines_are_the_same(spark, far_orders):
    lines = fx.staged_lines(spark, far_orders)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(fx.fx_orders(spark, far_orders, lines)) == rows(fx.fx_orders(spark, far_orders))
    assert rows(fx.user_orders_log(spark, far_orders, lines=lines)) == rows(fx.user_orders_log(spark, far_orders))
    assert rows(fx.customer_research(spark, far_orders, lines)) == rows(fx.customer_research(spark, far_orders))
