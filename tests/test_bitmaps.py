"""A3 by bitmaps: equality with the plain plan, merges in any order and
grouping, refreshes with replaced, emptied and late days."""

import random

import pytest
from pyspark.sql import functions as F

from martwright.plans import bitmaps as B
from martwright.plans import retention as R
from martwright.session import scratch_path
from martwright.sources.store import Warehouse
from helpers import day, items_df, rows_of, sales_df
from test_retention import _random_sales, expected

ITEMS = [(1, "a", "cat1"), (2, "b", "cat2"), (3, "c", None)]


def with_odd_rows(rows):
    """Sales without customer and without date, and one customer many times."""
    return rows + [dict(customer_id=None), dict(customer_id=None, status="refunded"), dict(date_time=None),
                   dict(date_time=None, customer_id=3, status="refunded")] + [dict(customer_id=1)] * 50


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_loops(spark, seed):
    items = items_df(spark, ITEMS)
    sales = sales_df(spark, _random_sales(seed, 90))
    assert rows_of(B.retention_by_bitmaps(sales, items)) == expected(sales, items)


def test_odd_rows_and_empty(spark):
    items = items_df(spark, ITEMS)
    sales = sales_df(spark, with_odd_rows(_random_sales(9, 60)))
    assert rows_of(B.retention_by_bitmaps(sales, items)) == rows_of(R.weekly_retention(sales, items))
    assert rows_of(B.retention_by_bitmaps(sales.limit(0), items)) == []


def test_numbers_have_no_gap_and_run_by_cohort(spark):
    rows = [(c, day(f"2022-0{1 + c % 7}-03") if c % 5 else None) for c in range(1, 1001)]
    customers = spark.createDataFrame(rows, "customer_id int, first_buy date")
    got = sorted((r.number, r.cohort, r.customer_id) for r in B.number_customers(customers, 40, parts=3).collect())
    assert [n for n, _, _ in got] == list(range(40, 1040))
    assert [c for _, c, _ in got] == sorted((c for _, c, _ in got), key=lambda c: c or "")
    assert sorted(i for _, _, i in got) == list(range(1, 1001))


def test_bits_merge_in_any_order_and_grouping(spark):
    """More customers than a block holds, the same ones on several days."""
    items = items_df(spark, ITEMS)
    rnd = random.Random(4)
    sales = sales_df(spark, [dict(customer_id=rnd.randrange(200), date_time=day(f"2022-07-{rnd.randrange(4, 18):02}"),
                                  item_id=rnd.choice([1, 2]), status=rnd.choice(["shipped", "refunded"]))
                             for _ in range(900)])
    groups = B.day_groups(sales, items)
    bits = B.pack(groups, B.number_customers(B.first_days(groups))).cache()
    want = rows_of(R.weekly_retention(sales, items))
    days = [r[0] for r in bits.select("date_time").distinct().collect()]
    for seed in range(2):
        random.Random(seed).shuffle(days)
        some, rest = bits.where(F.col("date_time").isin(days[:5])), bits.where(F.col("date_time").isin(days[5:]))
        merged = B.merge(some).unionByName(B.merge(rest))
        assert rows_of(B.retention(merged)) == want
    # a part merged twice changes no count of customers
    twice = B.retention(bits.unionByName(bits))
    counts = ["period_id", "category_name", "cohort", "new_customers_count", "returning_customers_count",
              "refunded_customers_count"]
    assert rows_of(twice.select(*counts)) == rows_of(R.weekly_retention(sales, items).select(*counts))


@pytest.mark.parametrize("grain,seed", [("month", 1), ("day", 2)])
def test_refreshes_equal_a_full_recompute(spark, grain, seed):
    """Days are replaced, emptied and added; founding sales go and come."""
    items = items_df(spark, ITEMS)
    wh = Warehouse(spark, scratch_path(spark, "wh"), grain=grain)
    rows = _random_sales(seed, 70)
    days = sorted({r["date_time"] for r in rows})
    rnd = random.Random(seed)
    held = [r for r in rows if r["date_time"] not in days[:2] + days[-3:]]
    wh.overwrite("f_daily_sales", sales_df(spark, held))
    B.refresh(wh, items)
    first, emptied = days[2], days[4]
    steps = [days[-3:],         # new days, newcomers among them
             days[:2],          # late days before all others: cohorts move
             [first, emptied]]  # a day replaced by other customers' sales, another emptied
    for k, step in enumerate(steps):
        own = [r for r in rows if r["date_time"] in step]
        if k == 2:
            own = [dict(r, customer_id=rnd.choice([7, 8])) for r in own if r["date_time"] == first]
        held = [r for r in held if r["date_time"] not in step] + own
        wh.overwrite("f_daily_sales", sales_df(spark, held))
        B.refresh(wh, items, step)
        want = rows_of(R.weekly_retention(wh.read("f_daily_sales"), items))
        assert rows_of(wh.read("f_customer_retention")) == want
        numbers = [r.number for r in wh.read("customer_numbers").collect()]
        assert sorted(numbers) == list(range(len(numbers)))


def test_refresh_reads_bits_of_its_weeks_only(spark):
    items = items_df(spark, ITEMS)
    wh = Warehouse(spark, scratch_path(spark, "wh"), grain="day")
    old = [dict(customer_id=c, date_time=day(d)) for c in (1, 2) for d in ("2022-03-01", "2022-05-03")]
    new = [dict(customer_id=c, date_time=day("2022-07-12")) for c in (2, 3)]
    wh.overwrite("f_daily_sales", sales_df(spark, old))
    B.refresh(wh, items)
    before = set(wh.partitions("retention_day_bits"))
    wh.replace_by_key("f_daily_sales", sales_df(spark, new), "date_time")
    read = []
    plain = Warehouse._files

    def files(self, name, folders=None):
        read.append((name, folders))
        return plain(self, name, folders)

    Warehouse._files = files
    try:
        B.refresh(wh, items, [day("2022-07-12")])
    finally:
        Warehouse._files = plain
    assert ("f_daily_sales", {"dt=2022-07-12"}) in read and ("f_daily_sales", None) not in read
    assert set(wh.partitions("retention_day_bits")) == before | {"dt=2022-07-12"}
    assert rows_of(wh.read("f_customer_retention")) == rows_of(R.weekly_retention(sales_df(spark, old + new), items))
