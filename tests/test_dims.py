import random
from decimal import Decimal as D

import pytest

from martwright.operators import dims
from martwright.plans import jobs
from martwright.session import scratch_path
from martwright.sources.store import Warehouse
from helpers import day, orders_df, rows_of, shuffles, ts


def test_latest_attributes_win(spark):
    o = orders_df(spark, [
        dict(id=1, customer_id=7, first_name="Ann", city_id=1, date_time=ts("2022-07-09 00:00:00")),
        dict(id=9, customer_id=7, first_name="Anna", city_id=2, date_time=ts("2022-07-08 00:00:00")),
        dict(id=5, customer_id=7, first_name="Anne", city_id=3, date_time=ts("2022-07-09 00:00:00")),
    ])
    # latest by (date_time, id): 2022-07-09 / id 5; attributes from one row
    assert rows_of(dims.d_customer(o)) == [(7, "Anne", "l", 3)]


def test_item_dimension_with_and_without_mapping(spark):
    o = orders_df(spark, [dict(id=1, item_id=1, item_name="x"), dict(id=2, item_id=2, item_name="y")])
    cats = spark.createDataFrame([(1, "tools")], "item_id int, category_name string")
    assert rows_of(dims.d_item(o, cats)) == [(1, "x", "tools"), (2, "y", None)]
    assert rows_of(dims.d_item(o)) == [(1, "x", None), (2, "y", None)]


def test_calendar_and_city(spark):
    o = orders_df(spark, [dict(id=1, date_time=ts("2022-09-30 10:00:00"), city_id=4, city_name="Oslo")])
    a = spark.createDataFrame([(1, 1, ts("2022-01-01 00:00:00"), 1, 3)],
                              "action_id long, customer_id long, date_time timestamp_ntz, id long, quantity long")
    assert rows_of(dims.d_calendar(o, a)) == [
        (day("2022-01-01"), 1, 1, "January", 2022), (day("2022-09-30"), 30, 9, "September", 2022)]
    assert rows_of(dims.d_city(o)) == [(4, "Oslo")]


def test_f_activity_sums_quantity_per_action_and_day(spark):
    a = spark.createDataFrame(
        [(1, 1, ts("2022-01-01 00:00:00"), 1, 3), (1, 2, ts("2022-01-01 05:00:00"), 2, 4),
         (2, 1, ts("2022-01-01 00:00:00"), 3, 1), (None, 1, ts("2022-01-01 00:00:00"), 4, 1)],
        "action_id long, customer_id long, date_time timestamp_ntz, id long, quantity long")
    assert rows_of(dims.f_activity(a)) == [(1, day("2022-01-01"), 7), (2, day("2022-01-01"), 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_dimensions_equal_a_full_build(spark, seed):
    """Days are emptied, rewritten and added in any order (rows without a date
    or key among them): every dimension equals one built from all rows."""
    rng = random.Random(seed)
    wh = Warehouse(spark, scratch_path(spark, "wh"), grain="day", buckets=4)
    days = [f"2022-07-0{d}" for d in range(1, 7)]
    ids = iter(range(1, 1000))

    def rows_on(d):
        return [dict(id=next(ids), date_time=d and ts(f"{d} 00:00:00"), customer_id=rng.choice([None, 1, 2, 3, 4, 5, 6]),
                     first_name=rng.choice("abcd"), city_id=rng.choice([None, 1, 2, 3]), city_name=rng.choice("xyz"),
                     item_id=rng.choice([None, 1, 2, 3, 4]), item_name=rng.choice("pq")) for _ in range(rng.randint(1, 4))]

    held = {d: rows_on(d) for d in (*days[:4], None)}

    def write(touched=None):
        rows = orders_df(spark, [r for d, own in held.items() if touched is None or d in touched for r in own])
        values = touched and [d and day(d) for d in touched]
        if touched is None:
            wh.overwrite("user_orders_log", rows)
        else:
            wh.replace_partitions("user_orders_log", rows, values)
        for dim in dims.LATEST_DIMS:
            jobs.refresh_latest_dim(wh, dim, values)

    write()
    for step in range(4):
        touched = rng.sample([*days, None], 2)
        for d in touched:
            held[d] = [] if rng.random() < 0.5 else rows_on(d) if rng.random() < 0.5 else held.get(d, [])[:1]
        write(touched)
        orders = wh.read("user_orders_log")
        for dim in dims.LATEST_DIMS:
            assert rows_of(wh.read(dim)) == rows_of(getattr(dims, dim)(orders)), (step, dim)


def test_spread_summaries_need_one_shuffle_and_are_the_same(spark):
    """The items' summary and its write by date dealt nearly every order line out twice."""
    o = orders_df(spark, [dict(id=i, item_id=None if i % 9 == 0 else i % 6, item_name=f"n{i % 5}", customer_id=i % 4, first_name=f"f{i}",
                               date_time=None if i % 10 == 0 else ts(f"2022-0{1 + i % 5}-03 00:00:00")) for i in range(150)])
    o = o.selectExpr("*", "trunc(date_time, 'month') as dt")
    for dim in dims.LATEST_DIMS:
        spread = dims.latest_per_partition(o, dim, spread=True)
        assert [s.split("#")[0] for s in shuffles(spread)] == ["rangepartitioning(dt"]
        assert rows_of(spread) == rows_of(dims.latest_per_partition(o, dim))
