from decimal import Decimal as D

from martwright.plans.sales import daily_sales
from helpers import day, orders_df, rows_of, shuffles, ts


def test_daily_sales_rows(spark):
    o = orders_df(spark, [
        dict(id=1, quantity=3, payment_amount=D("10.00")),
        # identical repeat purchase on the same day collapses (DISTINCT)
        dict(id=2, quantity=3, payment_amount=D("10.00")),
        dict(id=3, item_id=2, status="refunded", quantity=2, payment_amount=D("5.00")),
        dict(id=4, item_id=3, status="refunded", quantity=2, payment_amount=D("-5.00")),
        dict(id=5, item_id=4, status=None, date_time=ts("2022-07-10 09:15:00")),
        dict(id=6, item_id=5, status="lost"),
    ])
    got = rows_of(daily_sales(o))
    assert got == sorted([
        (day("2022-07-09"), 1, 1, D("3.33"), 3, D("10.00"), "shipped"),
        (day("2022-07-09"), 2, 1, D("-2.50"), 2, D("-5.00"), "refunded"),
        (day("2022-07-09"), 3, 1, D("-2.50"), 2, D("-5.00"), "refunded"),
        (day("2022-07-10"), 4, 1, D("10.00"), 1, D("10.00"), None),
        (day("2022-07-09"), 5, 1, D("10.00"), 1, D("10.00"), "lost"),
    ], key=repr)


def test_sale_and_refund_same_key_both_kept(spark):
    o = orders_df(spark, [dict(id=1), dict(id=2, status="refunded")])
    got = rows_of(daily_sales(o))
    assert [r[-1] for r in got] == ["refunded", "shipped"]
    assert [r[5] for r in got] == [D("-10.00"), D("10.00")]


def test_spread_sales_need_one_shuffle_and_are_the_same(spark):
    """The DISTINCT and the write by date dealt every sale out twice."""
    o = orders_df(spark, [dict(id=i, customer_id=i % 4, item_id=i % 3, date_time=None if i % 10 == 0 else ts(f"2022-07-{1 + i % 5:02d} 00:00:00"))
                          for i in range(120)])
    spread = daily_sales(o, spread=True)
    assert [s.split("#")[0] for s in shuffles(spread)] == ["rangepartitioning(date_time"]
    assert rows_of(spread) == rows_of(daily_sales(o)) and spread.count() < 120
