from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martwright.functions import business_day, is_refund, period_id, signed_amount, unit_price
from helpers import day


def test_period_id_year_boundaries(spark):
    df = spark.createDataFrame([(day("2022-01-01"),), (day("2022-12-30"),), (day("2024-12-30"),),
                                (day("2024-01-03"),), (None,)], "d date")
    got = [tuple(r) for r in df.select(period_id("d"), period_id("d", iso_year=True)).collect()]
    # calendar year + ISO week (reference) vs ISO year + ISO week
    assert got == [("202252", "202152"), ("202252", "202252"), ("20241", "20251"),
                   ("20241", "20241"), (None, None)]


def test_signed_amount_and_price(spark):
    rows = [("refunded", D("10.00"), 3), ("refunded", D("-10.00"), 3), ("refunded", D("0.00"), 3),
            ("shipped", D("10.00"), 3), (None, D("10.00"), 4), ("refunded", D("0.05"), 2)]
    df = spark.createDataFrame(rows, "status string, amt decimal(14,2), q bigint")
    got = [tuple(r) for r in df.select(
        signed_amount(F.col("status"), F.col("amt")).cast("decimal(10,2)"),
        unit_price(F.col("status"), F.col("amt"), F.col("q")),
        is_refund(F.col("status"), F.col("amt"))).collect()]
    assert got == [
        (D("-10.00"), D("-3.33"), True),
        (D("-10.00"), D("-3.33"), False),   # already negative: kept, not flipped
        (D("0.00"), D("0.00"), False),
        (D("10.00"), D("3.33"), False),
        (D("10.00"), D("2.50"), False),     # NULL status -> ELSE branch
        (D("-0.05"), D("-0.03"), True),     # HALF_UP away from zero: -0.025 -> -0.03
    ]


def test_price_division_by_zero(spark):
    df = spark.createDataFrame([("shipped", D("10.00"), 0)], "status string, amt decimal(14,2), q bigint")
    lenient = df.select(unit_price(F.col("status"), F.col("amt"), F.col("q"), lenient=True)).first()[0]
    assert lenient is None
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        df.select(unit_price(F.col("status"), F.col("amt"), F.col("q"))).collect()


def test_business_day_from_text(spark):
    assert spark.range(1).select(business_day("2022-07-09")).first()[0] == day("2022-07-09")
