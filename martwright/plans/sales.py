"""The daily sales fact (`f_daily_sales`) from the orders staging table.

Per staging row: the sale day, item, customer, signed unit price (DECIMAL
10,2 HALF_UP), quantity, signed amount, status; then DISTINCT over all seven
columns (identical repeat purchases on one day collapse to one row, as in
the reference).  Replacing the fact for the days present in the update is
``store.replace_partitions`` on ``date_time``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import signed_amount, to_day, unit_price


def daily_sales(orders: DataFrame, lenient: bool = False, spread: bool = False) -> DataFrame:
    """``spread``: the rows are dealt out by ranges of day, customer and item, so
    that the DISTINCT's shuffle also serves a write partitioned by date."""
    st, amt = F.col("status"), F.col("payment_amount")
    rows = orders.select(
        to_day("date_time").alias("date_time"),
        F.col("item_id").cast("int").alias("item_id"),
        F.col("customer_id").cast("int").alias("customer_id"),
        unit_price(st, amt, F.col("quantity"), lenient=lenient).alias("price"),
        F.col("quantity").cast("bigint").alias("quantity"),
        signed_amount(st, amt).cast("decimal(10,2)").alias("payment_amount"),
        st.alias("status"),
    )
    # One hash aggregate on all seven columns; map-side partial
    # aggregation removes repeats before the shuffle (not with ``spread``).
    return (rows.repartitionByRange("date_time", "customer_id", "item_id") if spread else rows).distinct()

