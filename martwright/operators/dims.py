"""Dimension and activity loads D1-D5.

The reference calls a dimension script that it does not ship, so these
rules are ours, derived from the declared targets:

* D1 ``d_calendar``: every distinct day of the orders and activity staging
  tables with day / month / month name / year.
* D2-D4: one row per natural key; when a key carries several attribute
  values the latest row wins, ordered by ``(date_time, id)``.  The
  attributes of a dimension row always come from one staging row.
* D4 ``category_name`` comes from an optional item -> category mapping;
  items it does not cover get NULL.
* D5 ``f_activity``: ``sum(quantity)`` per (action, day) as click_number.

All are one grouped aggregate (partial aggregation before the shuffle,
so a hot key costs one row per map task, not one row per event).

D2-D4 are "latest by (date_time, id)", and the latest of per-partition
latests is the overall latest.  So the job layer keeps, per staging
partition, each key's latest row (:func:`latest_per_partition`) and stores the dimension itself
with its winning rows' order.  An increment re-summarises only the
partitions it touched and merges their keys into the dimension
(:func:`latest_changes`); other summaries are read only for keys whose
winning row is gone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_attributes, to_day


#: dimension -> (natural key, attributes) of the latest-row dimensions.
LATEST_DIMS = {
    "d_city": ("city_id", ["city_name"]),
    "d_customer": ("customer_id", ["first_name", "last_name", "city_id"]),
    "d_item": ("item_id", ["item_name"]),
}


def _latest(attrs: list[str]) -> Column:
    """The latest row: order and attributes in one struct, so that a shuffled
    row holds its order once (equal orders: the largest attributes)."""
    return F.max(F.struct("date_time", "id", *attrs)).alias("w")


#: Dimensions with about as many (partition, key) pairs as there are order lines.
FINE_DIMS = {"d_item"}


def latest_per_partition(orders: DataFrame, dim: str, part: str = "dt", spread: bool = False) -> DataFrame:
    """Per (staging partition, key): the key's latest row there, keeping its
    ``date_time`` and ``id`` so summaries reduce exactly like raw rows.

    ``spread``: the rows are dealt out by ranges of partition and key, so that one
    shuffle serves the summary and its write: for a dimension whose keys have
    few rows in a partition, where merging them before the shuffle saves nothing."""
    key, attrs = LATEST_DIMS[dim]
    cols = attrs + ["date_time", "id"]
    if spread:
        orders = orders.select(part, key, *cols).repartitionByRange(part, key)
    w = orders.groupBy(part, key).agg(_latest(attrs))
    return w.select(key, *[F.col(f"w.{c}").alias(c) for c in cols])


def latest_rows(summaries: DataFrame, dim: str) -> DataFrame:
    """Each key's overall latest row, with its ``date_time`` and ``id``."""
    key, attrs = LATEST_DIMS[dim]
    cols = attrs + ["date_time", "id"]
    w = summaries.groupBy(key).agg(_latest(attrs))
    return w.select(key, *[F.col(f"w.{c}").alias(c) for c in cols])


def latest_changes(stored: DataFrame, stale: DataFrame, fresh: DataFrame, dim: str,
                   touched: Callable[[Column], Column]) -> DataFrame:
    """The stored rows merged with changed summaries, one row per key.

    ``stored``: rows of the dimension with their order; ``stale`` and
    ``fresh``: summaries of the touched partitions before and after;
    ``touched``: whether a date_time lies in one of these.  A key's winning row
    outside the touched partitions still stands, and the fresh one competes
    with it.  One inside is replaced by the fresh one, unless that is missing or
    comes earlier: then any partition may hold the winner, and ``lost`` is
    true.  Rows: key, ``row`` (NULL: none), ``lost``, ``changed``.
    """
    key, attrs = LATEST_DIMS[dim]
    cols = attrs + ["date_time", "id"]
    row = F.struct(*cols)
    none = F.lit(None).cast(fresh.select(row.alias("r")).schema["r"].dataType)

    def side(df, old, new, is_touched):
        return df.select(key, old.alias("old"), new.alias("new"), F.lit(is_touched).alias("touched"))

    def order(name):  # NULL where there is no row
        return F.when(F.col(name).isNotNull(), F.struct(F.col(name)["date_time"], F.col(name)["id"]))

    sides = (side(stored, row, none, False).unionByName(side(fresh, none, row, True))
             .unionByName(side(stale, none, none, True)))
    both = sides.groupBy(key).agg(F.max_by("old", order("old")).alias("old"), F.max_by("new", order("new")).alias("new"),
                                  F.max("touched").alias("touched"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    new_wins = F.coalesce(order("new") >= order("old"), has_new)
    inside = has_old & F.col("touched") & touched(F.col("old")["date_time"])
    best = F.when(F.col("touched") & new_wins, F.col("new")).otherwise(F.col("old"))
    return both.select(key, best.alias("row"), (inside & ~new_wins).alias("lost"),
                       (F.col("touched") & ~F.col("old").eqNullSafe(best)).alias("changed"))


def days_per_partition(df: DataFrame) -> DataFrame:
    """D1 source summary: the distinct days of a staging table (the job layer
    keeps one per partition, re-summarising only touched partitions)."""
    return df.select(to_day("date_time").alias("date_time")).where(
        F.col("date_time").isNotNull()).distinct()


def d_calendar(orders: DataFrame, activity: DataFrame) -> DataFrame:
    days = (
        orders.select(to_day("date_time").alias("date_time"))
        .union(activity.select(to_day("date_time").alias("date_time")))
        .where(F.col("date_time").isNotNull())
        .distinct()
    )
    return days.select("date_time", *calendar_attributes("date_time"))


def d_city(orders: DataFrame) -> DataFrame:
    return city_rows(latest_rows(orders, "d_city")).drop("date_time", "id")


def d_customer(orders: DataFrame) -> DataFrame:
    return customer_rows(latest_rows(orders, "d_customer")).drop("date_time", "id")


def d_item(orders: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    return item_rows(latest_rows(orders, "d_item"), categories).drop("date_time", "id")


def city_rows(latest: DataFrame) -> DataFrame:
    """D2 rows of the cities' latest rows."""
    return latest.select(F.col("city_id").cast("int"), "city_name", "date_time", "id")


def customer_rows(latest: DataFrame) -> DataFrame:
    """D3 rows of the customers' latest rows."""
    return latest.where(F.col("customer_id").isNotNull()).select(
        F.col("customer_id").cast("int"), "first_name", "last_name", F.col("city_id").cast("int"), "date_time", "id")


def item_rows(latest: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """D4 rows of the items' latest rows."""
    items = latest.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("int"), "item_name", "date_time", "id")
    if categories is None:
        items = items.withColumn("category_name", F.lit(None).cast("string"))
    else:
        # The mapping is keyed on item_id; both sides are keyed aggregates, so
        # this is a plain equi-join left to the planner (AQE broadcasts it when
        # the runtime size is small).
        cats = categories.groupBy(F.col("item_id").cast("int").alias("item_id")).agg(
            F.max("category_name").alias("category_name"))
        items = items.join(cats, "item_id", "left")
    return items.select("item_id", "item_name", "category_name", "date_time", "id")


def f_activity(activity: DataFrame) -> DataFrame:
    return (
        activity.where(F.col("action_id").isNotNull() & F.col("date_time").isNotNull())
        .groupBy(
            F.col("action_id").cast("int").alias("activity_id"),
            to_day("date_time").alias("date_time"),
        )
        .agg(F.sum("quantity").cast("int").alias("click_number"))
    )
