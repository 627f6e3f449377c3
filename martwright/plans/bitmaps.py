"""A3 by sets that merge: weekly retention from daily bitmaps of customers.

Every customer has a number (``customer_numbers``).  A day's sales are kept as
one row per (day, period, category, cohort, status, block of 64 numbers): the
block's customers as the bits of a 64-bit word, with the amount and the number
of sales (``retention_day_bits``, partitioned by day).  Words merge by OR and
amounts by addition, in any order and over any grouping of days, since the
distinct sales of two days never meet.  A week's exact distinct counts are the
set bits of its days' merged words: the sales are not grouped again.

Numbers are dealt out by cohort, so a cohort's customers lie side by side and
its groups fill their words; a group of few customers costs a row per customer
at most.  (Spark's own bitmap aggregates hold 4 KB per group however few
customers it has, and have no hash aggregate; OR of words has both.)

The words are also the index from customers to days: where a late or withdrawn
sale moves a customer's cohort, the days whose words hold the customer's bit
are packed again.  A refresh reads the days it is given, the bits of their
weeks, and the customers' numbers once in four columns; it reads bits of other
days only for customers whose founding day is gone or whose cohort moved.

A sale without customer counts in the amounts and for no customer; sales
without a date form the NULL day of the NULL period.  A warehouse is kept
either by this module or by ``jobs.refresh_retention``, not by both in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import period_id
from ..sources.store import Warehouse, stage
from . import retention as R

#: A cohort's customers are numbered in so many parts side by side.
NUMBER_PARTS = 64

_KEYS = ["period_id", "category_name", "cohort", "status", "block"]


def _merged() -> list[Column]:
    return [F.bit_or("word").alias("word"), F.sum("amount").alias("amount"), F.sum("n_tx").alias("n_tx")]


def day_groups(sales: DataFrame, d_item: DataFrame, iso_year: bool = False) -> DataFrame:
    """One row per (customer, day, category, status) of the distinct sales: a
    hot customer is merged before its rows meet on the customer."""
    return R.sales_enriched(sales, d_item, iso_year).groupBy(
        "customer_id", "date_time", "period_id", "category_name", "status").agg(
        F.sum("payment_amount").alias("amount"), F.count(F.lit(1)).alias("n_tx"))


def first_days(groups: DataFrame) -> DataFrame:
    """(customer_id, first day that founds a cohort or NULL)."""
    founding = F.when(F.col("status") != "refunded", F.col("date_time"))
    return (groups.where("customer_id is not null").groupBy("customer_id")
            .agg(F.min(founding).alias("first_buy")))


def number_customers(customers: DataFrame, start: int = 0, iso_year: bool = False,
                     parts: int = NUMBER_PARTS) -> DataFrame:
    """(customer_id, number, first_buy, cohort) for (customer_id, first_buy):
    numbers from ``start`` on without a gap, cohort by cohort.  Only the sizes
    of the cohorts' parts (weeks x ``parts`` rows) are summed in one task."""
    own = customers.select("customer_id", "first_buy", period_id("first_buy", iso_year).alias("cohort"),
                           F.pmod(F.xxhash64("customer_id"), F.lit(parts)).alias("part"))
    before = Window.orderBy("_cohort", "_part").rowsBetween(Window.unboundedPreceding, -1)
    places = (own.groupBy(F.col("cohort").alias("_cohort"), F.col("part").alias("_part")).count()
              .select("_cohort", "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")))
    place = F.row_number().over(Window.partitionBy("cohort", "part").orderBy("customer_id"))
    return (own.withColumn("place", place)
            .join(places, F.col("cohort").eqNullSafe(F.col("_cohort")) & (F.col("part") == F.col("_part")))
            .select("customer_id", (F.lit(start - 1) + F.col("first") + F.col("place")).cast("long").alias("number"),
                    "first_buy", "cohort"))


def pack(groups: DataFrame, numbers: DataFrame) -> DataFrame:
    """The day groups as bits; ``numbers`` covers their customers."""
    placed = groups.join(numbers.select("customer_id", "number", "cohort"), "customer_id", "left")
    placed = placed.withColumn("block", F.shiftright("number", 6)).withColumn(
        "word", F.expr("shiftleft(1L, cast(number & 63 as int))"))
    return placed.groupBy("date_time", *_KEYS).agg(*_merged())


def merge(bits: DataFrame) -> DataFrame:
    """Bits of any days merged into one row per period, group and block; what
    it returns merges again."""
    return bits.groupBy(*_KEYS).agg(*_merged())


def retention(bits: DataFrame) -> DataFrame:
    """C2 from bits: the merged words' set bits are the distinct customers."""
    return R.final_aggregate(merge(bits), F.coalesce(F.bit_count("word"), F.lit(0)))


def retention_by_bitmaps(sales: DataFrame, d_item: DataFrame, iso_year: bool = False) -> DataFrame:
    """C2 of a whole fact by way of its days' bits."""
    groups = stage(day_groups(sales, d_item, iso_year), "day-groups")
    return retention(pack(groups, number_customers(first_days(groups), 0, iso_year)))


def _on(days: list, column: str = "date_time") -> Column:
    """Whether a day is one of ``days`` (never NULL)."""
    known = [d for d in days if d is not None]
    inside = F.col(column).isin(known) if known else F.when(F.col(column).isNotNull(), F.lit(False))
    return F.coalesce(inside, F.lit(None in days))


def _held(bits: DataFrame, customers: DataFrame) -> DataFrame:
    """The bits' rows of each customer, with customer_id."""
    own = customers.select("customer_id", "number", F.shiftright("number", 6).alias("block"))
    return bits.join(own, "block").where("shiftright(word, cast(number & 63 as int)) & 1 = 1")


def refresh(wh: Warehouse, d_item: DataFrame, days: list | None = None) -> None:
    """C2 + M4 over the stored fact, whose ``days`` have changed (None: all, as
    after a change of item categories).  Numbers, bits and retention change in
    one state of the warehouse; the retention equals a full recompute."""
    iso = wh.iso_year

    def groups_of(own: list) -> DataFrame:
        fact = wh.read("f_daily_sales", with_partition=True, days=own).where(wh.days_filter(own)).drop("dt")
        return day_groups(fact, d_item, iso)

    if days is None or not wh.exists("retention_day_bits") or not wh.partitions("retention_day_bits"):
        groups = stage(day_groups(wh.read("f_daily_sales"), d_item, iso), "day-groups")
        numbers = stage(number_customers(first_days(groups), 0, iso), "numbers")
        with wh.transaction():
            wh.overwrite("customer_numbers", numbers)
            wh.overwrite("retention_day_bits", pack(groups, numbers))
            wh.overwrite("f_customer_retention", retention(wh.read("retention_day_bits")))
            wh.set_max_id("customer_numbers", numbers.count())
        return
    if not days:
        return
    fresh = stage(groups_of(days), "day-groups")
    now = stage(first_days(fresh).withColumnRenamed("first_buy", "now").withColumn("seen", F.lit(True)), "first-days")
    stored, all_bits = wh.read("customer_numbers"), wh.read("retention_day_bits")
    founded_here = F.col("first_buy").isNotNull() & _on(days, "first_buy")
    known = stage(stored.join(now, "customer_id", "left").where(F.col("seen") | founded_here).withColumn(
        "lost", founded_here & F.coalesce(F.col("now") > F.col("first_buy"), F.lit(True))), "known")

    # a founding day that is gone: the customer's next one, from other days' bits
    lost = known.where("lost")
    others = all_bits.where(~_on(days))
    earlier = _held(others.where("status <> 'refunded'"), lost).groupBy("customer_id").agg(
        F.min("date_time").alias("earlier"))
    first = F.least(F.when(~F.col("lost"), F.col("first_buy")), "now", "earlier")
    if lost.isEmpty():
        known = known.withColumn("earlier", F.lit(None).cast("date"))
    else:
        known = known.join(earlier, "customer_id", "left")
    known = stage(known.select("customer_id", "number", first.alias("first_buy"), F.col("cohort").alias("old_cohort"))
                  .withColumn("cohort", period_id("first_buy", iso)), "known-now")
    newcomers = now.select("customer_id", F.col("now").alias("first_buy")).join(
        stored.select("customer_id"), "customer_id", "left_anti")
    start = wh.max_id("customer_numbers")
    added = stage(number_customers(newcomers, start, iso), "newcomers")
    changed = known.drop("old_cohort").unionByName(added)

    # a cohort that moved: the other days that hold the customer's bit
    moved = known.where(~F.col("cohort").eqNullSafe(F.col("old_cohort")))
    extra = []
    if not moved.isEmpty():
        extra = [r["date_time"] for r in _held(others, moved).select("date_time").distinct().collect()]
    groups, numbers = fresh, changed
    if extra:
        groups = groups.unionByName(groups_of(extra))
        numbers = changed.unionByName(stored.join(changed.select("customer_id"), "customer_id", "left_anti"))
    every = [*days, *extra]
    packed = pack(groups, numbers).unionByName(wh.read("retention_day_bits", days=every).where(~_on(every)))
    buckets = [r["b"] for r in changed.select(wh.bucket_of(F.col("customer_id")).alias("b")).distinct().collect()]
    kept = wh.read("customer_numbers", values=buckets).join(changed.select("customer_id"), "customer_id", "left_anti")
    periods = sorted({R.period_of(d, iso) for d in every}, key=lambda p: (p is None, p))
    with wh.transaction():
        if buckets:
            wh.replace_partitions("customer_numbers", kept.unionByName(changed), buckets)
        wh.replace_partitions("retention_day_bits", packed, sorted({wh.grain_value(d) for d in every}, key=repr))
        weeks = wh.read("retention_day_bits", days=R.days_of_periods(periods, iso)).where(
            F.coalesce(F.col("period_id").isin([p for p in periods if p]), F.lit(None in periods)))
        wh.replace_partitions("f_customer_retention", retention(weeks), periods)
        wh.set_max_id("customer_numbers", start + added.count())
