"""Staging-shaped inputs derived from the driver's TPC-H-like Parquet tables.

The reference lands three CSV extracts (orders, activity, customer
research).  These functions map the given tables onto those schemas, as
documented in FIXTURES.md, so every job in this library runs over data whose
size grows with the scale factor.  All of it is lazy DataFrame algebra: the
lineitem/orders/customer/part joins are ordinary shuffle joins left to
Catalyst and AQE; only ``nation`` (25 rows by TPC-H definition) is hinted
as a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import USER_ORDERS_LOG
from .store import stage

#: Offset added to the ids of the refunded copies in ``user_orders_log``
#: (fixed value from FIXTURES.md).
REFUND_COPY_ID_OFFSET = 1_000_000_000_000_000_000
#: Offsets of the exact copies used by the research / activity de-dup inputs.
RESEARCH_COPY_ID_OFFSET = 10_000_000_000_000
ACTIVITY_COPY_ID_OFFSET = 1_000_000_000
#: Order ids up to here are the formula of FIXTURES.md, which leaves a bigint at
#: some 8 million orders; the room above is dealt out by (order, place of the
#: line in its order, sale or refunded copy).
LAST_FORMULA_ID = 9_000_000_000_000_000_000
LINES_PER_ORDER = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _within_bigint(formula: Column, far: Column) -> Column:
    """The formula's id (NULL: it has none or leaves a bigint), else ``far``."""
    return F.when(formula <= LAST_FORMULA_ID, formula).otherwise(far)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`fx_orders` with ``_copy_id``, the id of the line's refunded copy.

    Ids beyond the formula's range keep its order: they follow all formula ids,
    order by order and line by line, each copy after its sale.  Lines that share
    a formula id share it there, too.

    The lines are shuffled twice, narrow: by part, then by order for places and
    orders.  Lines of unknown parts count for the places, so they go afterwards;
    the customers join the orders, which are fewer than lines."""
    in_order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    known = F.col("l_linenumber").isNotNull() & F.col("l_partkey").isNotNull() & F.col("l_suppkey").isNotNull()
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.lit(True).alias("_part"))
    lines = li.join(p, li.l_partkey == p.p_partkey, "left").drop("p_partkey").withColumn(
        "_place", F.when(known, F.dense_rank().over(in_order)))
    j = (
        lines.where("_part")
        .join(o.join(c, o.o_custkey == c.c_custkey), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    formula = F.try_multiply("l_orderkey", F.lit(1_000_000_000_000))
    for term in (F.col("l_linenumber").cast("bigint") * F.lit(100_000_000_000), F.col("l_partkey") * F.lit(100_000),
                 F.col("l_suppkey")):
        formula = F.try_add(formula, term)
    place = F.when(F.col("_place") < LINES_PER_ORDER, F.col("_place")).when(
        F.col("_place").isNotNull(), F.raise_error(F.lit("too many lines in an order")).cast("int"))
    far = F.lit(LAST_FORMULA_ID) + (F.col("l_orderkey") * F.lit(LINES_PER_ORDER) + place) * F.lit(2)
    return j.select(
        _within_bigint(formula, far).alias("id"),
        F.col("c_nationkey").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("date_time"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(14,2)").alias("payment_amount"),
        F.when(F.col("l_returnflag") == "R", "refunded").otherwise("shipped").alias("status"),
        F.col("p_type").alias("category_name"),
        _within_bigint(F.try_add(formula, F.lit(REFUND_COPY_ID_OFFSET)), far + F.lit(1)).alias("_copy_id"),
    )


def staged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined lines, written once for the inputs that are built from them
    (the ``lines`` of the functions below)."""
    return stage(_order_lines(spark, sf_dir), "order-lines")


def fx_orders(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One order line per lineitem, shaped like ``user_orders_log`` plus the
    item's ``category_name`` (part type)."""
    return (_order_lines(spark, sf_dir) if lines is None else lines).drop("_copy_id")


def user_orders_log(spark: SparkSession, sf_dir: str, with_category: bool = False,
                    lines: DataFrame | None = None) -> DataFrame:
    """Orders staging input: every order line plus a later, refunded copy of
    the lines of every tenth customer (drives de-dup survivorship and the
    refund paths)."""
    # one pass over the joined lines: a union would join them a second time
    lines = (_order_lines(spark, sf_dir) if lines is None else lines).withColumn("_copy", F.explode(
        F.when(F.col("customer_id") % 10 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    out = lines.withColumns({
        "id": F.when(F.col("_copy"), F.col("_copy_id")).otherwise(F.col("id")),
        "status": F.when(F.col("_copy"), "refunded").otherwise(F.col("status"))})
    cols = [f.name for f in USER_ORDERS_LOG.fields] + (["category_name"] if with_category else [])
    return out.select(*cols)


def item_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional item -> category mapping input of the item dimension."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item_id"),
        F.col("p_type").alias("category_name"),
    )


def user_activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity staging input from ``events``: one row per event, action coded
    1-5, the event day as midnight timestamp."""
    e = table(spark, sf_dir, "events")
    action = (
        F.when(F.col("event_type") == "view", 1)
        .when(F.col("event_type") == "click", 2)
        .when(F.col("event_type") == "signup", 3)
        .when(F.col("event_type") == "purchase", 4)
        .otherwise(5)
    )
    return e.select(
        action.cast("bigint").alias("action_id"),
        F.col("user_id").alias("customer_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("date_time"),
        F.col("event_id").alias("id"),
        F.floor("value").cast("bigint").alias("quantity"),
    )


def customer_research(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Research staging input: sales per day x category x geo, with an id
    that is a pure function of the group key (day, category, geo)."""
    fx = fx_orders(spark, sf_dir, lines)
    g = fx.groupBy(
        "date_time",
        (F.col("item_id") % 50).cast("int").alias("category_id"),
        F.col("city_id").alias("geo_id"),
    ).agg(
        F.sum("quantity").cast("int").alias("sales_qty"),
        F.sum("payment_amount").cast("decimal(14,2)").alias("sales_amt"),
    )
    rid = (
        F.date_format("date_time", "yyyyMMdd").cast("bigint") * F.lit(100_000)
        + F.col("category_id") * F.lit(100)
        + F.col("geo_id")
    )
    return g.select(rid.alias("id"), "date_time", "category_id", "geo_id", "sales_qty", "sales_amt")


def research_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Research rows plus later exact copies (new ids) of the first five
    categories: input of the research de-dup."""
    base = customer_research(spark, sf_dir)
    copies = base.where(F.col("category_id") < 5).withColumn(
        "id", F.col("id") + F.lit(RESEARCH_COPY_ID_OFFSET)
    )
    return base.unionByName(copies)


def activity_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity rows plus later copies (shifted ids) of every purchase event:
    input of the activity de-dup."""
    base = user_activity_log(spark, sf_dir)
    copies = base.where(F.col("action_id") == 4).withColumn(
        "id", F.col("id") + F.lit(ACTIVITY_COPY_ID_OFFSET)
    )
    return base.unionByName(copies)
