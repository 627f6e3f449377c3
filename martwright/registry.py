"""Registered queries: name -> Spark callable, plus its DuckDB oracle text.

Names and the operator IDs they cover follow SURVEY §5.4.  Each callable
takes ``(spark, sf_dir)``, reads the given tables of that scale factor (the
staging-shaped inputs of ``sources.fixtures``) and returns a DataFrame over
all of their rows.  Write jobs write below the session's shared checkpoint
folder and return what they read back.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import oracle as O
from .functions import landing_file_name, period_id, to_day
from .operators import dims, quality, staging
from .plans import bitmaps, jobs
from .plans import retention as R
from .plans import sales as C1
from .schemas import DEDUP_KEYS, USER_ORDERS_LOG
from .session import configure, scratch_path, scratch_scope
from .sources import fixtures as fx
from .sources.landing import (CSV, cleanse_increment, cleanse_initial, good_rows, landing_path,
                              read_checked, read_landing, rejected_rows, write_landing)
from .sources.store import Warehouse, stage
from .streaming import increments

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        @functools.wraps(fn)
        def query(spark, sf):
            return fn(configure(spark), sf)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query
    return deco


def _ctes(*extra: str) -> tuple[str, ...]:
    return O.ORDERS_CTES + extra


# --- shared inputs ------------------------------------------------------------

def _warehouse(spark):
    """A fresh warehouse below the shared scratch folder.  Month grain: the
    test history spans 2,400 days of a few dozen rows each, too little per
    day to deserve its own files (day grain is the default for real daily
    volumes; both give identical tables)."""
    return Warehouse(spark, scratch_path(spark, "wh"), grain="month")


def _land(df, land, entity, ds, increment=False):
    """An extract of the jobs, which read whole files: compressed."""
    write_landing(df, landing_path(land, entity, ds, increment), compression="gzip")


def _orders(spark, sf):
    return fx.user_orders_log(spark, sf)


def _sales(spark, sf):
    return C1.daily_sales(_orders(spark, sf))


def _d_item(spark, sf):
    return dims.d_item(_orders(spark, sf), fx.item_categories(spark, sf))


ORDER_COLUMNS = [f.name for f in USER_ORDERS_LOG.fields]
NO_ID = [c for c in ORDER_COLUMNS if c != "id"]

#: Business dates used by the registered scenarios (parameters, not caps:
#: every scenario still reads all rows of its tables).
DELETE_DAY = "1996-03-15"
ACTIVITY_DELETE_DAY = "2024-01-15"
REPLACE_FROM = "2000-01-01"


#: All orders, and the refunded ones once more as orders of items, customers and
#: days that no dimension knows (the unmatched side of J1 and J5).
WITH_UNKNOWNS = """with_unknowns as (
  select * from user_orders_log
  union all
  select city_id, city_name, -customer_id as customer_id, date_time + interval 36500 day as date_time, first_name,
    -id as id, -item_id as item_id, item_name, last_name, quantity, payment_amount, status
  from user_orders_log where status = 'refunded')"""


def _with_unknowns(spark, sf):
    orders = _orders(spark, sf).withColumn("_unknown", F.explode(
        F.when(F.col("status") == "refunded", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    unknown = {"id": -F.col("id"), "item_id": -F.col("item_id"), "customer_id": -F.col("customer_id"),
               "date_time": F.col("date_time") + F.expr("interval 36500 days")}
    return orders.withColumns({
        c: F.when(F.col("_unknown"), v).otherwise(F.col(c)) for c, v in unknown.items()}).drop("_unknown")


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


#: Item names with quotes, commas, a line break and a backslash.
ODD_NAME = """item_name || ' 32", A "B", ' || chr(10) || '\\C' as item_name"""


# === S1-S4, P2-P5, P12: landing files ==========================================

@register("landing_csv_roundtrip", O.with_ctes(
    *_ctes(), body=f"""
select {O.ORDER_COLS_NO_ID.replace('item_name', ODD_NAME)},
  status from user_orders_log"""))
def q_landing_csv_roundtrip(spark, sf):
    """Write the orders extract in landing form, read it
    back by column name, drop the index and the id.  Item names hold quotes,
    commas, a line break and a backslash."""
    root = scratch_path(spark, "landing")
    path = landing_path(root, "user_orders_log", "2022-07-09", increment=True)
    odd = F.concat("item_name", F.lit(' 32", A "B", \n\\C'))
    write_landing(_orders(spark, sf).withColumn("item_name", odd), path)
    return cleanse_increment(read_landing(spark, path, "user_orders_log"), "user_orders_log")


@register("landing_rejects", O.with_ctes(*_ctes(), body="""
select 'taken' as verdict, city_name, count(*) as n_rows, sum(quantity)::bigint as quantity
from user_orders_log group by city_name
union all
select case when n_regionkey = 0 then 'date_time, quantity' else 'date_time' end, n_name, 1, null::bigint from nation"""))
def q_landing_rejects(spark, sf):
    """The orders extract with one bad row per nation among its files:
    every good row is taken, every bad one set apart with its reason."""
    path = landing_path(scratch_path(spark, "landing"), "user_orders_log", "2022-07-09", increment=True)
    write_landing(_orders(spark, sf), path)
    bad = {"city_name": F.col("n_name"), "date_time": F.lit("some day"),
           "quantity": F.when(F.col("n_regionkey") == 0, "many").otherwise("1")}
    planted = fx.table(spark, sf, "nation").select(
        F.lit("0").alias(""), *[bad.get(c, F.lit(None).cast("string")).alias(c) for c in ORDER_COLUMNS])
    planted.write.mode("append").options(header=True, **CSV).csv(path)
    checked = read_checked(spark, path, "user_orders_log", multi_line=False)
    taken = good_rows(checked).groupBy(F.lit("taken").alias("verdict"), "city_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity"))
    rejects = rejected_rows(checked, "user_orders_log", "2022-07-09")
    return taken.unionByName(rejects.groupBy(
        F.col("reason").alias("verdict"), F.get_json_object("text", "$.city_name").alias("city_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(None).cast("long").alias("quantity")))


@register("cleanse_initial_orders", O.with_ctes(
    *_ctes(), body=f"select distinct {O.ORDER_COLS_NO_ID}, 'shipped' as status from user_orders_log"))
def q_cleanse_initial_orders(spark, sf):
    """An initial extract with ``date_id`` and no id/status; exact
    duplicates dropped, then every row 'shipped'."""
    root = scratch_path(spark, "landing")
    path = landing_path(root, "user_orders_log", "2022-07-09")
    src = _orders(spark, sf).drop("id", "status").withColumnRenamed("date_time", "date_id")
    write_landing(src, path)
    return cleanse_initial(read_landing(spark, path, "user_orders_log"), "user_orders_log")


@register("cleanse_increment_orders", O.with_ctes(
    *_ctes(), body=f"select {O.ORDER_COLS_NO_ID}, 'shipped' as status from user_orders_log"))
def q_cleanse_increment_orders(spark, sf):
    """An increment with id and ``date_id`` but no status: id
    dropped, status added; duplicates are kept."""
    root = scratch_path(spark, "landing")
    path = landing_path(root, "user_orders_log", "2022-07-09", increment=True)
    src = _orders(spark, sf).drop("status").withColumnRenamed("date_time", "date_id")
    write_landing(src, path)
    return cleanse_increment(read_landing(spark, path, "user_orders_log"), "user_orders_log")


@register("landing_date_name", O.with_ctes(*_ctes(), body="""
select distinct cast(date_time as date) as business_dt,
  strftime(cast(date_time as date), '%Y%m%d') || '_user_orders_log.csv' as file_name,
  strftime(cast(date_time as date), '%Y%m%d') || '_user_orders_log_inc.csv' as increment_file_name
from user_orders_log"""))
def q_landing_date_name(spark, sf):
    """Landing file names of every business day in the orders."""
    d = _orders(spark, sf).select(to_day("date_time").alias("business_dt")).distinct()
    return d.select(
        "business_dt",
        landing_file_name(F.col("business_dt"), "user_orders_log").alias("file_name"),
        landing_file_name(F.col("business_dt"), "user_orders_log", True).alias("increment_file_name"),
    )


# === S5 S6 M6-M11: staging table maintenance ====================================

@register("append_by_name", O.with_ctes(*_ctes(), body="select * from user_orders_log"))
def q_append_by_name(spark, sf):
    """Append rows whose columns come in another order (and
    with an extra column) into the declared table, by name; read back."""
    wh = _warehouse(spark)
    wh.init_tables(["user_orders_log"])
    src = fx.user_orders_log(spark, sf, with_category=True)
    src = src.select(*reversed(src.columns))
    wh.append("user_orders_log", staging.align(src, USER_ORDERS_LOG))
    return wh.read("user_orders_log")


@register("increment_gate_noop", O.with_ctes(*_ctes(), body="select * from user_orders_log"))
def q_increment_gate_noop(spark, sf):
    """The day's increment is not complete -> the job does nothing and
    the staging table is unchanged."""
    wh = _warehouse(spark)
    wh.init_tables(["user_orders_log"])
    land = scratch_path(spark, "landing")
    with scratch_scope(spark):
        orders = stage(_orders(spark, sf), "orders")
        wh.overwrite("user_orders_log", orders)
        # one of three extracts is not enough
        _land(orders, land, "user_orders_log", "2022-07-09", increment=True)
    result = jobs.daily_increment(spark, land, wh, "2022-07-09")
    assert result.status == "no-op"
    return wh.read("user_orders_log")


@register("backfill_status", O.with_ctes(
    *_ctes(), body=f"select {O.ORDER_COLS}, 'shipped' as status from user_orders_log"))
def q_backfill_status(spark, sf):
    """Every status set to 'shipped'."""
    return staging.backfill_status(_orders(spark, sf))


@register("add_status_column", O.with_ctes(
    *_ctes(), body=f"select {O.ORDER_COLS}, cast(null as varchar) as status from user_orders_log"))
def q_add_status_column(spark, sf):
    """M7: a table stored before ``status`` existed, read with the evolved
    schema: the new column is NULL for the old rows."""
    path = scratch_path(spark, "pre-status")
    _orders(spark, sf).drop("status").write.parquet(path)
    old = spark.read.parquet(path)
    evolved = spark.read.schema(USER_ORDERS_LOG).parquet(path)
    assert "status" not in old.columns
    return staging.add_status_column(evolved).select(*ORDER_COLUMNS)


@register("assign_row_ids", O.with_ctes(*_ctes(), body="""
select count(*) as n_rows, count(*) as n_distinct_ids, true as all_above_base, 0::bigint as n_out_of_order
from user_orders_log"""))
def q_assign_row_ids(spark, sf):
    """M9: ids assigned to an id-less extract of several files of unequal
    size are unique, above the table's high-water mark, and follow the file
    names and the rows of each file."""
    base, land = 1_000, scratch_path(spark, "landing")
    # the earliest month makes up a small first file, the others larger ones
    months = F.date_format("date_time", "yyyy-MM")
    with scratch_scope(spark):
        orders = stage(_orders(spark, sf), "orders")
        for k, years in enumerate((months <= "1995-01", (months > "1995-01") & (months < "1999"), months >= "1999")):
            write_landing(orders.where(years).coalesce(k + 1).withColumn("city_name", F.lit(str(k))),
                          f"{land}/{k}.csv")
    # no value holds a line break: large files are read in blocks
    rows = read_landing(spark, f"{land}/*", "user_orders_log", multi_line=False, position=True)
    rows = rows.withColumns({c: F.col("_position")[c] for c in ("file", "block", "row")})
    both = staging.assign_ids(rows, base).select("file", "block", "row", F.col("id").alias("new"))
    in_block = Window.partitionBy("file", "block").orderBy("row")
    blocks = both.groupBy("file", "block").agg(F.min("new").alias("low"), F.max("new").alias("high"))
    in_blocks = both.withColumn("back", F.col("new") <= F.lag("new").over(in_block))
    # one row per block
    between = blocks.withColumn("back", F.col("low") <= F.lag("high").over(Window.orderBy("file", "block")))
    out = in_blocks.select("new", "back").unionByName(between.select(F.lit(None).cast("long").alias("new"), "back"))
    # the ids alone are shuffled for the distinct count, not the other sums beside each
    distinct = both.select("new").distinct().agg(F.count("new").alias("n_distinct_ids"))
    return out.agg(
        F.count("new").alias("n_rows"),
        (F.min("new") > base).alias("all_above_base"),
        F.count(F.when(F.col("back"), 1)).alias("n_out_of_order"),
    ).crossJoin(distinct).select("n_rows", "n_distinct_ids", "all_above_base", "n_out_of_order")


@register("delete_business_day", O.with_ctes(*_ctes(), body=f"""
select * from user_orders_log
where not coalesce(date_time = make_date(
  cast(left('{DELETE_DAY}', 4) as integer), cast(substring('{DELETE_DAY}', 6, 2) as integer),
  cast(right('{DELETE_DAY}', 2) as integer))::timestamp, false)"""))
def q_delete_business_day(spark, sf):
    """Remove the business day's (midnight) rows."""
    return staging.delete_business_day(_orders(spark, sf), DELETE_DAY)


@register("delete_business_day_sql", O.with_ctes(*_ctes(), body=f"""
select * from user_orders_log where date_time is null or date_time <> timestamp '{DELETE_DAY}'"""))
def q_delete_business_day_sql(spark, sf):
    """The same statement through ``spark.sql`` with bound parameters."""
    _orders(spark, sf).createOrReplaceTempView("orders_of_the_day")
    return staging.delete_business_day_sql(spark, "orders_of_the_day", DELETE_DAY)


@register("delete_whole_day", f"""
with events_staged as (
  select case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3
                         when 'purchase' then 4 else 5 end::bigint as action_id,
         user_id as customer_id, ts as date_time, event_id as id,
         cast(floor(value) as bigint) as quantity
  from events)
select * from events_staged
where not coalesce(cast(date_time as date) = date '{ACTIVITY_DELETE_DAY}', false)""")
def q_delete_whole_day(spark, sf):
    """M1 (whole-day option): activity rows keep their event time; every row
    of the day is removed, not just midnight ones."""
    e = fx.table(spark, sf, "events").select("event_id", "ts")
    act = fx.user_activity_log(spark, sf).join(e, F.col("id") == F.col("event_id")).select(
        "action_id", "customer_id", F.col("ts").alias("date_time"), "id", "quantity")
    return staging.delete_business_day(act, ACTIVITY_DELETE_DAY, whole_day=True)


# === W1 M5 P8 T1: de-duplication =================================================

def _dedup_oracle(src: str, keys: list[str], *ctes: str) -> str:
    k = ", ".join(keys)
    return O.with_ctes(*ctes, body=f"""
select * exclude (rn) from (
  select *, row_number() over (partition by {k} order by id) as rn from {src}) t
where rn = 1""")


@register("dedup_customer_research", _dedup_oracle(
    "research_with_copies", DEDUP_KEYS["customer_research"],
    O.FX_ORDERS, O.CUSTOMER_RESEARCH, O.RESEARCH_WITH_COPIES))
def q_dedup_customer_research(spark, sf):
    """Research rows, lowest id per full payload."""
    return staging.dedupe_entity(fx.research_with_copies(spark, sf), "customer_research")


@register("dedup_activity", _dedup_oracle(
    "activity_with_copies", DEDUP_KEYS["user_activity_log"],
    O.USER_ACTIVITY_LOG, O.ACTIVITY_WITH_COPIES))
def q_dedup_activity(spark, sf):
    """Activity rows, lowest id per payload."""
    return staging.dedupe_entity(fx.activity_with_copies(spark, sf), "user_activity_log")


@register("dedup_orders", _dedup_oracle(
    "user_orders_log", DEDUP_KEYS["user_orders_log"], *O.ORDERS_CTES))
def q_dedup_orders(spark, sf):
    """Orders, lowest id per key without status -- the later
    refunded copy of a sale is dropped."""
    return staging.dedupe_entity(_orders(spark, sf), "user_orders_log")


# === Q1-Q5: quality =============================================================

#: A bound that the test tables exceed, for the failing verdict.
TIGHT_BOUNDS = (5, 10)


def _rows_check_oracle(table: str, label: str, check: str, *ctes: str) -> str:
    return O.with_ctes(*ctes, body=f"""
select '{label}' as table_name, '{check}' as dq_check_name, hi as highest,
  cast(case when n between 5 and hi then 0 else 1 end as decimal(8,2)) as dq_check_result
from (select count(*) as n from {table}), (values (1000000), ({TIGHT_BOUNDS[1]})) b(hi)""")


def _rows_check(df, table):
    """The verdicts under the reference's bounds and under tight ones."""
    verdicts = [quality.rows_check(df, table, b).withColumn("highest", F.lit(b[1]))
                for b in (quality.REFERENCE_BOUNDS, TIGHT_BOUNDS)]
    return verdicts[0].unionByName(verdicts[1]).drop("datetime")


@register("rows_check_orders", _rows_check_oracle(
    "user_orders_log", "user_orders_log", "check_rows_orders_log", *O.ORDERS_CTES))
def q_rows_check_orders(spark, sf):
    """Orders row-count verdicts (0 pass, 1 fail)."""
    return _rows_check(_orders(spark, sf), "user_orders_log")


@register("rows_check_activity", _rows_check_oracle(
    "user_activity_log", "user_activity_log", "check_rows_activity_log", O.USER_ACTIVITY_LOG))
def q_rows_check_activity(spark, sf):
    """Activity row-count verdicts."""
    return _rows_check(fx.user_activity_log(spark, sf), "user_activity_log")


@register("verdict_log", O.with_ctes(*_ctes(O.USER_ACTIVITY_LOG), body=f"""
select 'user_orders_log' as table_name, 'check_rows_orders_log' as dq_check_name,
  cast(case when (select count(*) from user_orders_log) between 5 and 1000000 then 0 else 1 end
       as decimal(8,2)) as dq_check_result, true as has_timestamp
union all
select 'user_activity_log', 'check_rows_activity_log',
  cast(case when (select count(*) from user_activity_log) between 5 and {TIGHT_BOUNDS[1]} then 0 else 1 end
       as decimal(8,2)), true"""))
def q_verdict_log(spark, sf):
    """Both checks run in order and are appended to the
    check log with the current time; the second fails and stops the job."""
    wh = _warehouse(spark)
    wh.init_tables(["dq_checks_results"])
    try:
        jobs.run_checks(spark, wh, {"user_orders_log": _orders(spark, sf),
                                    "user_activity_log": fx.user_activity_log(spark, sf)},
                        bounds={"user_orders_log": quality.REFERENCE_BOUNDS, "user_activity_log": TIGHT_BOUNDS})
    except quality.DataQualityError:
        pass
    else:
        raise AssertionError("the failing check did not stop the job")
    log = wh.read("dq_checks_results")
    return log.select("table_name", "dq_check_name", "dq_check_result",
                      F.col("datetime").isNotNull().alias("has_timestamp"))


def _mart_inputs(spark, sf):
    orders = _orders(spark, sf)
    activity = fx.user_activity_log(spark, sf)
    return {
        "orders": orders,
        "activity": activity,
        "d_calendar": dims.d_calendar(orders, activity),
        "d_city": dims.d_city(orders),
        "d_customer": dims.d_customer(orders),
        "d_item": dims.d_item(orders, fx.item_categories(spark, sf)),
        "f_activity": dims.f_activity(activity),
        "f_daily_sales": C1.daily_sales(orders),
    }


_MART_CTES = _ctes(
    O.USER_ACTIVITY_LOG, O.ITEM_CATEGORIES, O.D_ITEM, O.D_CALENDAR, O.F_ACTIVITY,
    O.sales_cte("f_daily_sales", "user_orders_log"),
    O.latest_cte("d_city", "user_orders_log", "city_id", ["city_name"], "integer"),
    O.latest_cte("d_customer", "user_orders_log", "customer_id",
                 ["first_name", "last_name", "city_id"], "integer"),
)


_UNKNOWN_CTES = _ctes(
    WITH_UNKNOWNS, O.USER_ACTIVITY_LOG, O.ITEM_CATEGORIES, O.F_ACTIVITY, O.sales_cte("f_daily_sales", "with_unknowns"),
    O.D_ITEM, "d_calendar as (select distinct cast(date_time as date) as date_time from user_orders_log)",
    O.latest_cte("d_customer", "user_orders_log", "customer_id", ["first_name", "last_name", "city_id"], "integer"))


def _fk_orphans(m):
    days = quality.fk_orphans(m["f_activity"], m["d_calendar"], "date_time", "date_time", "f_activity.date_time")
    return days.unionByName(quality.fk_orphans_at_once(m["f_daily_sales"], [
        (m["d_calendar"], "date_time", "date_time", "f_daily_sales.date_time"),
        (m["d_item"], "item_id", "item_id", "f_daily_sales.item_id"),
        (m["d_customer"], "customer_id", "customer_id", "f_daily_sales.customer_id"),
    ]))


@register("fk_orphans", O.with_ctes(*_UNKNOWN_CTES, body="""
select 'f_activity.date_time' as fk_name, count(*) as n_orphans from f_activity f
  where f.date_time is not null and not exists (select 1 from d_calendar c where c.date_time = f.date_time)
union all
select 'f_daily_sales.date_time', count(*) from f_daily_sales f
  where f.date_time is not null and not exists (select 1 from d_calendar c where c.date_time = f.date_time)
union all
select 'f_daily_sales.item_id', count(*) from f_daily_sales f
  where f.item_id is not null and not exists (select 1 from d_item i where i.item_id = f.item_id)
union all
select 'f_daily_sales.customer_id', count(*) from f_daily_sales f
  where f.customer_id is not null and not exists (select 1 from d_customer c where c.customer_id = f.customer_id)
"""))
def q_fk_orphans(spark, sf):
    """Orphan fact rows per declared foreign key: sales of unknown
    items, customers and days, and a calendar of the orders' days alone."""
    m = _mart_inputs(spark, sf)
    return _fk_orphans(m | {"d_calendar": dims.days_per_partition(m["orders"]),
                            "f_daily_sales": C1.daily_sales(_with_unknowns(spark, sf))})


@register("fk_orphans_whole", O.with_ctes(*_MART_CTES, body="""
select 'f_activity.date_time' as fk_name, count(*) as n_orphans from f_activity f
  where f.date_time is not null and not exists (select 1 from d_calendar c where c.date_time = f.date_time)
union all
select 'f_daily_sales.date_time', count(*) from f_daily_sales f
  where f.date_time is not null and not exists (select 1 from d_calendar c where c.date_time = f.date_time)
union all
select 'f_daily_sales.item_id', count(*) from f_daily_sales f
  where f.item_id is not null and not exists (select 1 from d_item i where i.item_id = f.item_id)
union all
select 'f_daily_sales.customer_id', count(*) from f_daily_sales f
  where f.customer_id is not null and not exists (select 1 from d_customer c where c.customer_id = f.customer_id)
"""))
def q_fk_orphans_whole(spark, sf):
    """Orphan fact rows per declared foreign key, against the mart's
    whole dimensions."""
    return _fk_orphans(_mart_inputs(spark, sf))


_PK_SPECS = [
    ("f_daily_sales", ["date_time", "item_id", "customer_id"]),
    ("f_activity", ["activity_id", "date_time"]),
    ("d_calendar", ["date_time"]),
    ("d_city", ["city_id"]),
    ("d_customer", ["customer_id"]),
    ("d_item", ["item_id"]),
    ("user_orders_log", ["id"]),
]


def _pk_oracle() -> str:
    parts = []
    for t, keys in _PK_SPECS:
        k = ", ".join(keys)
        parts.append(f"""select '{t}' as table_name, '{",".join(keys)}' as key_columns,
  count(*) as n_keys, cast(coalesce(sum(n), 0) as bigint) as n_rows
from (select {k}, count(*) as n from {t} group by {k} having count(*) > 1) d""")
    return O.with_ctes(*_MART_CTES, body="\nunion all\n".join(parts))


@register("pk_violations", _pk_oracle())
def q_pk_violations(spark, sf):
    """Q5: primary-key / unique violations.  The sales PK omits status, so a
    sale and its refund on one day collide (reported, rows kept)."""
    m = _mart_inputs(spark, sf)
    frames = {**m, "user_orders_log": m["orders"]}
    out = None
    for t, keys in _PK_SPECS:
        part = quality.pk_violations(frames[t], keys, t)
        out = part if out is None else out.unionByName(part)
    return out


_COLUMN_SPECS = [
    ("d_calendar", ["date_time"], {"month_name": 8}),
    ("d_city", [], {"city_name": 50}),
    ("d_customer", ["customer_id"], {"first_name": 15, "last_name": 15}),
    ("d_item", ["item_id"], {"item_name": 50, "category_name": 50}),
    ("f_daily_sales", ["date_time", "item_id", "customer_id"], {}),
    ("f_activity", ["activity_id", "date_time"], {}),
]


def _column_checks_oracle() -> str:
    parts = []
    for t, nn, ml in _COLUMN_SPECS:
        for c in nn:
            parts.append(f"select '{t}' as table_name, '{c}' as column_name, 'not_null' as check_name, "
                         f"count(*) filter (where {c} is null) as n_violations from {t}")
        for c, n in ml.items():
            parts.append(f"select '{t}', '{c}', 'max_length_{n}', "
                         f"count(*) filter (where length({c}) > {n}) from {t}")
    return O.with_ctes(*_MART_CTES, body="\nunion all\n".join(parts))


@register("null_and_length_checks", _column_checks_oracle())
def q_null_and_length_checks(spark, sf):
    """Q5: NOT NULL and VARCHAR(n) limits of the declared mart schema."""
    m = _mart_inputs(spark, sf)
    out = None
    for t, nn, ml in _COLUMN_SPECS:
        part = quality.column_checks(m[t], t, nn, ml)
        out = part if out is None else out.unionByName(part)
    return out


# === D1-D5: dimensions and activity ==============================================

@register("dim_calendar", O.with_ctes(*_MART_CTES, body="select * from d_calendar"))
def q_dim_calendar(spark, sf):
    """Calendar of all order and activity days."""
    return _mart_inputs(spark, sf)["d_calendar"]


@register("dim_city", O.with_ctes(*_MART_CTES, body="select * from d_city"))
def q_dim_city(spark, sf):
    """One row per city, latest name."""
    return _mart_inputs(spark, sf)["d_city"]


@register("dim_customer", O.with_ctes(*_MART_CTES, body="select * from d_customer"))
def q_dim_customer(spark, sf):
    """D3: one row per customer, latest attributes."""
    return _mart_inputs(spark, sf)["d_customer"]


@register("dim_item", O.with_ctes(*_MART_CTES, body="select * from d_item"))
def q_dim_item(spark, sf):
    """One row per item with its category."""
    return _mart_inputs(spark, sf)["d_item"]


@register("fact_activity", O.with_ctes(*_MART_CTES, body="select * from f_activity"))
def q_fact_activity(spark, sf):
    """Clicks per action and day."""
    return _mart_inputs(spark, sf)["f_activity"]


# === C1, M3 =======================================================================

@register("daily_sales", O.with_ctes(*O.SALES_CTES, body="select * from f_daily_sales"))
def q_daily_sales(spark, sf):
    """F4 F9 F10 P10 A9."""
    return _sales(spark, sf)


_REPLACE_CTES = (
    O.FX_ORDERS, O.USER_ORDERS_LOG,
    O.sales_cte("target", "fx_orders"),
    O.sales_cte("updates", f"(select * from user_orders_log where date_time >= date '{REPLACE_FROM}')"),
)


@register("daily_sales_replace", O.with_ctes(*_REPLACE_CTES, body="""
select * from target where date_time not in (select distinct date_time from updates)
union all
select * from updates"""))
def q_daily_sales_replace(spark, sf):
    """The stored fact has the days of an update replaced
    (touched partitions merged by an anti join on the day and swapped in by
    dynamic partition overwrite); other days kept."""
    wh = _warehouse(spark)
    wh.overwrite("f_daily_sales", C1.daily_sales(fx.fx_orders(spark, sf)))
    upd = _orders(spark, sf).where(F.col("date_time") >= F.lit(REPLACE_FROM).cast("timestamp_ntz"))
    wh.replace_by_key("f_daily_sales", C1.daily_sales(upd), "date_time")
    return wh.read("f_daily_sales")


# === F1-F3, W2, J1/J2, A1-A10, C2, M4 ===========================================

@register("period_id", O.with_ctes(*_ctes(), body="""
select distinct cast(date_time as date) as business_dt,
  cast(year(date_time) as varchar) || cast(week(date_time) as varchar) as period_id,
  cast(isoyear(date_time) as varchar) || cast(week(date_time) as varchar) as iso_period_id
from user_orders_log"""))
def q_period_id(spark, sf):
    """Year || ISO week, reference form and ISO-year form."""
    d = _orders(spark, sf).select(to_day("date_time").alias("business_dt")).distinct()
    return d.select("business_dt", period_id("business_dt").alias("period_id"),
                    period_id("business_dt", iso_year=True).alias("iso_period_id"))


_RET_CTES = O.SALES_CTES + (O.ITEM_CATEGORIES, O.D_ITEM) + O.retention_ctes("f_daily_sales")


@register("customer_cohort", O.with_ctes(*_RET_CTES, body="select * from cohorts"))
def q_customer_cohort(spark, sf):
    """Each customer's first non-refunded sale day and its period."""
    return R.customer_cohort(_sales(spark, sf))


@register("sales_enriched", O.with_ctes(
    *_ctes(WITH_UNKNOWNS, O.sales_cte("f_daily_sales", "with_unknowns"), O.ITEM_CATEGORIES, O.D_ITEM),
    *O.retention_ctes("f_daily_sales"),
    body="""
select * exclude (is_new), case when is_new then 'new' else 'returning' end as customer_type from sold"""))
def q_sales_enriched(spark, sf):
    """The DISTINCT retention base with category (left join
    on items, some of which are unknown), cohort (left join on
    customers) and customer type."""
    sales = C1.daily_sales(_with_unknowns(spark, sf))
    base = R.sales_enriched(sales, _d_item(spark, sf))
    cohorts = R.customer_cohort(sales).select("customer_id", "cohort")
    out = base.join(cohorts, "customer_id", "left")
    new = F.coalesce(F.col("cohort") == F.col("period_id"), F.lit(False))
    return out.withColumn("customer_type", F.when(new, "new").otherwise("returning"))


@register("retention_groups", O.with_ctes(*_RET_CTES, body="""
select period_id, case when is_new then 'new' else 'returning' end as customer_type, status, category_name, cohort,
  count(distinct customer_id) as n_customers, sum(payment_amount)::decimal(14,2) as payment_amount,
  count(*) as n_transactions
from sold group by period_id, is_new, status, category_name, cohort"""))
def q_retention_groups(spark, sf):
    """The inner aggregate per (period, type, status, category,
    cohort)."""
    return R.retention_groups(_sales(spark, sf), _d_item(spark, sf))


@register("weekly_retention", O.with_ctes(*_RET_CTES, body="select * from retention"))
def q_weekly_retention(spark, sf):
    """A2 A5 A8 F11 F12 (flagship)."""
    return R.weekly_retention(_sales(spark, sf), _d_item(spark, sf))


@register("weekly_retention_bitmaps", ORACLE["weekly_retention"])
def q_weekly_retention_bitmaps(spark, sf):
    """A3: the same fact by merged bitmaps.  Days up to the middle of 2001
    build numbers and bits, with one day's sales missing and another day's
    all shipped; a refresh mends these two days and adds the later ones."""
    wh = _warehouse(spark)
    items = _d_item(spark, sf)
    sales = jobs.stage(_sales(spark, sf), "sales")
    until, missing, altered = (F.lit(d).cast("date") for d in ("2001-06-30", "1996-03-04", "1997-05-06"))
    first = sales.where((F.col("date_time") <= until) & (F.col("date_time") != missing))
    wh.overwrite("f_daily_sales", first.withColumn(
        "status", F.when(F.col("date_time") == altered, "shipped").otherwise(F.col("status"))))
    bitmaps.refresh(wh, items)
    late = sales.where((F.col("date_time") > until) | F.col("date_time").isin(missing, altered))
    days = [r["date_time"] for r in late.select("date_time").distinct().collect()]
    wh.replace_by_key("f_daily_sales", late, "date_time")
    bitmaps.refresh(wh, items, days)
    return wh.read("f_customer_retention")


_RET_REPLACE_CTES = (
    _REPLACE_CTES + (O.ITEM_CATEGORIES, O.D_ITEM)
    + O.retention_ctes("target", "t_") + O.retention_ctes("updates", "u_")
)


@register("weekly_retention_replace", O.with_ctes(*_RET_REPLACE_CTES, body="""
select * from t_retention where period_id not in (select period_id from u_retention)
union all
select * from u_retention"""))
def q_weekly_retention_replace(spark, sf):
    """M4: the stored retention has the periods of a new computation
    replaced; periods absent from it are kept."""
    wh = _warehouse(spark)
    d_item = _d_item(spark, sf)
    wh.overwrite("f_customer_retention",
                 R.weekly_retention(C1.daily_sales(fx.fx_orders(spark, sf)), d_item))
    upd = _orders(spark, sf).where(F.col("date_time") >= F.lit(REPLACE_FROM).cast("timestamp_ntz"))
    wh.replace_by_key("f_customer_retention", R.weekly_retention(C1.daily_sales(upd), d_item),
                      "period_id")
    return wh.read("f_customer_retention")


# === C3-C5: jobs ==================================================================

@register("initial_load", O.with_ctes(*_ctes(), body=f"""
select {O.ORDER_COLS}, 'shipped' as status from (
  select *, row_number() over (partition by city_id, city_name, customer_id, date_time, first_name,
                                            item_id, item_name, last_name, quantity, payment_amount
                               order by id) as rn
  from user_orders_log) t
where rn = 1"""))
def q_initial_load(spark, sf):
    """C3 (M11 P3 P12 S1 S5 M5 and the first mart build): the whole orders
    extract, refunded copies included, lands as the initial file; every row
    becomes 'shipped' and the later copies are de-duplicated away."""
    land = scratch_path(spark, "landing")
    wh = _warehouse(spark)
    with scratch_scope(spark):
        _land(_orders(spark, sf), land, "user_orders_log", "2022-07-09")
        _land(fx.user_activity_log(spark, sf), land, "user_activity_log", "2022-07-09")
    res = jobs.initial_load(spark, land, wh, "2022-07-09", categories=fx.item_categories(spark, sf))
    assert res.status == "loaded"
    return wh.read("user_orders_log")


@register("initial_load_mart", O.with_ctes(
    *_ctes(O.ITEM_CATEGORIES,
           f"""loaded as (
  select {O.ORDER_COLS}, 'shipped' as status from (
    select *, row_number() over (partition by city_id, city_name, customer_id, date_time, first_name,
                                              item_id, item_name, last_name, quantity, payment_amount
                                 order by id) as rn
    from user_orders_log) t where rn = 1)""",
           O.D_ITEM.replace("from user_orders_log", "from loaded"),
           O.sales_cte("f_daily_sales", "loaded")) + O.retention_ctes("f_daily_sales"),
    body="select * from retention"))
def q_initial_load_mart(spark, sf):
    """The retention fact that the initial load builds."""
    land = scratch_path(spark, "landing")
    wh = _warehouse(spark)
    with scratch_scope(spark):
        _land(_orders(spark, sf), land, "user_orders_log", "2022-07-09")
    jobs.initial_load(spark, land, wh, "2022-07-09", categories=fx.item_categories(spark, sf))
    return wh.read("f_customer_retention")


INITIAL_DS = "2000-11-30"
INCREMENT_DS = "2000-12-15"
INCREMENT_FROM = "2000-12-01"
INITIAL_UNTIL = "2001-01-01"
ACTIVITY_UNTIL = "2024-01-20"
ACTIVITY_FROM = "2024-01-15"


def _land_increment(spark, sf):
    """A warehouse loaded up to the end of 2000 and the increment's landed extracts."""
    land = scratch_path(spark, "landing")
    wh = _warehouse(spark)
    activity = fx.user_activity_log(spark, sf)
    with scratch_scope(spark):
        lines = fx.staged_lines(spark, sf)
        orders = fx.user_orders_log(spark, sf, lines=lines)
        research = stage(fx.customer_research(spark, sf, lines), "research")
        _land(orders.where(F.col("date_time") < _ts(INITIAL_UNTIL)), land, "user_orders_log", INITIAL_DS)
        _land(activity.where(F.col("date_time") < _ts(ACTIVITY_UNTIL)), land, "user_activity_log", INITIAL_DS)
        _land(research.where(F.col("date_time") < _ts(INITIAL_UNTIL)), land, "customer_research", INITIAL_DS)
        inc = fx.fx_orders(spark, sf, lines).where(F.col("date_time") >= _ts(INCREMENT_FROM)).drop("id")
        _land(inc.drop("category_name"), land, "user_orders_log", INCREMENT_DS, increment=True)
        _land(activity.where(F.col("date_time") >= _ts(ACTIVITY_FROM)).drop("id"),
              land, "user_activity_log", INCREMENT_DS, increment=True)
        _land(research.where(F.col("date_time") >= _ts(INCREMENT_FROM)), land, "customer_research", INCREMENT_DS, increment=True)
    cats = fx.item_categories(spark, sf)
    jobs.initial_load(spark, land, wh, INITIAL_DS, categories=cats)
    return land, wh, cats


@register("increment_end_to_end", O.with_ctes(
    *_ctes(O.ITEM_CATEGORIES,
           f"""final_orders as (
  select {O.ORDER_COLS},
    case when date_time >= timestamp '{INITIAL_UNTIL}' or date_time = timestamp '{INCREMENT_DS}'
         then status else 'shipped' end as status
  from fx_orders)""",
           O.D_ITEM.replace("from user_orders_log", "from final_orders"),
           O.sales_cte("f_daily_sales", "final_orders")) + O.retention_ctes("f_daily_sales"),
    body="select * from retention"))
def q_increment_end_to_end(spark, sf):
    """C4 (after a C3 setup): an initial load up to the end of 2000 (every
    row 'shipped', refunded copies de-duplicated away), then one increment
    with all rows from 2000-12-01 on (statuses kept).  The business day is
    deleted and reloaded, overlapping days keep the earlier rows, later days
    are new; facts are refreshed for the touched days and retention in full."""
    land, wh, cats = _land_increment(spark, sf)
    res = jobs.daily_increment(spark, land, wh, INCREMENT_DS, categories=cats)
    assert res.status == "loaded"
    return wh.read("f_customer_retention")


class _Lost(RuntimeError):
    pass


class _LossyWarehouse(Warehouse):
    """Loses the job inside the next write of one table, after some files."""

    lost: str | None = None

    def _write(self, name, df):
        if name == self.lost:
            super()._write(name, df.limit(1))
            raise _Lost(name)
        return super()._write(name, df)


@register("increment_after_lost_write", ORACLE["increment_end_to_end"])
def q_increment_after_lost_write(spark, sf):
    """The increment of ``increment_end_to_end`` is lost inside
    the write of staging, of the customer state and of the retention groups
    before it runs to its end; the fact is the same."""
    land, wh, cats = _land_increment(spark, sf)
    for table in ("user_orders_log", "customer_cohorts", "retention_groups"):
        lossy = _LossyWarehouse(spark, wh.root)
        lossy.lost = table
        try:
            jobs.daily_increment(spark, land, lossy, INCREMENT_DS, categories=cats)
        except _Lost:
            pass
        else:
            raise AssertionError(f"{table} was not written")
    wh = Warehouse(spark, wh.root)
    jobs.daily_increment(spark, land, wh, INCREMENT_DS, categories=cats)
    return wh.read("f_customer_retention")


BACKFILL_DAYS = ["2001-07-01", "2001-07-02", "2001-07-03"]
ORDERS_ONLY = ("user_orders_log",)


def _land_backfill(spark, sf):
    """C3 from an initial extract up to 2001-06-30, then three increment
    extracts (the first two days, then everything from the third day on)."""
    land = scratch_path(spark, "landing")
    wh = _warehouse(spark)
    day = F.to_date("date_time")
    with scratch_scope(spark):
        fxo = stage(fx.fx_orders(spark, sf).drop("category_name"), "orders")
        _land(fxo.where(day < F.lit(BACKFILL_DAYS[0]).cast("date")), land, "user_orders_log", "2001-06-30")
        _land(fx.user_activity_log(spark, sf), land, "user_activity_log", "2001-06-30")
        for i, ds in enumerate(BACKFILL_DAYS):
            sel = day >= F.lit(ds).cast("date") if i == len(BACKFILL_DAYS) - 1 else day == F.lit(ds).cast("date")
            _land(fxo.where(sel).drop("id"), land, "user_orders_log", ds, increment=True)
    jobs.initial_load(spark, land, wh, "2001-06-30", categories=fx.item_categories(spark, sf))
    return land, wh


_BACKFILL_ORACLE = O.with_ctes(
    *_ctes(f"""final_orders as (
  select {O.ORDER_COLS},
    case when date_time >= timestamp '{BACKFILL_DAYS[0]}' then status else 'shipped' end as status
  from fx_orders)""", O.sales_cte("f_daily_sales", "final_orders")),
    body="select * from f_daily_sales")


@register("stream_increments", _BACKFILL_ORACLE)
def q_stream_increments(spark, sf):
    """S8 + C5 through Structured Streaming: a file stream over the landing
    folder (Trigger.AvailableNow) runs the increment for each landed day,
    once its extracts, which land in two batches, are complete."""
    land, wh = _land_backfill(spark, sf)
    seen, ckpt = [], scratch_path(spark, "stream-ckpt")
    expected = ("user_orders_log", "user_activity_log")
    activity = fx.user_activity_log(spark, sf).where(F.to_date("date_time") > F.lit("2024-01-28").cast("date")).drop("id")

    def catch_up():  # AvailableNow stops by itself
        increments.start(spark, land, wh, ckpt, fx.item_categories(spark, sf), on_result=lambda r: seen.append(r.ds),
                         expected=expected).awaitTermination()

    catch_up()
    assert seen == []  # every day still lacks an extract
    for ds in BACKFILL_DAYS:
        _land(activity, land, "user_activity_log", ds, increment=True)
    catch_up()
    assert seen == BACKFILL_DAYS, seen
    return wh.read("f_daily_sales")


@register("backfill_three_days", _BACKFILL_ORACLE)
def q_backfill_three_days(spark, sf):
    """C5 (after a C3 setup): three daily increments in order -- the first
    two days, then everything from the third day on -- leave the fact equal
    to a one-shot computation over the final staging."""
    land, wh = _land_backfill(spark, sf)
    results = jobs.backfill(spark, land, wh, BACKFILL_DAYS, categories=fx.item_categories(spark, sf),
                            expected=ORDERS_ONLY)
    assert [r.status for r in results] == ["loaded"] * 3
    return wh.read("f_daily_sales")


@register("increment_after_failed_check", _BACKFILL_ORACLE)
def q_increment_after_failed_check(spark, sf):
    """Q3b + C4: the first day's row check fails, which stops the job after
    staging has been rewritten; the following days' runs also refresh the
    day that is owed, so the fact equals a computation over final staging."""
    land, wh = _land_backfill(spark, sf)
    options = {"categories": fx.item_categories(spark, sf), "expected": ORDERS_ONLY}
    try:
        jobs.daily_increment(spark, land, wh, BACKFILL_DAYS[0], row_bounds={"user_orders_log": TIGHT_BOUNDS}, **options)
    except quality.DataQualityError:
        pass
    else:
        raise AssertionError("the failing check did not stop the job")
    jobs.backfill(spark, land, wh, BACKFILL_DAYS[1:], **options)
    return wh.read("f_daily_sales")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
