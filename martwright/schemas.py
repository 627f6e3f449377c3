"""Declared table schemas of the staging and mart layers.

Column order follows the reference DDL; ``status`` is the nullable text
column added by the schema-evolution step (M7).  Mart date keys are
``DateType`` because every mart row is keyed by a calendar day.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
SH = T.ShortType()
TS = T.TimestampNTZType()
D = T.DateType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


CUSTOMER_RESEARCH = _schema(
    ("id", L),
    ("date_time", TS),
    ("category_id", I),
    ("geo_id", I),
    ("sales_qty", I),
    ("sales_amt", T.DecimalType(14, 2)),
)

USER_ACTIVITY_LOG = _schema(
    ("action_id", L),
    ("customer_id", L),
    ("date_time", TS),
    ("id", L),
    ("quantity", L),
)

USER_ORDERS_LOG_BASE = _schema(
    ("city_id", I),
    ("city_name", S),
    ("customer_id", L),
    ("date_time", TS),
    ("first_name", S),
    ("id", L),
    ("item_id", I),
    ("item_name", S),
    ("last_name", S),
    ("quantity", L),
    ("payment_amount", T.DecimalType(14, 2)),
)

USER_ORDERS_LOG = T.StructType(
    USER_ORDERS_LOG_BASE.fields + [T.StructField("status", S, True)]
)

DQ_CHECKS_RESULTS = _schema(
    ("table_name", S),
    ("dq_check_name", S),
    ("datetime", TS),
    ("dq_check_result", T.DecimalType(8, 2)),
)

#: Staging days whose facts are still to be refreshed (not in the reference,
#: which refreshes every staging day on each run).
OWED_DAYS = _schema(("table_name", S), ("day", D))

#: Landed rows that could not be taken: where they stand and why.  ``place``
#: grows along the block of the file.
REJECTED_ROWS = _schema(("table_name", S), ("business_day", D), ("file", S), ("block", L), ("place", L),
                        ("reason", S), ("text", S))

#: Landed business days of the stream: the batch that brought the latest of
#: their files, and whether the day has been run since.
DAY_LEDGER = _schema(("business_day", D), ("batch_id", L), ("done", T.BooleanType()))

D_CALENDAR = _schema(
    ("date_time", D),
    ("day_num", SH),
    ("month_num", SH),
    ("month_name", S),
    ("year_num", SH),
)

D_CITY = _schema(("city_id", I), ("city_name", S))

D_CUSTOMER = _schema(
    ("customer_id", I), ("first_name", S), ("last_name", S), ("city_id", I)
)

D_ITEM = _schema(("item_id", I), ("item_name", S), ("category_name", S))

F_ACTIVITY = _schema(("activity_id", I), ("date_time", D), ("click_number", I))

F_DAILY_SALES = _schema(
    ("date_time", D),
    ("item_id", I),
    ("customer_id", I),
    ("price", T.DecimalType(10, 2)),
    ("quantity", L),
    ("payment_amount", T.DecimalType(10, 2)),
    ("status", S),
)

F_CUSTOMER_RETENTION = _schema(
    ("period_name", S),
    ("period_id", S),
    ("category_name", S),
    ("cohort", S),
    ("new_customers_count", I),
    ("returning_customers_count", I),
    ("refunded_customers_count", I),
    ("new_customers_revenue", T.DecimalType(14, 2)),
    ("returning_customers_revenue", T.DecimalType(14, 2)),
    ("refunded_customers_sum", T.DecimalType(14, 2)),
    ("customers_refunded", I),
)

#: Persisted intermediates of incremental retention (not in the reference):
#: the per-(customer, period, category, status) groups and the cohorts.
RETENTION_GROUPS = _schema(
    ("customer_id", I),
    ("period_id", S),
    ("category_name", S),
    ("status", S),
    ("amount", T.DecimalType(20, 2)),
    ("n_tx", L),
    ("first_day", D),
)

#: State of every customer in the fact: first day that founds a cohort (NULL:
#: none) and the periods that hold the customer's groups ('' for the NULL one).
CUSTOMER_COHORTS = _schema(("customer_id", I), ("first_buy", D), ("cohort", S), ("periods", T.ArrayType(T.StringType())))

#: Retention by bitmaps (A3): every customer's number, founding day and cohort,
#: and the days' customers as bits of 64-bit words.
CUSTOMER_NUMBERS = _schema(("customer_id", I), ("number", L), ("first_buy", D), ("cohort", S))
RETENTION_DAY_BITS = _schema(
    ("date_time", D),
    ("period_id", S),
    ("category_name", S),
    ("cohort", S),
    ("status", S),
    ("block", L),
    ("word", L),
    ("amount", T.DecimalType(20, 2)),
    ("n_tx", L),
)

#: Per-staging-partition latest rows feeding D2-D4 (key, attributes, and the
#: winning row's date_time and id).
D_CITY_PARTS = _schema(("city_id", I), ("city_name", S), ("date_time", TS), ("id", L))
D_CUSTOMER_PARTS = _schema(("customer_id", L), ("first_name", S), ("last_name", S),
                           ("city_id", I), ("date_time", TS), ("id", L))
D_ITEM_PARTS = _schema(("item_id", I), ("item_name", S), ("date_time", TS), ("id", L))

#: D2-D4 as stored, in hash buckets of the key: the declared columns and, not
#: shown by a plain read, the winning row's date_time and id.
_LATEST = [T.StructField("date_time", TS, True), T.StructField("id", L, True)]
LATEST_ROWS = {
    "d_city": T.StructType(D_CITY.fields + _LATEST),
    "d_customer": T.StructType(D_CUSTOMER.fields + _LATEST),
    "d_item": T.StructType(D_ITEM.fields + _LATEST),
}

#: Per-staging-partition distinct days feeding D1.
CALENDAR_DAYS = _schema(("date_time", D))

#: staging entity name -> declared schema (S2 fan-out)
STAGING = {
    "customer_research": CUSTOMER_RESEARCH,
    "user_orders_log": USER_ORDERS_LOG,
    "user_activity_log": USER_ACTIVITY_LOG,
}

MART = {
    "d_calendar": D_CALENDAR,
    "d_city": D_CITY,
    "d_customer": D_CUSTOMER,
    "d_item": D_ITEM,
    "f_activity": F_ACTIVITY,
    "f_daily_sales": F_DAILY_SALES,
    "f_customer_retention": F_CUSTOMER_RETENTION,
}

#: De-duplication keys per staging entity (W1a-c).  Fixed values: they must
#: equal the reference's PARTITION BY lists.  ``status`` is deliberately not
#: part of the orders key.
DEDUP_KEYS = {
    "customer_research": ["date_time", "category_id", "geo_id", "sales_qty", "sales_amt"],
    "user_activity_log": ["action_id", "customer_id", "date_time", "quantity"],
    "user_orders_log": [
        "city_id", "city_name", "customer_id", "date_time", "first_name",
        "item_id", "item_name", "last_name", "quantity", "payment_amount",
    ],
}

#: De-dup key columns by whose ranges staging rows are dealt out: the date first
#: (the partitions follow it), then as many as make hot days fall apart.
SPREAD = {
    "customer_research": ("date_time", "geo_id", "category_id"),
    "user_activity_log": ("date_time", "customer_id", "action_id"),
    "user_orders_log": ("date_time", "customer_id", "item_id"),
}

#: Partition column added to stored staging tables (calendar day of date_time).
STAGING_PARTITION = "dt"
