import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from martwright.schemas import F_DAILY_SALES, USER_ORDERS_LOG

D = Decimal

SMOKE = "/root/testdata/sf0.001"


def day(s):
    return dt.date.fromisoformat(s)


def ts(s):
    return dt.datetime.fromisoformat(s)


def orders_df(spark, rows):
    """rows: dicts with any USER_ORDERS_LOG fields; the rest default."""
    defaults = dict(city_id=1, city_name="c", customer_id=1, date_time=ts("2022-07-09 00:00:00"),
                    first_name="f", id=1, item_id=1, item_name="i", last_name="l",
                    quantity=1, payment_amount=D("10.00"), status="shipped")
    data = [tuple({**defaults, **r}[f.name] for f in USER_ORDERS_LOG.fields) for r in rows]
    return spark.createDataFrame(data, USER_ORDERS_LOG)


def sales_df(spark, rows):
    defaults = dict(date_time=day("2022-07-09"), item_id=1, customer_id=1, price=D("10.00"),
                    quantity=1, payment_amount=D("10.00"), status="shipped")
    data = [tuple({**defaults, **r}[f.name] for f in F_DAILY_SALES.fields) for r in rows]
    return spark.createDataFrame(data, F_DAILY_SALES)


def items_df(spark, rows):
    schema = T.StructType([T.StructField("item_id", T.IntegerType()),
                           T.StructField("item_name", T.StringType()),
                           T.StructField("category_name", T.StringType())])
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shuffles(df):
    """How each shuffle of rows deals them out, in a DataFrame that has not run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1].split(",")[0] for line in plan.splitlines() if " Exchange " in line]
