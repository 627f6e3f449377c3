"""Staging-table operators: S5 append by name, M1 day delete, M5/W1 de-dup,
M6/M7 status backfill and schema evolution, M9 row ids, P12 exact
duplicates.  All are DataFrame -> DataFrame; storage lives in
``sources.store``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import on_business_day
from ..schemas import DEDUP_KEYS, SPREAD


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Match columns by name, cast each to the declared type (ANSI
    casts raise on overflow, and a fraction is rounded into an integer column,
    as an INSERT would), and fill declared columns the input lacks with NULL.
    Extra input columns are dropped."""
    types = {f.name: f.dataType for f in df.schema}

    def value(f: T.StructField):
        if f.name not in types:
            return F.lit(None)
        fraction = isinstance(types[f.name], (T.FractionalType, T.DecimalType))
        whole = isinstance(f.dataType, T.IntegralType)
        return F.round(f.name) if fraction and whole else F.col(f.name)

    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema.fields])


def delete_business_day(df: DataFrame, ds: str | _dt.date, whole_day: bool = False) -> DataFrame:
    """M1/M2: remove rows dated ``ds``.  Reference mode removes only rows at
    midnight of ``ds``; NULL dates are kept."""
    return df.where(~on_business_day(F.col("date_time"), ds, whole_day))


#: M1 in SQL form (P13): table and business date are bound parameters, never
#: spliced into the text.
DELETE_DAY_SQL = """
SELECT * FROM IDENTIFIER(:table)
WHERE NOT coalesce(date_time = CAST(make_date(CAST(left(:ds, 4) AS INT),
                                              CAST(substring(:ds, 6, 2) AS INT),
                                              CAST(right(:ds, 2) AS INT)) AS TIMESTAMP_NTZ), false)
"""


def delete_business_day_sql(spark, table: str, ds: str | _dt.date) -> DataFrame:
    """M1/M2/P13 through ``spark.sql`` with named parameters over a table or
    temporary view; same rows as :func:`delete_business_day`."""
    return spark.sql(DELETE_DAY_SQL, args={"table": table, "ds": str(ds)})


def dedupe(df: DataFrame, keys: list[str], order_col: str = "id",
           flag_removed: bool = False, spread: list[str] | None = None) -> DataFrame:
    """Keep the row with the lowest ``order_col`` per key (NULL last).

    One aggregate per key: the smallest (order, payload) struct.  Map-side
    partial aggregation shrinks duplicate-heavy (hot) keys before the
    shuffle, and the sort-based aggregate spills.  NULL key values form one
    group, as in PARTITION BY.  ``flag_removed`` adds ``_n_removed``, the
    number of rows dropped per surviving row.

    A fingerprint of the key leads the grouping columns: the sorts on both
    sides of the shuffle compare one number and look at the wide key only
    where fingerprints agree, so the result stays exact.

    ``spread``: key columns by whose ranges the rows are dealt out before they
    are grouped.  Rows of one key share them, so one shuffle serves the de-dup
    and a write partitioned by the first of them; equal rows are not merged
    before it.
    """
    rest = [c for c in df.columns if c not in keys]
    payload = F.struct(F.col(order_col).isNull().alias("_null"), F.col(order_col).alias("_order"), *rest)
    aggs = [F.min(payload).alias("_first")]
    if flag_removed:
        aggs.append((F.count(F.lit(1)) - 1).alias("_n_removed"))
    if spread:
        rows = df.repartitionByRange(*spread).groupBy(*spread, *[k for k in keys if k not in spread])
    else:
        rows = df.groupBy(F.xxhash64(*keys).alias("_fingerprint"), *keys)
    out = rows.agg(*aggs)
    return out.select(*[c if c in keys else F.col("_first")[c].alias(c) for c in df.columns],
                      *(["_n_removed"] if flag_removed else []))


def dedupe_window(df: DataFrame, keys: list[str], order_col: str = "id") -> DataFrame:
    """W1 in its window form (``row_number() = 1``); same result as
    :func:`dedupe`, kept for equivalence tests and the bench comparison."""
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_entity(df: DataFrame, entity: str, flag_removed: bool = False,
                  include_status: bool = False, spread: bool = False) -> DataFrame:
    """M5 with the reference's keys.  The orders key leaves ``status`` out,
    so a later refund whose other columns equal its sale is dropped;
    ``include_status=True`` makes status part of the key and keeps both.
    ``spread`` deals the rows out by ``SPREAD``, ready to be written by date."""
    keys = list(DEDUP_KEYS[entity])
    if include_status and "status" in df.columns:
        keys.append("status")
    return dedupe(df, keys, flag_removed=flag_removed, spread=list(SPREAD[entity]) if spread else None)


def backfill_status(df: DataFrame, value: str = "shipped") -> DataFrame:
    """Every row's status set to the constant."""
    return df.withColumn("status", F.lit(value))


def add_status_column(df: DataFrame) -> DataFrame:
    """M7: add the nullable text column when missing (existing values kept)."""
    if "status" in df.columns:
        return df
    return df.withColumn("status", F.lit(None).cast("string"))


#: Where a landed row stands: file, block start in it, and a number that
#: grows along the block (``landing.read_landing(position=True)``).
POSITION = "_position"


def assign_ids(df: DataFrame, base: int, id_col: str = "id") -> DataFrame:
    """M9: ids above ``base`` in landing order: by file path, then by place
    in the file.

    Spark packs splits of several files into a task, larger ones first, so a
    row's number in its task says nothing about file order.  Each (file, block)
    gets an offset instead: the sum of the lengths of the blocks before it.
    Only the list of blocks is ordered (one row per 128 MB of extract); the
    rows themselves are neither sorted nor gathered.  A retried task reads the
    same split and gives the same ids.  Rows without a position get ids that
    are unique above ``base`` but follow no file.

    The list is sent to the rows: Spark only knows the extract's size and would
    shuffle every row by its block.
    """
    if POSITION not in df.columns:
        return df.withColumn(id_col, F.lit(int(base) + 1) + F.monotonically_increasing_id())
    rows = df.select(*[c for c in df.columns if c != POSITION],
                     *(F.col(POSITION)[c].alias(f"_{c}") for c in ("file", "block", "row")))
    blocks = rows.groupBy("_file", "_block").agg(
        F.min("_row").alias("_low"), (F.max("_row") - F.min("_row") + 1).alias("_length"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", "_low",
                           F.coalesce(F.sum("_length").over(before), F.lit(0)).alias("_offset"))
    new_id = F.lit(int(base) + 1) + F.col("_offset") + F.col("_row") - F.col("_low")
    keep = [c for c in df.columns if c not in (POSITION, id_col)]
    return rows.join(F.broadcast(blocks), ["_file", "_block"]).select(*keep, new_id.alias(id_col))
