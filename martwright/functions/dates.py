"""Date helpers: F4 day truncation, F7/F8 the templated day literal, F14
landing-file date stamps, and the M1 day-delete predicate."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(ts: Column | str) -> Column:
    """F4 ``::date``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


def business_day(ds: str | _dt.date) -> Column:
    """The business date ``YYYY-MM-DD`` as a DATE built with
    ``make_date(left(ds,4), substring(ds,6,2), right(ds,2))``."""
    s = F.lit(str(ds))
    return F.make_date(
        F.left(s, F.lit(4)).cast("int"),
        F.substring(s, 6, 2).cast("int"),
        F.right(s, F.lit(2)).cast("int"),
    )


def stamp(ds: str | _dt.date | Column) -> Column:
    """``YYYYMMDD`` (dashes removed) of a date."""
    if isinstance(ds, Column):
        return F.date_format(ds, "yyyyMMdd")
    return F.lit(str(ds).replace("-", ""))


def landing_file_name(ds: Column, entity: str, increment: bool = False) -> Column:
    """S3: ``<yyyymmdd>_<entity>[_inc].csv``."""
    suffix = f"_{entity}{'_inc' if increment else ''}.csv"
    return F.concat(stamp(ds), F.lit(suffix))


def on_business_day(ts: Column, ds: str | _dt.date, whole_day: bool = False) -> Column:
    """M1 match predicate, never NULL.

    Reference mode compares the timestamp with midnight of ``ds`` (so 09:15
    rows that day are not matched); ``whole_day=True`` matches any time of
    that day.  NULL timestamps never match, so they survive a delete.
    """
    day = business_day(ds)
    if whole_day:
        return F.coalesce(F.to_date(ts) == day, F.lit(False))
    return F.coalesce(ts == day.cast("timestamp_ntz"), F.lit(False))
