"""Calendar helpers: F1 year, F2 ISO week, F3 period_id, D1 calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_id(ts: Column | str, iso_year: bool = False) -> Column:
    """``year || week`` as text, no zero padding.

    The reference pairs the *calendar* year with the *ISO* week, so
    2022-01-01 gives ``202252`` and 2024-12-30 gives ``20241``.  That is the
    default; ``iso_year=True`` pairs the ISO week with its ISO year instead.
    NULL in, NULL out (``concat`` propagates NULL like ``||``).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    year = F.extract(F.lit("YEAROFWEEK"), c) if iso_year else F.year(c)
    return F.concat(year.cast("string"), F.weekofyear(c).cast("string"))


def calendar_attributes(day: Column | str) -> list[Column]:
    """D1 attributes of a calendar day: day/month numbers, English month name
    (not truncated to the reference's VARCHAR(8)), year."""
    c = F.col(day) if isinstance(day, str) else day
    return [
        F.dayofmonth(c).cast("short").alias("day_num"),
        F.month(c).cast("short").alias("month_num"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.year(c).cast("short").alias("year_num"),
    ]
