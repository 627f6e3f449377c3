"""Signed amounts and unit price of the daily sales fact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_refund(status: Column, amount: Column) -> Column:
    """``status = 'refunded' AND payment_amount > 0``; NULL counts as false
    (the CASE falls through to ELSE)."""
    return F.coalesce((status == F.lit("refunded")) & (amount > 0), F.lit(False))


def signed_amount(status: Column, amount: Column) -> Column:
    """positive refunds are flipped negative; everything else unchanged
    (already negative refunds stay negative)."""
    return F.when(is_refund(status, amount), -amount).otherwise(amount)


def unit_price(status: Column, amount: Column, quantity: Column, lenient: bool = False) -> Column:
    """signed ``payment_amount / quantity`` as DECIMAL(10,2), HALF_UP.

    Decimal / bigint stays exact decimal in Spark and is rounded once by the
    cast.  Division by zero raises under ANSI mode as in the reference;
    ``lenient=True`` returns NULL instead.
    """
    signed = signed_amount(status, amount)
    q = quantity.cast("decimal(20,0)")
    ratio = F.try_divide(signed, q) if lenient else signed / q
    return ratio.cast("decimal(10,2)")
