from .dates import business_day, landing_file_name, on_business_day, stamp, to_day
from .money import is_refund, signed_amount, unit_price
from .periods import calendar_attributes, period_id

__all__ = [
    "business_day", "landing_file_name", "on_business_day", "stamp", "to_day",
    "is_refund", "signed_amount", "unit_price", "calendar_attributes", "period_id",
]
