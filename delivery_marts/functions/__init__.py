"""Column-to-column functions; all native expressions, none a Python UDF."""

from delivery_marts.functions.lifecycle import (
    cancel_after_delivery_flag,
    cancel_error_flag,
    interval_end,
    order_status,
)
from delivery_marts.functions.money import line_value, order_amount
from delivery_marts.functions.values import (
    address_city,
    date_parts,
    has_non_digit,
    nan_to_null,
    normalize_phone,
    unfill_replaced_id,
)

__all__ = [
    "address_city",
    "cancel_after_delivery_flag",
    "cancel_error_flag",
    "date_parts",
    "has_non_digit",
    "interval_end",
    "line_value",
    "nan_to_null",
    "normalize_phone",
    "order_amount",
    "order_status",
    "unfill_replaced_id",
]
