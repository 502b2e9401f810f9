"""What an order's timestamps say about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order statuses from the last stage to the first, each with the timestamp
# that proves it, and the cancellation reasons that count as service errors.
STATUS_BY_TIMESTAMP = (
    ("canceled", "canceled_at"),
    ("delivered", "delivered_at"),
    ("in_delivery", "delivery_started_at"),
    ("paid", "paid_at"),
)
INITIAL_STATUS = "created"
CANCELED = "canceled"
ERROR_REASONS = ("Ошибка приложения", "Проблемы с оплатой")


def order_status() -> Column:
    reached = [F.when(F.col(at).isNotNull(), F.lit(name)) for name, at in STATUS_BY_TIMESTAMP]
    return F.coalesce(*reached, F.lit(INITIAL_STATUS))


def _flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def cancel_error_flag(status: Column, reason: Column) -> Column:
    return _flag((status == CANCELED) & reason.isin(*ERROR_REASONS))


def cancel_after_delivery_flag(delivered_at: Column, canceled_at: Column) -> Column:
    return _flag(canceled_at > delivered_at)


def interval_end(delivered_at: Column, canceled_at: Column) -> Column:
    """When a courier's work on an order ended; NULL while it goes on."""
    return F.coalesce(delivered_at, canceled_at)
