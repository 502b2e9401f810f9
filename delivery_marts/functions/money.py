"""Money as exact integers for as long as rows are being added up.

Percent discounts on doubles give sums that depend on row order. Here a line is worth
``quantity * price * (100 - discount)`` hundredths, a bigint; the division comes once,
after the sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_value(quantity: Column, price: Column, discount: Column) -> Column:
    """Value of a line in hundredths after its own discount (bigint)."""
    return quantity.cast("bigint") * price * (F.lit(100) - discount)


def amount(hundredths: Column) -> Column:
    return hundredths.cast("double") / F.lit(100.0)


def order_amount(hundredths: Column, order_discount: Column) -> Column:
    """Summed line values after the order's discount; NULL where the discount is NULL.

    The product is taken in double so that an order of any size cannot overflow; it is
    exact up to 2**53, so the division stays the only rounding.
    """
    return hundredths.cast("double") * (F.lit(100) - order_discount) / F.lit(10000.0)
