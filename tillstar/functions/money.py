"""Money rules: decimals from the first step on, so sums do not depend on row order."""

from pyspark.sql import functions as F

from tillstar.schemas import MONEY


def exact_price(unit_price):
    """The price as a decimal; NULL if it does not fit (the load then rejects the row)."""
    return unit_price.try_cast("decimal(18,6)")


def line_amount(quantity, unit_price):
    """Quantity times the unrounded price."""
    return (quantity * exact_price(unit_price)).cast("decimal(29,6)")


def to_money(amount):
    """Round half up to cents; NULL if the result does not fit DECIMAL(10,2)."""
    return F.round(amount, 2).try_cast(MONEY)


def mean(total, count):
    """Average of a decimal sum as a double with six decimals."""
    return F.round(total.cast("double") / F.nullif(count, F.lit(0)), 6)
