"""Aggregate expressions with exact, order-independent results.

Sums run over whole numbers or decimals, so the result does not depend on how rows are
partitioned. Only the final division is done in doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T


def quarter_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "quarter")


def scale_of(data_type: T.DataType) -> int:
    return data_type.scale if isinstance(data_type, T.DecimalType) else 0


def units(column: Column, scale: int) -> Column:
    """The value as a whole number of 10**-scale."""
    return (column * 10**scale).cast("bigint") if scale else column.cast("bigint")


def divide(numerator: Column, denominator: Column) -> Column:
    """NULL, not an ANSI error, when there is nothing to divide by."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def fixed(value: Column, precision: int, scale: int) -> Column:
    """Round the double first: casting 1.005 straight to a decimal differs between engines."""
    return F.round(value, scale).cast(T.DecimalType(precision, scale))


def mean(column: Column, precision: int, places: int, scale: int = 0) -> Column:
    """Mean of the non-NULL values; NULL for an all-NULL group. ``scale`` is the column's own.

    A DECIMAL of at most 8 digits is summed as DECIMAL(8, scale): Spark sums that as plain longs,
    and 10**14 rows fit.
    """
    summed = column.cast(T.DecimalType(8, scale)) if scale else column
    return fixed(divide(F.sum(summed), F.count(column)), precision, places)


def exact_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """The ratio of whole numbers as DECIMAL(18, places), halves away from zero. All of it is whole-number arithmetic, so
    a tie is a tie in any engine. NULL when there is nothing to divide by."""
    size = F.abs(numerator.cast("decimal(20,0)")) * F.lit(Decimal(2 * 10**places))
    below = F.nullif(denominator, F.lit(0)).cast("decimal(28,0)")
    steps = F.call_function("div", size + below, below * F.lit(Decimal(2)))
    signed = F.when(numerator < 0, -steps).otherwise(steps).cast("decimal(18,0)")
    return (signed * F.lit(Decimal(1).scaleb(-places))).cast(T.DecimalType(18, places))


def share_of_rows(condition: Column, places: int = 4) -> Column:
    """Rows meeting the condition over all rows: a NULL condition counts as not met."""
    return fixed(divide(F.count_if(condition), F.count("*")), places + 1, places)
