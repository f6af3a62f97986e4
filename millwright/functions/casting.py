"""Text to contract types. A value that does not fit gives NULL, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# How a missing float arrives as text: as a string, and as Spark renders a bare NaN read as text.
NAN_TEXTS = ("NaN", '"NaN"')

# Times as they travel: date, T, seconds, then a fraction and an offset if there are any. Spark alone would also take
# "2025" or "T12:30" (today's).
WIRE_TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?$"

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def typed(raw: Column, field: T.StructField) -> Column:
    """The text ``raw`` as the field's type.

    A number with decimals in a whole-number column is rounded half to even, since producers
    resample such columns as floats. NaN means missing.
    """
    raw = raw.cast("string")
    if isinstance(field.dataType, T.StringType):
        return raw
    number = F.when(~raw.isin(*NAN_TEXTS), raw)
    if isinstance(field.dataType, T.LongType):  # a double holds no more than 53 bits
        exact = number.try_cast("decimal(38,18)")
        return F.bround(exact, 0).try_cast("bigint")
    if isinstance(field.dataType, T.IntegralType):
        return F.rint(number.try_cast("double")).try_cast(field.dataType)
    if isinstance(field.dataType, T.DecimalType):
        return number.try_cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        return F.when(raw.rlike(WIRE_TIME), raw).try_cast(field.dataType)
    return raw.try_cast(field.dataType)


def nan_to_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def iso_parse(text: Column) -> Column:
    return F.to_timestamp(text, ISO_FORMAT)


def clip(column: Column, low, high) -> Column:
    """NULL stays NULL, which ``least`` and ``greatest`` alone would replace by a bound."""
    return F.when(column.isNotNull(), F.greatest(F.least(column, F.lit(high)), F.lit(low)))
