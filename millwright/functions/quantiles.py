"""Exact percentiles per group without ever holding a group in one task.

Values are counted per (group, value) first, with map-side partials, so a group or a value holding
a third of all rows shrinks before it moves. Ranks are then located level by level: running counts
over slices of the value range, then over the finer slices of only those that hold a wanted rank.
A level resolves at most ``LEVEL_BITS`` bits, so a running count sees at most about four million
narrow rows per group, whatever the type and however many rows: two levels for INTEGER (65,536 rows)
and NUMERIC(12,2), three for NUMERIC(14,7), BIGINT and DOUBLE.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from millwright.functions.measures import scale_of, units

LEVEL_BITS = 22
#: In place of a decimal scale: the whole number is the order code of a double.
DOUBLE_CODE = -1


def value_bits(data_type: T.DataType) -> int:
    """The bits a value of this type can need."""
    if isinstance(data_type, T.DecimalType):
        return math.ceil(data_type.precision * math.log2(10)) + 1
    bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64, "float": 64, "double": 64}
    name = data_type.simpleString()
    if name not in bits:
        raise TypeError(f"exact percentiles need numbers, not {name}")
    return bits[name]


def level_count(data_types: list[T.DataType], extra: int = 0) -> int:
    """Levels that suit all of the types; ``extra`` bits more than a value needs."""
    return max(2, math.ceil((max(map(value_bits, data_types)) + extra) / LEVEL_BITS))


def level_bits(data_type: T.DataType, levels: int, extra: int = 0) -> int:
    """The bits that each of so many levels resolves."""
    return math.ceil((value_bits(data_type) + extra) / levels)


def scale_code(data_type: T.DataType) -> int:
    return DOUBLE_CODE if isinstance(data_type, T.FractionalType) and not isinstance(
        data_type, T.DecimalType) else scale_of(data_type)


def whole(column: Column, data_type: T.DataType) -> Column:
    """A whole number in the order of the values, a decimal in 10**-scale. NaN is NULL."""
    scale = scale_code(data_type)
    return order_code(column.cast("double")) if scale == DOUBLE_CODE else units(column, scale)


def order_code(x: Column) -> Column:
    """The 64-bit pattern of a double's size, negated for negative values; both zeros give 0 and NaN NULL.

    ``log2`` may miss the exponent by one next to a power of two, so it is put right by the fraction. Dividing and
    multiplying by powers of two is exact.
    """
    size = F.abs(x)
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)).cast("int")))
    part = size / F.pow(F.lit(2.0), guess)
    low = (part < 1) & (guess > -1022)
    exponent = guess + F.when(part >= 2, 1).when(low, -1).otherwise(0)
    part = F.when(part >= 2, part / 2).when(low, part * 2).otherwise(part)
    pattern = (exponent + 1022).cast("bigint") * F.lit(2**52) + (part * F.lit(2.0**52)).cast("bigint")
    pattern = F.when(size == float("inf"), F.lit(2047 * 2**52)).when(size > 0, pattern)
    return F.when(F.isnan(x), None).when(x == 0, F.lit(0).cast("bigint")).when(x < 0, -pattern).otherwise(pattern)


def from_order_code(code: Column) -> Column:
    pattern = F.abs(code)
    exponent = F.shiftright(pattern, 52)
    rest = pattern.bitwiseAND(F.lit(2**52 - 1)).cast("double")
    size = (
        F.when(exponent == 2047, F.lit(float("inf")))
        .when(exponent == 0, rest * F.lit(2.0**-1074))
        .otherwise((1 + rest / F.lit(2.0**52)) * F.pow(F.lit(2.0), exponent - 1023))
    )
    return F.when(code < 0, -size).otherwise(size)


def histogram(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, units, n for the non-NULL values; ``units`` is ``whole`` of the value.

    ``neighbours`` reads the histogram once per level. The filters on the keys and the ``coalesce``, which
    only tells Spark that the value is never NULL, keep its later joins from adding filters of their
    own to single readings: they stay equal and share one scan and one shuffle.
    """
    number = whole(F.col(value), rows.schema[value].dataType)
    present = number.isNotNull()
    for key in keys:
        present = present & F.col(key).isNotNull()
    known = F.coalesce(number, F.lit(0))
    return (
        rows.where(present).groupBy(*keys, known.alias("units")).agg(F.count("*").alias("n"))
    )


def neighbours(
    counts: DataFrame, keys: list[str], probabilities: list[float], bits: int | str, levels: int
) -> DataFrame:
    """Per group: ``total`` and, for probability i, the values ``low_i`` and ``high_i`` on either
    side of position p * (total - 1) in sorted order and the fraction ``part_i`` between them.

    ``counts`` has keys, units and n; ``bits``, what one of the levels resolves, is a number or the
    name of a column that depends on the keys only. Keys are not NULL.
    """
    def position(p: float) -> Column:
        return F.lit(p) * (F.col("total") - 1)

    ranks = [
        (F.floor(position(p)).cast("bigint"), F.ceil(position(p)).cast("bigint"))
        for p in probabilities
    ]
    holds_a_rank = F.lit(False)
    for rank in (r for pair in ranks for r in pair):
        holds_a_rank = holds_a_rank | (
            (rank >= F.col("before")) & (rank < F.col("before") + F.col("slice_n"))
        )

    wanted, sliced = None, counts
    for finer in range(levels - 1, 0, -1):
        inside = [*keys, "slice"] if wanted is not None else keys
        narrowed = sliced.join(wanted, inside) if wanted is not None else sliced
        known = ["before", "total"] if wanted is not None else []
        inside = ["outer" if k == "slice" else k for k in inside]
        if wanted is not None:
            narrowed = narrowed.withColumnRenamed("slice", "outer")
        group = W.partitionBy(*inside)
        running = F.sum("slice_n").over(group.orderBy("slice").rowsBetween(W.unboundedPreceding, -1))
        running = F.coalesce(running, F.lit(0))
        slices = (
            narrowed.withColumn("slice", F.expr(f"shiftright(units, {bits} * {finer})"))
            .groupBy(*inside, *known, "slice")
            .agg(F.sum("n").alias("slice_n"))
            .select(
                *keys,
                "slice",
                "slice_n",
                (F.col("before") + running if known else running).alias("before"),
                F.col("total") if known else F.sum("slice_n").over(group).alias("total"),
            )
        )
        wanted = slices.where(holds_a_rank).select(*keys, "slice", "before", "total")
        sliced = counts.withColumn("slice", F.expr(f"shiftright(units, {bits} * {finer})"))

    in_slice = W.partitionBy(*keys, "slice").orderBy("units")
    upto = F.col("before") + F.sum("n").over(
        in_slice.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    located = sliced.join(wanted, [*keys, "slice"]).withColumn("upto", upto)

    def value_at(rank: Column) -> Column:
        here = (rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto"))
        return F.max(F.when(here, F.col("units")))

    picks = []
    for i, (low, high) in enumerate(ranks):
        picks += [value_at(low).alias(f"low_{i}"), value_at(high).alias(f"high_{i}")]
    found = located.groupBy(*keys).agg(F.first("total").alias("total"), *picks)
    return found.select(
        "*",
        *[
            (position(p) - F.floor(position(p))).alias(f"part_{i}")
            for i, p in enumerate(probabilities)
        ],
    )


def interpolated(i: int, scale: Column) -> Column:
    """The linearly interpolated percentile i from ``neighbours``, as a double; equal neighbours need no step, which would
    make NaN of infinite ones."""
    if_double = scale == DOUBLE_CODE
    low, high = F.col(f"low_{i}"), F.col(f"high_{i}")
    step = (high.cast("double") - low.cast("double")) * F.col(f"part_{i}")
    decimal = (low.cast("double") + step) / F.pow(F.lit(10.0), scale)
    first, last = from_order_code(low), from_order_code(high)
    part = F.col(f"part_{i}")
    double = F.when((low == high) | (part == 0), first).otherwise(first * (1 - part) + last * part)
    return F.when(if_double, double).otherwise(decimal)
