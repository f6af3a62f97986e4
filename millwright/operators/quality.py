"""Validation with quarantine, and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from millwright.contracts import VALUE_RANGES
from millwright.functions.casting import NAN_TEXTS, typed
from millwright.functions.measures import divide, fixed, quarter_start, scale_of, units
from millwright.functions.quantiles import histogram, level_bits, level_count, neighbours

CORRUPT = "_corrupt_record"


def parse_messages(messages: DataFrame, contract: T.StructType) -> DataFrame:
    """JSON messages to text columns named as in the contract, next to the message's own columns.

    Every field is read as text, so one badly typed field is reported by name and does not void
    its record. Unknown fields are ignored and missing ones are NULL.
    """
    text_schema = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in contract.fields]
        + [T.StructField(CORRUPT, T.StringType())]
    )
    record = F.from_json(
        F.col("value").cast("string"),
        text_schema,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return messages.select("*", record.alias("record")).select(*messages.columns, "record.*")


def validate(text_rows: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract columns in their types plus ``reasons``: empty for a good row.

    Reasons are corrupt, missing:<column>, type:<column> and length:<column>. Other columns of
    the input (message position, payload) are kept.
    """
    names = set(contract.names)
    kept = [c for c in text_rows.columns if c not in names and c != CORRUPT]
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in text_rows.columns else F.lit(False)
    # Typed next to its text, so that each value is converted once for the rules and the result.
    both = text_rows.select(
        *kept,
        corrupt.alias("is_corrupt"),
        *[F.col(f.name).alias(f"{f.name}__text") for f in contract.fields],
        *[typed(F.col(f.name), f).alias(f.name) for f in contract.fields],
    )

    reasons = [F.when(F.col("is_corrupt"), F.lit("corrupt"))]
    for field in contract.fields:
        text, value = F.col(f"{field.name}__text"), F.col(field.name)
        if not field.nullable:
            # NaN is how a missing number arrives
            missing = ~F.col("is_corrupt") & (text.isNull() | text.isin(*NAN_TEXTS))
            reasons.append(F.when(missing, F.lit(f"missing:{field.name}")))
        if not isinstance(field.dataType, T.StringType):
            excused = isinstance(field.dataType, T.NumericType) or not field.nullable
            unreadable = value.isNull() & text.isNotNull()
            if excused:
                unreadable = unreadable & ~text.isin(*NAN_TEXTS)
            reasons.append(F.when(unreadable, F.lit(f"type:{field.name}")))
        if "max_length" in field.metadata:
            too_long = F.length(text) > field.metadata["max_length"]
            reasons.append(F.when(too_long, F.lit(f"length:{field.name}")))

    return both.select(
        *kept,
        *contract.names,
        F.array_compact(F.array(*reasons)).alias("reasons"),
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") == 0).drop("reasons")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") > 0)


def range_violations(rows: DataFrame, ranges: dict[str, tuple] = VALUE_RANGES) -> DataFrame:
    """Per rule: how many values were checked and how many lie outside the bounds."""
    present = {c: bounds for c, bounds in ranges.items() if c in rows.columns}
    wide = rows.agg(*[
        aggregate
        for c, (low, high) in present.items()
        for aggregate in (
            F.count(c).alias(f"{c}__checked"),
            F.count_if((F.col(c) < low) | (F.col(c) > high)).alias(f"{c}__outside"),
        )
    ])
    return wide.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(f"{c} in [{low}, {high}]").alias("rule"),
                F.col(f"{c}__checked").alias("checked"),
                F.col(f"{c}__outside").alias("violations"),
            )
            for c, (low, high) in present.items()
        ]))
    )


def missing_by_quarter(rows: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """Per quarter and column: NULLs and their share."""
    wide = rows.groupBy(quarter_start(F.col(ts)).alias("quarter_start")).agg(
        F.count("*").alias("row_count"), *[F.count(c).alias(f"{c}__filled") for c in columns]
    )
    return wide.select(
        "quarter_start",
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                (F.col("row_count") - F.col(f"{c}__filled")).alias("missing_count"),
                fixed(
                    divide(F.col("row_count") - F.col(f"{c}__filled"), F.col("row_count")), 7, 6
                ).alias("missing_rate"),
            )
            for c in columns
        ])),
    )


def key_uniqueness(rows: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """One row: keys, keys that occur more than once, rows beyond the first of their key."""
    return (
        rows.groupBy(*key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.lit(table).alias("table_name"),
            F.count("*").alias("key_count"),
            F.count_if(F.col("n") > 1).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
        )
    )


def raw_readiness(rows: DataFrame, ts: str, min_rows: int, max_gap_days: int) -> DataFrame:
    """Per quarter: is there enough raw data, reaching near enough to the quarter's end?"""
    last = F.to_date(F.col("last_event"))
    next_quarter = F.add_months("quarter_start", 3)
    return (
        rows.groupBy(quarter_start(F.col(ts)).alias("quarter_start"))
        .agg(F.count("*").alias("row_count"), F.max(ts).alias("last_event"))
        .withColumn(
            "is_ready",
            (F.col("row_count") >= min_rows) & (F.datediff(next_quarter, last) <= max_gap_days),
        )
    )


def first_delivery(messages: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keep the earliest delivery of each message. Spark turns the filter on row_number into a
    group limit in front of the shuffle, so a message delivered a billion times leaves each map
    task as one row."""
    nth = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return messages.withColumn("nth", nth).where(F.col("nth") == 1).drop("nth")


def mad_profile(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per group the median and the median absolute deviation, as whole numbers: ``median_2`` is
    twice the median and ``mad_4`` four times the deviation, in the value's own units.

    Deviations are taken on the histogram, so the rows are read and shuffled once.
    """
    data_type = rows.schema[value].dataType
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        raise TypeError("deviations are compared in whole numbers: cast the column to DECIMAL")
    levels = level_count([data_type])
    counts = histogram(rows, [key], value)
    never_null = F.lit(0)  # see ``histogram``: keeps both readings of the deviations equal
    medians = neighbours(counts, [key], [0.5], level_bits(data_type, levels), levels).select(
        key, F.coalesce(F.col("low_0") + F.col("high_0"), never_null).alias("median_2")
    )
    distance = F.abs(2 * F.col("units") - F.col("median_2"))
    deviations = (
        counts.join(medians, key)
        .groupBy(key, "median_2", F.coalesce(distance, never_null).alias("units"))
        .agg(F.sum("n").alias("n"))
    )
    wide = level_count([data_type], extra=2)  # twice a difference
    return neighbours(
        deviations, [key, "median_2"], [0.5], level_bits(data_type, wide, extra=2), wide
    ).select(
        key, "median_2", (F.col("low_0") + F.col("high_0")).alias("mad_4")
    )


def outliers_mad(rows: DataFrame, row_id: str, key: str, value: str, k: float) -> DataFrame:
    """Rows further than k deviations from their group's median; compared in whole numbers.

    The profile has one row per group. It is joined without a hint: adaptive execution broadcasts
    it when its measured size allows and splits crowded groups otherwise.
    """
    scale = scale_of(rows.schema[value].dataType)
    distance_2 = F.abs(2 * units(F.col(value), scale) - F.col("median_2"))
    return (
        rows.select(row_id, key, value)
        .join(mad_profile(rows, key, value), key)
        .where(2 * distance_2 > F.lit(k) * F.col("mad_4"))
        .select(
            row_id,
            key,
            value,
            fixed(F.col("median_2") / F.lit(2.0 * 10**scale), 18, 4).alias("group_median"),
            fixed(F.col("mad_4") / F.lit(4.0 * 10**scale), 18, 4).alias("group_mad"),
        )
    )
