"""Column profiles: the distributed form of deriving a schema from a source.

One wide aggregation covers all columns and only its single row is unpivoted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from millwright.functions.casting import nan_to_null
from millwright.functions.measures import divide, exact_ratio, fixed, units
from millwright.functions.quantiles import (
    DOUBLE_CODE, histogram, interpolated, level_bits, level_count, neighbours, scale_code, whole,
)


def kind_of(field: T.StructField, forced_categorical: tuple[str, ...] = ()) -> str:
    """The column's kind, from its type alone."""
    if field.name in forced_categorical:
        return "categorical"
    if isinstance(field.dataType, T.BooleanType):
        return "boolean"
    if isinstance(field.dataType, T.IntegralType):
        return "integer"
    if isinstance(field.dataType, T.NumericType):
        return "numeric"
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "categorical"


def profile_columns(
    rows: DataFrame, columns: list[str], forced_categorical: tuple[str, ...] = ()
) -> DataFrame:
    """Per column: kind, rows, non-NULL rows, null rate and, for booleans, the share of true."""
    fields = [rows.schema[c] for c in columns]
    booleans = [f.name for f in fields if isinstance(f.dataType, T.BooleanType)]
    wide = rows.agg(
        F.count("*").alias("row_count"),
        # NaN is how a missing number arrives
        *[F.count(nan_to_null(F.col(f.name)) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else F.col(f.name))
          .alias(f"{f.name}__filled") for f in fields],
        *[F.count_if(c).alias(f"{c}__true") for c in booleans],
    )

    def line(field: T.StructField):
        filled = F.col(f"{field.name}__filled")
        true_rate = (
            fixed(divide(F.col(f"{field.name}__true"), filled), 7, 6)
            if field.name in booleans
            else F.lit(None).cast("decimal(7,6)")
        )
        return F.struct(
            F.lit(field.name).alias("column"),
            F.lit(kind_of(field, forced_categorical)).alias("kind"),
            F.col("row_count"),
            filled.alias("non_null_count"),
            fixed(
                1 - filled.cast("double") / F.greatest(F.col("row_count"), F.lit(1)), 7, 6
            ).alias("null_rate"),
            true_rate.alias("true_rate"),
        )

    return wide.select(F.inline(F.array(*[line(f) for f in fields])))


def category_frequencies(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per column and category: count and share of the column's non-NULL rows.

    The totals are aggregated from the category counts and joined back (one row per column), not
    taken over a window, which would bring all categories of a column into one task. Without columns
    the result is empty.
    """
    if not columns:
        return rows.sparkSession.createDataFrame(
            [], "column string, category string, category_count bigint, frequency decimal(7,6)"
        )
    counts = (
        rows.select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
                for c in columns
            ]))
        )
        .where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(  # one row per profiled column
        "column",
        "category",
        F.col("n").alias("category_count"),
        fixed(divide(F.col("n"), F.col("total")), 7, 6).alias("frequency"),
    )


def top_categories(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent categories, ties by name."""
    return (
        rows.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("category_count"))
        .orderBy(F.desc("category_count"), column)
        .limit(k)
    )


#: Buckets of the first pass of ``heavy_hitters``, and how many of them a filter may name.
BUCKETS, NAMED_BUCKETS = 1 << 16, 4096


def heavy_hitters(rows: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value, as ``top_categories`` finds them, without a shuffle of all values.

    A first pass adds up the rows of BUCKETS hash buckets: a summary of bounded size that merges, and whose total is an
    upper bound for each value in the bucket. The values of the heaviest buckets are then counted exactly. The k-th
    count found decides: a bucket left out whose total is smaller can't hold a value that belongs among the k. If there
    is such a bucket, the values of all buckets with a total that large are counted, which is complete, since that
    k-th count can only grow. Where a filter would have to name too many of them, all values are counted.
    """
    value = F.col(column)
    known = rows.where(value.isNotNull()).withColumn("bucket", F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int"))
    totals = {r["bucket"]: r["n"] for r in known.groupBy("bucket").agg(F.count("*").alias("n")).collect()}  # BUCKETS at most

    def counted(buckets: list[int] | None) -> DataFrame:
        chosen = known if buckets is None else known.where(F.col("bucket").isin(buckets))
        return top_categories(chosen, column, k)

    heaviest = sorted(totals, key=lambda b: (-totals[b], b))
    first = heaviest[: max(64, 4 * k)]
    if len(first) == len(heaviest):
        return counted(None)
    found = counted(first).collect()  # k rows
    least = found[-1]["category_count"] if len(found) == k else 0
    if totals[heaviest[len(first)]] < least:
        return counted(first)
    wanted = [b for b in heaviest if totals[b] >= least]
    return counted(wanted if len(wanted) <= NAMED_BUCKETS else None)


def class_weights(readings: DataFrame) -> DataFrame:
    """Share of each (anomalous, optimised) cell; the window sees the four cells only."""
    everything = W.partitionBy(F.lit(1))
    return (
        readings.groupBy("is_anomalous", "is_optimised")
        .agg(F.count("*").alias("reading_count"))
        .withColumn(
            "class_weight",
            fixed(divide(F.col("reading_count"), F.sum("reading_count").over(everything)), 7, 6),
        )
    )


def quantile_profile(
    rows: DataFrame, columns: list[str], probabilities: tuple[float, ...] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Per numeric column: count, min, exact percentiles, max, mean and sample deviation. NaN is NULL.

    A result beyond DECIMAL(18,4), as doubles can have, is NULL. The mean of a DOUBLE column is a sum of doubles; all
    other means are exact.
    """
    types = {c: rows.schema[c].dataType for c in columns}
    levels = level_count(list(types.values()))
    long = rows.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                whole(F.col(c), types[c]).alias("value"),
                F.lit(level_bits(types[c], levels)).alias("bits"),
                F.lit(scale_code(types[c])).alias("scale"),
            )
            for c in columns
        ]))
    )
    keys = ["column", "bits", "scale"]
    located = neighbours(histogram(long, keys, "value"), keys, list(probabilities), "bits", levels)

    def mean_of(c: str) -> Column:
        scale = scale_code(types[c])
        if scale == DOUBLE_CODE:
            return _narrowed(F.avg(nan_to_null(F.col(c).cast("double"))))
        return exact_ratio(F.sum(units(F.col(c), scale)), F.count(c) * F.lit(10**scale), 4)

    wide = rows.agg(*[
        aggregate
        for c in columns
        for value in [nan_to_null(F.col(c).cast("double"))]
        for aggregate in (
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
            mean_of(c).alias(f"{c}__mean"),
            F.stddev_samp(value).alias(f"{c}__deviation"),
        )
    ])
    moments = wide.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(c).alias("column"),
                *[
                    F.col(f"{c}__{name}").alias(name)
                    for name in ("min", "max", "mean", "deviation")
                ],
            )
            for c in columns
        ]))
    )
    return located.join(F.broadcast(moments), "column").select(  # one row per profiled column
        "column",
        F.col("total").alias("non_null_count"),
        _narrowed(F.col("min")).alias("min_value"),
        *[
            _narrowed(interpolated(i, F.col("scale"))).alias(f"p{round(p * 100)}")
            for i, p in enumerate(probabilities)
        ],
        _narrowed(F.col("max")).alias("max_value"),
        F.col("mean").alias("mean_value"),
        _narrowed(F.col("deviation")).alias("stddev_value"),
    )


def _narrowed(value: Column) -> Column:
    """A double with four decimals; NULL where it does not fit."""
    return F.round(value, 4).try_cast(T.DecimalType(18, 4))


def median_by_group(rows: DataFrame, key: str, value: str) -> DataFrame:
    data_type = rows.schema[value].dataType
    levels = level_count([data_type])
    located = neighbours(
        histogram(rows, [key], value), [key], [0.5], level_bits(data_type, levels), levels
    )
    return located.select(
        key,
        F.col("total").alias("non_null_count"),
        _narrowed(interpolated(0, F.lit(scale_code(data_type)))).alias("median_value"),
    )


def approximate_quantiles(
    rows: DataFrame, key: str, value: str, probabilities: list[float], accuracy: int = 10_000
) -> DataFrame:
    """One pass and a fixed-size sketch per group, where an approximate rank is enough."""
    return rows.groupBy(key).agg(
        F.percentile_approx(value, probabilities, accuracy).alias("quantiles")
    )


def hour_profile(rows: DataFrame, ts: str) -> DataFrame:
    """Share of rows per UTC clock hour; the window sees at most 24 rows."""
    everything = W.partitionBy(F.lit(1))
    return (
        rows.groupBy(F.hour(ts).alias("hour_of_day"))
        .agg(F.count("*").alias("event_count"))
        .withColumn(
            "share", fixed(divide(F.col("event_count"), F.sum("event_count").over(everything)), 7, 6)
        )
    )


def arrival_rate(rows: DataFrame, source: str, ts: str) -> DataFrame:
    """Rows per minute and per second, by source."""
    return (
        rows.groupBy(F.lit(source).alias("source"), F.date_trunc("minute", ts).alias("minute"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("rows_per_second", fixed(F.col("row_count") / F.lit(60.0), 18, 4))
    )
