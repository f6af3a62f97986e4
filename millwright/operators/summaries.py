"""Quantiles from stored summaries that merge.

A batch leaves, per column, its row count and PIECES + 1 values that cut its sorted values into pieces of equal size. Merged,
every value stands for one piece of its batch. The summary of a batch of n rows misplaces a value by no more than
n / PIECES for the pieces and n / ACCURACY for the values, which Spark's approximate percentiles give; summed over batches
that is a share of ERROR of all rows, however many batches there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

PIECES, ACCURACY = 400, 20_000
#: Bound on the rank error of a merged quantile, as a share of all rows.
ERROR = 1 / PIECES + 1 / ACCURACY

SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("n", T.LongType()), T.StructField("cuts", T.ArrayType(T.DoubleType())),
])


def summaries(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """One row per ``by`` and column with a value: n and the cuts. One pass; partial summaries are merged, rows don't move.
    NULL and NaN don't count."""
    values = {c: F.col(c).cast("double") for c in columns}
    known = {c: F.when(~F.isnan(v), v) for c, v in values.items()}
    points = [k / PIECES for k in range(PIECES + 1)]
    wide = rows.groupBy(*by).agg(*[
        a for c in columns for a in (
            F.count(known[c]).alias(f"{c}__n"),
            F.percentile_approx(known[c], points, ACCURACY).alias(f"{c}__cuts"),
        )
    ])
    return wide.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__cuts").alias("cuts")) for c in columns
    ]))).where("n > 0")


def merged_quantiles(stored: DataFrame, probabilities: list[float]) -> DataFrame:
    """Per column and probability the value at that share of all rows behind the summaries: column, n, probability, value.

    A window holds a column's cuts: batches times PIECES, whatever the number of rows.
    """
    points = stored.select("column", "n", F.posexplode("cuts").alias("k", "value")).where("k > 0")
    # in sorted order a cut closes its piece
    upto = W.partitionBy("column").orderBy("value", "n", "k").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("column")
    placed = points.select(
        "column", "value", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total"),
    )
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    return (
        placed.select("*", asked)
        .where(F.col("upto") >= F.col("probability") * F.col("total"))
        .groupBy("column", "probability")
        .agg((F.first("total") / PIECES).cast("bigint").alias("n"), F.min("value").alias("value"))
    )
