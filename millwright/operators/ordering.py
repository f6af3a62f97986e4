"""Global order and positions in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millwright.session import shared_dir


def sorted_by_time(rows: DataFrame, ts: str, row_id: str) -> DataFrame:
    """A distributed sort: range partitions, each sorted. The id breaks ties, so even a single
    crowded instant is split over partitions."""
    return rows.orderBy(ts, row_id) if ts != row_id else rows.orderBy(ts)


def with_position(rows: DataFrame, ts: str, row_id: str) -> DataFrame:
    """Rows numbered from 1 in time order, without a window over the whole table.

    The sort is checkpointed to fix its partitions. A row's position is then the size of the
    partitions before its own plus its place inside it; the sizes are one row per partition.
    """
    spark = rows.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "sort"))
    fixed_order = sorted_by_time(rows, ts, row_id).checkpoint()
    placed = fixed_order.withColumn("place", F.monotonically_increasing_id()).withColumns({
        "part": F.shiftright("place", 33),
        "place": F.col("place").bitwiseAND((1 << 33) - 1),
    })
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    return (
        placed.join(F.broadcast(offsets), "part")  # one row per partition of the sort
        .withColumn("position", F.col("offset") + F.col("place") + 1)
        .drop("part", "place", "offset")
    )
