"""Live aggregates: the batch operators on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StreamingQuery

from millwright.sources.layout import file_system


def live_aggregate(
    stream: DataFrame,
    aggregate: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    available_now: bool = True,
    ts: str | None = None,
    late_by: str | None = None,
) -> StreamingQuery:
    """Run ``aggregate`` in update mode. Every batch writes the groups it changed under its own
    number; ``latest`` reads the current value of each.

    Quarters, classes and assets bound the state, so no row is ever too late. Only an aggregate over event-time windows
    needs ``ts`` and ``late_by``, which drop later rows and free the state; ``throughput`` counts what was dropped.
    """

    def keep(changed: DataFrame, number: int) -> None:
        (
            changed.withColumn("batch", F.lit(number))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    watched = stream.withWatermark(ts, late_by) if late_by else stream
    writer = (
        aggregate(watched)
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest(updates: DataFrame, key: list[str]) -> DataFrame:
    """The newest row per key: one row per map task and key enters the shuffle."""
    nth = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("batch")))
    return updates.withColumn("nth", nth).where(F.col("nth") == 1).drop("nth", "batch")


def _folded(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last batch of the newest whole snapshot, and its folder."""
    system, place, jvm = file_system(spark, f"{path}-folded")
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(place, "upto=*/_SUCCESS")) or []
    upto = max((int(str(s.getPath().getParent().getName()).split("=")[1]) for s in found), default=-1)
    return upto, f"{path}-folded/upto={upto}" if upto >= 0 else None


def _since(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot and the updates after it."""
    upto, snapshot = _folded(spark, path)
    updates = spark.read.parquet(path)
    if snapshot is None:
        return updates
    return spark.read.schema(updates.schema).parquet(snapshot).unionByName(updates.where(F.col("batch") > upto))


def current(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """``latest`` of all updates below ``path``; batches that were folded are read as one snapshot."""
    return latest(_since(spark, path), key)


def fold(spark: SparkSession, path: str, key: list[str], upto: int) -> str:
    """Write the newest row per key of all batches up to ``upto`` (finished ones) as a snapshot, so that ``current`` reads
    one row per key and the updates since. It counts once it is whole; a run that died is repeated. Updates that a
    snapshot holds may be deleted."""
    rows = _since(spark, path).where(F.col("batch") <= upto)
    nth = F.row_number().over(W.partitionBy(*key).orderBy(F.desc("batch")))
    target = f"{path}-folded/upto={upto}"
    rows.withColumn("nth", nth).where(F.col("nth") == 1).drop("nth").write.mode("overwrite").parquet(target)
    return target


def throughput(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of the recent batches, from the query's own progress."""
    return [
        {
            "batch": p["batchId"],
            "rows": p["numInputRows"],
            "rows_per_second": p["processedRowsPerSecond"],
            "late_rows_dropped": sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
        }
        for p in query.recentProgress
    ]
