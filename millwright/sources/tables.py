"""Raw and feature tables as partitioned Parquet.

Raw tables are append-only and partitioned by event month, so a quarter reads its own folders only; inside
files rows are sorted by day. ``layout`` says which folders count. Feature tables are partitioned by quarter and a run replaces exactly the quarters it was asked for.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.sources import layout


def append_raw(rows: DataFrame, path: str, ts: str, batch: str, sort_by: list[str]) -> None:
    """Add one batch. The batch name is a partition below the month and is written in dynamic
    overwrite mode: a batch that is written again replaces itself and nothing else.

    The rebalance hint leaves file sizes to adaptive execution: small months share a task and a
    crowded month is split. Sorting inside files lets row-group statistics skip on the day and keys.
    """
    (
        rows.withColumn("event_month", F.trunc(F.to_date(ts), "month"))
        .hint("rebalance", "event_month")
        .sortWithinPartitions("event_month", F.to_date(ts), *sort_by)
        .withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_month", "batch")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """The rows that count, with their month and batch."""
    if not layout.swaps(spark, path):
        whole = spark.read.schema(T.StructType(contract.fields + layout.PARTITIONS)).parquet(path)
        # a replacement that is being written, or was left behind
        return whole.where(~F.startswith(F.col("batch"), F.lit(layout.MADE)))
    return layout.read_units(spark, path, contract, layout.live(spark, path))


def overwrite_quarters(features: DataFrame, path: str, quarters: Iterable[str]) -> None:
    """Replace the listed quarters, including one that now has no rows.

    Dynamic overwrite leaves a partition alone when the result has no row for it, so such a
    quarter is emptied on its own. Rows of other quarters are an error, not a silent overwrite.
    """
    wanted = sorted(set(quarters))
    quarter_text = F.date_format("quarter_start", "yyyy-MM-dd")
    kept = features.persist()  # aggregated rows; rebuilt from the source if an executor is lost
    try:
        present = [r[0] for r in kept.select(quarter_text).distinct().limit(len(wanted) + 1).collect()]
        strangers = sorted(set(present) - set(wanted))
        if strangers:
            raise ValueError(f"result holds quarters that were not asked for: {strangers}")
        if present:
            (
                kept.hint("rebalance", "quarter_start")
                .sortWithinPartitions(*[c for c in kept.columns if c in _SORT_KEYS])
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("quarter_start")
                .parquet(path)
            )
        for quarter in sorted(set(wanted) - set(present)):
            kept.limit(0).drop("quarter_start").write.mode("overwrite").parquet(
                f"{path}/quarter_start={quarter}"
            )
    finally:
        kept.unpersist()


def overwrite_quarter(rows: DataFrame, path: str, quarter: str) -> None:
    """Replace one quarter's folder by ``rows``, which all belong to it; without rows it becomes empty. Nothing is cached,
    so the rows may be as many as the raw ones."""
    kept = rows.drop("quarter_start") if "quarter_start" in rows.columns else rows
    kept.write.mode("overwrite").parquet(f"{path}/quarter_start={quarter}")


_SORT_KEYS = ("quarter_start", "asset_id", "is_anomalous", "is_optimised")


def read_features(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    return spark.read.schema(contract).parquet(path)


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Serve tables to SQL under their names."""
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)


def write_logs(parsed: DataFrame, path: str, batch: str) -> None:
    """Add one batch of lines, in folders of day and batch; lines without a readable time go to the null-date folder.
    A batch that is written again replaces itself. A day's rows are sorted by service and time."""
    (
        parsed.withColumn("log_date", F.to_date("log_time"))
        .withColumn("batch", F.lit(batch))
        .hint("rebalance", "log_date")
        .sortWithinPartitions("log_date", "service", "log_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("log_date", "batch")
        .parquet(path)
    )


def read_log_files(spark: SparkSession, path: str) -> DataFrame:
    """Log files as ``service`` and ``line``; the service is the file's name up to the first dot."""
    return spark.read.text(path).select(
        F.substring_index("_metadata.file_name", ".", 1).alias("service"),
        F.col("value").alias("line"),
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files as ``service``, ``line`` and the line's place: ``file``, ``block`` (where the part of the file begins
    that one task reads) and ``place`` (ascending inside a block). The service is the file's name up to the first dot."""
    return spark.read.text(path).select(
        F.substring_index("_metadata.file_name", ".", 1).alias("service"),
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
