"""Relational tables over JDBC. The database's driver jar must be on the session's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def partitioned_read_options(
    url: str,
    table: str,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Split the scan on an indexed column. The bounds set the stride only: rows outside them are
    read by the first and last task, so none is lost."""
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
    }


def read_jdbc(
    spark: SparkSession, properties: dict[str, str] | None = None, **options
) -> DataFrame:
    """Credentials go into ``properties`` and stay out of the options that plans print."""
    reader = spark.read.format("jdbc").options(**partitioned_read_options(**options))
    return reader.options(**(properties or {})).load()
