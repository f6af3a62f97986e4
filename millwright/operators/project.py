"""Renames, typing, filters and value clean-up: narrow operators, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwright.contracts import HRSS_SOURCE_NAMES, LOGISTICS_SOURCE_NAMES
from millwright.functions.casting import clip, nan_to_null, typed


def project_logistics(source: DataFrame, time_column: str | None = None) -> DataFrame:
    """Source column names to contract names; other columns are dropped, the source's own
    Timestamp with them. ``time_column`` names the column that carries the event time, if any."""
    names = dict(LOGISTICS_SOURCE_NAMES)
    if time_column:
        names[time_column] = "event_timestamp"
    return _project(source, names, ("event_id",))


def project_hrss(source: DataFrame, time_column: str | None = None) -> DataFrame:
    """As above; the source's Timestamp is seconds since the cycle began and becomes
    ``cycle_elapsed_sec``. The class flags, added when the files are read, are kept."""
    names = dict(HRSS_SOURCE_NAMES)
    if time_column:
        names[time_column] = "reading_timestamp"
    return _project(source, names, ("reading_id", "is_anomalous", "is_optimised"))


def _project(source: DataFrame, names: dict[str, str], kept: tuple[str, ...]) -> DataFrame:
    return source.select(*[
        c for c in source.columns if c in names or c in kept
    ]).withColumnsRenamed(names)


def to_contract(text_rows: DataFrame, contract: T.StructType) -> DataFrame:
    """All-text columns to the contract's types; columns outside the contract are dropped."""
    return text_rows.select(*[
        typed(F.col(f.name), f).alias(f.name) for f in contract.fields if f.name in text_rows.columns
    ])


def nan_columns_to_null(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        f.name: nan_to_null(F.col(f.name))
        for f in rows.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    })


def with_defaults(rows: DataFrame, id_name: str, key: list, arrived_at: Column) -> DataFrame:
    """Row id and arrival time. The id is a hash of what identifies the message: its position and,
    for lines that share one, the place in the batch. A 64-bit hash is an identifier here, not the deduplication key."""
    return rows.withColumns({id_name: F.xxhash64(*key), "ingested_at": arrived_at})


def time_window(rows: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """Both ends included."""
    return rows.where(F.col(ts).between(start, end))


def in_quarter(rows: DataFrame, ts: str, quarter: str, lead_days: int = 0) -> DataFrame:
    """Half-open filter on the quarter starting at ``quarter`` (yyyy-mm-dd) and ``lead_days`` before it. A
    raw table's months are pruned by the same bounds."""
    start = F.date_sub(F.lit(quarter).cast("date"), lead_days) if lead_days else F.lit(quarter).cast("date")
    end = F.add_months(F.lit(quarter).cast("date"), 3)
    picked = rows.where(
        (F.col(ts) >= start.cast("timestamp")) & (F.col(ts) < end.cast("timestamp"))
    )
    if "event_month" in rows.columns:
        picked = picked.where((F.col("event_month") >= F.trunc(start, "month")) & (F.col("event_month") < end))
    return picked


def of_class(readings: DataFrame, is_anomalous: bool, is_optimised: bool) -> DataFrame:
    return readings.where(
        (F.col("is_anomalous") == is_anomalous) & (F.col("is_optimised") == is_optimised)
    )


def clipped(rows: DataFrame, bounds: dict[str, tuple]) -> DataFrame:
    return rows.withColumns({c: clip(F.col(c), low, high) for c, (low, high) in bounds.items()})


def rounded_half_even(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.rint(F.col(c)).cast("bigint") for c in columns})
