"""Quarterly features as sums that add up.

A batch of raw rows leaves one row per quarter and key with counts and whole-number or decimal sums. Adding up the rows of
any set of batches, in any order, and dividing at the end gives exactly what the features over all their rows are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millwright import contracts as c
from millwright.functions.measures import divide, fixed, quarter_start
from millwright.operators.features import row_power


@dataclass(frozen=True)
class Measure:
    """Sums over rows, by name, and the feature that they give when added up."""

    feature: str
    parts: dict[str, Column]
    value: Column


def _mean(column: str, feature: str, precision: int, scale: int = 0) -> Measure:
    summed = F.col(column).cast(T.DecimalType(8, scale)) if scale else F.col(column)
    total, count = f"{column}_total", f"{column}_count"
    return Measure(
        feature, {total: F.sum(summed), count: F.count(column)}, fixed(divide(F.col(total), F.col(count)), precision, 2)
    )


def _count(feature: str) -> Measure:
    return Measure(feature, {feature: F.count("*")}, F.col(feature))


def _share(feature: str, condition: Column, of: str) -> Measure:
    part = f"{feature}_rows"
    return Measure(feature, {part: F.count_if(condition)}, fixed(divide(F.col(part), F.col(of)), 5, 4))


def measures(topic: str) -> list[Measure]:
    if topic == c.TOPIC_LOGISTICS:
        return [
            _count("event_count"),
            _share("delay_rate", F.col("logistics_delay"), "event_count"),
            _mean("waiting_time_min", "avg_waiting_time_min", 8),
            _mean("inventory_level", "avg_inventory_level", 10),
            _mean("asset_utilization_pct", "avg_asset_utilization_pct", 5, scale=2),
            _mean("temperature_c", "avg_temperature_c", 6, scale=2),
            _mean("humidity_pct", "avg_humidity_pct", 6, scale=2),
            Measure(
                "total_transaction_amount", {"amount_total": F.sum("user_transaction_amount")}, F.col("amount_total")
            ),
        ]
    return [
        _count("reading_count"),
        *[_mean(f"{axis}_power_w", f"avg_{axis}_power_w", 10) for axis in c.AXES],
        Measure("total_power_w", {"power_total": F.sum(row_power())}, F.col("power_total").cast("decimal(24,2)")),
        _share("anomaly_label_rate", F.col("label") == 1, "reading_count"),
    ]


KEYS = {c.TOPIC_LOGISTICS: ["asset_id"], c.TOPIC_HRSS: ["is_anomalous", "is_optimised"]}
LAST = "last_time"


def partial_sums(rows: DataFrame, topic: str, by: list[str], also: tuple[Column, ...] = ()) -> DataFrame:
    """One row per quarter, key and ``by`` (a batch, a file): the sums, the last event time, and aggregates ``also``."""
    ts = c.EVENT_TIME[topic]
    return rows.groupBy(*by, quarter_start(F.col(ts)).alias("quarter_start"), *KEYS[topic]).agg(
        *[part.alias(name) for m in measures(topic) for name, part in m.parts.items()], F.max(ts).alias(LAST), *also
    )


def schema(topic: str, contract: T.StructType) -> T.StructType:
    """The columns of ``partial_sums`` without ``by``."""
    fields = [T.StructField("quarter_start", T.DateType()), *[contract[k] for k in KEYS[topic]]]
    for m in measures(topic):
        for name in m.parts:
            column = name.removesuffix("_total")
            scaled = column in contract.names and isinstance(contract[column].dataType, T.DecimalType)
            fields.append(T.StructField(name, T.DecimalType(18, 2) if name.endswith("_total") and scaled else T.LongType()))
    return T.StructType([*fields, T.StructField(LAST, T.TimestampType())])


def added_up(partials: DataFrame, topic: str) -> DataFrame:
    """The features of all rows behind the given partial sums."""
    names = [name for m in measures(topic) for name in m.parts]
    return (
        partials.groupBy("quarter_start", *KEYS[topic]).agg(*[F.sum(n).alias(n) for n in names])
        .select("quarter_start", *KEYS[topic], *[m.value.alias(m.feature) for m in measures(topic)])
    )


def readiness(partials: DataFrame, topic: str, min_rows: int, max_gap_days: int) -> DataFrame:
    """Per quarter what ``quality.raw_readiness`` says of the rows, from their partial sums."""
    last = F.to_date("last_event")
    return (
        partials.groupBy("quarter_start")
        .agg(F.sum(measures(topic)[0].feature).alias("row_count"), F.max(LAST).alias("last_event"))
        .withColumn(
            "is_ready",
            (F.col("row_count") >= min_rows) & (F.datediff(F.add_months("quarter_start", 3), last) <= max_gap_days),
        )
    )
