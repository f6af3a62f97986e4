"""Quarterly features: per asset, per class and per axis.

Every operator is one hash aggregation with map-side partials, so a key holding a third of all
rows reaches the reducers as one partial row per map task. Per-axis reports aggregate wide first
and unpivot the aggregated rows, never the readings. All of them also run on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.contracts import AXES
from millwright.functions.measures import divide, fixed, mean, quarter_start, share_of_rows


def row_power(axes=AXES) -> Column:
    """Power of one reading over all axes; a missing axis counts as 0."""
    total = F.lit(0).cast("bigint")
    for axis in axes:
        total = total + F.coalesce(F.col(f"{axis}_power_w"), F.lit(0))
    return total


def _logistics_measures() -> dict[str, Column]:
    return {
        "event_count": F.count("*"),
        "delay_rate": share_of_rows(F.col("logistics_delay")),
        "avg_waiting_time_min": mean(F.col("waiting_time_min"), 8, 2),
        "avg_inventory_level": mean(F.col("inventory_level"), 10, 2),
        "avg_asset_utilization_pct": mean(F.col("asset_utilization_pct"), 5, 2, scale=2),
        "avg_temperature_c": mean(F.col("temperature_c"), 6, 2, scale=2),
        "avg_humidity_pct": mean(F.col("humidity_pct"), 6, 2, scale=2),
        "total_transaction_amount": F.sum("user_transaction_amount"),
    }


def logistics_features(events: DataFrame, only: tuple[str, ...] = ()) -> DataFrame:
    """Per (quarter, asset). An event whose delay flag is unknown still counts as an event.

    ``only`` names the features to compute; ``events`` then needs no other columns.
    """
    measures = _logistics_measures()
    return events.groupBy(
        quarter_start(F.col("event_timestamp")).alias("quarter_start"), "asset_id"
    ).agg(*[measures[name].alias(name) for name in only or measures])


def hrss_features(readings: DataFrame) -> DataFrame:
    """Per (quarter, anomalous, optimised). ``total_power_w`` sums rows, not averages."""
    return readings.groupBy(
        quarter_start(F.col("reading_timestamp")).alias("quarter_start"),
        "is_anomalous",
        "is_optimised",
    ).agg(
        F.count("*").alias("reading_count"),
        *[mean(F.col(f"{axis}_power_w"), 10, 2).alias(f"avg_{axis}_power_w") for axis in AXES],
        F.sum(row_power()).cast("decimal(24,2)").alias("total_power_w"),
        share_of_rows(F.col("label") == 1).alias("anomaly_label_rate"),
    )


def anomaly_rate(readings: DataFrame) -> DataFrame:
    return readings.groupBy(
        quarter_start(F.col("reading_timestamp")).alias("quarter_start")
    ).agg(
        F.count("*").alias("reading_count"),
        F.count_if("is_anomalous").alias("anomalous_count"),
        share_of_rows(F.col("is_anomalous")).alias("anomaly_rate"),
    )


def _by_axis(wide: DataFrame, *names: str) -> DataFrame:
    """One aggregated row per quarter -> one row per quarter and axis."""
    return wide.select(
        "quarter_start",
        F.inline(F.array(*[
            F.struct(
                F.lit(axis).alias("axis"), *[F.col(f"{axis}_{n}").alias(n) for n in names]
            )
            for axis in AXES
        ])),
    )


def anomaly_rate_by_axis(readings: DataFrame) -> DataFrame:
    """Share of an axis's power drawn in anomalous readings. Every reading covers all axes, so a
    plain row rate would be the same for each of them."""
    power = {axis: F.col(f"{axis}_power_w") for axis in AXES}
    wide = readings.groupBy(
        quarter_start(F.col("reading_timestamp")).alias("quarter_start")
    ).agg(*[
        aggregate
        for axis in AXES
        for aggregate in (
            F.sum(F.when(F.col("is_anomalous"), power[axis])).alias(f"{axis}_anomalous"),
            F.sum(power[axis]).alias(f"{axis}_total"),
        )
    ])
    share = fixed(divide(F.coalesce("anomalous", F.lit(0)), F.col("total")), 5, 4)
    return _by_axis(wide, "anomalous", "total").select(
        "quarter_start", "axis", share.alias("anomalous_power_share")
    )


def _class_mean(value: Column, in_class: Column) -> Column:
    picked = F.when(in_class, value)
    return divide(F.sum(picked), F.count(picked))


def _efficiency_columns() -> list[Column]:
    ratio = F.col("p_opt") / F.nullif(F.col("p_std"), F.lit(0))
    return [
        fixed(F.col("p_opt"), 18, 4).alias("optimised_power_w"),
        fixed(F.col("p_std"), 18, 4).alias("standard_power_w"),
        fixed(ratio, 18, 4).alias("power_ratio"),
        fixed(100 * (1 - ratio), 18, 4).alias("saving_pct"),
    ]


def energy_efficiency(readings: DataFrame) -> DataFrame:
    """Mean power of optimised against standard readings. NULL where a class is absent."""
    return (
        readings.groupBy(quarter_start(F.col("reading_timestamp")).alias("quarter_start"))
        .agg(
            _class_mean(row_power(), F.col("is_optimised")).alias("p_opt"),
            _class_mean(row_power(), ~F.col("is_optimised")).alias("p_std"),
        )
        .select("quarter_start", *_efficiency_columns())
    )


def energy_efficiency_by_axis(readings: DataFrame) -> DataFrame:
    wide = readings.groupBy(
        quarter_start(F.col("reading_timestamp")).alias("quarter_start")
    ).agg(*[
        aggregate
        for axis in AXES
        for aggregate in (
            _class_mean(row_power([axis]), F.col("is_optimised")).alias(f"{axis}_p_opt"),
            _class_mean(row_power([axis]), ~F.col("is_optimised")).alias(f"{axis}_p_std"),
        )
    ])
    return _by_axis(wide, "p_opt", "p_std").select(
        "quarter_start", "axis", *_efficiency_columns()
    )


def class_rollup(readings: DataFrame) -> DataFrame:
    """Totals per class cell, per anomaly flag and overall. The readings are aggregated once to
    the few cells; only those are expanded into the grouping sets."""
    cells = readings.groupBy("is_anomalous", "is_optimised").agg(
        F.count("*").alias("n"), F.sum(row_power()).alias("power")
    )
    return (
        cells.rollup("is_anomalous", "is_optimised")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("n").alias("reading_count"),
            F.sum("power").alias("total_power_w"),
        )
    )


def quarter_over_quarter(features: DataFrame) -> DataFrame:
    """Change against the asset's previous feature row. The window holds one row per quarter of
    one asset, so its size follows the calendar and not the events."""
    by_asset = W.partitionBy("asset_id").orderBy("quarter_start")
    return features.select(
        "asset_id",
        "quarter_start",
        F.lag("quarter_start").over(by_asset).alias("previous_quarter"),
        (F.col("event_count") - F.lag("event_count").over(by_asset)).alias("event_count_change"),
        (F.col("delay_rate") - F.lag("delay_rate").over(by_asset))
        .cast("decimal(6,4)")
        .alias("delay_rate_change"),
        (F.col("avg_waiting_time_min") - F.lag("avg_waiting_time_min").over(by_asset))
        .cast("decimal(9,2)")
        .alias("avg_waiting_time_change"),
    )


def stamp(features: DataFrame, key: tuple[str, ...], computed_at: Column) -> DataFrame:
    """Add the row id and the run time. The id is a hash of the key, so re-running a quarter
    gives the same rows; only ``computed_at`` differs and it is passed in."""
    return features.select(
        F.xxhash64(*key).alias("feature_id"), *features.columns, computed_at.alias("computed_at")
    )
