"""Rolling statistics per asset over the preceding days.

A window partitioned by asset alone would put a busy asset's whole history into one task, and a
sliding frame re-reads the frame for every row. Instead:

1. events are reduced to one point per (asset, event time), with map-side partials;
2. time is cut into tiles as long as the frame. A frame reaches at most into the tile before, so
   each point goes to its own tile and, as a carry, to the next one;
3. inside a tile the frame's sum is (carries in total) - (carries that have left) + (own points so
   far): running sums over integers, one shuffle, linear time.

A task's largest group is therefore two tiles of one asset at one row per distinct event time. The
wire format has whole seconds, so that is at most 1.2 million narrow rows for 7 days, however many
events the asset has. Finer times stay exact but raise that bound; ``rolling_daily_stats`` is bounded
by the calendar alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millwright.functions.measures import divide, fixed

_MEASURES = ("events", "waits", "wait_total", "delays")


def rolling_points(events: DataFrame, days: int = 7) -> DataFrame:
    """One row per (asset, event time) with raw sums over [time - days, time], both included."""
    width = days * 86_400_000_000
    points = events.groupBy("asset_id", "event_timestamp").agg(
        F.count("*").alias("events"),
        F.count("waiting_time_min").alias("waits"),
        F.coalesce(F.sum("waiting_time_min"), F.lit(0)).alias("wait_total"),
        F.count_if("logistics_delay").alias("delays"),
    )
    micros = F.unix_micros("event_timestamp")
    tile = F.expr(f"(unix_micros(event_timestamp) - pmod(unix_micros(event_timestamp), {width}))"
                  f" div {width}")  # whole-number floor, also before 1970
    own = F.struct(
        tile.alias("tile"), micros.alias("position"), F.lit(False).alias("carried"),
    )
    carry = F.struct(
        (tile + 1).alias("tile"), (micros + width + 1).alias("position"), F.lit(True).alias("carried")
    )
    placed = points.select("*", F.inline(F.array(own, carry)))

    # Points are unique per position, so a row frame is exact once a carry that leaves at a position
    # comes before the point there. The running sums go first: their sort serves both windows.
    whole_tile = W.partitionBy("asset_id", "tile")
    so_far = whole_tile.orderBy("position", F.desc("carried")).rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    running = placed.select(
        "asset_id", "event_timestamp", "tile", "carried", *_MEASURES,
        *[
            F.sum(F.when(F.col("carried"), -F.col(name)).otherwise(F.col(name)))
            .over(so_far).alias(f"{name}_so_far")
            for name in _MEASURES
        ],
    )
    entering = {
        name: F.sum(F.when(F.col("carried"), F.col(name)).otherwise(0)).over(whole_tile)
        for name in _MEASURES
    }
    return (
        running.select(
            "asset_id", "event_timestamp", "carried",
            *[(entering[n] + F.col(f"{n}_so_far")).alias(n) for n in _MEASURES],
        )
        .where(~F.col("carried"))
        .drop("carried")
    )


def rolling_asset_stats(events: DataFrame, days: int = 7) -> DataFrame:
    """The rolling statistics attached to every event. Keys of the join are (asset, event time):
    the point side is unique, so a crowded key only repeats its one point."""
    return (
        events.select("event_id", "asset_id", "event_timestamp")
        .join(rolling_points(events, days), ["asset_id", "event_timestamp"])
        .select(
            "event_id",
            "asset_id",
            "event_timestamp",
            F.col("events").alias("rolling_events"),
            F.col("wait_total").alias("rolling_waiting_min"),
            fixed(divide(F.col("wait_total"), F.col("waits")), 12, 4).alias("rolling_avg_waiting_min"),
            fixed(divide(F.col("delays"), F.col("events")), 5, 4).alias("rolling_delay_rate"),
        )
    )


def rolling_daily_stats(events: DataFrame, days: int = 7) -> DataFrame:
    """The cheaper form: one row per (asset, day) over that day and the ``days - 1`` before it."""
    daily = events.groupBy("asset_id", F.to_date("event_timestamp").alias("event_date")).agg(
        F.count("*").alias("events"),
        F.count("waiting_time_min").alias("waits"),
        F.coalesce(F.sum("waiting_time_min"), F.lit(0)).alias("wait_total"),
        F.count_if("logistics_delay").alias("delays"),
    )
    # One row per day and asset: the frame holds at most ``days`` rows.
    frame = (
        W.partitionBy("asset_id")
        .orderBy(F.unix_date("event_date"))
        .rangeBetween(-(days - 1), W.currentRow)
    )
    sums = {name: F.sum(name).over(frame) for name in _MEASURES}
    return daily.select(
        "asset_id",
        "event_date",
        sums["events"].alias("rolling_events"),
        sums["wait_total"].alias("rolling_waiting_min"),
        fixed(divide(sums["wait_total"], sums["waits"]), 12, 4).alias("rolling_avg_waiting_min"),
        fixed(divide(sums["delays"], sums["events"]), 5, 4).alias("rolling_delay_rate"),
    )
