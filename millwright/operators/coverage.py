"""Where events are missing: intervals without one, per source, and what share of each quarter is covered.

Time is cut into tiles as long as the longest gap that is allowed. Two events of one tile are never too far apart, so a
tile's first and last event are all that counts, and rows are reduced to one per source and tile before any order
matters. Gaps are then looked for between neighbouring tiles of a span, and between the borders of neighbouring
spans. A window holds a span's tiles or a source's spans: the calendar bounds both, not the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.functions.measures import divide, fixed, quarter_start

#: Tiles of a span.
SPAN = 4096


def _floor_div(value: str, width: int) -> Column:
    return F.expr(f"({value} - pmod({value}, {width}L)) div {width}L")  # rounds down before 1970 too


def _tiles(rows: DataFrame, source: str, ts: str, max_gap_seconds: int) -> DataFrame:
    width = max_gap_seconds * 1_000_000
    return (
        rows.where(F.col(ts).isNotNull())
        .groupBy(source, _floor_div(f"unix_micros({ts})", width).alias("tile"))
        .agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
        .withColumn("span", _floor_div("tile", SPAN))
    )


def _spans(tiles: DataFrame, source: str) -> DataFrame:
    return tiles.groupBy(source, "span").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def _micros(start: str, end: str) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def _gaps(tiles: DataFrame, source: str, max_gap_seconds: int) -> DataFrame:
    inside = W.partitionBy(source, "span").orderBy("tile")
    between = W.partitionBy(source).orderBy("span")
    both = tiles.select(source, F.lag("last").over(inside).alias("gap_start"), F.col("first").alias("gap_end")).unionByName(
        _spans(tiles, source).select(source, F.lag("last").over(between).alias("gap_start"), F.col("first").alias("gap_end"))
    )
    return both.where(_micros("gap_start", "gap_end") > max_gap_seconds * 1_000_000)


def missing_intervals(rows: DataFrame, source: str, ts: str, max_gap_seconds: int) -> DataFrame:
    """Per source the intervals between two successive events that are further apart than allowed: source, gap_start,
    gap_end (the events). NULL is a source like any other; rows without a time don't count."""
    return _gaps(_tiles(rows, source, ts, max_gap_seconds), source, max_gap_seconds)


def quarter_coverage(rows: DataFrame, source: str, ts: str, max_gap_seconds: int) -> DataFrame:
    """Per source and quarter, from the quarter of its first event to that of its last: missing_count and missing_micros
    of the quarter's missing intervals, and covered_share.

    Beside the intervals between events, the time from the first quarter's start to the first event and from the last
    event to the last quarter's end is missing where it is longer than allowed. An interval counts in every quarter that
    it reaches into, with its part there.
    """
    tiles = _tiles(rows, source, ts, max_gap_seconds)
    ends = _spans(tiles, source).groupBy(source).agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
        source, "first", "last", quarter_start(F.col("first")).alias("from"), quarter_start(F.col("last")).alias("until"),
    )
    outer = ends.select(source, F.inline(F.array(
        F.struct(F.col("from").cast("timestamp").alias("gap_start"), F.col("first").alias("gap_end")),
        F.struct(F.col("last").alias("gap_start"), F.add_months("until", 3).cast("timestamp").alias("gap_end")),
    ))).where(_micros("gap_start", "gap_end") > max_gap_seconds * 1_000_000)
    months = F.expr("interval 3 months")
    last_instant = F.timestamp_micros(F.unix_micros("gap_end") - 1)
    pieces = (
        _gaps(tiles, source, max_gap_seconds).unionByName(outer)
        .select("*", F.explode(F.sequence(quarter_start(F.col("gap_start")), quarter_start(last_instant), months)).alias("quarter_start"))
        .select(
            source, "quarter_start",
            F.greatest("gap_start", F.col("quarter_start").cast("timestamp")).alias("piece_start"),
            F.least("gap_end", F.add_months("quarter_start", 3).cast("timestamp")).alias("piece_end"),
        )
        .groupBy(source, "quarter_start")
        .agg(F.count("*").alias("missing_count"), F.sum(_micros("piece_start", "piece_end")).alias("missing_micros"))
    )
    whole = ends.select(source, F.explode(F.sequence("from", "until", months)).alias("quarter_start"))
    length = F.datediff(F.add_months("quarter_start", 3), "quarter_start").cast("bigint") * 86_400_000_000
    mine = pieces.select(F.col(source).alias("_source"), F.col("quarter_start").alias("_quarter"), "missing_count", "missing_micros")
    same = whole[source].eqNullSafe(mine["_source"]) & (whole["quarter_start"] == mine["_quarter"])
    return whole.join(mine, same, "left").select(
        source, "quarter_start",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("missing_count", "missing_micros")],
    ).withColumn("covered_share", fixed(divide(length - F.col("missing_micros"), length), 7, 6))
