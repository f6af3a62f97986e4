"""The two recurring jobs, and the profile run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millwright import contracts as c
from millwright.operators.coverage import quarter_coverage
from millwright.operators.features import (
    anomaly_rate,
    anomaly_rate_by_axis,
    energy_efficiency,
    energy_efficiency_by_axis,
    hrss_features,
    logistics_features,
    stamp,
)
from millwright.operators import partials, privacy
from millwright.operators.logs import entries, without_health_checks
from millwright.operators.profile import category_frequencies, profile_columns, quantile_profile
from millwright.operators.project import in_quarter
from millwright.operators.quality import key_uniqueness, raw_readiness
from millwright.operators.rolling import rolling_asset_stats
from millwright.session import use_utc
from millwright.sources import derived, layout
from millwright.sources.files import read_csv
from millwright.sources.messages import stream_files, stream_kafka
from millwright.sources.tables import (
    overwrite_quarter, overwrite_quarters, read_features, read_log_lines, read_raw, register, write_logs,
)
from millwright.streaming import replay
from millwright.streaming.ingest import ingest, without_redeliveries

CONTRACTS = {
    c.TOPIC_LOGISTICS: (c.LOGISTICS_EVENTS, "event_timestamp", ["asset_id", "event_timestamp"]),
    c.TOPIC_HRSS: (
        c.HRSS_TELEMETRY, "reading_timestamp", ["is_anomalous", "is_optimised", "reading_timestamp"]
    ),
}

FEATURES = {
    c.TOPIC_LOGISTICS: (
        "logistics_features_quarterly", logistics_features, c.LOGISTICS_KEY, c.LOGISTICS_FEATURES
    ),
    c.TOPIC_HRSS: ("hrss_features_quarterly", hrss_features, c.HRSS_KEY, c.HRSS_FEATURES),
}

ROLLING_DAYS = 7
#: A time without any row of a topic that is longer than this is a hole.
HOLE_SECONDS = 3600

#: Per topic the further tables of a quarter: name, computation, days of raw data before the quarter it needs.
REPORTS: dict[str, list[tuple[str, Callable[[DataFrame], DataFrame], int]]] = {
    c.TOPIC_LOGISTICS: [
        ("rolling_asset_stats", lambda rows: rolling_asset_stats(rows, ROLLING_DAYS), ROLLING_DAYS),
    ],
    c.TOPIC_HRSS: [
        ("anomaly_rate", anomaly_rate, 0),
        ("anomaly_rate_by_axis", anomaly_rate_by_axis, 0),
        ("energy_efficiency", energy_efficiency, 0),
        ("energy_efficiency_by_axis", energy_efficiency_by_axis, 0),
    ],
}


class NotReady(Exception):
    """The quarter's raw data is not there yet."""


def flush_topic(
    spark: SparkSession,
    topic: str,
    base: str,
    servers: str | None = None,
    landing: str | None = None,
    max_rows: int = 100_000_000,
    max_files: int = 1_000,
    repeats_within: str | None = None,
    repeats_ever: bool = False,
) -> StreamingQuery:
    """One hourly flush of a topic, from Kafka or from a landing folder of message files.

    A backlog is taken in micro-batches of ``max_rows`` messages or ``max_files`` files, which
    bounds what a batch caches and what a failure repeats; all of it is taken. ``repeats_within``
    also drops payloads a producer sent twice within that time, ``repeats_ever`` those that any earlier flush with
    that option accepted.
    """
    use_utc(spark)
    contract, ts, sort_by = CONTRACTS[topic]
    if servers:
        messages = stream_kafka(
            spark, servers=servers, topic=topic, max_rows_per_trigger=max_rows
        )
    else:
        messages = stream_files(spark, landing, topic, max_files_per_trigger=max_files)
    if repeats_within:
        messages = without_redeliveries(messages, repeats_within)
    return ingest(
        messages, contract, ts, f"{base}/raw/{topic}", f"{base}/quarantine/{topic}",
        f"{base}/checkpoints/{topic}", sort_by, history=f"{base}/history/{topic}" if repeats_ever else None,
    )


def quarterly(
    spark: SparkSession,
    quarter: str,
    base: str,
    computed_at: datetime,
    min_rows: int = 1,
    max_gap_days: int = 7,
    topics: tuple[str, ...] = tuple(FEATURES),
    from_partials: bool = False,
    min_covered: float = 0.0,
) -> dict[str, str]:
    """Rebuild one quarter of the feature tables and reports; running it again gives the same tables.

    With ``from_partials`` features and the check of readiness come from stored partial sums, and only raw folders that
    were added since the last run are read for them (see ``refresh_partials``). The result is the same.

    The job refuses a quarter whose raw data has not arrived: fewer than ``min_rows`` rows, or none in the last
    ``max_gap_days`` days (0 rows and 92 days refuse nothing). With ``min_covered`` it also refuses one whose hours
    without any row add up to more: every hole of over an hour counts, wherever it is. The check reads one aggregated row per table. Keys are
    checked before the feature table is replaced.
    """
    use_utc(spark)
    written = {}
    for topic in topics:
        table, compute, key, output = FEATURES[topic]
        contract, ts, _ = CONTRACTS[topic]
        raw = read_raw(spark, f"{base}/raw/{topic}", contract)
        rows = in_quarter(raw, ts, quarter)
        sums = None
        if from_partials:
            sums = partial_rows(spark, base, topic).where(F.col("quarter_start") == F.lit(quarter).cast("date"))
        if min_rows:
            state = (
                raw_readiness(rows, ts, min_rows, max_gap_days) if sums is None
                else partials.readiness(sums, topic, min_rows, max_gap_days)
            ).head()
            if state is None or not state["is_ready"]:
                raise NotReady(f"{topic} {quarter}: {state}")
        if min_covered:
            whole = quarter_coverage(rows.select(F.lit(topic).alias("source"), ts), "source", ts, HOLE_SECONDS).head()
            if whole is None or whole["covered_share"] < min_covered:
                raise NotReady(f"{topic} {quarter}: {whole}")
        computed = compute(rows) if sums is None else partials.added_up(sums, topic)
        features = stamp(computed, key, F.lit(computed_at).cast("timestamp")).select(*output.names)
        features.persist()  # aggregated rows, read by the check and the write
        try:
            state = key_uniqueness(features, table, key).head()
            if state["duplicated_keys"]:
                raise ValueError(f"keys that are not unique: {state}")
            path = f"{base}/analytics/{table}"
            overwrite_quarters(features, path, [quarter])
        finally:
            features.unpersist()
        written[topic] = path
        for name, report, lead_days in REPORTS[topic]:
            found = report(in_quarter(raw, ts, quarter, lead_days))
            if lead_days:  # what went before only fills the frames
                found = in_quarter(found, ts, quarter)
            written[name] = f"{base}/analytics/{name}"
            overwrite_quarter(found, written[name], quarter)
    return written


def refresh_partials(spark: SparkSession, base: str, topic: str) -> derived.State:
    """Store the partial sums of the raw folders that have none: new batches, and folders that were written again.

    Compaction needs no new sums, erasure those of the folders it rewrote.
    """
    use_utc(spark)
    return derived.refresh(
        spark, f"{base}/raw/{topic}", CONTRACTS[topic][0], f"{base}/partials/{topic}",
        lambda rows, by: partials.partial_sums(rows, topic, by), additive=True,
    )


def partial_rows(spark: SparkSession, base: str, topic: str) -> DataFrame:
    """The partial sums of all raw rows that count, brought up to date."""
    found = refresh_partials(spark, base, topic)
    schema = partials.schema(topic, CONTRACTS[topic][0])
    return derived.read(spark, f"{base}/partials/{topic}", schema, found.counting)


def compact_topic(
    spark: SparkSession, topic: str, base: str, before: str | None = None, target: int = layout.TARGET_BYTES,
    keep_hours: float = 24.0,
) -> layout.Compaction:
    """Merge the small files of a topic's raw table, and delete what was replaced long enough ago. ``before`` leaves out
    batches from that name on: while a flush runs, the batch it writes."""
    use_utc(spark)
    contract, _, sort_by = CONTRACTS[topic]
    path = f"{base}/raw/{topic}"
    found = layout.compact(spark, path, contract, sort_by, target, before)
    layout.vacuum(spark, path, keep_hours)
    return found


def retain_topic(spark: SparkSession, topic: str, base: str, oldest: str) -> list[str]:
    """Remove a topic's raw rows from before ``oldest``; returns the folders that went."""
    use_utc(spark)
    return privacy.retain(spark, f"{base}/raw/{topic}", CONTRACTS[topic][0], oldest)


def erase_topic(spark: SparkSession, topic: str, base: str, column: str, ids: str) -> int:
    """Remove a topic's raw rows whose ``column`` is named in a CSV file; returns the folders touched."""
    use_utc(spark)
    contract = CONTRACTS[topic][0]
    named = spark.read.csv(ids, header=True).select(F.col(column).cast(contract[column].dataType).alias(column))
    return privacy.erase(spark, f"{base}/raw/{topic}", contract, column, named)


def replay_topic(spark: SparkSession, topic: str, base: str, run: str) -> int:
    """Take a topic's quarantined messages again under today's contract; returns how many were moved."""
    use_utc(spark)
    contract, ts, sort_by = CONTRACTS[topic]
    return replay.replay(spark, contract, ts, f"{base}/raw/{topic}", f"{base}/quarantine/{topic}", run, sort_by)


def add_logs(spark: SparkSession, path: str, base: str, batch: str) -> None:
    """Add log files to the table of log entries, health checks left out. A batch that is added again replaces itself."""
    use_utc(spark)
    write_logs(without_health_checks(entries(read_log_lines(spark, path))), f"{base}/logs", batch)


def profile_csv(spark: SparkSession, path: str, out: str) -> None:
    """The profile of CSV files, written as three tables."""
    use_utc(spark)
    rows = read_csv(spark, path)
    numeric = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    for name, table in profile(rows, text, numeric).items():
        table.write.mode("overwrite").parquet(f"{out}/{name}")


def serve(spark: SparkSession, base: str, topics: tuple[str, ...] = tuple(CONTRACTS)) -> list[str]:
    """Make the raw tables, feature tables and reports below ``base`` available to SQL under their names."""
    tables = {}
    for topic in topics:
        contract = CONTRACTS[topic][0]
        name, _, _, output = FEATURES[topic]
        tables[topic] = read_raw(spark, f"{base}/raw/{topic}", contract)
        tables[name] = read_features(spark, f"{base}/analytics/{name}", output)
        for report, _, _ in REPORTS[topic]:
            tables[report] = spark.read.parquet(f"{base}/analytics/{report}")
    register(spark, tables)
    return sorted(tables)


def profile(rows: DataFrame, categorical: list[str], numeric: list[str]) -> dict[str, DataFrame]:
    """The profile of a source: columns, category frequencies and quantiles."""
    return {
        "columns": profile_columns(rows, rows.columns, tuple(categorical)),
        "categories": category_frequencies(rows, categorical),
        "quantiles": quantile_profile(rows, numeric),
    }
