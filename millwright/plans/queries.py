"""The registered queries. Each runs over its whole table; timestamps are returned without a zone
(UTC wall time), which is how the check engine holds them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright import contracts as c
from millwright.functions.casting import iso_parse, iso_text
from millwright.operators import (
    coverage,
    features,
    lineage,
    logs,
    ordering,
    partials,
    privacy,
    profile,
    project,
    quality,
    rolling,
    sampling,
    summaries,
    tumbling,
)
from millwright.plans import fixtures as fx, jobs
from millwright.session import shared_dir
from millwright.sources import derived, files, layout, tables
from millwright.sources.messages import as_messages, publish_files, stream_files
from millwright.sources.tables import overwrite_quarters, read_raw
from millwright.streaming import history, replay
from millwright.streaming.ingest import checked, ingest
from millwright.streaming.live import current, fold, latest, live_aggregate

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the check SQL.
WINDOW_END = "2001-06-30"
WINDOW_DAYS = 18 * 30
QUARTER = "1998-04-01"
QUARTER_LAST_DAY = "1998-06-30"
MAD_K = 1.5
TOP_K = 2
SALT = "plant-7"
OLDEST_DAY = "2023-07-01"
ERASED_EVERY = 1000  # ids that erasure requests name
SAMPLE_PERCENT = 10
SAMPLE_SEED = 42
BOOTSTRAP_RATE = 0.5
BOOTSTRAP_ROWS = 1500
HEAVY_K = 20
LONGER_ASSET_ID = 100
REBUILT_QUARTER = "2023-04-01"
READY_ROWS = 100
READY_GAP_DAYS = 7
INGESTED_IN = 4  # batches, each of which spans the whole period
ASSET_GAP_SECONDS = 7 * 86_400
LATE_RATE = 0.4
MERGED_AT = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)

CATEGORICAL = ["asset_id", "shipment_status", "traffic_status", "logistics_delay_reason"]
LOGISTICS_COLUMNS = [
    f.name for f in c.LOGISTICS_EVENTS.fields if f.name not in ("event_id", "ingested_at")
]
HRSS_COLUMNS = [
    f.name for f in c.HRSS_TELEMETRY.fields if f.name not in ("reading_id", "ingested_at")
]
ROLLING_COLUMNS = ["event_id", "asset_id", "event_timestamp", "waiting_time_min", "logistics_delay"]
KEY_COLUMNS = ["asset_id", "event_timestamp", "logistics_delay"]
AMOUNT_COLUMNS = ["event_id", "asset_id", "user_transaction_amount"]
QUANTILE_COLUMNS = ["cycle_elapsed_sec", "label"] + [f"{axis}_power_w" for axis in c.AXES]

_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = function(spark, sf_dir)
        zoned = [f.name for f in result.schema.fields if isinstance(f.dataType, T.TimestampType)]
        return result.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned})

    run.__doc__ = function.__doc__
    _REGISTRY[function.__name__] = run
    return function


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- features ------------------------------------------------------------------------------------

@query
def logistics_features_quarterly(spark, sf_dir):
    return features.logistics_features(fx.logistics_events(spark, sf_dir, parts=True))


@query
def hrss_features_quarterly(spark, sf_dir):
    return features.hrss_features(fx.hrss_telemetry(spark, sf_dir))


@query
def anomaly_rate_quarterly(spark, sf_dir):
    return features.anomaly_rate(fx.hrss_telemetry(spark, sf_dir))


@query
def anomaly_rate_by_axis(spark, sf_dir):
    return features.anomaly_rate_by_axis(fx.hrss_telemetry(spark, sf_dir))


@query
def energy_efficiency(spark, sf_dir):
    return features.energy_efficiency(fx.hrss_telemetry(spark, sf_dir))


@query
def energy_efficiency_by_axis(spark, sf_dir):
    return features.energy_efficiency_by_axis(fx.hrss_telemetry(spark, sf_dir))


@query
def class_rollup(spark, sf_dir):
    return features.class_rollup(fx.hrss_telemetry(spark, sf_dir))


@query
def rolling_asset_stats(spark, sf_dir):
    return rolling.rolling_asset_stats(fx.logistics_events(spark, sf_dir, ROLLING_COLUMNS))


@query
def rolling_daily_stats(spark, sf_dir):
    return rolling.rolling_daily_stats(fx.logistics_events(spark, sf_dir, ROLLING_COLUMNS))


@query
def quarter_over_quarter(spark, sf_dir):
    return features.quarter_over_quarter(
        features.logistics_features(
            fx.logistics_events(spark, sf_dir, ROLLING_COLUMNS),
            only=("event_count", "delay_rate", "avg_waiting_time_min"),
        )
    )


# --- projection, filter, typing ------------------------------------------------------------------

@query
def project_logistics(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, parts=True)
    back = {new: old for old, new in c.LOGISTICS_SOURCE_NAMES.items()}
    source = events.withColumnsRenamed({**back, "event_timestamp": "Timestamp"})
    return project.project_logistics(source)


@query
def project_hrss(spark, sf_dir):
    readings = fx.hrss_telemetry(spark, sf_dir)
    back = {new: old for old, new in c.HRSS_SOURCE_NAMES.items()}
    return project.project_hrss(readings.withColumnsRenamed(back))


@query
def typed_events(spark, sf_dir):
    return project.to_contract(fx.wire_rows(spark, sf_dir, parts=True), c.LOGISTICS_EVENTS)


@query
def iso_timestamps(spark, sf_dir):
    text = iso_text(F.col("event_timestamp"))
    return fx.logistics_events(spark, sf_dir, ["event_id", "event_timestamp"]).select(
        "event_id", text.alias("iso"), iso_parse(text).alias("parsed")
    )


@query
def window_filter(spark, sf_dir):
    end = F.lit(WINDOW_END).cast("timestamp")
    start = end - F.make_dt_interval(F.lit(WINDOW_DAYS))
    first_day = (date.fromisoformat(WINDOW_END) - timedelta(days=WINDOW_DAYS)).isoformat()
    events = fx.logistics_events(spark, sf_dir, start=first_day, end=WINDOW_END, parts=True)
    return project.time_window(events, "event_timestamp", start, end)


@query
def quarter_filter(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, start=QUARTER, end=QUARTER_LAST_DAY, parts=True)
    return project.in_quarter(events, "event_timestamp", QUARTER)


@query
def class_filter(spark, sf_dir):
    return project.of_class(fx.hrss_telemetry(spark, sf_dir), True, False)


@query
def clip_values(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, parts=True)
    bounds = {"waiting_time_min": (10, 60), "inventory_level": (100, 400)}
    return project.clipped(events, bounds).select("event_id", *bounds)


@query
def rint_values(spark, sf_dir):
    halves = fx.hrss_telemetry(spark, sf_dir).select(
        "reading_id", (F.col("cycle_elapsed_sec").cast("double") * 2).alias("doubled"),
        F.col("cycle_elapsed_sec").cast("double").alias("elapsed"),
    )
    return project.rounded_half_even(halves, ["doubled", "elapsed"])


@query
def to_json_rows(spark, sf_dir):
    return as_messages(fx.logistics_events(spark, sf_dir, parts=True), c.LOGISTICS_EVENTS)


@query
def tagged_union(spark, sf_dir):
    untagged = ["reading_id", "reading_timestamp", *c.HRSS_SOURCE_NAMES.values()]
    readings = fx.hrss_telemetry(spark, sf_dir)
    return files.tagged_union({
        (anomalous, optimised): project.of_class(readings, anomalous, optimised).select(*untagged)
        for anomalous in (False, True)
        for optimised in (False, True)
    })


@query
def tagged_files(spark, sf_dir):
    """The readings as four CSV sources, one per class, read back with the class flags."""
    base = shared_dir(spark, "csv")
    back = {new: old for old, new in c.HRSS_SOURCE_NAMES.items()}
    flags = ["is_anomalous", "is_optimised"]
    source = fx.hrss_telemetry(spark, sf_dir).withColumnsRenamed(back)
    source.select(*c.HRSS_SOURCE_NAMES, *flags).write.partitionBy(*flags).csv(base, header=True)
    cells = {
        (anomalous, optimised): base
        + f"/is_anomalous={anomalous}/is_optimised={optimised}".lower()
        for anomalous in (False, True)
        for optimised in (False, True)
    }
    schema = c.source_schema(c.HRSS_TELEMETRY, c.HRSS_SOURCE_NAMES)
    return project.project_hrss(files.read_tagged(spark, cells, schema))


@query
def served_sql(spark, sf_dir):
    """SQL over the feature tables, as a consumer would write it."""
    tables.register(spark, {
        "served_features": features.hrss_features(fx.hrss_telemetry(spark, sf_dir))
    })
    return spark.sql("""
        select quarter_start, sum(reading_count) as readings, max(avg_hl_power_w) as peak_hl_power_w
        from served_features where not is_anomalous group by quarter_start""")


# --- profiles ------------------------------------------------------------------------------------

@query
def profile_nulls(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir)
    return profile.profile_columns(events, LOGISTICS_COLUMNS, tuple(CATEGORICAL)).drop("kind")


@query
def profile_kinds(spark, sf_dir):
    readings = fx.hrss_telemetry(spark, sf_dir)
    return profile.profile_columns(readings, HRSS_COLUMNS).select(
        "column", "kind", "row_count", "non_null_count"
    )


@query
def profile_categories(spark, sf_dir):
    return profile.category_frequencies(
        fx.logistics_events(spark, sf_dir, CATEGORICAL), CATEGORICAL
    )


@query
def class_weights(spark, sf_dir):
    return profile.class_weights(fx.hrss_telemetry(spark, sf_dir))


@query
def profile_quantiles(spark, sf_dir):
    return profile.quantile_profile(fx.hrss_telemetry(spark, sf_dir), QUANTILE_COLUMNS)


@query
def median_by_group(spark, sf_dir):
    return profile.median_by_group(
        fx.logistics_events(spark, sf_dir, AMOUNT_COLUMNS), "asset_id", "user_transaction_amount"
    )


@query
def hour_profile(spark, sf_dir):
    return profile.hour_profile(
        fx.logistics_events(spark, sf_dir, ["event_timestamp"]), "event_timestamp"
    )


@query
def arrival_rate(spark, sf_dir):
    return profile.arrival_rate(
        fx.logistics_events(spark, sf_dir, ["event_timestamp"]),
        c.TOPIC_LOGISTICS,
        "event_timestamp",
    ).unionByName(
        profile.arrival_rate(fx.hrss_telemetry(spark, sf_dir), c.TOPIC_HRSS, "reading_timestamp")
    )


@query
def top_delay_reasons(spark, sf_dir):
    return profile.top_categories(
        fx.logistics_events(spark, sf_dir, ["logistics_delay_reason"]),
        "logistics_delay_reason",
        TOP_K,
    )


@query
def heavy_hitters(spark, sf_dir):
    return profile.heavy_hitters(
        fx.logistics_events(spark, sf_dir, AMOUNT_COLUMNS), "user_transaction_amount", HEAVY_K
    )


@query
def sort_events(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, ["event_id", "event_timestamp"])
    return ordering.with_position(events, "event_timestamp", "event_id")


@query
def profile_csv(spark, sf_dir):
    """The events as a CSV whose NULL cells are null words, read without a schema and profiled."""
    path = shared_dir(spark, "csv-profile")
    words = F.array(*[F.lit(w) for w in ("NA", "None", "nan", "NULL")])
    events = fx.logistics_events(spark, sf_dir, LOGISTICS_COLUMNS)
    events.select(*[
        F.coalesce(
            F.col(n).cast("string"), F.element_at(words, (F.hash("asset_id") % 2 + 3).cast("int"))
        ).alias(n)
        for n in LOGISTICS_COLUMNS
    ]).write.csv(path, header=True)
    found = files.read_csv(spark, path)
    return profile.profile_columns(found, found.columns)


# --- privacy: pseudonyms, retention, erasure -----------------------------------------------------

@query
def pseudonymised_assets(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, ROLLING_COLUMNS)
    return privacy.pseudonymised(events, ["asset_id"], SALT)


@query
def retained_readings(spark, sf_dir):
    """The readings as a raw table, its dates before the cutoff dropped, read back."""
    path = shared_dir(spark, "retained")
    readings = fx.hrss_telemetry(spark, sf_dir)
    tables.append_raw(readings, path, "reading_timestamp", "0", ["is_anomalous", "is_optimised"])
    privacy.retain(spark, path, c.HRSS_TELEMETRY, OLDEST_DAY)
    return read_raw(spark, path, c.HRSS_TELEMETRY).select(
        *[f.name for f in c.HRSS_TELEMETRY.fields if f.name != "ingested_at"]
    )


@query
def erased_readings(spark, sf_dir):
    """The readings as a raw table, those that erasure requests name removed from it, read back."""
    path = shared_dir(spark, "erased")
    readings = fx.hrss_telemetry(spark, sf_dir)
    tables.append_raw(readings, path, "reading_timestamp", "0", ["is_anomalous", "is_optimised"])
    requests = readings.select("reading_id").where(F.col("reading_id") % ERASED_EVERY == 0)
    privacy.erase(spark, path, c.HRSS_TELEMETRY, "reading_id", requests)
    return read_raw(spark, path, c.HRSS_TELEMETRY).select(
        *[f.name for f in c.HRSS_TELEMETRY.fields if f.name != "ingested_at"]
    )


# --- data quality, lineage -----------------------------------------------------------------------

@query
def validate_events(spark, sf_dir):
    contract = c.wire(c.LOGISTICS_EVENTS)
    return quality.validate(fx.wire_rows(spark, sf_dir), contract).select(
        "event_id", F.concat_ws(",", "reasons").alias("reasons")
    )


@query
def csv_quarantine(spark, sf_dir):
    """Faulty rows as a CSV file, read in the contract's types with what doesn't fit."""
    path = shared_dir(spark, "csv-checked")
    fx.wire_rows(spark, sf_dir).write.csv(path, header=True)
    found = files.read_csv_checked(spark, path, c.wire(c.LOGISTICS_EVENTS))
    return found.select(F.col("event_id").cast("bigint").alias("event_id"), F.concat_ws(",", "reasons").alias("reasons"))


@query
def folded_features(spark, sf_dir):
    """The class features kept by a stream in several batches, some of them folded into a snapshot, read back."""
    base = shared_dir(spark, "folded")
    parts = f"{base}/parts"
    fx.hrss_telemetry(spark, sf_dir).repartition(4, "reading_id").write.parquet(parts)
    stream = spark.readStream.schema(spark.read.parquet(parts).schema).option("maxFilesPerTrigger", 1).parquet(parts)
    live_aggregate(stream, features.hrss_features, f"{base}/updates", f"{base}/checkpoint").awaitTermination()
    for upto in (0, 2):
        fold(spark, f"{base}/updates", list(c.HRSS_KEY), upto)
    return current(spark, f"{base}/updates", list(c.HRSS_KEY))


@query
def range_violations(spark, sf_dir):
    typed = project.to_contract(fx.wire_rows(spark, sf_dir), c.LOGISTICS_EVENTS)
    return quality.range_violations(typed)


@query
def outliers_mad(spark, sf_dir):
    return quality.outliers_mad(
        fx.logistics_events(spark, sf_dir, AMOUNT_COLUMNS),
        "event_id", "asset_id", "user_transaction_amount", MAD_K,
    )


@query
def missing_by_quarter(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir)
    return quality.missing_by_quarter(events, "event_timestamp", LOGISTICS_COLUMNS)


@query
def key_uniqueness(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, KEY_COLUMNS)
    logistics = features.logistics_features(events, only=("event_count",))
    hrss = features.hrss_features(fx.hrss_telemetry(spark, sf_dir))
    return (
        quality.key_uniqueness(logistics, "logistics_features_quarterly", c.LOGISTICS_KEY)
        .unionByName(quality.key_uniqueness(hrss, "hrss_features_quarterly", c.HRSS_KEY))
        .unionByName(
            quality.key_uniqueness(events, "logistics_events", ("asset_id", "event_timestamp"))
        )
    )


@query
def raw_readiness(spark, sf_dir):
    return quality.raw_readiness(
        fx.hrss_telemetry(spark, sf_dir), "reading_timestamp", READY_ROWS, READY_GAP_DAYS
    )


@query
def dedup_events(spark, sf_dir):
    return quality.first_delivery(
        fx.deliveries(spark, sf_dir), ["topic", "partition", "offset"], ["delivery"]
    )


@query
def lineage_semi(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, ["event_id", *KEY_COLUMNS])
    late = features.logistics_features(
        fx.logistics_events(spark, sf_dir, KEY_COLUMNS), only=("delay_rate",)
    ).where("delay_rate > 0.4")
    return lineage.trace(events, late)


@query
def reconcile_anti(spark, sf_dir):
    """Feature rows from the events whose delay flag is known, against all raw events."""
    events = fx.logistics_events(spark, sf_dir, KEY_COLUMNS)
    published = features.logistics_features(
        events.where("logistics_delay is not null"), only=("event_count",)
    )
    return lineage.reconcile(events, published)


# --- sampling ------------------------------------------------------------------------------------

@query
def bootstrap_sample(spark, sf_dir):
    return sampling.bootstrap_sample(fx.hrss_telemetry(spark, sf_dir), "reading_id", BOOTSTRAP_RATE, SAMPLE_SEED)


@query
def bootstrap_exact(spark, sf_dir):
    return sampling.bootstrap_exact(fx.hrss_telemetry(spark, sf_dir), "reading_id", BOOTSTRAP_ROWS, SAMPLE_SEED)


@query
def stratified_sample(spark, sf_dir):
    return sampling.stratified_sample(
        fx.hrss_telemetry(spark, sf_dir), ["is_anomalous", "is_optimised"], "reading_id", SAMPLE_PERCENT, SAMPLE_SEED
    )


# --- windows over time, logs ---------------------------------------------------------------------

@query
def tumbling_counts(spark, sf_dir):
    return tumbling.tumbling_counts(
        fx.hrss_telemetry(spark, sf_dir), "reading_timestamp", "is_anomalous"
    )


@query
def tumbling_counts_by_asset(spark, sf_dir):
    return tumbling.tumbling_counts(
        fx.logistics_events(spark, sf_dir, KEY_COLUMNS), "event_timestamp", "asset_id", "1 day"
    )


@query
def parse_logs(spark, sf_dir):
    return logs.without_health_checks(logs.parse_lines(fx.log_lines(spark, sf_dir)))


@query
def log_levels_daily(spark, sf_dir):
    return logs.levels_per_day(
        logs.without_health_checks(logs.parse_lines(fx.log_lines(spark, sf_dir)))
    )


# --- jobs and streams, end to end ----------------------------------------------------------------

@query
def ingest_stream(spark, sf_dir):
    """Publish every reading as a JSON message, flush the messages with a stream, read the raw
    table back."""
    base = shared_dir(spark, "ingest")
    contract = c.wire(c.HRSS_TELEMETRY)
    publish_files(as_messages(fx.hrss_telemetry(spark, sf_dir), contract), f"{base}/landing")
    ingest(
        stream_files(spark, f"{base}/landing", c.TOPIC_HRSS),
        c.HRSS_TELEMETRY, "reading_timestamp", f"{base}/raw", f"{base}/quarantine",
        f"{base}/checkpoint", ["is_anomalous", "is_optimised", "reading_timestamp"],
    ).awaitTermination()
    return read_raw(spark, f"{base}/raw", c.HRSS_TELEMETRY).select(*contract.names)


@query
def live_features(spark, sf_dir):
    """The quarterly class features kept by a stream over the readings, read back when the stream
    has taken all of them."""
    base = shared_dir(spark, "live")
    source = fx.events_stream(spark, sf_dir)
    live_aggregate(
        fx.hrss_from(spark, source), features.hrss_features, f"{base}/updates", f"{base}/checkpoint",
    ).awaitTermination()
    return latest(spark.read.parquet(f"{base}/updates"), list(c.HRSS_KEY))


@query
def overwritten_quarters(spark, sf_dir):
    """Write the feature table, write it again, read it back: one copy of every quarter."""
    base = shared_dir(spark, "features")
    computed = features.hrss_features(fx.hrss_telemetry(spark, sf_dir))
    quarters = [
        r[0] for r in computed.select(F.date_format("quarter_start", "yyyy-MM-dd")).distinct()
        .collect()  # one row per calendar quarter
    ]
    for _ in range(2):
        overwrite_quarters(computed, f"{base}/hrss", quarters)
    return spark.read.parquet(f"{base}/hrss")


@query
def quarterly_tables(spark, sf_dir):
    """The quarterly job over the stored readings, its reports read back by SQL."""
    base = shared_dir(spark, "quarterly")
    topic = (c.TOPIC_HRSS,)
    tables.append_raw(
        fx.hrss_telemetry(spark, sf_dir), f"{base}/raw/{c.TOPIC_HRSS}", "reading_timestamp", "0",
        ["is_anomalous", "is_optimised"],
    )
    moment = datetime(2024, 1, 1, tzinfo=timezone.utc)
    jobs.quarterly(spark, REBUILT_QUARTER, base, moment, topics=topic)
    jobs.serve(spark, base, topic)
    return spark.sql("""
        select e.quarter_start, e.axis, e.power_ratio, a.anomalous_power_share, r.anomaly_rate, f.reading_count
        from energy_efficiency_by_axis e join anomaly_rate_by_axis a using (quarter_start, axis)
        join anomaly_rate r using (quarter_start)
        join (select quarter_start, sum(reading_count) as reading_count
            from hrss_features_quarterly group by quarter_start) f using (quarter_start)""")


# --- tables kept batch by batch ------------------------------------------------------------------

def _ingested(rows, row_id, path, ts, sort_by, order=tuple(range(INGESTED_IN))):
    for k in order:
        tables.append_raw(rows.where(F.pmod(row_id, F.lit(INGESTED_IN)) == k), path, ts, f"{k:012d}", sort_by)


@query
def compacted_readings(spark, sf_dir):
    """The readings ingested in several batches, their small files merged, read back."""
    path = shared_dir(spark, "compacted")
    sort_by = ["is_anomalous", "is_optimised"]
    _ingested(fx.hrss_telemetry(spark, sf_dir), "reading_id", path, "reading_timestamp", sort_by)
    layout.compact(spark, path, c.HRSS_TELEMETRY, sort_by)
    return read_raw(spark, path, c.HRSS_TELEMETRY).select(
        *[f.name for f in c.HRSS_TELEMETRY.fields if f.name != "ingested_at"]
    )


def _incremental(spark, topic, rows, row_id):
    """Batches out of order, sums brought up to date in between, a batch delivered again, and a compaction."""
    base = shared_dir(spark, "incremental")
    contract, ts, sort_by = jobs.CONTRACTS[topic]
    path = f"{base}/raw/{topic}"
    for order in ((2, 0), (3, 1, 0)):
        _ingested(rows, row_id, path, ts, sort_by, order)
        jobs.refresh_partials(spark, base, topic)
    jobs.compact_topic(spark, topic, base)
    return partials.added_up(jobs.partial_rows(spark, base, topic), topic)


@query
def incremental_hrss_features(spark, sf_dir):
    return _incremental(spark, c.TOPIC_HRSS, fx.hrss_telemetry(spark, sf_dir), "reading_id")


@query
def incremental_logistics_features(spark, sf_dir):
    return _incremental(spark, c.TOPIC_LOGISTICS, fx.logistics_events(spark, sf_dir), "event_id")


@query
def recognised_messages(spark, sf_dir):
    """The readings as messages in two batches, then the anomalous ones delivered again: every payload once."""
    base = shared_dir(spark, "recognised")
    contract = c.wire(c.HRSS_TELEMETRY)
    readings = fx.hrss_telemetry(spark, sf_dir)
    batches = [readings.where(F.pmod("reading_id", F.lit(2)) == k) for k in (0, 1)] + [readings.where("is_anomalous")]
    for k, rows in enumerate(batches):
        checked(as_messages(rows, contract), c.HRSS_TELEMETRY).write.parquet(f"{base}/checked/{k}")
        fresh = history.first_deliveries(
            spark, quality.accepted(spark.read.parquet(f"{base}/checked/{k}")), "reading_timestamp", f"{base}/history",
            f"{k:012d}", ["value"],
        )
        history.remember(spark, fresh, "reading_timestamp", f"{base}/history", f"{k:012d}")
        tables.append_raw(fresh.select(*contract.names), f"{base}/raw", "reading_timestamp", f"{k:012d}", [])
    return read_raw(spark, f"{base}/raw", c.HRSS_TELEMETRY).select(*contract.names)


@query
def missing_intervals(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, ["asset_id", "event_timestamp"])
    return coverage.missing_intervals(events, "asset_id", "event_timestamp", ASSET_GAP_SECONDS)


@query
def quarter_coverage(spark, sf_dir):
    events = fx.logistics_events(spark, sf_dir, ["asset_id", "event_timestamp"])
    return coverage.quarter_coverage(events, "asset_id", "event_timestamp", ASSET_GAP_SECONDS)


@query
def log_entries(spark, sf_dir):
    """The log lines as one file per service, in order, read back as entries with their traces."""
    path = shared_dir(spark, "log-files")
    lines = fx.log_lines(spark, sf_dir, "ts", "event_id").repartition("service")
    lines.sortWithinPartitions("service", "ts", "event_id").select("service", "line").write.partitionBy("service").text(path)
    # the folder names the service here, and a file is read in the order it was written in
    by_folder = F.regexp_extract("file", "service=([^/]*)/", 1)
    return logs.entries(tables.read_log_lines(spark, path).withColumn("service", by_folder)).drop("file")


@query
def traced_events(spark, sf_dir):
    """Raw events behind the features of assets that were often late, found by the files recorded with the features."""
    path = shared_dir(spark, "traced")
    tables.append_raw(fx.logistics_events(spark, sf_dir), path, "event_timestamp", "0", ["asset_id"])
    record_path = shared_dir(spark, "record")
    lineage.recorded(read_raw(spark, path, c.LOGISTICS_EVENTS), c.TOPIC_LOGISTICS).write.parquet(record_path)
    record = spark.read.parquet(record_path)
    late = partials.added_up(record, c.TOPIC_LOGISTICS).where(F.col("delay_rate") > LATE_RATE)
    return lineage.trace_recorded(spark, record, late, c.TOPIC_LOGISTICS, c.LOGISTICS_EVENTS).drop("ingested_at")


@query
def replayed_quarantine(spark, sf_dir):
    """Faulty messages ingested, then those in quarantine taken again under a contract with longer asset ids."""
    base = shared_dir(spark, "replayed")
    contract = c.wire(c.LOGISTICS_EVENTS)
    text = F.to_json(F.struct(*contract.names), {"ignoreNullFields": "false"})
    publish_files(fx.wire_rows(spark, sf_dir).select(text.alias("value")), f"{base}/landing")
    paths = (f"{base}/raw", f"{base}/quarantine")
    ingest(
        stream_files(spark, f"{base}/landing", c.TOPIC_LOGISTICS), c.LOGISTICS_EVENTS, "event_timestamp", *paths,
        f"{base}/checkpoint", ["asset_id"],
    ).awaitTermination()
    longer = c.with_length(c.LOGISTICS_EVENTS, "asset_id", LONGER_ASSET_ID)
    replay.replay(spark, longer, "event_timestamp", *paths, "longer-ids", ["asset_id"])
    return read_raw(spark, f"{base}/raw", c.LOGISTICS_EVENTS).select(*contract.names)


@query
def merged_quantiles(spark, sf_dir):
    """Quantiles of the readings from summaries stored batch by batch, with the places that the values have among all
    rows. The last column says whether these lie within the summaries' error."""
    base = shared_dir(spark, "summaries")
    contract, columns = c.HRSS_TELEMETRY, QUANTILE_COLUMNS
    readings = fx.hrss_telemetry(spark, sf_dir)
    _ingested(readings, "reading_id", f"{base}/raw", "reading_timestamp", ["is_anomalous"])
    state = derived.refresh(
        spark, f"{base}/raw", contract, f"{base}/summaries", lambda rows, by: summaries.summaries(rows, columns, by), additive=True
    )
    found = summaries.merged_quantiles(derived.read(spark, f"{base}/summaries", summaries.SCHEMA, state.counting), list(MERGED_AT))
    values = readings.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(n).cast("double").alias("x")) for n in columns
    ])))
    # each value is counted against the few quantiles of its column
    places = values.join(found, "column").groupBy("column", "probability", "n").agg(
        F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    slack = summaries.ERROR * F.col("n") + 1
    target = F.col("probability") * F.col("n")
    return places.select(
        "column", "probability", F.col("n").alias("row_count"),
        ((F.col("below") <= target + slack) & (F.col("upto") >= target - slack)).alias("within_error"),
    )
