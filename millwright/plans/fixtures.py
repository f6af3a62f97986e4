"""Contract-shaped views over the benchmark tables.

The tables the operators are written for come from a plant. For checks and benchmarks these views
give ``lineitem``, ``part`` and ``events`` the same columns, types and value ranges. A view body is
one SELECT list, shared with the check SQL; only a few function names differ between the engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.session import use_utc

_LOGISTICS = """
    cast(conv(substring(md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 15),
        16, 10) as bigint) as event_id,
    timestamp_micros(unix_micros(l_shipdate) + (l_orderkey*7919 + l_linenumber*3607) % 86400 * 1000000)
        as event_timestamp,
    concat('ASSET-', cast(l_suppkey as string)) as asset_id,
    cast(cast(l_suppkey*37 % 18000 as double)/100 - 90 as decimal(9,4)) as latitude,
    cast(cast(l_suppkey*91 % 36000 as double)/100 - 180 as decimal(9,4)) as longitude,
    case when (l_orderkey + l_linenumber) % 200 = 0 then null else cast(STOCK as int) end
        as inventory_level,
    case when l_linestatus = 'F' then 'Delivered' when l_returnflag = 'N' then 'In Transit'
         else 'Delayed' end as shipment_status,
    cast(18 + l_tax*100 as decimal(5,2)) as temperature_c,
    cast(50 + l_discount*200 as decimal(5,2)) as humidity_pct,
    case l_linenumber % 3 when 0 then 'Clear' when 1 then 'Heavy' else 'Detour' end
        as traffic_status,
    cast(floor(l_tax*1000 + 0.5) as int) as waiting_time_min,
    case when (l_orderkey + l_suppkey) % 200 = 0 then null
         else cast(floor(l_extendedprice) as int) end as user_transaction_amount,
    cast(l_linenumber as int) as user_purchase_frequency,
    case when l_returnflag <> 'R' then null when l_linenumber % 3 = 0 then 'Weather'
         when l_linenumber % 3 = 1 then 'Traffic' else 'Mechanical' end as logistics_delay_reason,
    cast(l_quantity*2 as decimal(5,2)) as asset_utilization_pct,
    cast(FORECAST as int) as demand_forecast,
    case when (l_orderkey + l_partkey) % 200 = 0 then null else l_returnflag = 'R' end
        as logistics_delay
"""

#: What an event's stock and forecast are made from: its part, or the part's key alone.
_OF_PART = {"STOCK": "p_size*10", "FORECAST": "floor(p_retailprice)"}
_OF_KEY = {"STOCK": "(l_partkey % 50 + 1)*10", "FORECAST": "900 + l_partkey % 1100"}


def _logistics(parts: bool) -> str:
    body = _LOGISTICS
    for name, value in (_OF_PART if parts else _OF_KEY).items():
        body = body.replace(name, value)
    return body


_AXIS = """
    cast(floor(value*{mm}) as int) % 997 as {axis}_position_mm,
    cast(floor(value*{w}) as int) % {cap} as {axis}_power_w,
    cast(24 + user_id % {v} as int) as {axis}_voltage_v,"""

_AXES = "".join(
    _AXIS.format(axis=axis, mm=2 * i + 3, w=i + 1, cap=97 + i, v=i + 3)
    for i, axis in enumerate(("blo", "bhl", "bhr", "bru", "hr", "hl"))
)

_HRSS = f"""
    event_id as reading_id,
    ts - make_ym_interval(0,cast(user_id % 18 as int)) as reading_timestamp,
    cast(cast(event_id % 100000 as double)/16 as decimal(14,7)) as cycle_elapsed_sec,{_AXES}
    cast(case when cast(get_json_object(props,'$.k') as int) >= 80 then 1 else 0 end as smallint)
        as label,
    event_type = 'error' as is_anomalous,
    event_id % 2 = 0 as is_optimised
"""

# Log lines: JSON, plain, health checks and a trace's continuation lines.
_LOGS = """
    concat('service-', cast(user_id % 5 as string)) as service,
    case
        when event_type = 'purchase' then concat(
            '{"time": "', DAYTEXT, '", "level": "INFO", "logger": "jobs.',
            cast(user_id % 7 as string), '", "message": "batch ', cast(event_id as string), '"}')
        when event_type = 'view' and event_id % 3 = 0 then concat(
            DAYTEXT, ',000 INFO web: GET /health 200')
        when event_type = 'error' and event_id % 2 = 0 then concat(
            '  File "job.py", line ', cast(event_id as string))
        else concat(
            DAYTEXT, ',000 ',
            case event_type when 'error' then 'ERROR' when 'signup' then 'WARNING' else 'INFO' end,
            ' stage.', cast(user_id % 11 as string), ': row ', cast(event_id as string),
            ' took ', cast(user_id as string), ' ms')
    end as line
"""

# Message fields as text, with faults planted by key: too long, overflowing, not a number, absent.
_WIRE = """
    event_id,
    case when event_id % 97 = 0 then null else strftime_iso(event_timestamp) end
        as event_timestamp,
    case when event_id % 89 = 0 then concat(asset_id, repeat('-', 50))
         when event_id % 83 = 0 then null else asset_id end as asset_id,
    cast(cast(cast(latitude as double)*1.25 as decimal(9,4)) as string) as latitude,
    cast(longitude as string) as longitude,
    cast(inventory_level as string) as inventory_level,
    shipment_status,
    case when event_id % 79 = 0 then '1234.5' else cast(temperature_c as string) end
        as temperature_c,
    cast(cast(humidity_pct*2 as decimal(5,2)) as string) as humidity_pct,
    traffic_status,
    case when event_id % 73 = 0 then 'soon' else cast(waiting_time_min as string) end
        as waiting_time_min,
    cast(user_transaction_amount as string) || '.5' as user_transaction_amount,
    cast(user_purchase_frequency as string) as user_purchase_frequency,
    logistics_delay_reason,
    cast(asset_utilization_pct as string) as asset_utilization_pct,
    cast(demand_forecast as string) as demand_forecast,
    case when event_id % 71 = 0 then 'maybe'
         when logistics_delay is null then null when logistics_delay then '1' else '0' end
        as logistics_delay
"""


def _select(spark: SparkSession, columns: str, source: DataFrame, name: str) -> DataFrame:
    literal = columns.replace("{", "{{").replace("}", "}}")  # braces in the text are not fields
    return spark.sql("select " + literal + " from {" + name + "}", **{name: source})


def _utc(schema: T.StructType) -> T.StructType:
    """The tables' timestamps carry no zone. Read as instants they keep their number, which is
    UTC wall time, and need no conversion per row."""
    return T.StructType([
        T.StructField(f.name, T.TimestampType())
        if isinstance(f.dataType, T.TimestampNTZType) else f
        for f in schema.fields
    ])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_utc(spark.read.parquet(path).schema)).parquet(path)


def logistics_events(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    parts: bool = False,
) -> DataFrame:
    """All columns, or those named.

    With ``parts`` stock and forecast come from the event's part. The join is an outer one: an event exists whether or
    not its part is known.

    ``start`` and ``end`` (dates) bound the scan where the caller filters on event time: an event
    falls on its ship date, so the bounds reach the file's statistics.
    """
    lineitem = _table(spark, sf_dir, "lineitem")
    if start:
        lineitem = lineitem.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp"))
    if end:
        lineitem = lineitem.where(F.col("l_shipdate") <= F.lit(end).cast("timestamp"))
    if parts:
        part = _table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
        # No hint: the size of ``part`` decides the strategy.
        lineitem = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    view = _select(spark, _logistics(parts), lineitem, "source")
    return view.select(*columns) if columns else view


def hrss_from(spark: SparkSession, events: DataFrame) -> DataFrame:
    return _select(spark, _HRSS, events, "source")


def hrss_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hrss_from(spark, _table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a stream of its files."""
    use_utc(spark)
    schema = _utc(spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    # A glob, because a stream takes a plain path for a folder and the table may be one file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def log_lines(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """Columns ``also`` are the table's own."""
    body = ", ".join([_LOGS.replace("DAYTEXT", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')"), *also])
    return _select(spark, body, _table(spark, sf_dir, "events"), "source")


def wire_rows(spark: SparkSession, sf_dir: str, parts: bool = False) -> DataFrame:
    body = _WIRE.replace(
        "strftime_iso(event_timestamp)",
        "date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    )
    return _select(spark, body, logistics_events(spark, sf_dir, parts=parts), "source")


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as delivered: every reading once, and those of anomalous cycles a second time."""
    readings = hrss_telemetry(spark, sf_dir).select(
        F.lit("hrss_telemetry").alias("topic"),
        (F.col("reading_id") % 8).cast("int").alias("partition"),
        F.col("reading_id").alias("offset"),
        "reading_timestamp",
        "blo_power_w",
        "is_anomalous",
        F.lit(1).alias("delivery"),
    )
    again = readings.where("is_anomalous").withColumn("delivery", F.lit(2))
    return readings.unionByName(again)


def _duck(columns: str) -> str:
    return (
        columns.replace("conv(substring(", "concat('0x', substring(")
        .replace("1, 15),\n        16, 10)", "1, 15))")
        .replace("timestamp_micros(unix_micros(", "make_timestamp(epoch_us(")
        .replace("make_ym_interval(0,", "to_months(")
        .replace("get_json_object(props,'$.k')", "json_extract_string(props,'$.k')")
        .replace("DAYTEXT", "strftime(ts, '%Y-%m-%d %H:%M:%S')")
        .replace("strftime_iso(event_timestamp)", "strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ')")
    )


def check_views(parts: bool = False) -> dict[str, str]:
    """The same views as named subqueries for the check SQL."""
    logistics = f"select {_duck(_logistics(parts))} from lineitem"
    if parts:
        logistics += " left join part on l_partkey = p_partkey"
    return {
        "logistics_events": logistics,
        "hrss_telemetry": f"select {_duck(_HRSS)} from events",
        "log_lines": f"select {_duck(_LOGS)} from events",
        "placed_lines": f"select {_duck(_LOGS)}, ts, event_id from events",
        "wire_rows": f"select {_duck(_WIRE)} from logistics_events",
        "deliveries": """
            select 'hrss_telemetry' as topic, cast(reading_id % 8 as int) as "partition",
                   reading_id as "offset", reading_timestamp, blo_power_w, is_anomalous,
                   1 as delivery from hrss_telemetry
            union all
            select 'hrss_telemetry', cast(reading_id % 8 as int), reading_id, reading_timestamp,
                   blo_power_w, is_anomalous, 2 from hrss_telemetry where is_anomalous""",
    }
