"""Table contracts: one StructType per table, plus rename maps and value rules.

All timestamps are instants and every calendar term (quarter, date, hour) is taken in UTC.

Two output types are wider than a desktop-sized deployment would need: counts are BIGINT and
``total_power_w`` is DECIMAL(24,2). With 100 TB of readings one class holds more than 2**31 rows
and its summed power passes 10**12, and an ANSI session would fail the job on the narrower types.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: axes, signals and source column names -----------------------------------------

AXES = ("blo", "bhl", "bhr", "bru", "hr", "hl")
SIGNALS = ("position_mm", "power_w", "voltage_v")

LOGISTICS_SOURCE_NAMES = {
    "Asset_ID": "asset_id",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Inventory_Level": "inventory_level",
    "Shipment_Status": "shipment_status",
    "Temperature": "temperature_c",
    "Humidity": "humidity_pct",
    "Traffic_Status": "traffic_status",
    "Waiting_Time": "waiting_time_min",
    "User_Transaction_Amount": "user_transaction_amount",
    "User_Purchase_Frequency": "user_purchase_frequency",
    "Logistics_Delay_Reason": "logistics_delay_reason",
    "Asset_Utilization": "asset_utilization_pct",
    "Demand_Forecast": "demand_forecast",
    "Logistics_Delay": "logistics_delay",
}

# The source's own Timestamp is seconds since the cycle began, not a calendar time.
HRSS_SOURCE_NAMES = {"Timestamp": "cycle_elapsed_sec", "Labels": "label"}
for _axis in AXES:
    HRSS_SOURCE_NAMES[f"I_w_{_axis.upper()}_Weg"] = f"{_axis}_position_mm"
    HRSS_SOURCE_NAMES[f"O_w_{_axis.upper()}_power"] = f"{_axis}_power_w"
    HRSS_SOURCE_NAMES[f"O_w_{_axis.upper()}_voltage"] = f"{_axis}_voltage_v"

TOPIC_LOGISTICS = "logistics_events"
TOPIC_HRSS = "hrss_telemetry"

# --- end of fixed values -------------------------------------------------------------------------


def _text(name: str, max_length: int, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"max_length": max_length})


def _field(name: str, data_type: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, data_type, nullable)


_ID_AND_ARRIVAL = ("event_id", "reading_id", "ingested_at")

LOGISTICS_EVENTS = T.StructType([
    _field("event_id", T.LongType(), False),
    _field("event_timestamp", T.TimestampType(), False),
    _text("asset_id", 50, False),
    _field("latitude", T.DecimalType(9, 4)),
    _field("longitude", T.DecimalType(9, 4)),
    _field("inventory_level", T.IntegerType()),
    _text("shipment_status", 50),
    _field("temperature_c", T.DecimalType(5, 2)),
    _field("humidity_pct", T.DecimalType(5, 2)),
    _text("traffic_status", 50),
    _field("waiting_time_min", T.IntegerType()),
    _field("user_transaction_amount", T.IntegerType()),
    _field("user_purchase_frequency", T.IntegerType()),
    _text("logistics_delay_reason", 100),
    _field("asset_utilization_pct", T.DecimalType(5, 2)),
    _field("demand_forecast", T.IntegerType()),
    _field("logistics_delay", T.BooleanType()),
    _field("ingested_at", T.TimestampType(), False),
])

HRSS_TELEMETRY = T.StructType(
    [
        _field("reading_id", T.LongType(), False),
        _field("reading_timestamp", T.TimestampType(), False),
        _field("cycle_elapsed_sec", T.DecimalType(14, 7)),
    ]
    + [_field(f"{axis}_{signal}", T.IntegerType()) for axis in AXES for signal in SIGNALS]
    + [
        _field("label", T.ShortType()),
        _field("is_anomalous", T.BooleanType(), False),
        _field("is_optimised", T.BooleanType(), False),
        _field("ingested_at", T.TimestampType(), False),
    ]
)

LOGISTICS_FEATURES = T.StructType([
    _field("feature_id", T.LongType(), False),
    _field("quarter_start", T.DateType(), False),
    _text("asset_id", 50, False),
    _field("event_count", T.LongType()),
    _field("delay_rate", T.DecimalType(5, 4)),
    _field("avg_waiting_time_min", T.DecimalType(8, 2)),
    _field("avg_inventory_level", T.DecimalType(10, 2)),
    _field("avg_asset_utilization_pct", T.DecimalType(5, 2)),
    _field("avg_temperature_c", T.DecimalType(6, 2)),
    _field("avg_humidity_pct", T.DecimalType(6, 2)),
    _field("total_transaction_amount", T.LongType()),
    _field("computed_at", T.TimestampType(), False),
])

HRSS_FEATURES = T.StructType(
    [
        _field("feature_id", T.LongType(), False),
        _field("quarter_start", T.DateType(), False),
        _field("is_anomalous", T.BooleanType(), False),
        _field("is_optimised", T.BooleanType(), False),
        _field("reading_count", T.LongType()),
    ]
    + [_field(f"avg_{axis}_power_w", T.DecimalType(10, 2)) for axis in AXES]
    + [
        _field("total_power_w", T.DecimalType(24, 2)),
        _field("anomaly_label_rate", T.DecimalType(5, 4)),
        _field("computed_at", T.TimestampType(), False),
    ]
)

LOGISTICS_KEY = ("quarter_start", "asset_id")
HRSS_KEY = ("quarter_start", "is_anomalous", "is_optimised")

EVENT_TIME = {"logistics_events": "event_timestamp", "hrss_telemetry": "reading_timestamp"}

# Values outside these bounds are kept and reported: the tables carry no CHECK constraint.
VALUE_RANGES = {
    "latitude": (-90, 90),
    "longitude": (-180, 180),
    "humidity_pct": (0, 100),
    "asset_utilization_pct": (0, 100),
    "label": (0, 1),
}


def wire(contract: T.StructType) -> T.StructType:
    """The part of a raw contract that travels in a message: ids and arrival time are added later."""
    return T.StructType([f for f in contract.fields if f.name not in _ID_AND_ARRIVAL])


def with_length(contract: T.StructType, name: str, max_length: int) -> T.StructType:
    """The contract with another greatest length for one text column."""
    return T.StructType([
        _text(f.name, max_length, f.nullable) if f.name == name else f for f in contract.fields
    ])


def source_schema(contract: T.StructType, names: dict[str, str]) -> T.StructType:
    """The source's columns, under their own names, in the types of the contract."""
    return T.StructType([
        T.StructField(old, contract[new].dataType) for old, new in names.items()
    ])
