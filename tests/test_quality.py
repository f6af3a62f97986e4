import json
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.functions.casting import clip, nan_to_null
from millwright.operators import lineage, logs, project, quality, sampling
from millwright.operators.features import logistics_features
from tests.conftest import utc

WIRE = c.wire(c.LOGISTICS_EVENTS)
GOOD = {"event_timestamp": "2025-02-01T10:00:00Z", "asset_id": "A"}


def validated(spark, *values):
    messages = spark.createDataFrame(
        [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)],
        "n int, value string",
    )
    rows = quality.validate(quality.parse_messages(messages, WIRE), WIRE)
    return {r["n"]: r for r in rows.collect()}


def test_message_faults_are_named(spark):
    rows = validated(
        spark,
        GOOD,
        '{"asset_id": "A", ',
        {**GOOD, "temperature_c": "warm"},
        {**GOOD, "colour": "red"},
        {"asset_id": "A"},
        {**GOOD, "asset_id": "x" * 51},
        {**GOOD, "temperature_c": 1234.5},
        {**GOOD, "asset_id": "x" * 50},
    )
    reasons = {n: r["reasons"] for n, r in rows.items()}
    assert reasons == {
        0: [], 1: ["corrupt"], 2: ["type:temperature_c"], 3: [], 4: ["missing:event_timestamp"],
        5: ["length:asset_id"], 6: ["type:temperature_c"], 7: [],
    }
    assert rows[0]["event_timestamp"].isoformat() == "2025-02-01T10:00:00"


def test_float_in_a_whole_number_column_is_rounded_half_even(spark):
    rows = validated(spark, {**GOOD, "inventory_level": 2.5}, {**GOOD, "inventory_level": 3.5},
                     {**GOOD, "inventory_level": 4_000_000_000}, '{"event_timestamp": '
                     '"2025-02-01T10:00:00Z", "asset_id": "A", "inventory_level": NaN}')
    assert [rows[n]["inventory_level"] for n in range(4)] == [2, 4, None, None]
    assert rows[2]["reasons"] == ["type:inventory_level"] and rows[3]["reasons"] == []


def test_zero_one_flag_becomes_boolean_and_null_stays_null(spark):
    rows = validated(spark, *[{**GOOD, "logistics_delay": v} for v in (0, 1, True, None, 7)])
    assert [rows[n]["logistics_delay"] for n in range(4)] == [False, True, True, None]


def test_quarantine_conserves_rows(spark):
    messages = spark.createDataFrame(
        [(json.dumps({**GOOD, "asset_id": "x" * n}),) for n in range(1, 100)], "value string"
    )
    rows = quality.validate(quality.parse_messages(messages, WIRE), WIRE)
    good, bad = quality.accepted(rows).count(), quality.quarantined(rows).count()
    assert (good, bad) == (50, 49)


def test_long_integers_keep_all_digits(spark):
    rows = spark.createDataFrame([("9007199254740993",)], "event_id string")
    assert project.to_contract(rows, c.LOGISTICS_EVENTS).head()["event_id"] == 9007199254740993


def test_first_delivery_keeps_one_row_per_message(spark):
    rows = spark.range(3000).select(
        F.lit("t").alias("topic"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("offset"),
        "id",
    )
    kept = quality.first_delivery(rows, ["topic", "offset"], ["id"])
    assert kept.count() == 2001
    assert kept.where("offset = 0").head()["id"] == 0


def test_range_violations_are_counted_and_nulls_are_not(spark):
    rows = spark.createDataFrame([(Decimal(91),), (Decimal(-90),), (None,)], "latitude decimal(9,4)")
    row = quality.range_violations(rows).head()
    assert (row["checked"], row["violations"]) == (2, 1)


def test_readiness(events):
    day = utc("2025-03-30T00:00:00")
    rows = events([{"event_timestamp": day - timedelta(days=d)} for d in range(3)])
    ready = [quality.raw_readiness(rows, "event_timestamp", n, gap).head()["is_ready"]
             for n, gap in ((3, 2), (4, 2), (3, 1))]
    assert ready == [True, False, False]


def test_duplicate_keys_are_reported(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    row = quality.key_uniqueness(rows, "t", ("k",)).head()
    assert (row["key_count"], row["duplicated_keys"], row["surplus_rows"]) == (2, 1, 1)


def test_reconcile_reports_both_directions(events):
    raw = events([{"asset_id": a} for a in ("same", "fewer", "fewer", "unpublished")])
    published = logistics_features(
        events([{"asset_id": a} for a in ("same", "fewer", "orphan")])
    )
    got = {r["asset_id"]: r["status"] for r in lineage.reconcile(raw, published).collect()}
    assert got == {"fewer": "count_mismatch", "unpublished": "missing_feature",
                   "orphan": "orphan_feature"}


def test_trace_one_feature_row(events):
    rows = events([{"event_id": 1}, {"event_id": 2, "asset_id": "B"},
                   {"event_id": 3, "event_timestamp": utc("2025-04-01T00:00:00")}])
    assert [r["event_id"] for r in lineage.trace_key(rows, "2025-01-01", "A").collect()] == [1]


def test_clip_keeps_null_and_nan_becomes_null(spark):
    rows = spark.createDataFrame([(-5.0,), (None,), (50.0,), (float("nan"),)], "v double")
    got = rows.select(clip(nan_to_null(F.col("v")), 0, 10).alias("v")).collect()
    assert [r["v"] for r in got] == [0.0, None, 10.0, None]
    assert project.nan_columns_to_null(rows).where("v is null").count() == 2


def test_log_layouts(spark):
    lines = [
        "2025-02-01 10:00:00,123 INFO data.seed: done: 5 rows",
        "2025-02-01 10:00:01,000 WARNING job: slow",
        '  File "job.py", line 3',
        "2025-02-01 10:00:02,000 INFO web: GET /health 200",
        '{"time": "2025-02-01T10:00:03Z", "level": "ERROR", "logger": "job", "message": "boom"}',
        "{not json",
    ]
    frame = spark.createDataFrame([("s", line) for line in lines], "service string, line string")
    rows = logs.without_health_checks(logs.parse_lines(frame)).collect()
    assert [(r["level"], r["logger"], r["message"], r["layout"]) for r in rows] == [
        ("INFO", "data.seed", "done: 5 rows", "plain"),
        ("WARNING", "job", "slow", "plain"),
        (None, None, '  File "job.py", line 3', "unparsed"),
        ("ERROR", "job", "boom", "json"),
        (None, None, "{not json", "unparsed"),
    ]
    assert rows[0]["log_time"].microsecond == 123000


def flags(spark, n):
    return spark.range(n).select(
        F.col("id").alias("reading_id"), (F.col("id") % 3 != 0).alias("is_anomalous"),
        (F.col("id") % 50 == 0).alias("is_optimised"))


def test_samples_do_not_depend_on_partitioning(spark):
    rows, classes = flags(spark, 5000), ["is_anomalous", "is_optimised"]
    for draw in (
        lambda r: sampling.stratified_sample(r, classes, "reading_id", 7, 1),
        lambda r: sampling.bootstrap_sample(r, "reading_id", 1.5, 1),
    ):
        one, many = draw(rows.coalesce(1)), draw(rows.repartition(13))
        assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_stratified_sample_fills_every_quota(spark):
    rows, classes = flags(spark, 5000), ["is_anomalous", "is_optimised"]
    drawn = sampling.stratified_sample(rows, classes, "reading_id", 7, 1)
    sizes = {tuple(r[:2]): r[2] for r in rows.groupBy(*classes).count().collect()}
    got = {tuple(r[:2]): r[2] for r in drawn.groupBy(*classes).count().collect()}
    assert got == {k: -(-n * 7 // 100) for k, n in sizes.items()}
    assert drawn.count() == drawn.select("reading_id").distinct().count()


def test_classes_of_a_stratified_sample_are_flags(spark):
    with pytest.raises(ValueError, match="boolean"):
        sampling.stratified_sample(spark.range(5), ["id"], "id", 10, 1)


def test_bootstrap_repeats_rows_at_the_given_rate(spark):
    drawn = sampling.bootstrap_sample(flags(spark, 20_000), "reading_id", 1.0, 3)
    assert abs(drawn.count() / 20_000 - 1.0) < 0.03
    assert drawn.agg(F.max("copy")).head()[0] >= 4
