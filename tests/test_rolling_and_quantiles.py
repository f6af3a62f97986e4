import random
import struct
from datetime import timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from millwright.functions.measures import exact_ratio
from millwright.functions.quantiles import LEVEL_BITS, from_order_code, level_bits, level_count, order_code
from millwright.operators import ordering, profile, quality, rolling
from tests.conftest import utc


def brute_force(rows, days=7):
    span = timedelta(days=days)
    result = {}
    for r in rows:
        seen = [o for o in rows if o["asset_id"] == r["asset_id"]
                and r["event_timestamp"] - span <= o["event_timestamp"] <= r["event_timestamp"]]
        waits = [o["waiting_time_min"] for o in seen if o["waiting_time_min"] is not None]
        result[r["event_id"]] = (
            len(seen), sum(waits), round(sum(waits) / len(waits), 4) if waits else None,
            round(sum(1 for o in seen if o["logistics_delay"]) / len(seen), 4),
        )
    return result


def test_rolling_matches_brute_force_with_one_crowded_asset(events):
    rng = random.Random(7)
    start = utc("2024-12-20T00:00:00")
    rows = [
        {
            "event_id": i,
            "asset_id": "HOT" if i % 3 else f"A{i % 5}",
            # whole days and seconds, so that frames end exactly on other events
            "event_timestamp": start + timedelta(days=rng.randrange(30), seconds=rng.randrange(3)),
            "waiting_time_min": rng.choice([None, 0, 5, 10]),
            "logistics_delay": rng.choice([None, True, False]),
        }
        for i in range(400)
    ]
    got = {
        r["event_id"]: (
            r["rolling_events"], r["rolling_waiting_min"],
            None if r["rolling_avg_waiting_min"] is None else float(r["rolling_avg_waiting_min"]),
            float(r["rolling_delay_rate"]),
        )
        for r in rolling.rolling_asset_stats(events(rows)).collect()
    }
    expected = brute_force(rows)
    assert got.keys() == expected.keys()
    for event_id, values in expected.items():
        assert got[event_id] == pytest.approx(values, abs=1e-4), event_id


def test_rolling_before_1970_and_at_microseconds(events):
    base = utc("1969-12-30T23:59:59.999999")
    rows = [{"event_id": i, "event_timestamp": base + d, "waiting_time_min": 1}
            for i, d in enumerate([timedelta(0), timedelta(days=7),
                                   timedelta(days=7, microseconds=1)])]
    got = {r["event_id"]: r["rolling_events"]
           for r in rolling.rolling_asset_stats(events(rows)).collect()}
    assert got == {0: 1, 1: 2, 2: 2}


@pytest.mark.parametrize("values", [
    [0], [1, 2], [5, 5, 5, 5], [-3, -2, 70_000, 2**31 - 1, -(2**31)],
    [random.Random(3).randrange(-(2**31), 2**31) for _ in range(501)],
    [7] * 300 + list(range(100)),
])
def test_exact_percentiles_match_numpy(spark, values):
    rows = spark.createDataFrame([("g", v) for v in values], "g string, v int")
    probabilities = (0.1, 0.25, 0.5, 0.75, 0.9)
    row = profile.quantile_profile(rows, ["v"], probabilities).head()
    for p in probabilities:
        assert float(row[f"p{round(p * 100)}"]) == pytest.approx(
            np.quantile(np.array(values, dtype=float), p), abs=1e-3)


def test_percentiles_of_decimals_and_nulls(spark):
    values = [Decimal("-1.2500000"), Decimal("0.0000001"), Decimal("9999999.9999999"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v decimal(14,7)")
    row = profile.quantile_profile(rows, ["v"], (0.5,)).head()
    assert (row["non_null_count"], row["p50"]) == (3, Decimal("0.0000"))
    assert row["max_value"] == Decimal("10000000.0000")


@pytest.mark.parametrize("data_type, levels", [
    (T.IntegerType(), 2), (T.DecimalType(12, 2), 2), (T.DecimalType(14, 7), 3), (T.LongType(), 3), (T.DoubleType(), 3),
])
def test_a_level_is_bounded(data_type, levels):
    assert level_count([data_type]) == levels
    assert level_bits(data_type, levels) <= LEVEL_BITS


def test_order_codes_are_bit_patterns(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308, float("inf"), float("-inf"), 1.0, 0.1]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [s * np.nextafter(2.0**e, t) for e in range(-1070, 1024, 3) for t in (0, 1e308) for s in (1, -1)]
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    code = order_code(F.col("v"))
    for r in rows.select("v", code.alias("code"), from_order_code(code).alias("back")).collect():
        if np.isnan(r["v"]):
            assert r["code"] is None
            continue
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert (r["code"], r["back"]) == (-bits if r["v"] < 0 else bits, r["v"])


def test_percentiles_of_doubles(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 1000) for _ in range(400)] + [0.0, -0.0, 1e-9]
    rows = spark.createDataFrame([("g", v) for v in values + [float("nan"), None]], "g string, v double")
    row = profile.quantile_profile(rows, ["v"]).head()
    assert row["non_null_count"] == len(values)
    for p in (0.25, 0.5, 0.75):
        assert float(row[f"p{round(p * 100)}"]) == pytest.approx(np.quantile(values, p), abs=1e-4)
    assert float(row["mean_value"]) == pytest.approx(np.mean(values), abs=1e-4)
    assert float(profile.median_by_group(rows, "g", "v").head()["median_value"]) == pytest.approx(
        np.median(values), abs=1e-4)


def test_percentiles_of_whole_64_bits(spark):
    values = [-(2**62), 2**40 + 1, 2**40 + 2, 2**40 + 3, 7]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    row = profile.quantile_profile(rows, ["v"], (0.5, 0.75)).head()
    assert (int(row["p50"]), int(row["p75"])) == (2**40 + 1, 2**40 + 2)


def test_means_round_halves_away_from_zero(spark):
    rows = spark.createDataFrame([(19845, 100000), (-19845, 100000), (5, 0), (None, 3), (1, 3)], "n bigint, d bigint")
    got = [r[0] for r in rows.select(exact_ratio(F.col("n"), F.col("d"), 4)).collect()]
    assert [None if v is None else str(v) for v in got] == ["0.1985", "-0.1985", None, None, "0.3333"]


def test_outliers_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "HOT" if i % 3 else f"g{i % 4}", rng.choice([None, 1, 2, 3, 50, -40]))
            for i in range(300)]
    frame = spark.createDataFrame(rows, "id int, g string, v int")
    expected = set()
    for g in {r[1] for r in rows}:
        members = [r for r in rows if r[1] == g and r[2] is not None]
        median = np.median([r[2] for r in members])
        deviation = np.median([abs(r[2] - median) for r in members])
        expected |= {r[0] for r in members if abs(r[2] - median) > 3 * deviation}
    got = {r["id"] for r in quality.outliers_mad(frame, "id", "g", "v", 3.0).collect()}
    assert got == expected and got


def test_positions_with_one_crowded_instant(events):
    moment = utc("2025-02-01T00:00:00")
    rows = [{"event_id": i, "event_timestamp": moment + timedelta(hours=max(0, i - 60))}
            for i in random.Random(1).sample(range(100), 100)]
    placed = ordering.with_position(
        events(rows).select("event_id", "event_timestamp").repartition(7),
        "event_timestamp", "event_id",
    ).collect()
    assert sorted((r["position"], r["event_id"]) for r in placed) == [
        (i + 1, i) for i in range(100)
    ]


def test_approximate_quantiles_are_close(spark):
    rows = spark.range(10_000).selectExpr("'g' as g", "cast(id as int) as v")
    row = profile.approximate_quantiles(rows, "g", "v", [0.5]).head()
    assert abs(row["quantiles"][0] - 5000) <= 10
