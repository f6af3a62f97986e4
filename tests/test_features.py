from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import features
from tests.conftest import utc


def test_unknown_delay_counts_as_an_event(events):
    rows = events([{"logistics_delay": d} for d in (True, False, False, None)])
    assert features.logistics_features(rows).head()["delay_rate"] == Decimal("0.2500")


def test_all_null_metric_keeps_the_row(events):
    row = features.logistics_features(events([{"waiting_time_min": 4}, {}])).head()
    assert row["avg_inventory_level"] is None
    assert row["event_count"] == 2
    assert row["avg_waiting_time_min"] == Decimal("4.00")


def test_missing_axis_counts_as_zero_in_the_total(readings):
    row = features.hrss_features(readings([{}, {"hl_power_w": None}])).head()
    assert row["total_power_w"] == Decimal("110.00")
    assert row["avg_hl_power_w"] == Decimal("10.00")


def test_quarter_edges_are_utc(events):
    rows = events([{"event_timestamp": utc("2025-03-31T23:59:59")},
                   {"event_timestamp": utc("2025-04-01T00:00:00")}])
    quarters = {r["quarter_start"] for r in features.logistics_features(rows).collect()}
    assert quarters == {date(2025, 1, 1), date(2025, 4, 1)}


def test_label_rate_uses_the_label_and_not_the_flag(readings):
    rows = readings([{"label": 1}, {"label": 0}, {"label": None}, {"label": 1}])
    assert features.hrss_features(rows).head()["anomaly_label_rate"] == Decimal("0.5000")


def test_counts_beyond_32_bits_fit_the_output_types():
    assert c.LOGISTICS_FEATURES["event_count"].dataType.simpleString() == "bigint"
    assert c.HRSS_FEATURES["reading_count"].dataType.simpleString() == "bigint"


def test_output_types_are_the_contract(events, readings):
    for result, contract in (
        (features.logistics_features(events([{}])), c.LOGISTICS_FEATURES),
        (features.hrss_features(readings([{}])), c.HRSS_FEATURES),
    ):
        got = {f.name: f.dataType for f in result.schema.fields}
        want = {f.name: f.dataType for f in contract.fields}
        assert got == {n: t for n, t in want.items() if n not in ("feature_id", "computed_at")}


def test_efficiency_is_null_without_one_class(readings):
    row = features.energy_efficiency(readings([{"is_optimised": True}])).head()
    assert row["optimised_power_w"] == Decimal("60.0000")
    assert row["power_ratio"] is None and row["saving_pct"] is None


def test_efficiency_is_null_when_standard_power_is_zero(readings):
    idle = {f"{axis}_power_w": 0 for axis in c.AXES}
    row = features.energy_efficiency(readings([{"is_optimised": True}, idle])).head()
    assert row["power_ratio"] is None


def test_saving(readings):
    half = {f"{axis}_power_w": 5 for axis in c.AXES}
    row = features.energy_efficiency(readings([{**half, "is_optimised": True}, {}])).head()
    assert row["saving_pct"] == Decimal("50.0000")


def test_axis_share_is_null_without_power(readings):
    rows = readings([{"blo_power_w": 0, "is_anomalous": True}])
    shares = {r["axis"]: r["anomalous_power_share"]
              for r in features.anomaly_rate_by_axis(rows).collect()}
    assert shares["blo"] is None and shares["hl"] == Decimal("1.0000")


def test_counts_add_up(events):
    rows = events([{"asset_id": a, "event_timestamp": utc(f"2025-0{m}-01T00:00:00")}
                   for a in "ABC" for m in range(1, 10)])
    total = features.logistics_features(rows).agg(F.sum("event_count")).head()[0]
    assert total == 27


def test_stamp_is_the_same_on_every_run(events):
    computed = features.logistics_features(events([{}, {"asset_id": "B"}]))
    first, second = (
        features.stamp(computed, c.LOGISTICS_KEY, F.lit(datetime(2025, 4, d, tzinfo=timezone.utc)))
        for d in (1, 2)
    )
    key = ["feature_id", "quarter_start", "asset_id"]
    assert sorted(first.select(key).collect()) == sorted(second.select(key).collect())
    assert first.select("computed_at").distinct().count() == 1


def test_rates_stay_between_zero_and_one(spark):
    from millwright.plans import fixtures as fx
    from tests.conftest import SMALL
    rows = features.logistics_features(fx.logistics_events(spark, SMALL))
    assert rows.where("delay_rate < 0 or delay_rate > 1 or delay_rate is null").count() == 0
    total = fx.logistics_events(spark, SMALL).count()
    assert rows.agg(F.sum("event_count")).head()[0] == total


def test_named_features_need_only_their_columns(events):
    rows = events([{"logistics_delay": True}, {}]).select(
        "event_timestamp", "asset_id", "logistics_delay")
    row = features.logistics_features(rows, only=("delay_rate",)).head()
    assert row.asDict() == {"quarter_start": date(2025, 1, 1), "asset_id": "A",
                            "delay_rate": Decimal("0.5000")}


def test_change_against_the_previous_quarter(events):
    rows = events([{"event_timestamp": utc(f"2025-0{m}-01T00:00:00"), "waiting_time_min": m}
                   for m in (1, 4, 5)])
    changes = features.quarter_over_quarter(features.logistics_features(rows))
    first, second = changes.orderBy("quarter_start").collect()
    assert first["previous_quarter"] is None and first["event_count_change"] is None
    assert second["previous_quarter"] == date(2025, 1, 1)
    assert (second["event_count_change"], second["avg_waiting_time_change"]) == (1, Decimal("3.50"))
