"""Quarantine taken again, exact bootstrap, heavy hitters, coverage and log entries on made-up cases."""

import random
from bisect import bisect_left, bisect_right
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import coverage, logs, profile, sampling, summaries
from millwright.operators.lineage import origins, recorded, trace, trace_recorded
from millwright.operators.features import logistics_features
from millwright.operators.partials import added_up
from millwright.sources import tables
from millwright.streaming import replay
from tests.conftest import utc
from tests.test_streaming import drop, flush, message, stored

LONGER = c.with_length(c.LOGISTICS_EVENTS, "asset_id", 100)


def paths(base):
    return f"{base}/raw/{c.TOPIC_LOGISTICS}", f"{base}/quarantine/{c.TOPIC_LOGISTICS}"


def waits(spark, base):
    return sorted(r["waiting_time_min"] for r in stored(spark, base).collect())


@pytest.mark.parametrize("dies_at", [None, "append_raw", "after append_raw"])
def test_quarantined_messages_reach_the_raw_table_once(spark, tmp_path, monkeypatch, dies_at):
    long = {"asset_id": "x" * 60}
    drop(tmp_path / "landing", "a.json", [message(1), message(2, **long), message(2, **long), message(3, asset_id="y" * 120), "{"])
    flush(spark, tmp_path)
    drop(tmp_path / "landing", "b.json", [message(2, **long), message(4, **long)])
    flush(spark, tmp_path)
    assert waits(spark, tmp_path) == [1]
    raw, quarantine = paths(tmp_path)
    run = lambda name: replay.replay(spark, LONGER, "event_timestamp", raw, quarantine, name, ["asset_id"])
    if dies_at:
        whole = replay.append_raw

        def dies(*args):
            if dies_at.startswith("after"):
                whole(*args)
            raise RuntimeError("driver lost")

        with monkeypatch.context() as m:
            m.setattr(replay, "append_raw", dies)
            with pytest.raises(RuntimeError, match="driver lost"):
                run("first")
        assert run("second") == 0  # it finishes the run before
    else:
        assert run("first") == 4
    assert waits(spark, tmp_path) == [1, 2, 2, 2, 4]
    assert run("first") == 4 and run("third") == 0
    assert waits(spark, tmp_path) == [1, 2, 2, 2, 4]
    assert sorted(r["reasons"][0] for r in replay.waiting(spark, quarantine).collect()) == ["corrupt", "length:asset_id"]
    # what arrives later is taken by the next run
    drop(tmp_path / "landing", "c.json", [message(5, **long)])
    flush(spark, tmp_path)
    assert run("fourth") == 1 and waits(spark, tmp_path) == [1, 2, 2, 2, 4, 5]


@pytest.mark.parametrize("n", [0, 7, 5000])
def test_exact_bootstrap(spark, n):
    rows = spark.range(200).withColumn("x", F.col("id") * 2).repartition(5)
    drawn = sampling.bootstrap_exact(rows, "id", n, 3)
    found = [tuple(r) for r in drawn.select("draw", "id", "x").collect()]
    assert len(found) == n and sorted(d for d, _, _ in found) == list(range(1, n + 1))
    again = sampling.bootstrap_exact(rows.repartition(2, "x"), "id", n, 3)
    assert sorted(map(tuple, again.select("draw", "id", "x").collect())) == sorted(found)
    if n == 5000:
        times = Counter(i for _, i, _ in found)
        expected = n / 200
        chi = sum((times[i] - expected) ** 2 / expected for i in range(200))
        assert 140 < chi < 265  # 199 degrees of freedom: within about three deviations
    assert sampling.bootstrap_exact(rows.where("false"), "id", n, 3).count() == 0


@pytest.mark.parametrize("shape", ["steep", "flat", "ties", "few"])
def test_heavy_hitters(spark, monkeypatch, shape):
    monkeypatch.setattr(profile, "BUCKETS", 256)
    monkeypatch.setattr(profile, "NAMED_BUCKETS", 200)
    rng = random.Random(7)
    values = {
        "steep": [int(rng.paretovariate(0.8)) for _ in range(20_000)],
        "flat": [rng.randrange(15_000) for _ in range(20_000)],
        "ties": [k % 4000 for k in range(16_000)],
        "few": [1, 1, 2],
    }[shape]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)] * 500, "v long")
    want = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in profile.heavy_hitters(rows, "v", 10).collect()] == want


def test_nan_counts_as_missing(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (2.0,)], "x double")
    assert profile.profile_columns(rows, ["x"]).head()["non_null_count"] == 2


# --- coverage ------------------------------------------------------------------------------------


def test_missing_intervals_cross_spans_and_a_crowded_source(spark, monkeypatch):
    monkeypatch.setattr(coverage, "SPAN", 3)
    start, hour = utc("2024-12-30T00:00:00"), timedelta(hours=1)
    a = [0, 0.5, 1.4, 1.4, 3, 30, 30.2, 31.2, 400]
    rows = [("a", start + hour * h) for h in a] * 3 + [(None, start), (None, start + 5 * hour), ("b", start), ("a", None)]
    frame = spark.createDataFrame(rows, "s string, t timestamp").repartition(4)
    found = {(r["s"], r["gap_start"], r["gap_end"]) for r in coverage.missing_intervals(frame, "s", "t", 3600).collect()}
    naive = lambda h: (start + hour * h).replace(tzinfo=None)
    assert found == {("a", naive(x), naive(y)) for x, y in ((1.4, 3), (3, 30), (31.2, 400))} | {(None, naive(0), naive(5))}
    shares = {(r["s"], str(r["quarter_start"])): r for r in coverage.quarter_coverage(frame, "s", "t", 3600).collect()}
    assert set(shares) == {("a", "2024-10-01"), ("a", "2025-01-01"), (None, "2024-10-01"), ("b", "2024-10-01")}
    first = shares["a", "2024-10-01"]
    # 90 days before the first event, 1.6 and 27 hours, and from 31.2 hours to the quarter's end after 48
    assert first["missing_count"] == 4
    assert first["missing_micros"] == round((90 * 24 + 1.6 + 27 + 16.8) * 3.6e9)
    assert shares["a", "2025-01-01"]["missing_micros"] == round(90 * 24 * 3.6e9), "the gap and the rest of the quarter"
    assert float(shares["a", "2025-01-01"]["covered_share"]) == 0


# --- log entries over file splits ----------------------------------------------------------------


@pytest.mark.parametrize("split", [64, 1 << 20])
def test_entries_keep_their_traces_wherever_files_are_cut(spark, tmp_path, split):
    rng = random.Random(5)
    want = []
    for name in ("api", "jobs"):
        text, head, trace_ = [], None, []

        def close():
            if head:
                want.append((name, head, "\n".join(trace_) if trace_ else None, 1 + len(trace_)))

        for k in range(120):
            if k < 2 or rng.random() < 0.6:
                line = f'  File "{name}.py", line {k}' if rng.random() < 0.9 else ""
                if head:
                    trace_.append(line)
                else:
                    want.append((name, line, None, 1))
            else:
                close()
                head, trace_ = f"failed {k}", []
                line = f"2025-02-01 10:00:{k % 60:02d},000 ERROR a.b: failed {k}"
            text.append(line)
        close()
        (tmp_path / f"{name}.log").write_text("\n".join(text) + "\n")
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = tables.read_log_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > (20 if split == 64 else 0)
        found = logs.entries(lines)
        rows = [(r["service"], r["message"], r["trace"], r["line_count"]) for r in found.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter(rows) == Counter(want)


# --- recorded origins ----------------------------------------------------------------------------


def test_a_trace_opens_the_recorded_files_alone(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    for batch in range(4):
        rows = [
            {"event_id": 100 * batch + k, "asset_id": f"A{batch}" if k % 2 else "common",
             "event_timestamp": utc(f"2025-0{k % 6 + 1}-05T00:00:00"), "logistics_delay": batch == 2}
            for k in range(24)
        ]
        tables.append_raw(events(rows), path, "event_timestamp", str(batch), ["asset_id"])
    raw = tables.read_raw(spark, path, c.LOGISTICS_EVENTS)
    recorded(raw, c.TOPIC_LOGISTICS).write.parquet(str(tmp_path / "record"))
    record = spark.read.parquet(str(tmp_path / "record"))
    features = logistics_features(raw)
    assert sorted(map(tuple, added_up(record, c.TOPIC_LOGISTICS).collect())) == sorted(map(tuple, features.collect()))
    late = features.where("delay_rate = 1.0 and quarter_start = date'2025-04-01'")
    late = spark.createDataFrame(late.collect(), late.schema)  # a plan of its own
    found = trace_recorded(spark, record, late, c.TOPIC_LOGISTICS, c.LOGISTICS_EVENTS)
    want = trace(raw.drop("event_month", "batch"), late)
    assert found.count() > 0 and sorted(r["event_id"] for r in found.collect()) == sorted(r["event_id"] for r in want.collect())
    files = {f.split("/event_month=")[1] for f in found.inputFiles() if "/raw/" in f}
    assert {f.split("/")[1] for f in files} == {"batch=2"} and len(files) == origins(record, late, c.TOPIC_LOGISTICS).select("file_path").distinct().count()
    assert len(files) < len(raw.inputFiles()) / 4
    nothing = trace_recorded(spark, record, late.where("false"), c.TOPIC_LOGISTICS, c.LOGISTICS_EVENTS)
    assert nothing.columns == found.columns and nothing.count() == 0


# --- mergeable quantiles -------------------------------------------------------------------------


def test_merged_quantiles_keep_to_their_error(spark, monkeypatch):
    monkeypatch.setattr(summaries, "PIECES", 50)
    monkeypatch.setattr(summaries, "ACCURACY", 500)
    rng = random.Random(2)
    batches = {b: [rng.gauss(b % 3, 1 + b) for _ in range(rng.choice([1, 30, 4000]))] for b in range(9)}
    batches[9] = [7.0] * 9000  # one value holds a third of all rows
    rows = [(b, x, None) for b, xs in batches.items() for x in xs] + [(1, None, None), (2, float("nan"), None)]
    frame = spark.createDataFrame(rows, "b int, x double, y double").repartition(6)
    stored = summaries.summaries(frame, ["x", "y"], ["b"])
    assert stored.select("column").distinct().collect() == [("x",)]
    points = [0.0, 0.01, 0.3, 0.5, 0.77, 0.99, 1.0]
    every = sorted(x for xs in batches.values() for x in xs)
    n, error = len(every), 1 / 50 + 1 / 500
    found = summaries.merged_quantiles(stored, points).collect()
    assert len(found) == len(points)
    for r in found:
        assert r["n"] == n
        below, upto = bisect_left(every, r["value"]), bisect_right(every, r["value"])
        # every batch can be off by one row beside its share
        assert below - error * n - 10 <= r["probability"] * n <= upto + error * n + 10
    # the order and grouping of batches don't matter
    again = summaries.merged_quantiles(stored.repartition(3).orderBy(F.desc("b")), points)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found))
