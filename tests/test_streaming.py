import json
import re
from datetime import timedelta

import pytest

from millwright import contracts as c
from millwright.operators.features import logistics_features
from millwright.operators.tumbling import tumbling_counts
from millwright.plans import jobs
from millwright.sources import messages, tables
from millwright.streaming import ingest as ingest_module
from millwright.streaming.live import current, fold, latest, live_aggregate, throughput
from tests.conftest import utc


def drop(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(
        (r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def message(n, **more):
    moment = utc("2025-01-01T00:00:00") + timedelta(hours=n)
    return {"event_timestamp": moment.strftime("%Y-%m-%dT%H:%M:%SZ"), "asset_id": f"A{n % 3}",
            "waiting_time_min": n, **more}


def flush(spark, base, **options):
    query = jobs.flush_topic(spark, c.TOPIC_LOGISTICS, str(base), landing=str(base / "landing"),
                             **options)
    query.awaitTermination()
    return query


def stored(spark, base):
    return tables.read_raw(spark, f"{base}/raw/logistics_events", c.LOGISTICS_EVENTS)


def test_flush_takes_interleaved_runs_whole(spark, tmp_path):
    """Three files, each sorted over the same period: nothing is late."""
    for k in range(3):
        drop(tmp_path / "landing", f"run{k}.json", [message(n) for n in range(k, 300, 3)])
    query = flush(spark, tmp_path)
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == list(range(300))
    assert sum(p["rows"] for p in throughput(query)) == 300
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    assert spark.conf.get(setting) == "true", "the stream's settings stay in its own session"


def test_second_flush_takes_only_what_is_new(spark, tmp_path):
    drop(tmp_path / "landing", "a.json", [message(1), message(2)])
    flush(spark, tmp_path)
    drop(tmp_path / "landing", "b.json", [message(3)])
    flush(spark, tmp_path)
    flush(spark, tmp_path)
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == [1, 2, 3]


def test_bad_messages_are_quarantined_and_equal_readings_kept(spark, tmp_path):
    drop(tmp_path / "landing", "a.json",
         [message(1), message(1), message(2), '{"broken', message(3, asset_id="x" * 51)])
    flush(spark, tmp_path)
    rows = stored(spark, tmp_path).collect()
    assert sorted(r["waiting_time_min"] for r in rows) == [1, 1, 2]
    assert len({r["event_id"] for r in rows}) == 3 and all(r["ingested_at"] for r in rows)
    bad = spark.read.parquet(f"{tmp_path}/quarantine/logistics_events").collect()
    assert sorted(r["reasons"][0] for r in bad) == ["corrupt", "length:asset_id"]


def test_replay_after_a_crash_between_the_sinks_loses_and_repeats_nothing(
    spark, tmp_path, monkeypatch
):
    drop(tmp_path / "landing", "a.json", [message(n) for n in range(10)] + ["{"])
    whole_append = ingest_module.append_raw

    def append_then_crash(*args, **kwargs):
        whole_append(*args, **kwargs)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest_module, "append_raw", append_then_crash)
    with pytest.raises(Exception, match="executor lost"):
        flush(spark, tmp_path)
    monkeypatch.setattr(ingest_module, "append_raw", whole_append)
    flush(spark, tmp_path)
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == list(range(10))
    assert spark.read.parquet(f"{tmp_path}/quarantine/logistics_events").count() == 1


def test_payload_sent_twice_in_different_flushes(spark, tmp_path):
    drop(tmp_path / "landing", "a.json", [message(1)])
    flush(spark, tmp_path, repeats_within="2 days")
    drop(tmp_path / "landing", "b.json", [message(1), message(2)])
    flush(spark, tmp_path, repeats_within="2 days")
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == [1, 2]


def raw_stream(spark, events, tmp_path, rows):
    path = str(tmp_path / "events")
    for start in range(0, len(rows), 20):
        events(rows[start:start + 20]).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(c.LOGISTICS_EVENTS).option("maxFilesPerTrigger", 1)
    return reader.parquet(path), spark.read.parquet(path)


@pytest.mark.parametrize("aggregate, key", [
    (logistics_features, ["quarter_start", "asset_id"]),
    (lambda rows: tumbling_counts(rows, "event_timestamp", "asset_id"),
     ["window_start", "asset_id"]),
])
def test_live_result_equals_batch_result(spark, events, tmp_path, aggregate, key):
    rows = [{"event_id": n, "asset_id": f"A{n % 3}", "waiting_time_min": n,
             "event_timestamp": utc("2025-03-30T00:00:00") + timedelta(hours=n)} for n in range(60)]
    stream, batch = raw_stream(spark, events, tmp_path, rows)
    live_aggregate(stream, aggregate, f"{tmp_path}/updates", f"{tmp_path}/checkpoint").awaitTermination()
    live = latest(spark.read.parquet(f"{tmp_path}/updates"), key)
    expected = aggregate(batch)
    live = live.select(*expected.columns)
    assert live.exceptAll(expected).count() == 0 and expected.exceptAll(live).count() == 0


def test_batch_limit_reaches_the_source(spark, tmp_path):
    for k in range(3):
        drop(tmp_path / "landing", f"{k}.json", [message(k)])
    stream = messages.stream_files(spark, str(tmp_path / "landing"), "t", max_files_per_trigger=1)
    seen = []
    query = (stream.writeStream.foreachBatch(lambda batch, n: seen.append(batch.count()))
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert seen == [1, 1, 1]


@pytest.mark.parametrize("max_files", [1, 3])
def test_result_does_not_depend_on_the_batch_size(spark, tmp_path, max_files):
    for k in range(3):
        drop(tmp_path / "landing", f"{k}.json", [message(1), message(1)])
    flush(spark, tmp_path, max_files=max_files)
    rows = stored(spark, tmp_path).collect()
    assert len(rows) == 6 and len({r["event_id"] for r in rows}) == 6


def test_dropped_late_rows_are_counted(spark, events, tmp_path):
    rows = [{"event_id": n, "event_timestamp": utc("2025-03-30T00:00:00") - timedelta(days=n)} for n in range(60)]
    stream, _ = raw_stream(spark, events, tmp_path, rows)
    query = live_aggregate(stream, lambda r: tumbling_counts(r, "event_timestamp", "asset_id"), f"{tmp_path}/updates",
                           f"{tmp_path}/checkpoint", ts="event_timestamp", late_by="1 hour")
    query.awaitTermination()
    assert sum(p["late_rows_dropped"] for p in throughput(query)) > 0


def test_folded_updates_are_not_read_again(spark, events, tmp_path):
    rows = [{"event_id": n, "asset_id": f"A{n % 3}", "waiting_time_min": n} for n in range(80)]
    stream, batch = raw_stream(spark, events, tmp_path, rows)
    path, key = f"{tmp_path}/updates", ["quarter_start", "asset_id"]
    live_aggregate(stream, logistics_features, path, f"{tmp_path}/checkpoint").awaitTermination()
    expected = sorted(map(tuple, logistics_features(batch).collect()))

    def bounds():
        """The partition filters of the updates' scan."""
        frame = current(spark, path, key)
        assert sorted(map(tuple, frame.select(*logistics_features(batch).columns).collect())) == expected
        plan = frame._jdf.queryExecution().executedPlan().toString()
        return [int(n) for n in re.findall(r"PartitionFilters: \[[^\]]*batch#\d+ > (\d+)\)", plan)]

    assert bounds() == []
    for upto in (1, 2, 3):
        target = fold(spark, path, key, upto)
        assert set(bounds()) == {upto}
        assert spark.read.parquet(target).count() == 3
    # a snapshot that isn't whole doesn't count
    (tmp_path / "updates-folded" / "upto=9").mkdir()
    assert set(bounds()) == {3}
