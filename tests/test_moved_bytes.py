"""What raw rows cost on their way: packed messages, batches kept off the heap, merging and partial sums without a shuffle of
rows, traces that move few rows."""

import json

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import lineage
from millwright.sources import derived, layout, tables
from millwright.sources.messages import as_messages, batch_files, publish_files
from millwright.streaming import ingest as ingest_module
from tests.conftest import utc
from tests.test_plans import plan_of
from tests.test_streaming import drop, flush, message, stored


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_published_files_are_packed(spark, events, tmp_path):
    rows = events([{"event_id": k, "asset_id": f"A{k}"} for k in range(2000)])
    messages = as_messages(rows, c.wire(c.LOGISTICS_EVENTS))
    path = str(tmp_path / "landing")
    publish_files(messages, path, rows_per_file=100)
    on_disk = sum(f.stat().st_size for f in (tmp_path / "landing").glob("part-*"))
    assert on_disk * 3 < messages.agg(F.sum(F.length("value"))).head()[0]
    found = batch_files(spark, path, c.TOPIC_LOGISTICS).select("value")
    assert found.exceptAll(messages).count() == 0 and found.count() == 2000


def _in_batches(events, path, batches=3):
    for k in range(batches):
        rows = events([
            {"event_id": 100 * k + m, "asset_id": f"A{m % 2}", "event_timestamp": utc(f"2025-0{max(m, 1)}-1{k}T00:00:00")}
            for m in range(4)
        ]).withColumn("event_timestamp", F.expr("if(event_id % 100 = 0, null, event_timestamp)"))
        tables.append_raw(rows, path, "event_timestamp", f"{k:012d}", ["asset_id"])


def test_folders_of_one_file_are_merged_without_a_shuffle(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    _in_batches(events, path)
    before = tables.read_raw(spark, path, c.LOGISTICS_EVENTS).select(*c.LOGISTICS_EVENTS.names)
    before = before.orderBy("event_id").collect()
    held = layout.bins(layout.live(spark, path))
    sources = {f"event_month={h[0].month}/batch={layout.new_name()}": h for h in held}
    rows = layout.read_units(spark, path, c.LOGISTICS_EVENTS, [u for h in held for u in h])
    frames = layout._merged(rows, c.LOGISTICS_EVENTS, sources, layout.TARGET_BYTES)
    assert len(held) == 4 and [("Exchange" in plan_of(f)) for f in frames] == [False]
    with layout._one_after_the_other(spark):
        assert frames[0].rdd.getNumPartitions() == 4
    found = layout.compact(spark, path, c.LOGISTICS_EVENTS, ["asset_id"])
    assert (found.folders_before, found.folders_after, found.files_after) == (12, 4, 4)
    after = tables.read_raw(spark, path, c.LOGISTICS_EVENTS).select(*c.LOGISTICS_EVENTS.names)
    assert after.orderBy("event_id").collect() == before


def test_rows_meet_their_folders_names_without_a_shuffle(spark, events, tmp_path, no_broadcast):
    path = str(tmp_path / "raw")
    _in_batches(events, path)
    chosen = layout.live(spark, path)
    rows = derived.sourced(spark, path, c.LOGISTICS_EVENTS, chosen)
    assert "Exchange hashpartitioning" not in plan_of(rows)
    assert {(str(r[0]), r[1], r[2]) for r in rows.select("event_month", "batch", "source").collect()} == {
        (u.month.replace(layout.NO_MONTH, "None"), u.batch, u.source) for u in chosen
    }


def test_trace_moves_few_rows_that_it_does_not_return(spark, events, tmp_path, no_broadcast):
    path = str(tmp_path / "raw")
    rows = [{"event_id": k, "asset_id": f"A{k}", "logistics_delay": k % 100 == 0} for k in range(5000)]
    nameless = events(rows).withColumn("asset_id", F.expr("if(event_id = 0, null, asset_id)"))
    tables.append_raw(nameless, path, "event_timestamp", "0", ["asset_id"])
    raw = tables.read_raw(spark, path, c.LOGISTICS_EVENTS)
    record = lineage.recorded(raw, c.TOPIC_LOGISTICS)
    record.write.parquet(str(tmp_path / "record"))
    record = spark.read.parquet(str(tmp_path / "record"))
    late = record.where("delay_rate_rows > 0").select("quarter_start", "asset_id")
    found = lineage.trace_recorded(spark, record, late, c.TOPIC_LOGISTICS, c.LOGISTICS_EVENTS)
    assert sorted(r["event_id"] for r in found.collect()) == list(range(0, 5000, 100))
    final = plan_of(found)
    assert "BroadcastHashJoin" in final  # sorted out before the rows are moved
    placed = raw.withColumn("quarter_start", F.lit("2025-01-01").cast("date"))
    kept = {r["event_id"] for r in lineage._marked(placed, ["quarter_start", "asset_id"], late).collect()}
    assert kept >= set(range(0, 5000, 100)) and len(kept) < 100


@pytest.mark.parametrize("repeats_ever", [False, True])
def test_a_batch_takes_no_memory_for_caching(spark, tmp_path, monkeypatch, repeats_ever):
    cached = lambda: {i.id(): (i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    seen, payloads, before, quarantined = [], [], set(cached()), ingest_module.quarantined

    def looks(rows):
        of = rows.select((F.size("reasons") == 0).alias("good"), F.col("value").isNotNull().alias("held")).distinct()
        payloads.extend(sorted(map(tuple, of.collect())))
        level = (rows.storageLevel.useMemory, rows.storageLevel.useDisk)
        seen.append((level, [sizes for k, sizes in cached().items() if k not in before and sizes[1]]))
        return quarantined(rows)

    monkeypatch.setattr(ingest_module, "quarantined", looks)
    long = message(0, asset_id="x" * 60)
    drop(tmp_path / "landing", "a.json", [*map(message, range(1, 300)), long])
    flush(spark, tmp_path, repeats_ever=repeats_ever)
    (level, blocks), = seen
    assert level == (False, True) and len(blocks) == 1 + repeats_ever and all(memory == 0 for memory, _ in blocks)
    assert payloads == [(False, True), (True, repeats_ever)], "only a history asks for the payload of an accepted message"
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == list(range(1, 300))
    waiting = spark.read.parquet(f"{tmp_path}/quarantine/{c.TOPIC_LOGISTICS}").select("value", "reasons").collect()
    assert [(json.loads(r["value"]), r["reasons"]) for r in waiting] == [(long, ["length:asset_id"])]
