"""Features kept as partial sums, and messages recognised across batches: whatever the order, the result is the same."""

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import partials
from millwright.operators.features import hrss_features, logistics_features
from millwright.operators.quality import raw_readiness
from millwright.plans import jobs
from millwright.sources import derived, layout, tables
from millwright.sources.layout import Step, Swap, Unit
from millwright.streaming import history
from tests.conftest import utc
from tests.test_streaming import drop, flush, message, stored

TOPICS = {c.TOPIC_LOGISTICS: logistics_features, c.TOPIC_HRSS: hrss_features}


def made_up(topic, events, readings, seed, n=40):
    rng = random.Random(seed)
    moment = lambda: utc("2025-01-01T00:00:00") + timedelta(hours=rng.randrange(24 * 200))
    some = lambda x: rng.choice([None, x])
    if topic == c.TOPIC_LOGISTICS:
        return events([{
            "event_id": 1000 * seed + k, "event_timestamp": moment(), "asset_id": f"A{rng.randrange(3)}",
            "waiting_time_min": some(rng.randrange(90)), "logistics_delay": rng.choice([None, True, False]),
            "temperature_c": some(Decimal(rng.randrange(4000)).scaleb(-2)), "user_transaction_amount": None if seed % 2 else rng.randrange(1000),
        } for k in range(n)])
    return readings([{
        "reading_id": 1000 * seed + k, "reading_timestamp": moment(), "is_anomalous": rng.random() < 0.3,
        "is_optimised": rng.random() < 0.5, "blo_power_w": some(rng.randrange(100)), "label": some(rng.randrange(2)),
    } for k in range(n)])


def same(left, right):
    assert left.columns == right.columns and left.dtypes == right.dtypes
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


@pytest.mark.parametrize("topic", list(TOPICS))
def test_partial_sums_add_up(spark, events, readings, tmp_path, topic):
    base = str(tmp_path)
    contract, ts, sort_by = jobs.CONTRACTS[topic]
    raw = f"{base}/raw/{topic}"

    def add(batch):
        tables.append_raw(made_up(topic, events, readings, batch), raw, ts, f"{batch:012d}", sort_by)

    def check():
        rows = tables.read_raw(spark, raw, contract)
        sums = jobs.partial_rows(spark, base, topic)
        same(partials.added_up(sums, topic), TOPICS[topic](rows))
        same(partials.readiness(sums, topic, 5, 30), raw_readiness(rows, ts, 5, 30))

    def scanned():
        """The batches that a refresh would read."""
        lacking = derived.look(spark, raw, f"{base}/partials/{topic}", additive=True).lacking
        files = derived.sourced(spark, raw, contract, list(lacking)).inputFiles() if lacking else []
        return {f.split("batch=")[1].split("/")[0] for f in files}

    for batch in (3, 1, 4):
        add(batch)
    assert scanned() == {"000000000001", "000000000003", "000000000004"}
    check()
    assert scanned() == set()
    add(2)
    assert scanned() == {"000000000002"}, "only the new batch is read"
    check()
    add(1)  # delivered again: its files are new, its rows are not
    assert scanned() == {"000000000001"}
    check()
    jobs.compact_topic(spark, topic, base, keep_hours=0)
    assert scanned() == set(), "merged folders need no new sums"
    check()
    add(5)
    check()
    jobs.compact_topic(spark, topic, base, keep_hours=0)
    from millwright.operators import privacy
    gone = spark.createDataFrame([(1003,), (5001,)], f"{contract.fields[0].name} long")
    assert privacy.erase(spark, raw, contract, contract.fields[0].name, gone) > 0
    assert 0 < len(scanned()) <= len(layout.live(spark, raw))
    check()
    folders = {str(f.relative_to(tmp_path / "partials" / topic)) for f in (tmp_path / "partials" / topic).glob("*/*/*")}
    assert folders == {derived.place(p) for p in derived.look(spark, raw, f"{base}/partials/{topic}", True).counting}


def test_quarterly_job_from_partial_sums(spark, events, readings, tmp_path):
    base = str(tmp_path)
    for topic in TOPICS:
        contract, ts, sort_by = jobs.CONTRACTS[topic]
        for batch in (1, 2):
            tables.append_raw(made_up(topic, events, readings, batch), f"{base}/raw/{topic}", ts, str(batch), sort_by)
    found = []
    for from_partials in (False, True):
        paths = jobs.quarterly(spark, "2025-01-01", base, utc("2025-08-01T00:00:00"), max_gap_days=92, from_partials=from_partials)
        found.append([
            sorted(map(tuple, tables.read_features(spark, paths[t], jobs.FEATURES[t][3]).collect()), key=str) for t in TOPICS
        ])
    assert found[0] == found[1] and all(found[0])
    with pytest.raises(jobs.NotReady):
        jobs.quarterly(spark, "2025-01-01", base, utc("2025-08-01T00:00:00"), min_rows=1000, from_partials=True)


def test_parts_of_merged_folders():
    unit = lambda batch, source: Unit("m", batch, source, 1, 1, 0.0)
    a, b, ab, abc = (("event_month=m/batch=" + x, "s" + x) for x in ("a", "b", "swap-ab", "swap-abc"))
    c_ = ("event_month=m/batch=c", "sc")
    swaps = {1: Swap("compact", 0, (Step(ab[0], (a, b)),)), 2: Swap("compact", 0, (Step(abc[0], (ab, c_)),))}
    now = [unit("swap-abc", "sswap-abc")]
    assert derived.state(now, swaps, {a, b, c_}, True) == derived.State((a, b, c_), (), ())
    assert derived.state(now, swaps, {ab, c_, a}, True) == derived.State((ab, c_), (), (a,))
    assert derived.state(now, swaps, {a, c_}, True) == derived.State((abc,), (now[0],), (a, c_)), "b was never summed up"
    assert derived.state(now, swaps, {a, b, c_}, False).lacking == (now[0],)
    erased = {1: Swap("erase", 0, (Step(ab[0], (a, b)),))}
    assert derived.state([unit("swap-ab", "x")], erased, {a, b}, True).lacking == (unit("swap-ab", "x"),)


# --- messages of earlier batches -----------------------------------------------------------------


def keys(spark, values, day="2025-01-05"):
    rows = spark.createDataFrame([(v,) for v in values], "value string").withColumn("t", F.lit(f"{day}T00:00:00Z").cast("timestamp"))
    return history.keyed(rows, "t")


@pytest.mark.parametrize("false_positives", [0.05, 1e-3])
def test_filters_lose_nothing_and_keep_to_their_rate(spark, false_positives):
    held = keys(spark, [f"held {k}" for k in range(20_000)]).withColumn("batch", F.lit("0"))
    known = history.filters(held, ["event_month", "batch"], false_positives)
    again = history.suspects(held.select("event_month", "digest"), known, false_positives)
    assert again.count() == 20_000
    fresh = keys(spark, [f"fresh {k}" for k in range(50_000)]).select("event_month", "digest")
    assert history.suspects(fresh, known, false_positives).count() <= 1.5 * false_positives * 50_000 + 10
    other_month = keys(spark, ["held 1"], "2025-02-05").select("event_month", "digest")
    assert history.suspects(other_month, known, false_positives).count() == 0


def test_a_message_of_a_year_ago_is_recognised_without_reading_the_rest(spark, tmp_path):
    path, batches = str(tmp_path), 12
    for month in range(1, batches + 1):
        mine = keys(spark, [f"{month} {k}" for k in range(50)], f"2024-{month:02d}-05")
        history.remember(spark, mine, "t", path, f"{month:04d}")
    old = keys(spark, ["1 7", "1 8", "1 new"], "2024-01-05").unionByName(keys(spark, ["13 1", "1 7"], "2025-01-05"))
    found = history.repeats(spark, old, path, "0013")
    assert [u.batch for u in found.read] == ["0001"], "one folder of twelve is opened"
    stored_ = layout.read_units(spark, f"{path}/seen", history.SEEN, list(found.read))
    assert all("/event_month=2024-01-01/batch=0001/" in f for f in stored_.inputFiles())
    want = {bytes(r["digest"]) for r in keys(spark, ["1 7", "1 8"]).collect()}
    assert {bytes(r["digest"]) for r in found.digests.collect()} == want
    # the January of another year is another month: that message can't be the old one
    fresh = history.first_deliveries(spark, old.drop("digest", "event_month"), "t", path, "0013", ["value"])
    assert sorted(r["value"] for r in fresh.collect()) == ["1 new", "13 1"]


def test_flushes_recognise_messages_of_all_earlier_flushes(spark, tmp_path):
    landing = tmp_path / "landing"
    drop(landing, "a.json", [message(1), message(1), message(2), '{"broken'])
    flush(spark, tmp_path, repeats_ever=True)
    drop(landing, "b.json", [message(2), message(3)])
    flush(spark, tmp_path, repeats_ever=True)
    history.compact_history(spark, f"{tmp_path}/history/{c.TOPIC_LOGISTICS}", before=f"{2:012d}")
    drop(landing, "c.json", [message(1), message(3), message(4)])
    flush(spark, tmp_path, repeats_ever=True)
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == [1, 2, 3, 4]
    # both days fall into one month, so one merged folder and the last batch remain
    assert len(layout.live(spark, f"{tmp_path}/history/{c.TOPIC_LOGISTICS}/seen")) == 2


def test_a_batch_that_runs_again_keeps_its_messages(spark, tmp_path, monkeypatch):
    from millwright.streaming import ingest as ingest_module

    drop(tmp_path / "landing", "a.json", [message(n) for n in range(5)])
    whole = ingest_module.append_raw

    def dies(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(ingest_module, "append_raw", dies)
    with pytest.raises(Exception, match="executor lost"):
        flush(spark, tmp_path, repeats_ever=True)
    monkeypatch.setattr(ingest_module, "append_raw", whole)
    flush(spark, tmp_path, repeats_ever=True)
    assert sorted(r["waiting_time_min"] for r in stored(spark, tmp_path).collect()) == list(range(5))
