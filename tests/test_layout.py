"""Compaction of raw tables: same rows, fewer files, and nothing lost or doubled by a run that dies or runs again."""

import random

import pytest

from millwright import contracts as c
from millwright.operators.features import logistics_features
from millwright.sources import layout, tables
from millwright.sources.layout import Unit
from tests.conftest import utc


def unit(batch, size, files=1, month="2025-01-01"):
    return Unit(month, batch, f"s{batch}", files, size, 0.0)


def test_bins_hold_each_folder_once_and_keep_to_the_size():
    rng = random.Random(1)
    chosen = [unit(f"{k:03d}", rng.randrange(1, 120), month=rng.choice(["2025-01-01", "2025-02-01"])) for k in range(200)]
    found = layout.bins(chosen, 100)
    assert sum(map(len, found)) == len({u for held in found for u in held}) <= len(chosen)
    for held in found:
        assert len({u.month for u in held}) == 1 and sum(u.size for u in held) <= 100 and len(held) > 1
    for month in ("2025-01-01", "2025-02-01"):
        # no two bins could be one: at most one is half empty
        assert sum(sum(u.size for u in held) <= 50 for held in found if held[0].month == month) <= 1


def test_a_large_folder_is_merged_only_if_it_has_too_many_files():
    assert layout.bins([unit("0", 250, files=3)], 100) == []
    assert layout.bins([unit("0", 250, files=9)], 100) == [[unit("0", 250, files=9)]]
    assert layout.bins([unit("0", 50)], 100) == []


def ingest(spark, events, path, batches=3):
    """Each batch spans the whole period, as the runs of a backfill do."""
    for batch in range(batches):
        rows = [
            {"event_id": 100 * batch + k, "event_timestamp": utc(f"2025-{k % 4 + 1:02d}-{(batch + k) % 28 + 1:02d}T10:00:00"), "asset_id": f"A{k % 3}"}
            for k in range(12)
        ]
        tables.append_raw(events(rows).coalesce(1), path, "event_timestamp", f"{batch:012d}", ["asset_id"])


def stored(spark, path):
    return sorted(r["event_id"] for r in tables.read_raw(spark, path, c.LOGISTICS_EVENTS).collect())


def ids(batches=3):
    return sorted(100 * b + k for b in range(batches) for k in range(12))


def test_compaction(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    n, every = 20, ids(20)
    ingest(spark, events, path, n)
    features = sorted(map(tuple, logistics_features(tables.read_raw(spark, path, c.LOGISTICS_EVENTS)).collect()))
    found = layout.compact(spark, path, c.LOGISTICS_EVENTS, ["asset_id"])
    assert (found.files_before, found.folders_before) == (4 * n, 4 * n)
    assert (found.files_after, found.folders_after) == (4, 4)
    raw = tables.read_raw(spark, path, c.LOGISTICS_EVENTS)
    assert stored(spark, path) == every and len(raw.inputFiles()) == 4
    assert sorted(map(tuple, logistics_features(raw).collect())) == features
    again = layout.compact(spark, path, c.LOGISTICS_EVENTS, ["asset_id"])
    assert (again.files_before, again.files_after) == (4, 4)
    # replaced folders stay for readers that have begun, until they are old enough
    assert layout.vacuum(spark, path) == [] and len(list((tmp_path / "raw").rglob("*.parquet"))) == 4 * n + 4
    assert len(layout.vacuum(spark, path, hours=0)) == 4 * n
    assert stored(spark, path) == every and len(list((tmp_path / "raw").rglob("*.parquet"))) == 4
    # a batch that is delivered again after it was merged changes nothing; a new one counts
    tables.append_raw(events([{"event_id": 1, "event_timestamp": utc("2025-01-01T10:00:00")}]), path, "event_timestamp", f"{0:012d}", [])
    tables.append_raw(events([{"event_id": 7777, "event_timestamp": utc("2025-01-01T10:00:00")}]), path, "event_timestamp", f"{n:012d}", [])
    assert stored(spark, path) == [*every, 7777]
    layout.compact(spark, path, c.LOGISTICS_EVENTS, before=f"{n:012d}")
    assert len(layout.live(spark, path)) == 5, "the batch named is left out"
    layout.compact(spark, path, c.LOGISTICS_EVENTS)
    assert stored(spark, path) == [*every, 7777] and len(layout.live(spark, path)) == 4


@pytest.mark.parametrize("step", ["commit", "units", "read_units"])
def test_a_run_that_dies_leaves_the_table_as_it_was(spark, events, tmp_path, monkeypatch, step):
    path = str(tmp_path / "raw")
    ingest(spark, events, path)
    whole, calls = getattr(layout, step), []

    def dies(*args, **kwargs):
        calls.append(1)
        if step == "commit" or len(calls) == 2:  # the second listing and reading come after the write
            raise RuntimeError("driver lost")
        return whole(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(layout, step, dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            layout.compact(spark, path, c.LOGISTICS_EVENTS)
    assert stored(spark, path) == ids()
    assert layout.compact(spark, path, c.LOGISTICS_EVENTS).files_after == 4
    assert stored(spark, path) == ids()
    layout.vacuum(spark, path, hours=0)
    assert stored(spark, path) == ids() and len(list((tmp_path / "raw").rglob("*.parquet"))) == 4


def test_a_half_written_log_file_does_not_count(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    ingest(spark, events, path)
    (tmp_path / "raw" / layout.SWAPS).mkdir()
    (tmp_path / "raw" / layout.SWAPS / "000000000001.json").write_text('{"kind": "compact", "at": 1.0, "steps": [{"made"')
    assert stored(spark, path) == ids()
    layout.compact(spark, path, c.LOGISTICS_EVENTS)
    assert stored(spark, path) == ids() and list(layout.swaps(spark, path)) == [2]


def test_two_runs_at_a_time_replace_a_folder_once(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    ingest(spark, events, path)
    first, = [layout.Step(None, ((u.folder, u.source),)) for u in layout.live(spark, path)[:1]]
    layout.commit(spark, path, "erase", [first])
    with pytest.raises(RuntimeError, match="replaced by another run"):
        layout.commit(spark, path, "compact", [first])


def test_a_wrong_count_is_no_replacement(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    ingest(spark, events, path)
    now = layout.live(spark, path)[:2]
    sources = {f"event_month={now[0].month}/batch={layout.new_name()}": now}
    rows = layout._moved(spark, layout.read_units(spark, path, c.LOGISTICS_EVENTS, now), sources)
    with pytest.raises(RuntimeError, match="rows written"):
        layout.replace(spark, path, c.LOGISTICS_EVENTS, "compact", rows.limit(1), sources, [], expected=rows.count())
    assert stored(spark, path) == ids()


def test_a_large_folder_of_many_files_is_cut_into_files_of_the_size(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    rows = events([{"event_id": k, "event_timestamp": utc(f"2025-01-{k % 28 + 1:02d}T10:00:00")} for k in range(400)])
    many = rows.selectExpr("*", "date'2025-01-01' as event_month", "'0' as batch").repartition(12)
    many.write.partitionBy("event_month", "batch").parquet(path)
    size = layout.live(spark, path)[0].size
    found = layout.compact(spark, path, c.LOGISTICS_EVENTS, target=size // 3)
    assert (found.files_before, found.folders_after) == (12, 1) and 2 <= found.files_after <= 4
    assert stored(spark, path) == list(range(400))


def test_tables_that_are_not_there(spark, tmp_path):
    assert layout.live(spark, str(tmp_path / "none")) == [] and layout.swaps(spark, str(tmp_path / "none")) == {}
