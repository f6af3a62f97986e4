import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import privacy, quality
from millwright.sources import files, layout, tables
from tests.conftest import utc


def raw(spark, events, tmp_path, rows):
    path = str(tmp_path / "raw")
    tables.append_raw(events(rows), path, "event_timestamp", "0", ["asset_id"])
    return path


def test_pseudonym_of_null_is_null(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    found = [r["x"] for r in privacy.pseudonymised(rows, ["x"], "s").collect()]
    assert found[0] == found[1] and len(found[0]) == 64 and found[2] is None


def test_retention_drops_earlier_months_whole_and_cuts_the_month_of_the_cutoff(spark, events, tmp_path):
    days = ["2024-12-31", "2025-01-01", "2025-01-02", "2025-01-03", "2025-02-01"]
    path = raw(spark, events, tmp_path, [{"event_id": k, "event_timestamp": utc(f"{d}T00:00:00")} for k, d in enumerate(days)])

    def left():
        return sorted(r["event_id"] for r in tables.read_raw(spark, path, c.LOGISTICS_EVENTS).collect())

    untouched = sorted((tmp_path / "raw" / "event_month=2025-02-01" / "batch=0").iterdir())
    assert privacy.retain(spark, path, c.LOGISTICS_EVENTS, "2025-01-01") == ["event_month=2024-12-01/batch=0"]
    assert left() == [1, 2, 3, 4]
    assert privacy.retain(spark, path, c.LOGISTICS_EVENTS, "2025-01-02") == ["event_month=2025-01-01/batch=0"]
    assert left() == [2, 3, 4]
    assert privacy.retain(spark, path, c.LOGISTICS_EVENTS, "2025-01-02") == []
    assert not (tmp_path / "raw" / "event_month=2024-12-01" / "batch=0").exists()
    assert sorted((tmp_path / "raw" / "event_month=2025-02-01" / "batch=0").iterdir()) == untouched


def test_erasure_leaves_untouched_folders_alone(spark, events, tmp_path):
    path = raw(spark, events, tmp_path, [
        {"event_id": 1, "asset_id": "A", "event_timestamp": utc("2025-01-01T00:00:00")},
        {"event_id": 2, "asset_id": "B", "event_timestamp": utc("2025-01-01T01:00:00")},
        {"event_id": 3, "asset_id": "B", "event_timestamp": utc("2025-02-02T00:00:00")},
        {"event_id": 4, "asset_id": "A", "event_timestamp": utc("2025-03-03T00:00:00")},
    ])
    def untouched():
        return sorted((tmp_path / "raw" / "event_month=2025-02-01" / "batch=0").iterdir())

    before = untouched()
    ids = spark.createDataFrame([("A",), ("A",), (None,), ("unknown",)], "asset_id string")
    assert privacy.erase(spark, path, c.LOGISTICS_EVENTS, "asset_id", ids) == 2
    assert sorted(r["event_id"] for r in tables.read_raw(spark, path, c.LOGISTICS_EVENTS).collect()) == [2, 3]
    assert untouched() == before
    files = [str(f) for f in (tmp_path / "raw").rglob("*.parquet")]
    assert len(files) == 2 and not any("2025-03" in f for f in files), "what is erased is gone from the disk"
    assert privacy.erase(spark, path, c.LOGISTICS_EVENTS, "asset_id", ids) == 0


def test_erasure_that_dies_changes_nothing_and_can_be_repeated(spark, events, tmp_path, monkeypatch):
    path = raw(spark, events, tmp_path, [{"event_id": k, "asset_id": "AB"[k % 2]} for k in range(6)])
    ids = spark.createDataFrame([("A",)], "asset_id string")

    def dies(*args):
        if args[-1]:  # there is something to do
            raise RuntimeError("driver lost")
        return []

    for name, ids_left in (("commit", [0, 1, 2, 3, 4, 5]), ("delete", [1, 3, 5])):
        with monkeypatch.context() as m:
            m.setattr(layout, name, dies)
            with pytest.raises(RuntimeError, match="driver lost"):
                privacy.erase(spark, path, c.LOGISTICS_EVENTS, "asset_id", ids)
        found = sorted(r["event_id"] for r in tables.read_raw(spark, path, c.LOGISTICS_EVENTS).collect())
        assert found == ids_left, name
        if name == "commit":
            privacy.layout.vacuum(spark, path, hours=0)
    privacy.erase(spark, path, c.LOGISTICS_EVENTS, "asset_id", ids)
    assert len(list((tmp_path / "raw").rglob("*.parquet"))) == 1


def test_loose_times_are_refused(spark):
    rows = spark.createDataFrame(
        [("2025",), ("T12:30",), ("2025-01-01T00:00:00Z",), ("2025-01-01T00:00:00.25+01:00",)], "t string"
    ).withColumn("asset_id", F.lit("A"))
    contract = c.T.StructType([c.T.StructField("t", c.T.TimestampType(), False)])
    found = [r["reasons"] for r in quality.validate(rows, contract).collect()]
    assert found == [["type:t"], ["type:t"], [], []]


def test_csv_types_see_past_null_words(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "n,d,b,t,s,e,x\n1,1.50,true,2025-01-01T00:00:00Z,word,NA,1e5\nNA,nan,None,NULL,N/A,,2\n-2,-10.125,FALSE,"
        "2025-01-01 00:00:00,2,null,NaN\n")
    types = {f.name: f.dataType.simpleString() for f in files.read_csv(spark, str(tmp_path / "a.csv")).schema.fields}
    assert types == {"n": "bigint", "d": "decimal(5,3)", "b": "boolean", "t": "timestamp", "s": "string",
                     "e": "string", "x": "double"}
