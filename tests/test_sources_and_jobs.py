import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millwright import contracts as c
from millwright.operators import logs, project
from millwright.plans import jobs
from millwright.sources import files, jdbc, messages, tables
from tests.conftest import reading, utc


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_csv_null_texts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Asset_ID,Logistics_Delay_Reason,Waiting_Time\nA,None,5\nB,,\n")
    default = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert rows_of(default) == [("A", None, 5), ("B", None, None)]
    literal = files.read_csv(spark, str(tmp_path / "a.csv"), null_texts=("",))
    assert rows_of(literal)[0] == ("A", "None", 5)


def test_tagged_files_become_contract_columns(spark, tmp_path):
    cells = {}
    for i, cell in enumerate([(False, False), (False, True), (True, False), (True, True)]):
        path = tmp_path / f"part{i}.csv"
        path.write_text(f"Timestamp,Labels,I_w_BLO_Weg,O_w_BLO_power,O_w_BLO_voltage\n0.5,{i % 2},1,{i},3\n")
        cells[cell] = str(path)
    tagged = project.project_hrss(files.read_tagged(spark, cells))
    assert set(tagged.columns) == {
        "cycle_elapsed_sec", "label", "blo_position_mm", "blo_power_w", "blo_voltage_v",
        "is_anomalous", "is_optimised",
    }
    assert {(r["is_anomalous"], r["is_optimised"], r["blo_power_w"]) for r in tagged.collect()} == {
        (False, False, 0), (False, True, 1), (True, False, 2), (True, True, 3),
    }


def test_rename_maps_cover_the_contracts():
    assert len(c.LOGISTICS_SOURCE_NAMES) == 15
    assert len(c.HRSS_SOURCE_NAMES) == 20
    assert set(c.LOGISTICS_SOURCE_NAMES.values()) == set(c.wire(c.LOGISTICS_EVENTS).names) - {
        "event_timestamp"}
    assert set(c.HRSS_SOURCE_NAMES.values()) == set(c.wire(c.HRSS_TELEMETRY).names) - {
        "reading_timestamp", "is_anomalous", "is_optimised"}


def test_messages_write_nulls_and_iso_times(events):
    row = messages.as_messages(events([{"temperature_c": Decimal("21.50")}]), c.wire(c.LOGISTICS_EVENTS)).head()
    record = json.loads(row["value"])
    assert list(record) == c.wire(c.LOGISTICS_EVENTS).names
    assert record["event_timestamp"] == "2025-02-01T10:00:00Z"
    assert record["inventory_level"] is None and record["temperature_c"] == 21.5


def test_kafka_options():
    read = messages.kafka_read_options("host:1", "t", max_rows_per_trigger=messages.BATCH_ROWS)
    assert read["subscribe"] == "t" and read["maxOffsetsPerTrigger"] == "25000"
    write = messages.kafka_write_options("host:1", "t")
    assert write["kafka.linger.ms"] == "50" and write["kafka.batch.size"] == "65536"


def test_jdbc_options():
    options = jdbc.partitioned_read_options(
        "jdbc:postgresql://host/db", "raw.events", "event_timestamp", "2025-01-01", "2025-04-01", 90
    )
    assert options["partitionColumn"] == "event_timestamp" and options["numPartitions"] == "90"
    with pytest.raises(ValueError):
        jdbc.partitioned_read_options("u", "t", "c", "0", "1", 0)


def test_append_is_idempotent_per_batch(spark, readings, tmp_path):
    path = str(tmp_path / "raw")
    first = readings([{"reading_id": i} for i in range(5)])
    second = readings([{"reading_id": i} for i in range(5, 8)])
    for batch, rows in (("0", first), ("1", second), ("0", first)):
        tables.append_raw(rows, path, "reading_timestamp", batch, ["reading_timestamp"])
    stored = tables.read_raw(spark, path, c.HRSS_TELEMETRY)
    assert sorted(r["reading_id"] for r in stored.collect()) == list(range(8))
    assert stored.select("event_month").distinct().collect() == [(date(2025, 2, 1),)]


def seed(spark, base, quarters=("2025-02-01", "2025-05-01")):
    rows = [reading(reading_id=i, reading_timestamp=utc(f"{q}T10:00:00"), is_anomalous=bool(i % 2))
            for q in quarters for i in range(4)]
    tables.append_raw(spark.createDataFrame(rows, c.HRSS_TELEMETRY), f"{base}/raw/hrss_telemetry",
                      "reading_timestamp", "0", ["reading_timestamp"])
    from tests.conftest import event
    rows = [event(event_id=i, event_timestamp=utc(f"{q}T10:00:00"), asset_id=f"A{i}")
            for q in quarters for i in range(4)]
    tables.append_raw(spark.createDataFrame(rows, c.LOGISTICS_EVENTS),
                      f"{base}/raw/logistics_events", "event_timestamp", "0", ["asset_id"])


def test_quarterly_job_is_repeatable_and_leaves_other_quarters_alone(spark, tmp_path):
    base, run = str(tmp_path), datetime(2025, 7, 1, tzinfo=timezone.utc)
    seed(spark, base)
    paths = jobs.quarterly(spark, "2025-01-01", base, run, max_gap_days=92)
    path = paths["logistics_events"]
    first = rows_of(tables.read_features(spark, path, c.LOGISTICS_FEATURES))
    assert len(first) == 4
    jobs.quarterly(spark, "2025-01-01", base, run, max_gap_days=92)
    assert rows_of(tables.read_features(spark, path, c.LOGISTICS_FEATURES)) == first
    jobs.quarterly(spark, "2025-04-01", base, run, max_gap_days=92)
    both = rows_of(tables.read_features(spark, path, c.LOGISTICS_FEATURES))
    assert len(both) == 8 and set(first) < set(both)
    hrss = tables.read_features(spark, paths["hrss_telemetry"], c.HRSS_FEATURES)
    assert hrss.count() == 4 and hrss.agg(F.sum("reading_count")).head()[0] == 8
    assert len(jobs.serve(spark, base)) == 9
    joined = spark.sql("""
        select count(*) from logistics_features_quarterly f join logistics_events e
        on e.asset_id = f.asset_id and cast(date_trunc('quarter', e.event_timestamp) as date)
           = f.quarter_start""")
    assert joined.head()[0] == 8


def test_a_quarter_that_became_empty_is_emptied(spark, readings, tmp_path):
    from millwright.operators.features import hrss_features
    path = str(tmp_path / "features")
    computed = hrss_features(readings([{}, {"reading_timestamp": utc("2025-05-01T00:00:00")}]))
    tables.overwrite_quarters(computed, path, ["2025-01-01", "2025-04-01"])
    later = computed.where("quarter_start = date'2025-04-01'")
    tables.overwrite_quarters(later, path, ["2025-01-01", "2025-04-01"])
    left = spark.read.schema(computed.schema).parquet(path)
    assert [r["quarter_start"] for r in left.collect()] == [date(2025, 4, 1)]


def test_rows_of_an_unlisted_quarter_are_refused(readings, tmp_path):
    from millwright.operators.features import hrss_features
    with pytest.raises(ValueError, match="2025-01-01"):
        tables.overwrite_quarters(hrss_features(readings([{}])), str(tmp_path / "f"), ["2025-04-01"])


def test_rolling_report_of_a_quarter_sees_the_days_before_it(spark, events, readings, tmp_path):
    base = str(tmp_path)
    stamps = ["2025-03-20T00:00:00", "2025-03-29T00:00:00", "2025-04-02T00:00:00", "2025-07-01T00:00:00"]
    rows = events([{"event_id": i, "event_timestamp": utc(t)} for i, t in enumerate(stamps)])
    tables.append_raw(rows, f"{base}/raw/{c.TOPIC_LOGISTICS}", "event_timestamp", "0", ["asset_id"])
    for _ in range(2):
        jobs.quarterly(spark, "2025-04-01", base, utc("2025-08-01T00:00:00"), max_gap_days=92,
                       topics=(c.TOPIC_LOGISTICS,))
    jobs.serve(spark, base, (c.TOPIC_LOGISTICS,))
    got = spark.sql("select event_id, rolling_events, cast(quarter_start as string) from rolling_asset_stats")
    assert [tuple(r) for r in got.collect()] == [(2, 2, "2025-04-01")]
    with pytest.raises(jobs.NotReady):  # its last days are missing
        jobs.quarterly(spark, "2025-04-01", base, utc("2025-08-01T00:00:00"), topics=(c.TOPIC_LOGISTICS,))


def test_job_refuses_a_quarter_without_enough_raw_data(spark, tmp_path):
    seed(spark, str(tmp_path))
    with pytest.raises(jobs.NotReady):
        jobs.quarterly(spark, "2025-01-01", str(tmp_path), datetime(2025, 7, 1), min_rows=100)


def test_tables_are_served_to_sql(spark, events):
    tables.register(spark, {"served_events": events([{}, {"event_id": 2}])})
    assert spark.sql("select count(*) from served_events").head()[0] == 2


def test_log_files_by_day(spark, tmp_path):
    source = tmp_path / "logs"
    source.mkdir()
    (source / "seeder.log").write_text(
        "2025-02-01 10:00:00,000 INFO a: x\n2025-02-02 10:00:00,000 INFO a: y\n  trace\n")
    parsed = logs.parse_lines(tables.read_log_files(spark, str(source)))
    for _ in range(2):  # a batch that runs again replaces itself
        tables.write_logs(parsed, str(tmp_path / "table"), "0")
    stored = spark.read.parquet(str(tmp_path / "table"))
    assert stored.count() == parsed.count()
    assert {(str(r["log_date"]), r["service"]) for r in stored.collect()} == {
        ("2025-02-01", "seeder"), ("2025-02-02", "seeder"), ("None", "seeder")}


def test_profile_job(events):
    result = jobs.profile(events([{"asset_id": "A"}, {"asset_id": "A"}, {"asset_id": "B"}]),
                          ["asset_id"], ["waiting_time_min"])
    frequencies = {r["category"]: r["frequency"] for r in result["categories"].collect()}
    assert frequencies == {"A": Decimal("0.666667"), "B": Decimal("0.333333")}
    kinds = {r["column"]: r["kind"] for r in result["columns"].collect()}
    assert (kinds["asset_id"], kinds["latitude"], kinds["event_id"], kinds["logistics_delay"]) == (
        "categorical", "numeric", "integer", "boolean")


def test_defaults_are_stable_ids(spark):
    rows = spark.createDataFrame([("t", 0, 5)], "topic string, partition int, offset long")
    ids = {project.with_defaults(rows, "event_id", ["topic", "partition", "offset"],
                                 F.current_timestamp()).head()["event_id"] for _ in range(2)}
    assert len(ids) == 1


def test_command_line_flushes_and_rebuilds(spark, tmp_path):
    from millwright.plans import run
    landing = tmp_path / "landing"
    landing.mkdir()
    record = {"event_timestamp": "2025-02-01T10:00:00Z", "asset_id": "A", "waiting_time_min": 4}
    (landing / "a.json").write_text(json.dumps(record) + "\n")
    (landing / "b.json").write_text(json.dumps({**record, "asset_id": "B"}) + "\n")
    base = str(tmp_path)
    run.main(["flush", "--topic", "logistics_events", "--base", base, "--landing", str(landing)])
    tables.append_raw(spark.createDataFrame([reading()], c.HRSS_TELEMETRY),
                      f"{base}/raw/hrss_telemetry", "reading_timestamp", "0", [])
    run.main(["quarterly", "--max-gap-days", "92", "--quarter", "2025-01-01", "--base", base, "--min-rows", "1",
              "--computed-at", "2025-07-01T00:00:00+00:00"])
    stored = tables.read_features(
        spark, f"{base}/analytics/logistics_features_quarterly", c.LOGISTICS_FEATURES)
    assert {(r["asset_id"], r["event_count"], r["computed_at"].isoformat())
            for r in stored.collect()} == {("A", 1, "2025-07-01T00:00:00"),
                                           ("B", 1, "2025-07-01T00:00:00")}


def test_command_line_keeps_the_tables(spark, tmp_path):
    from millwright.plans import run
    from tests.conftest import event

    base = str(tmp_path)
    raw = f"{base}/raw/logistics_events"
    for batch in ("0", "1"):
        rows = [event(event_id=int(batch) * 10 + k, asset_id=f"A{k}", event_timestamp=utc(f"2025-0{k + 1}-02T00:00:00")) for k in range(3)]
        tables.append_raw(spark.createDataFrame(rows, c.LOGISTICS_EVENTS), raw, "event_timestamp", batch, ["asset_id"])
    stored = lambda: sorted(r["event_id"] for r in tables.read_raw(spark, raw, c.LOGISTICS_EVENTS).collect())
    table = ["--topic", "logistics_events", "--base", base]
    run.main(["compact", *table, "--keep-hours", "0"])
    assert stored() == [0, 1, 2, 10, 11, 12] and len(tables.read_raw(spark, raw, c.LOGISTICS_EVENTS).inputFiles()) == 3
    run.main(["retain", *table, "--oldest", "2025-02-01"])
    (tmp_path / "ids.csv").write_text("asset_id\nA2\nA9\n")
    run.main(["erase", *table, "--column", "asset_id", "--ids", f"{base}/ids.csv"])
    assert stored() == [1, 11]
    (tmp_path / "x.log").write_text("2025-02-01 10:00:00,000 ERROR a: x\n  trace\n2025-02-01 10:00:01,000 INFO a: GET /health 200\n")
    run.main(["logs", "--path", f"{base}/x.log", "--base", base, "--batch", "0"])
    assert [(r["message"], r["trace"]) for r in spark.read.parquet(f"{base}/logs").collect()] == [("x", "  trace")]
    (tmp_path / "s.csv").write_text("a,b\n1,x\n3,\n")
    run.main(["profile", "--path", f"{base}/s.csv", "--out", f"{base}/profile"])
    assert {r["column"]: r["non_null_count"] for r in spark.read.parquet(f"{base}/profile/columns").collect()} == {"a": 2, "b": 1}


def test_cells_that_do_not_fit_are_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t,extra\n1,2025-01-01T00:00:00Z,x\nsoon,2025-01-01T00:00:00Z,y\nNA,,z\n")
    contract = c.T.StructType([
        c.T.StructField("n", c.T.IntegerType()), c.T.StructField("t", c.T.TimestampType(), False)])
    found = files.read_csv_checked(spark, str(tmp_path / "a.csv"), contract)
    assert [(r["extra"], r["n"], r["reasons"]) for r in found.orderBy("extra").collect()] == [
        ("x", 1, []), ("y", None, ["type:n"]), ("z", None, ["missing:t"])]
    assert found.where(F.endswith("file", F.lit("a.csv"))).count() == 3


def test_job_refuses_a_quarter_with_a_hole(spark, tmp_path):
    rows = [reading(reading_id=d, reading_timestamp=utc(f"2025-0{m}-{d:02d}T00:30:00"))
            for m in (1, 2, 3) for d in range(1, 29) if m != 2]
    tables.append_raw(spark.createDataFrame(rows, c.HRSS_TELEMETRY), f"{tmp_path}/raw/hrss_telemetry", "reading_timestamp", "0", [])
    run = lambda share: jobs.quarterly(
        spark, "2025-01-01", str(tmp_path), utc("2025-07-01T00:00:00"), topics=(c.TOPIC_HRSS,), min_covered=share)
    jobs.HOLE_SECONDS, before = 2 * 86_400, jobs.HOLE_SECONDS
    try:
        assert run(0.5)
        with pytest.raises(jobs.NotReady):  # February is missing
            run(0.7)
    finally:
        jobs.HOLE_SECONDS = before


def test_pseudonyms_of_other_salts_differ(spark):
    from millwright.operators.privacy import pseudonym
    row = spark.createDataFrame([("bc", "c")], "x string, y string")
    assert row.select(pseudonym(F.col("x"), "a").alias("a"), pseudonym(F.col("y"), "ab").alias("b")).where("a = b").count() == 0


def test_too_many_flags_are_refused(spark):
    from millwright.operators.sampling import stratified_sample
    flags = [f"f{k}" for k in range(5)]
    rows = spark.range(3).selectExpr("id", *[f"true as {f}" for f in flags])
    with pytest.raises(ValueError, match="5 flags"):
        stratified_sample(rows, flags, "id", 10, 1)
