"""Quarantined messages taken again once the contract has changed.

A run has a name. What it accepts is first written to a ledger beside the quarantine, `<quarantine>-moved/run=<name>`, then to
the raw table as batch `replay-<name>`, and last the run is marked as done. Ledger and raw table are written in overwrite mode
under the run's name. A job that dies in between is finished by the next call, whatever its name: a run that is in the
ledger but not done is written to the raw table again, from the ledger's rows, and replaces itself there. So each message
reaches the raw table once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.operators.project import with_defaults
from millwright.operators.quality import accepted
from millwright.sources import layout
from millwright.sources.tables import append_raw
from millwright.streaming.ingest import POSITION, checked

_MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()), T.StructField("value", T.StringType()), T.StructField("batch", T.StringType()),
])
_IDENTITY = [*POSITION, "batch", "digest"]


def _ledger(path: str) -> str:
    return f"{path}-moved"


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("digest", F.sha2(F.coalesce("value", F.lit("")), 256))


def _runs(spark: SparkSession, path: str) -> dict[str, bool]:
    """Runs whose ledger rows are whole, and whether they are done."""
    system, place, jvm = layout.file_system(spark, _ledger(path))
    inside = lambda name: jvm.org.apache.hadoop.fs.Path(place, name)
    found = system.globStatus(inside("run=*/_SUCCESS")) or []
    names = [str(s.getPath().getParent().getName()).split("=", 1)[1] for s in found]
    return {n: system.exists(inside(f"_done/{n}")) for n in names}


def waiting(spark: SparkSession, quarantine_path: str) -> DataFrame:
    """The quarantined messages that no run has moved. Equal messages of one batch share their fate, whether or not they
    share a position."""
    schema = T.StructType([*_MESSAGE.fields, T.StructField("reasons", T.ArrayType(T.StringType()))])
    rows = _with_digest(spark.read.schema(schema).parquet(quarantine_path))
    runs = list(_runs(spark, quarantine_path))
    if not runs:
        return rows
    moved = _with_digest(spark.read.schema(_MESSAGE).parquet(*[f"{_ledger(quarantine_path)}/run={r}" for r in runs]))
    moved = moved.select(*[F.col(c).alias(f"_{c}") for c in _IDENTITY]).distinct()
    return rows.join(moved, [rows[c].eqNullSafe(moved[f"_{c}"]) for c in _IDENTITY], "left_anti")


def replay(
    spark: SparkSession, contract: T.StructType, ts: str, raw_path: str, quarantine_path: str, run: str, sort_by: list[str],
) -> int:
    """Validate what waits in quarantine under ``contract`` and move what is now good to the raw table; returns the number
    of messages that this run moved. The raw columns must be those of the table. A run's name is used once: called
    again, it moves nothing more."""
    layout.event_time(contract)  # a contract without an event time can't be a raw table's
    runs = _runs(spark, quarantine_path)
    if run not in runs:
        good = accepted(checked(waiting(spark, quarantine_path).drop("reasons"), contract))
        good.select(*_MESSAGE.names).write.mode("overwrite").parquet(f"{_ledger(quarantine_path)}/run={run}")
        runs = _runs(spark, quarantine_path)
    for name in sorted(n for n, done in runs.items() if not done):
        _move(spark, contract, ts, raw_path, quarantine_path, name, sort_by)
    return spark.read.schema(_MESSAGE).parquet(f"{_ledger(quarantine_path)}/run={run}").count()


def _move(spark, contract, ts, raw_path, quarantine_path, run, sort_by) -> None:
    held = spark.read.schema(_MESSAGE).parquet(f"{_ledger(quarantine_path)}/run={run}")
    typed = accepted(checked(held, contract)).withColumn("place", F.monotonically_increasing_id())
    rows = with_defaults(typed, contract.fields[0].name, [*POSITION, F.lit(run), "place"], F.current_timestamp())
    append_raw(rows.select(*contract.names), raw_path, ts, f"replay-{run}", sort_by)
    system, place, jvm = layout.file_system(spark, _ledger(quarantine_path))
    system.create(jvm.org.apache.hadoop.fs.Path(place, f"_done/{run}"), True).close()
