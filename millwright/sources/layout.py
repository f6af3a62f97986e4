"""Which folders of a raw table count, and how some of them are replaced by others.

A raw table has a folder per month and batch, `event_month=<first day>/batch=<name>`. Appending adds folders; compaction,
erasure and retention replace them. A replacement is written beside the old folders, under batch names that start with
`swap-`, and takes effect at once with one small file, `_swaps/<number>.json`, that names both sides. Until that file is
whole, readers see the old folders and none of the new; from then on the reverse. A run that dies leaves either
nothing that counts or a finished replacement, and can be repeated in both cases. A batch that is written again after it
was replaced stays replaced: its rows are in the new folder.

Readers get the folders that count from here (``tables.read_raw``). Replaced folders are deleted later by ``vacuum``, so that
jobs that still read them end in peace; erasure deletes them at once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import defaultdict
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

SWAPS = "_swaps"
MADE = "swap-"
#: Spark's name for a partition whose value is NULL.
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"
#: Size that a file should have.
TARGET_BYTES = 256 << 20
#: New folders that one write of a compaction makes.
ROUND = 100
PARTITIONS = [T.StructField("event_month", T.DateType()), T.StructField("batch", T.StringType())]


@dataclass(frozen=True, order=True)
class Unit:
    """A folder of one month and batch. ``source`` is a digest of its files' names, which no two writes share."""

    month: str
    batch: str
    source: str
    files: int
    size: int
    changed: float  # seconds since 1970

    @property
    def folder(self) -> str:
        return f"event_month={self.month}/batch={self.batch}"


@dataclass(frozen=True)
class Step:
    """Folders (with their sources) that one new folder replaces; None where no row is left."""

    made: str | None
    replaced: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Swap:
    kind: str  # compact: the same rows; erase, retain: fewer
    at: float
    steps: tuple[Step, ...]


def file_system(spark: SparkSession, path: str):
    """The file system that holds ``path``, local or remote, the path as it names it, and the JVM."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place, jvm


def exists(spark: SparkSession, path: str) -> bool:
    system, place, _ = file_system(spark, path)
    return system.exists(place)


def units(spark: SparkSession, path: str) -> list[Unit]:
    """All folders of the table, whether they count or not. Spark lists the files and adds them up; only folders reach the
    driver."""
    if not exists(spark, path):
        return []
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(path).select("path", "length", "modificationTime")
    )
    part = lambda n: F.regexp_extract("path", r"event_month=([^/]*)/batch=([^/]*)/([^/]*)$", n)
    found = (
        files.select(part(1).alias("month"), part(2).alias("batch"), part(3).alias("name"), "length", "modificationTime")
        .where("name <> ''")
        .groupBy("month", "batch")
        .agg(
            F.left(F.sha2(F.array_join(F.sort_array(F.collect_list("name")), ","), 256), F.lit(16)).alias("source"),
            F.count("*").alias("files"), F.sum("length").alias("size"),
            F.unix_micros(F.max("modificationTime")).alias("changed"),
        )
    )
    return sorted(
        Unit(r["month"], r["batch"], r["source"], r["files"], r["size"], r["changed"] / 1e6) for r in found.collect()
    )


def swaps(spark: SparkSession, path: str) -> dict[int, Swap]:
    """The replacements in effect, by number. A file that isn't whole JSON was never finished and doesn't count."""
    if not exists(spark, f"{path}/{SWAPS}"):
        return {}
    found = {}
    rows = spark.read.option("wholetext", "true").text(f"{path}/{SWAPS}").select("value", "_metadata.file_name")
    for r in rows.collect():  # names of folders
        try:
            entry = json.loads(r["value"])
        except ValueError:
            continue
        found[int(r["file_name"].split(".")[0])] = Swap(entry["kind"], entry["at"], tuple(
            Step(s["made"], tuple(map(tuple, s["replaced"]))) for s in entry["steps"]
        ))
    return dict(sorted(found.items()))


def counting(found: list[Unit], known: dict[int, Swap]) -> list[Unit]:
    """The folders that count: none that was replaced, and of the new ones those whose replacement is in effect."""
    steps = [s for swap in known.values() for s in swap.steps]
    gone = {folder for s in steps for folder, _ in s.replaced}
    made = {s.made for s in steps}
    return [u for u in found if u.folder not in gone and (u.folder in made or not u.batch.startswith(MADE))]


def live(spark: SparkSession, path: str) -> list[Unit]:
    return counting(units(spark, path), swaps(spark, path))


def read_units(spark: SparkSession, path: str, contract: T.StructType, chosen: list[Unit]) -> DataFrame:
    """The rows of the given folders, with their month and batch."""
    schema = T.StructType(contract.fields + PARTITIONS)
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{u.folder}" for u in chosen])


def new_name() -> str:
    return f"{MADE}{uuid.uuid4().hex[:12]}"


def event_time(contract: T.StructType) -> str:
    """The time that a raw table's months follow: its contract's first timestamp."""
    return next(f.name for f in contract.fields if isinstance(f.dataType, T.TimestampType))


@contextmanager
def _one_after_the_other(spark: SparkSession):
    """A union keeps its sides' partitions. Since Spark 4.1 it would otherwise merge sides of one partition each into one."""
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def replace(
    spark: SparkSession, path: str, contract: T.StructType, kind: str, rows: DataFrame | list[DataFrame],
    sources: dict[str, list[Unit]], sort_by: list[str], expected: int | None = None,
) -> list[Unit]:
    """Put ``rows`` in the place of folders. ``sources`` names the folders that each new folder (a key) replaces; the rows
    carry the new folder's name in ``batch`` and their month. A new folder without rows doesn't come to be, and its
    sources go. A new folder gets one file; rows in several frames are written frame by frame as they lie in partitions.

    Returns the new folders. Nothing counts before the last step. That step fails, and the table stays as it is, where the
    new folders hold another number of rows than ``expected`` or where someone else replaced a folder meanwhile.
    """
    wanted = {folder.split("/batch=")[1] for folder in sources}
    day = F.to_date(event_time(contract))
    with _one_after_the_other(spark):
        for part in rows if isinstance(rows, list) else [rows.repartition(len(wanted), "event_month", "batch")]:
            (
                part.sortWithinPartitions("event_month", "batch", day, *(sort_by or [event_time(contract)]))
                .write.mode("append").partitionBy("event_month", "batch").parquet(path)
            )
    made = [u for u in units(spark, path) if u.batch in wanted]
    if expected is not None and (found := read_units(spark, path, contract, made).count()) != expected:
        raise RuntimeError(f"{found} rows written in the place of {expected}")
    have = {u.folder for u in made}
    commit(spark, path, kind, [
        Step(folder if folder in have else None, tuple((u.folder, u.source) for u in olds)) for folder, olds in sources.items()
    ])
    return made


def commit(spark: SparkSession, path: str, kind: str, steps: list[Step]) -> int:
    """Write the file that puts a replacement into effect; returns its number.

    Numbers are taken one after the other and never twice, so of two runs at a time the second sees the first one's file.
    """
    system, place, jvm = file_system(spark, path)
    body = json.dumps({
        "kind": kind, "at": time.time(), "steps": [{"made": s.made, "replaced": s.replaced} for s in steps],
    }).encode()
    mine = {folder for s in steps for folder, _ in s.replaced}
    while True:
        taken = [int(str(s.getPath().getName()).split(".")[0]) for s in system.globStatus(jvm.org.apache.hadoop.fs.Path(place, f"{SWAPS}/*.json")) or []]
        gone = {folder for swap in swaps(spark, path).values() for s in swap.steps for folder, _ in s.replaced}
        if clash := mine & gone:
            raise RuntimeError(f"replaced by another run: {sorted(clash)[:3]}")
        number = max(taken, default=0) + 1
        file = jvm.org.apache.hadoop.fs.Path(place, f"{SWAPS}/{number:012d}.json")
        try:
            out = system.create(file, False)  # fails if the number is taken
        except Exception:
            if system.exists(file):
                continue
            raise
        out.write(bytearray(body))
        out.close()
        return number


def delete(spark: SparkSession, path: str, folders: list[str]) -> list[str]:
    """Delete folders below the table; one that is gone already is no error."""
    system, place, jvm = file_system(spark, path)
    return [f for f in folders if system.delete(jvm.org.apache.hadoop.fs.Path(place, f), True)]


def vacuum(spark: SparkSession, path: str, hours: float = 24.0) -> list[str]:
    """Delete folders that no longer count: replaced ones, and those of runs that died, once ``hours`` have passed since."""
    found, known, now = units(spark, path), swaps(spark, path), time.time()
    when = {folder: swap.at for swap in known.values() for s in swap.steps for folder, _ in s.replaced}
    counts = {u.folder for u in counting(found, known)}
    return delete(spark, path, [
        u.folder for u in found
        if u.folder not in counts and now - max(u.changed, when.get(u.folder, 0)) >= hours * 3600
    ])


# --- compaction ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Compaction:
    files_before: int
    files_after: int
    folders_before: int
    folders_after: int


def bins(chosen: list[Unit], target: int = TARGET_BYTES) -> list[list[Unit]]:
    """Folders to be merged, by month: largest first, each into the first bin of its month with room for its size.

    A folder as large as a file should be has a bin of its own and is left alone unless it has more files than its size
    asks for. A bin that would change nothing is left out.
    """
    by_month = defaultdict(list)
    for u in sorted(chosen, key=lambda u: (-u.size, u)):
        open_ = by_month[u.month]
        for held in open_:
            if sum(x.size for x in held) + u.size <= target:
                held.append(u)
                break
        else:
            open_.append([u])
    return [
        held for month in sorted(by_month) for held in by_month[month]
        if len(held) > 1 or held[0].files > file_count(held, target)
    ]


def file_count(held: list[Unit], target: int) -> int:
    return max(1, -(-sum(u.size for u in held) // target))


def compact(
    spark: SparkSession, path: str, contract: T.StructType, sort_by: list[str] | None = None, target: int = TARGET_BYTES,
    before: str | None = None,
) -> Compaction:
    """Merge small folders of each month into files of about ``target`` bytes; the rows stay the same.

    ``before`` leaves out batches from that name on, such as one that is being written. The rows are counted on both
    sides before the new folders count. Running it again finds nothing to do; after a crash it begins anew.
    """
    now = live(spark, path)
    todo = bins([u for u in now if before is None or u.batch.startswith(MADE) or u.batch < before], target)
    old = {u for held in todo for u in held}
    made = []
    if old:
        sources = {f"event_month={held[0].month}/batch={new_name()}": held for held in todo}
        rows = read_units(spark, path, contract, sorted(old))
        made = replace(
            spark, path, contract, "compact", _merged(rows, contract, sources, target), sources, sort_by or [], rows.count(),
        )
    after = [u for u in now if u not in old] + made
    return Compaction(sum(u.files for u in now), sum(u.files for u in after), len(now), len(after))


def _merged(rows: DataFrame, contract: T.StructType, sources: dict[str, list[Unit]], target: int) -> list[DataFrame]:
    """The rows with the name of their new folder in ``batch``, ROUND folders a frame. Old folders that make one file are
    read by one task, so that their rows aren't shuffled."""
    day = F.to_date(event_time(contract))
    found = []
    for folder, held in sources.items():
        month = None if held[0].month == NO_MONTH else held[0].month
        own = F.col("event_month").eqNullSafe(F.lit(month).cast("date")) & F.col("batch").isin([u.batch for u in held])
        part = rows.where(own).withColumn("batch", F.lit(folder.split("/batch=")[1]))
        files = file_count(held, target)
        # days stay together, so that a file covers few of them
        found.append(part.coalesce(1) if files == 1 else part.repartition(files, day))
    return [reduce(DataFrame.unionByName, found[k: k + ROUND]) for k in range(0, len(found), ROUND)]


def _moved(spark: SparkSession, rows: DataFrame, sources: dict[str, list[Unit]]) -> DataFrame:
    """The rows with the name of their new folder in ``batch``."""
    names = spark.createDataFrame(
        [(u.month, u.batch, folder.split("/batch=")[1]) for folder, held in sources.items() for u in held],
        "old_month string, old_batch string, new_batch string",
    )  # one row per folder
    month = F.coalesce(F.col("event_month").cast("string"), F.lit(NO_MONTH))
    return (
        rows.join(F.broadcast(names), (month == F.col("old_month")) & (F.col("batch") == F.col("old_batch")))
        .withColumn("batch", F.col("new_batch")).drop("old_month", "old_batch", "new_batch")
    )


def rewrite(spark: SparkSession, path: str, contract: T.StructType, kind: str, kept: DataFrame, touched: list[Unit]) -> list[Unit]:
    """Put ``kept``, the rows that stay of the touched folders, in their place: one new folder per month.

    The old folders are deleted at once: what is erased has to go. A reader that still uses them fails and starts again.
    """
    by_month: dict[str, list[Unit]] = defaultdict(list)
    for u in touched:
        by_month[u.month].append(u)
    sources = {f"event_month={month}/batch={new_name()}": held for month, held in by_month.items()}
    made = replace(spark, path, contract, kind, _moved(spark, kept, sources), sources, [])
    delete(spark, path, [u.folder for u in touched])
    return made
