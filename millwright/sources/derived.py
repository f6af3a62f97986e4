"""Tables that are worked out folder by folder from a raw table, and only once for each.

A derived table has the folders of its raw table with a level below: `event_month=…/batch=…/source=<digest>`, the digest of
the raw folder's files. A raw folder that is written again gets other files and so another digest: what was derived
before no longer counts. Which derived folders count follows from the raw table's folders alone, so a run that died is
repeated without a trace.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.sources import layout
from millwright.sources.layout import Swap, Unit

Part = tuple[str, str]  # a raw folder and its digest


@dataclass(frozen=True)
class State:
    """The parts that make up the derived table, the raw folders they still lack, and stored parts that don't count."""

    counting: tuple[Part, ...]
    lacking: tuple[Unit, ...]
    stale: tuple[Part, ...]


def place(part: Part) -> str:
    folder, source = part
    return f"{folder}/source={source}"


def stored(spark: SparkSession, path: str) -> set[Part]:
    """The parts that are there, by the names of their folders."""
    system, root, jvm = layout.file_system(spark, path)
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(root, "event_month=*/batch=*/source=*")) or []
    names = (str(status.getPath()).split("/")[-3:] for status in found)
    return {(f"{month}/{batch}", source.split("=", 1)[1]) for month, batch, source in names}


def state(now: list[Unit], swaps: dict[int, Swap], have: set[Part], additive: bool) -> State:
    """What counts for the raw folders ``now``.

    ``additive`` parts add up: those of the folders that a compaction merged stand for the merged one, so nothing is worked
    out again. Otherwise every raw folder has a part of its own.
    """
    merged = {s.made: s.replaced for swap in swaps.values() if swap.kind == "compact" for s in swap.steps if s.made}

    def parts_of(folder: str, source: str) -> list[Part] | None:
        if (folder, source) in have:
            return [(folder, source)]
        if not additive or folder not in merged:
            return None
        found = [parts_of(*old) for old in merged[folder]]
        return None if any(f is None for f in found) else [p for f in found for p in f]

    counting, lacking = [], []
    for unit in now:
        found = parts_of(unit.folder, unit.source)
        if found is None:
            lacking.append(unit)
            found = [(unit.folder, unit.source)]
        counting += found
    return State(tuple(counting), tuple(lacking), tuple(sorted(have - set(counting))))


def look(spark: SparkSession, raw: str, path: str, additive: bool) -> State:
    return state(layout.live(spark, raw), layout.swaps(spark, raw), stored(spark, path), additive)


def refresh(
    spark: SparkSession, raw: str, contract: T.StructType, path: str, compute: Callable[[DataFrame, list[str]], DataFrame],
    additive: bool,
) -> State:
    """Work out the parts that are lacking, from their raw folders alone, and delete those that don't count.

    ``compute`` takes rows and the names of columns to be grouped by besides its own; these must stay in its result.
    """
    found = look(spark, raw, path, additive)
    if found.lacking:
        names = _names(spark, list(found.lacking))
        rows = sourced(spark, raw, contract, list(found.lacking)).drop("event_month", "batch", "source")
        # what is moved carries the folder's number, not its names
        parts = compute(rows, ["folder"]).repartition("folder").join(F.broadcast(names), "folder").drop("folder", "_month")
        (
            parts.withColumnRenamed("_batch", "batch")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_month", "batch", "source").parquet(path)
        )
    layout.delete(spark, path, [place(p) for p in found.stale])
    return found


def _names(spark: SparkSession, chosen: list[Unit]) -> DataFrame:
    """One row per folder: its number, month as text and as a date, batch and digest."""
    return spark.createDataFrame(
        [(k, u.month, u.batch, u.source) for k, u in enumerate(chosen)], "folder int, _month string, _batch string, source string"
    ).withColumn("event_month", F.when(F.col("_month") != layout.NO_MONTH, F.col("_month")).cast("date"))


def sourced(spark: SparkSession, raw: str, contract: T.StructType, chosen: list[Unit]) -> DataFrame:
    """The rows of the folders with month, batch, the folder's digest and its number among those chosen."""
    names = _names(spark, chosen).drop("event_month")
    rows = layout.read_units(spark, raw, contract, chosen)
    month = F.coalesce(F.col("event_month").cast("string"), F.lit(layout.NO_MONTH))
    # named as small: without it both sides would be shuffled before their sizes are known
    same = (month == F.col("_month")) & (F.col("batch") == F.col("_batch"))
    return rows.join(F.broadcast(names), same).drop("_month", "_batch")


def read(spark: SparkSession, path: str, schema: T.StructType, parts: tuple[Part, ...] | list[Part]) -> DataFrame:
    """The rows of the parts, in the columns of ``schema`` and the three of their folders."""
    whole = T.StructType(schema.fields + layout.PARTITIONS + [T.StructField("source", T.StringType())])
    if not parts:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*[f"{path}/{place(p)}" for p in parts])
