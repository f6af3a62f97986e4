"""From a feature row back to its raw events, and whether the two sides agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright import contracts as c
from millwright.functions.measures import quarter_start
from millwright.operators.partials import KEYS, partial_sums
from millwright.operators.project import in_quarter


def trace(events: DataFrame, features: DataFrame) -> DataFrame:
    """Raw events behind the given feature rows. The feature side holds each key once; no hint,
    so its measured size decides between broadcast and a skew-split shuffle join."""
    return events.withColumn("quarter_start", quarter_start(F.col("event_timestamp"))).join(
        features.select("quarter_start", "asset_id"), ["quarter_start", "asset_id"], "left_semi"
    )


def trace_key(events: DataFrame, quarter: str, asset_id: str) -> DataFrame:
    """Raw events behind one feature row: plain filters, so partitions and row groups prune."""
    return in_quarter(events, "event_timestamp", quarter).where(F.col("asset_id") == asset_id)


def recorded(raw: DataFrame, topic: str) -> DataFrame:
    """Partial sums per feature key and raw file, with the range of rows in that file that went into them.

    ``raw`` is read from files. Adding the sums up (``partials.added_up``) gives the features, so that one pass over the raw
    rows yields both the features and where each of them comes from.
    """
    placed = raw.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
    rows = (F.min("row_index").alias("first_row"), F.max("row_index").alias("last_row"))
    return partial_sums(placed, topic, ["file_path"], rows)


def origins(record: DataFrame, features: DataFrame, topic: str) -> DataFrame:
    """The files and row ranges of the given feature rows: key, file_path, first_row, last_row."""
    key = ["quarter_start", *KEYS[topic]]
    wanted = features.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    return record.join(wanted, [record[k].eqNullSafe(wanted[f"_{k}"]) for k in key], "left_semi").select(
        *key, "file_path", "first_row", "last_row"
    )


#: Words of the bit table that sorts out rows before they are moved. Fixed, so that it stays small whatever the input; a full
#: table only sorts out less.
_WORDS = 1 << 18


def _marked(rows: DataFrame, key: list[str], wanted: DataFrame) -> DataFrame:
    """The rows whose key may be in ``wanted``: all that are, and few others."""
    digest = f"xxhash64({', '.join(key)})"
    word = F.expr(f"pmod({digest}, {_WORDS}L)")
    bits = F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned({digest}, {at}) & 63 as int))" for at in (40, 52)))
    table = wanted.select(word.alias("_word"), bits.alias("_set")).groupBy("_word").agg(F.bit_or("_set").alias("_set"))
    placed = rows.withColumns({"_word": word, "_bits": bits}).join(F.broadcast(table), "_word")
    return placed.where(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits")).drop("_word", "_bits", "_set")


def trace_recorded(spark: SparkSession, record: DataFrame, features: DataFrame, topic: str, contract: T.StructType) -> DataFrame:
    """Raw rows behind the given feature rows, all columns and their quarter, from no other files than those recorded.

    Compaction and erasure put new files in the place of old ones; the record has to be made anew after them.
    """
    found = origins(record, features, topic)
    files = [r["file_path"] for r in found.select("file_path").distinct().collect()]  # names of files
    key = ["quarter_start", *KEYS[topic]]
    if not files:
        return spark.createDataFrame([], T.StructType(contract.fields + [T.StructField("quarter_start", T.DateType())]))
    ranges = found.select(*[F.col(k).alias(f"_{k}") for k in [*key, "file_path"]], "first_row", "last_row")
    rows = (
        spark.read.schema(contract).parquet(*files)
        .select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("row_index"))
        .withColumn("quarter_start", quarter_start(F.col(c.EVENT_TIME[topic])))
    )
    rows = _marked(rows, key, features.select(*key))
    # the ranges hold each key and file once
    same = [rows[k].eqNullSafe(ranges[f"_{k}"]) for k in key] + [rows["file_path"] == ranges["_file_path"]]
    inside = F.col("row_index").between(F.col("first_row"), F.col("last_row"))
    return rows.join(ranges, same).where(inside).select(*contract.names, "quarter_start")


def reconcile(events: DataFrame, features: DataFrame) -> DataFrame:
    """Keys on which raw events and feature rows disagree. Both sides are one row per key before
    they meet, and one full outer join answers both directions and compares the counts."""
    raw = events.groupBy(
        quarter_start(F.col("event_timestamp")).alias("quarter_start"), "asset_id"
    ).agg(F.count("*").alias("raw_count"))
    published = features.select(
        "quarter_start", "asset_id", F.col("event_count").alias("feature_count")
    )
    status = (
        F.when(F.col("feature_count").isNull(), "missing_feature")
        .when(F.col("raw_count").isNull(), "orphan_feature")
        .when(F.col("raw_count") != F.col("feature_count"), "count_mismatch")
    )
    return (
        raw.join(published, ["quarter_start", "asset_id"], "full_outer")
        .withColumn("status", status)
        .where(F.col("status").isNotNull())
    )
