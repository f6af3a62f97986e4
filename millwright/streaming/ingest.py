"""Messages to raw tables: parse, validate, quarantine, drop repeats, append exactly once.

No event-time watermark is involved. A backfill arrives as many runs, each sorted over the whole
period, and a watermark on event time would drop most of it as late.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millwright.contracts import wire
from millwright.operators.project import with_defaults
from millwright.operators.quality import (
    accepted,
    parse_messages,
    quarantined,
    validate,
)
from millwright.sources.tables import append_raw
from millwright.streaming.history import first_deliveries, remember

POSITION = ["topic", "partition", "offset"]


def checked(messages: DataFrame, contract: T.StructType) -> DataFrame:
    return validate(parse_messages(messages, wire(contract)), wire(contract))


def without_redeliveries(messages: DataFrame, within: str) -> DataFrame:
    """For live streams: drop a payload seen before, from a producer's retry, which has an offset
    of its own. The watermark is on arrival time, which only moves forward; state is kept for
    ``within`` and then released."""
    return (
        messages.withColumn("payload", F.sha2(F.col("value").cast("string"), 256))
        .withWatermark("timestamp", within)
        .dropDuplicatesWithinWatermark(["topic", "payload"])
        .drop("payload")
    )


def ingest(
    messages: DataFrame,
    contract: T.StructType,
    ts: str,
    raw_path: str,
    quarantine_path: str,
    checkpoint: str,
    sort_by: list[str],
    available_now: bool = True,
    every: str = "1 hour",
    history: str | None = None,
) -> StreamingQuery:
    """Start the flush. With ``available_now`` it takes what has arrived and stops, which is the
    hourly form; otherwise it runs on and flushes at the given interval.

    Spark replays a batch that failed half-way with the same rows and the same number. Both sinks
    write a batch under its number and replace it, so a replay changes nothing. Equal messages are
    all kept: two equal readings are two readings. Two rules remove repeats, the same for every source and
    every size of batch: ``without_redeliveries`` within a time, and ``history``, a folder in which the
    digests of all accepted payloads are kept (see ``streaming.history``), without end.
    """
    row_id = contract.fields[0].name
    columns = [f.name for f in contract.fields]

    def flush(batch: DataFrame, number: int) -> None:
        # These settings reach the stream's own session only. Adaptive execution is off there for a
        # stateful stream, but the writes are ordinary batch plans and need it to split a crowded
        # date. Merging small partitions would not save a file, a date being in one partition
        # either way; it would only leave all dates of a small batch to one task.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        batch.sparkSession.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        name = f"{number:012d}"
        rows = checked(batch, contract).withColumn("place", F.monotonically_increasing_id())
        if not history:  # which alone asks for the payload of an accepted message
            rows = rows.withColumn("value", F.when(F.size("reasons") > 0, F.col("value")))
        # Kept on disk: a batch can be a whole backfill, of which memory would hold a small part only and be full of it.
        kept = [rows := rows.persist(StorageLevel.DISK_ONLY)]
        try:
            fresh = accepted(rows)
            if history:
                spark = batch.sparkSession
                fresh = first_deliveries(spark, fresh, ts, history, name, [*POSITION, "place"]).drop("value")
                kept.append(fresh := fresh.persist(StorageLevel.DISK_ONLY))
                remember(spark, fresh, ts, history, name)
            good = with_defaults(fresh, row_id, [*POSITION, F.lit(number), "place"], F.current_timestamp())
            append_raw(good.select(*columns), raw_path, ts, name, sort_by)
            (
                quarantined(rows)
                .select(*POSITION, "timestamp", F.col("value").cast("string"), "reasons")
                .withColumn("batch", F.lit(name))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch")
                .parquet(quarantine_path)
            )
        finally:
            for frame in kept:
                frame.unpersist()

    writer = messages.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()
