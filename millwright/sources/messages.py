"""Event messages: Kafka, and the same rows as JSON files.

Both readers give ``value`` plus topic, partition, offset and timestamp (arrival), so everything
downstream is shared. The Kafka connector is a separate package of Spark; without it the readers
below fail when Spark looks up the format, and the option builders still work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Rows per send, and the producer's linger and batch size.
BATCH_ROWS = 25_000
LINGER_MS = 50
BATCH_BYTES = 65_536

MESSAGE_COLUMNS = ("value", "topic", "partition", "offset", "timestamp")


def kafka_read_options(
    servers: str, topic: str, max_rows_per_trigger: int | None = None, starting: str = "earliest"
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_rows_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_rows_per_trigger)
    return options


def kafka_write_options(servers: str, topic: str, acks: str = "all") -> dict[str, str]:
    """``acks`` is stricter than the producer's usual 1: a lost broker then loses no message."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": acks,
        "kafka.linger.ms": str(LINGER_MS),
        "kafka.batch.size": str(BATCH_BYTES),
    }


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    rows = spark.readStream.format("kafka").options(**kafka_read_options(**options)).load()
    return rows.select(*MESSAGE_COLUMNS)


_LINE = T.StructType([T.StructField("value", T.StringType())])


def stream_files(
    spark: SparkSession, path: str, topic: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of text files with one message per line. The file and the position of a line's
    block stand in for partition and offset; a file's time is the arrival time."""
    reader = spark.readStream.format("text").schema(_LINE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _from_files(reader.load(path), topic)


def batch_files(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return _from_files(spark.read.schema(_LINE).text(path), topic)


def _from_files(lines: DataFrame, topic: str) -> DataFrame:
    """A text line has no offset; a digest of it stands in, which equal lines share."""
    return lines.select(
        "value",
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("value").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def as_messages(rows: DataFrame, contract: T.StructType) -> DataFrame:
    """Contract rows as JSON text in ``value``: ISO times in UTC with a Z, NULLs written out.

    A time's fraction of a second is written as far as it has one.
    """
    fields = [
        F.concat(
            F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss"),
            F.regexp_replace(F.date_format(f.name, ".SSSSSS"), "[.]?0*$", ""),
            F.lit("Z"),
        ).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in contract.fields
        if f.name in rows.columns
    ]
    return rows.select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    )


def publish(messages: DataFrame, **options) -> None:
    messages.select("value").write.format("kafka").options(**kafka_write_options(**options)).save()


def publish_files(messages: DataFrame, path: str, rows_per_file: int = BATCH_ROWS) -> None:
    """The file twin of ``publish``; files of the producer's batch size, or of another where that makes too many. They are
    packed, as JSON repeats its field names in every line; a file is small, so nothing is lost in that one task reads it."""
    messages.select("value").write.mode("append").option("maxRecordsPerFile", rows_per_file).option(
        "compression", "gzip"
    ).text(path)
