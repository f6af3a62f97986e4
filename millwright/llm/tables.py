"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from millwright.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What separates words: every ASCII character that is no letter and no digit.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(frame: DataFrame, purpose: str, group_bytes: int | None = None) -> DataFrame:
    """The rows written to the cluster's shared folder and read again. Where single rows are large, ``group_bytes`` keeps
    row groups small, so that a task need not read a whole file.

    This cuts the lineage and keeps a costly result for several readers; a lost executor costs
    nothing that was written.
    """
    spark = frame.sparkSession
    path = shared_dir(spark, purpose)
    write = frame.write.option("parquet.block.size", group_bytes) if group_bytes else frame.write
    write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text in lower case (A-Z only); none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN_WORDS), "")


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes, which stand for a text where the text itself is too wide.

    A null text has a key of its own.
    """
    return [
        F.xxhash64(text, F.lit(1)).alias("key_1"),
        F.xxhash64(F.lit(2), F.length(text), text).alias("key_2"),
    ]


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def arrow_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows of a task as a batch; nulls and whole numbers stay exact, which pandas does not grant."""
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library than glibc
    _trim = None


def give_back() -> None:
    """Return freed memory to the system. A Python worker waits for the next task with all that it once held, beside other
    workers of its executor."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)
