"""Sharding by sampled splitters: shards of nearly equal bytes from range-partitioned records.

Records are ordered by (key, doc_id), the key being a hash of the text: the order is as good as shuffled, and
equal texts lie side by side. A size-weighted sample of keys gives quantile boundaries of many ranges. Ranges
that turn out overfull, because a group of equal texts falls into them, are subdivided by boundaries from a
second sample that also looks at doc_id and row. Running sums inside the ranges, plus the ranges' totals, give
every record's place in the whole order, which is cut into shards of equal bytes.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millwright.llm.tables import saved

#: Rows of a range on average, ranges at most, sampled keys per range.
RANGE_ROWS, MOST_RANGES, SAMPLED = 8192, 8192, 32
#: A range with more than so many times its share of bytes is subdivided.
OVERFULL = 2


def _sample(rows: DataFrame, chance, columns: list[str]) -> list[tuple]:
    """Rows drawn by a hash of what identifies them: `chance` is the expected number of draws."""
    dice = F.pmod(F.xxhash64("key", "doc_id", "tie", F.lit("dice")), F.lit(1 << 30)) / float(1 << 30)
    return [tuple(r) for r in rows.where(dice < chance).select(*columns).collect()]


def _quantiles(values: list, parts: int) -> list:
    values = sorted(values)
    return sorted({values[len(values) * k // parts] for k in range(1, parts)}) if values else []


def assign(documents: DataFrame, shards: int = 8, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, slot and the columns to carry (the text, to write it).

    `size` is the text's UTF-8 bytes plus one; null counts as empty. Shards are cut from one order of all
    rows, so their bytes differ by no more than a row; `slot` counts a shard's rows from 0 without gaps. Repeated
    rows are rows like others. With fewer rows than shards some shards are empty; an empty table gives none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # one written copy, read by all steps: counts, samples and places agree whatever is run again
    rows = saved(documents.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.monotonically_increasing_id().alias("tie"),
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("int").alias("carried"),
    ), "sharding")
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    ranges = max(1, min(MOST_RANGES, -(-total["n"] // RANGE_ROWS)))
    share = (total["bytes"] or 0) / ranges
    drawn = _sample(rows, F.col("size") * (ranges * SAMPLED / max(1, total["bytes"] or 0)), ["key"])
    splitters = np.array(_quantiles([k for k, in drawn], ranges), np.int64)

    @F.pandas_udf("int")
    def coarse(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, key.to_numpy(), side="right").astype(np.int32))

    dealt = rows.withColumn("range", coarse("key"))
    over = {
        r["range"]: r["bytes"]
        for r in dealt.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > OVERFULL * share).collect()
    }  # at most `ranges` / OVERFULL rows
    finer: dict[int, list[tuple]] = {}
    if over:
        crowded = dealt.where(F.col("range").isin(list(over)))
        for r, *place in _sample(
            crowded, F.col("size") * (SAMPLED / max(1.0, share)),
            ["range", "key", F.coalesce("doc_id", F.lit(-(1 << 63))), "tie"],
        ):
            finer.setdefault(r, []).append(tuple(place))
        finer = {r: _quantiles(x, max(1, round(over[r] / share))) for r, x in finer.items()}

    @F.pandas_udf("int")
    def fine(range_: pd.Series, key: pd.Series, doc_id: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([
            bisect_right(finer[r], (k, d, t)) if r in finer else 0
            for r, k, d, t in zip(range_.tolist(), key.tolist(), doc_id.tolist(), tie.tolist())
        ], dtype="int32")

    dealt = dealt.withColumn("part", fine("range", "key", F.coalesce("doc_id", F.lit(-(1 << 63))), "tie"))
    place = ["key", F.col("doc_id").asc_nulls_first(), "tie"]
    sums = dealt.groupBy("range", "part").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    before, at_row, at_byte = [], 0, 0
    for r in sorted(sums):  # a row per range, a bounded number
        before.append((r["range"], r["part"], at_row, at_byte))
        at_row, at_byte = at_row + r["n"], at_byte + r["bytes"]
    spark = documents.sparkSession
    before = spark.createDataFrame(before, "range int, part int, row0 long, byte0 long")
    inside = W.partitionBy("range", "part").orderBy(*place).rowsBetween(W.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("bytes_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("rows_before", F.count("*").over(inside))
        .join(F.broadcast(before), ["range", "part"])
        .select(
            "doc_id", "size", "text_crc32", "carried",
            (F.col("row0") + F.col("rows_before")).alias("position"),
            F.least(
                F.lit(shards - 1),
                # the shard that the row's middle falls into
                F.expr(f"cast(((byte0 + bytes_before) * 2 + size) * {shards} div {2 * max(1, total['bytes'] or 0)} as int)"),
            ).alias("shard"),
        )
    )
    first = saved(placed.drop("carried") if not carry else placed, "sharded")
    start = first.groupBy("shard").agg(F.min("position").alias("start"))  # one row per shard
    out = first.join(F.broadcast(start), "shard").withColumn("slot", F.col("position") - F.col("start"))
    return out.select("doc_id", "size", "text_crc32", "shard", "slot", *[f"carried.{c}" for c in carry])


def write(documents: DataFrame, path: str, shards: int = 8) -> None:
    """Writes doc_id and text in `shards` folders, each row with its slot."""
    rows = assign(documents, shards, carry=("text",))
    rows.select("shard", "slot", "doc_id", "text").repartitionByRange("shard", "slot").sortWithinPartitions(
        "shard", "slot"
    ).write.partitionBy("shard").parquet(path)
