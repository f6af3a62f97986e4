"""Messages that were delivered before, however long ago.

`seen` is a raw table (see ``sources.layout``) of the digests of all payloads, by the month of the event and by batch. A
payload that comes again has the same event time and so can only be in its month. For every folder there is a Bloom
filter, a derived table (``sources.derived``) of bitmaps of 32,768 bits. A new batch is held against the filters of its
months; the few digests that a filter lets pass are compared with the digests stored in that filter's folder, and
only these folders are read. A filter errs on one side alone, and what it lets pass is compared in full, so no message is
taken for another.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millwright.operators.quality import first_delivery
from millwright.sources import derived, layout
from millwright.sources.tables import append_raw

SEEN = T.StructType([T.StructField("event_time", T.TimestampType()), T.StructField("digest", T.BinaryType())])
FILTERS = T.StructType([
    T.StructField("blocks", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("bits", T.BinaryType()),
])
#: Bits of a bitmap, as Spark's bitmap functions have it.
BITMAP = 32_768
#: Share of new payloads that a folder's filter lets pass.
FALSE_POSITIVES = 1e-4


@dataclass(frozen=True)
class Shape:
    """Bits and hashes per key of a filter with the given share of false positives."""

    bits: float
    hashes: int

    @classmethod
    def of(cls, false_positives: float) -> Shape:
        bits = -math.log(false_positives) / math.log(2) ** 2
        return cls(bits, max(1, round(bits * math.log(2))))


def digest(value: Column) -> Column:
    return F.unhex(F.sha2(value.cast("string"), 256))


def _place(n: int) -> Column:
    """The key's n-th bit in its bitmap."""
    return F.pmod(F.xxhash64("digest", F.lit(n)), F.lit(BITMAP))


def _block() -> Column:
    return F.pmod(F.xxhash64("digest", F.lit("block")), F.col("blocks")).cast("int")


def filters(seen: DataFrame, by: list[str], false_positives: float = FALSE_POSITIVES) -> DataFrame:
    """The Bloom filters of digests, one per ``by``: a row for each of its bitmaps. A key has all its bits in one bitmap."""
    shape = Shape.of(false_positives)
    size = seen.groupBy(*by).agg(F.greatest(F.ceil(F.count("*") * shape.bits / BITMAP), F.lit(1)).cast("int").alias("blocks"))
    bits = F.explode(F.array(*[_place(n) for n in range(shape.hashes)]))
    return (
        seen.join(size, by).select(*by, "blocks", _block().alias("block"), bits.alias("bit"))
        .groupBy(*by, "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )


def _is_set(n: int) -> Column:
    """Whether the key's n-th bit is set in the bitmap of its row."""
    place = _place(n)
    byte = F.substring("bits", F.shiftright(place, 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), place.bitwiseAND(7).cast("int")) == 1


def suspects(keys: DataFrame, known: DataFrame, false_positives: float = FALSE_POSITIVES) -> DataFrame:
    """(event_month, batch, digest): the keys that a folder's filter lets pass. ``keys`` has event_month and digest."""
    heads = known.select("event_month", "batch", "blocks").distinct()
    asked = keys.join(heads, "event_month").withColumn("block", _block())
    found = asked.join(known.select("event_month", "batch", "block", "bits"), ["event_month", "batch", "block"])
    for n in range(Shape.of(false_positives).hashes):
        found = found.where(_is_set(n))
    return found.select("event_month", "batch", "digest")


def keyed(messages: DataFrame, ts: str) -> DataFrame:
    return messages.withColumns({"digest": digest(F.col("value")), "event_month": F.trunc(F.to_date(ts), "month")})


@dataclass(frozen=True)
class Repeats:
    """Digests that history holds, and the folders of `seen` that had to be read to be sure."""

    digests: DataFrame
    read: tuple[layout.Unit, ...]


def repeats(spark: SparkSession, messages: DataFrame, path: str, batch: str, false_positives: float = FALSE_POSITIVES) -> Repeats:
    """The digests of ``keyed`` messages that other batches delivered. A batch that runs again doesn't meet itself."""
    months = {
        str(r[0]) if r[0] else layout.NO_MONTH for r in messages.select("event_month").distinct().collect()  # a calendar's months
    }
    now = {u.folder: u for u in layout.live(spark, f"{path}/seen") if u.batch != batch and u.month in months}
    known = derived.read(spark, f"{path}/filters", FILTERS, [
        p for p in _filters(spark, path, false_positives).counting if p[0] in now
    ])
    found = suspects(messages.select("event_month", "digest").distinct(), known, false_positives).persist()  # few
    passed = {f"event_month={r['event_month']}/batch={r['batch']}" for r in found.select("event_month", "batch").distinct().collect()}
    read = tuple(u for folder, u in now.items() if folder in passed)
    stored = layout.read_units(spark, f"{path}/seen", SEEN, list(read))
    sure = found.join(stored, ["event_month", "batch", "digest"], "left_semi")
    return Repeats(sure.select("digest").distinct(), read)


def _filters(spark: SparkSession, path: str, false_positives: float) -> derived.State:
    return derived.refresh(
        spark, f"{path}/seen", SEEN, f"{path}/filters", lambda seen, by: filters(seen, by, false_positives), additive=False
    )


def first_deliveries(
    spark: SparkSession, messages: DataFrame, ts: str, path: str, batch: str, order: list[str],
    false_positives: float = FALSE_POSITIVES,
) -> DataFrame:
    """The messages whose payload neither an earlier batch nor an earlier row of this one (by ``order``) delivered; with
    their digest and event_month."""
    with_key = keyed(messages, ts)
    return first_delivery(with_key, ["digest"], order).join(
        repeats(spark, with_key, path, batch, false_positives).digests, "digest", "left_anti"
    )


def remember(spark: SparkSession, messages: DataFrame, ts: str, path: str, batch: str, false_positives: float = FALSE_POSITIVES) -> None:
    """Add a batch's accepted messages to history. A batch that is remembered again replaces itself."""
    append_raw(messages.select(F.col(ts).alias("event_time"), "digest"), f"{path}/seen", "event_time", batch, ["digest"])
    _filters(spark, path, false_positives)


def compact_history(spark: SparkSession, path: str, before: str, false_positives: float = FALSE_POSITIVES) -> layout.Compaction:
    """Merge the folders of batches before the named one, so that a month has few filters to ask. Batches that may still
    run again must not be among them: they would meet themselves."""
    found = layout.compact(spark, f"{path}/seen", SEEN, ["digest"], before=before)
    _filters(spark, path, false_positives)
    return found
