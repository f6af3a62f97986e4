"""Find word sequences of a bounded list in long texts with built-in expressions.

A text's words are hashed once; every run of n hashes gives one hash. A bit table made from the list's own
hashes (a literal of bounded size in the plan) lets nearly all places of a text go by without leaving the
row; the few that remain carry their words, so that the later join compares words, not only hashes. A
bit table that is too full only lets more places through: results don't depend on its size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most 2**22 bits (half a megabyte) go into the plan.
MOST_BITS = 22


def gram_hash(hashes: Column, start: Column, n: Column | int) -> Column:
    return F.xxhash64(F.slice(hashes, start + 1, n))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def starts(count: Column, n: int) -> Column:
    """0 .. count - n, or nothing."""
    return F.when(count >= n, F.sequence(F.lit(0), count - n)).otherwise(F.array().cast("array<int>"))


def grams(words: Column, n: int) -> Column:
    """All runs of n words: (start, length, gram)."""
    return F.transform(starts(F.size(words), n), _gram_at(words, n))


def _gram_at(words: Column, n: int):
    return lambda i: F.struct(
        i.alias("start"), F.lit(n).alias("length"), F.array_join(F.slice(words, i + 1, n), " ").alias("gram")
    )


def _hash_at(n: int):
    return lambda i: gram_hash(F.col("hashes"), i, n)


class BitTable:
    """Bits of the hashes in a frame's `hash` column."""

    def __init__(self, hashes: DataFrame, count: int):
        self.bits = min(MOST_BITS, max(12, math.ceil(math.log2(max(1, count) * 64))))
        rows = (
            hashes.select(self._places(F.col("hash")))
            .select(F.explode("places").alias("place"))
            .groupBy(F.shiftright("place", 6).alias("slot"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("word"))
            .collect()  # at most 2**MOST_BITS / 64 rows
        )
        table = ["0"] * (1 << (self.bits - 6))
        for r in rows:
            table[r["slot"]] = str(r["word"])
        self.table = F.split(F.lit(",".join(table)), ",").cast("array<bigint>")

    def _places(self, h: Column) -> Column:
        mask = (1 << self.bits) - 1
        return F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, 64 - self.bits)).alias("places")

    def _set(self, place: Column) -> Column:
        return F.getbit(
            F.get(self.table, F.shiftright(place, 6).cast("int")), place.bitwiseAND(63).cast("int")
        ) == 1

    def may_hold(self, h: Column) -> Column:
        mask = (1 << self.bits) - 1
        return self._set(h.bitwiseAND(mask)) & self._set(F.shiftrightunsigned(h, 64 - self.bits))


def candidates(frame: DataFrame, table: BitTable, lengths: list[int], out: str) -> DataFrame:
    """Adds `out`: the places (start, length, gram) of `words` whose hash may be in the table.

    Expects `words` and `hashes`.
    """
    found = []
    for n in lengths:
        frame = frame.withColumn(
            f"_h{n}",
            # `hashes` is named outside the lambda too: named once, it would be worked out for every place
            F.transform(starts(F.size("hashes"), n), _hash_at(n)),
        )
        frame = frame.withColumn(
            f"_p{n}",
            F.array_compact(F.transform(f"_h{n}", lambda h, i: F.when(table.may_hold(h), i))),
        ).drop(f"_h{n}")
        found.append(F.transform(f"_p{n}", _gram_at(F.col("words"), n)))
    return frame.withColumn(out, F.concat(*found)).drop(*[f"_p{n}" for n in lengths])
