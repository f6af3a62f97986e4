"""Samples that depend on row ids and a seed only.

The same rows are drawn however the table is partitioned and however often a lost task is rerun.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from millwright.operators.ordering import with_position

_HASH_RANGE = 2**32
#: Flags that classes may consist of: 65,536 slices for each of 3**4 classes.
MOST_FLAGS = 4
#: Rates beyond this are drawn in parts: exp(-rate) must stay well above the hash's resolution.
PART_RATE = 8.0


def digest(row_id: str, seed: int | str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def _leading_hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("bigint")


def poisson_thresholds(rate: float) -> list[int]:
    """Cumulative Poisson probabilities as points of the 32-bit hash range."""
    thresholds, term, cumulative, k = [], math.exp(-rate), 0.0, 0
    while True:
        cumulative += term
        point = math.floor(cumulative * _HASH_RANGE)
        if point >= _HASH_RANGE - 1 or (k > rate and term < 1e-12):
            return thresholds
        thresholds.append(point)
        k += 1
        term *= rate / k


def bootstrap_sample(rows: DataFrame, row_id: str, rate: float, seed: int) -> DataFrame:
    """Sampling with replacement: each row is repeated a Poisson(rate) number of times, the
    distributed form of the bootstrap. Whole rows are drawn, so columns keep their relations."""
    # a large rate is a sum of independent draws of a small one, each with a hash of its own
    parts = max(1, math.ceil(rate / PART_RATE))
    points = ", ".join(f"{t}L" for t in poisson_thresholds(rate / parts))
    if parts == 1:
        hashes = F.array(_leading_hex(digest(row_id, seed), 8))
    else:
        hashes = F.expr(
            f"transform(sequence(1, {parts}), p -> "
            f"cast(conv(substring(md5(concat('{seed}/', p, ':', cast(`{row_id}` as string))), 1, 8), 16, 10) as bigint))"
        )
    draws = F.transform(hashes, lambda h: F.size(F.filter(F.expr(f"array({points})"), lambda t: h >= t)))
    copies = F.aggregate(draws, F.lit(0), lambda total, n: total + n)
    return (
        rows.withColumn("copies", copies)
        .where(F.col("copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .drop("copies")
    )


def bootstrap_exact(rows: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows drawn with replacement, each draw with equal chances for all rows; with the ``draw`` (from 1).

    Row ids (unique) are numbered by a distributed sort; a draw is the hash of its number, taken as a place in that
    order. Draws and places are both spread evenly, so their join has no crowded key. The same rows are drawn
    however the table is partitioned. A table without rows gives none.
    """
    spark = rows.sparkSession
    placed = with_position(rows.select(row_id), row_id, row_id)
    count = rows.count()
    draws = spark.range(1, n + 1 if count else 1).select(
        F.col("id").alias("draw"),
        (F.pmod(_leading_hex(F.md5(F.concat(F.lit(f"{seed}/"), F.col("id").cast("string"))), 15), F.lit(max(1, count))) + 1).alias("position"),
    )
    return rows.join(draws.join(placed, "position").select(row_id, "draw"), row_id)


def stratified_sample(
    rows: DataFrame, classes: list[str], row_id: str, percent: int, seed: int
) -> DataFrame:
    """ceil(percent %) of every class: the rows with the lowest hash of their id.

    Ranking a class in one window would gather it in one task. Counting 65,536 hash slices per
    class shows which slices are taken whole; only the one slice per class where the quota ends is
    ranked. ``classes`` are boolean flags, so the slice table is bounded (4 classes x 65,536).
    """
    if any(not isinstance(rows.schema[c].dataType, T.BooleanType) for c in classes):
        raise ValueError("classes must be boolean flags")
    if len(classes) > MOST_FLAGS:
        raise ValueError(f"{len(classes)} flags make a table of slices too large to send to every task")
    hashed = rows.withColumn("digest", digest(row_id, seed)).withColumn(
        "slice", _leading_hex(F.col("digest"), 4)
    )
    by_class = W.partitionBy(*classes)
    taken_before = F.sum("n").over(
        by_class.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    )
    slices = (
        hashed.groupBy(*classes, "slice")
        .agg(F.count("*").alias("n"))
        .select(
            *classes,
            "slice",
            "n",
            F.coalesce(taken_before, F.lit(0)).alias("before"),
            F.expr(f"(sum(n) over (partition by {', '.join(classes)}) * {percent} + 99) div 100")
            .alias("quota"),
        )
        .select(*classes, "slice", "n", (F.col("quota") - F.col("before")).alias("room"))
        .where(F.col("room") > 0)
    )
    # null-safe: rows whose flag is NULL are a class of their own
    bounds = F.broadcast(slices.select(*[F.col(c).alias(f"_{c}") for c in slices.columns]))
    same = [hashed[c].eqNullSafe(bounds[f"_{c}"]) for c in [*classes, "slice"]]
    joined = hashed.join(bounds, same).withColumns({"n": F.col("_n"), "room": F.col("_room")})
    whole = joined.where(F.col("n") <= F.col("room"))
    rank = F.row_number().over(W.partitionBy(*classes, "slice").orderBy("digest", row_id))
    edge = (
        joined.where(F.col("n") > F.col("room"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= F.col("room"))
    )
    return whole.select(*rows.columns).unionByName(edge.select(*rows.columns))
