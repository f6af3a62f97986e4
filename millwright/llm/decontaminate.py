"""Benchmark decontamination: find benchmark passages in training texts, drop the documents or the passages.

The benchmark's n-grams form a hash set that every task holds; a document's token windows are scanned
against it, windows that hit are compared word for word, and hit words are counted. The set is broadcast
only up to a checked size; a larger benchmark is joined by a shuffle with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.ngrams import BitTable, candidates, gram_hash, grams, word_hashes
from millwright.llm.tables import saved, text_key, words

WINDOW = 13
#: A window list up to this many bytes is sent to every executor.
BROADCAST_BYTES = 32 << 20


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows (gram, length, hash, items): `size` words, or a shorter item's words as a whole.

    Items without words (null and empty texts among them) have no window. An item without id takes part
    in hits but is not named.
    """
    item = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    every = F.when(F.size("words") >= size, grams(F.col("words"), size)).otherwise(F.array(F.struct(
        F.lit(0).alias("start"), F.size("words").alias("length"), F.array_join("words", " ").alias("gram"),
    )))
    return (
        item.select("item_id", F.explode(every).alias("w"))
        .groupBy(F.col("w.gram").alias("gram"), F.col("w.length").alias("length"))
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
        .withColumn(
            "hash", gram_hash(word_hashes(F.split("gram", " ")), F.lit(0), F.col("length"))
        )
    )


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: doc_id, key_1, key_2 (of its text), n_words, n_hit, n_items, items, contaminated, spans.

    `spans` lists the hit runs as (start, end) in words, end exclusive. Contaminated: at least one word is
    hit, and at least one in twenty. A null text has no words. Documents are rows: repeated rows are judged
    each, and need no unique doc_id. An empty benchmark hits nothing. Other columns are ignored.
    """
    window = saved(windows(benchmark, size), "benchmark-windows")
    known = window.agg(
        F.count("*"), F.sum(F.octet_length("gram") + 16 * F.size("items") + 64),
        F.sort_array(F.collect_set("length")),  # at most `size` values
    ).first()
    table = BitTable(window, known[0])
    hashed = (
        documents.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", *text_key(F.col("text")),
            words(F.col("text")).alias("words"),
        )
        .withColumn("hashes", word_hashes(F.col("words")))
    )
    if known[0]:
        hashed = candidates(hashed, table, known[2], "found")
        place = F.explode_outer("found")
    else:
        place = F.lit(None).cast("struct<start:int,length:int,gram:string>")
    scanned = hashed.withColumn("n_words", F.size("words").cast("long")).select(
        "row", "doc_id", "key_1", "key_2", "n_words", place.alias("w")
    )
    right = window.select("gram", "length", "items")
    if (known[1] or 0) <= BROADCAST_BYTES:
        right = F.broadcast(right)
    hit = scanned.join(
        right, (F.col("w.gram") == right["gram"]) & (F.col("w.length") == right["length"]), "left"
    )
    place = F.when(F.col("gram").isNotNull(), F.struct(
        F.col("w.start").alias("start"), (F.col("w.start") + F.col("w.length")).alias("end")
    ))
    grouped = hit.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "key_1", "key_2", "n_words")],
        F.sort_array(F.collect_list(place)).alias("places"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # runs of words that windows cover; a window that touches the run before it continues it
    run = "struct(p.start as start, p.end as end)"
    merged = F.expr(f"""
        aggregate(places, cast(array() as array<struct<start:int,end:int>>), (runs, p) ->
          if(size(runs) > 0 and element_at(runs, -1).end >= p.start,
             concat(slice(runs, 1, size(runs) - 1), array(struct(
               element_at(runs, -1).start as start, greatest(element_at(runs, -1).end, p.end) as end))),
             concat(runs, array({run}))))""")
    return (
        grouped.withColumn("spans", merged)
        .withColumn(
            "n_hit",
            F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)"),
        )
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
        .drop("row", "places")
    )


def clean(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, all their columns unchanged.

    The verdict depends on the text alone, so the contaminated texts' keys decide.
    """
    bad = contamination(documents, benchmark, size).where("contaminated").select("key_1", "key_2").distinct()
    keyed = documents.select(F.struct(*documents.columns).alias("_row"), *text_key(F.col("text")))
    return keyed.join(bad, ["key_1", "key_2"], "left_anti").select("_row.*")
