"""The registered queries: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import (
    decontaminate, katz, language, licenses, neighbours, packing, ranking, repeats, secrets, sharding, simhash, turns, urls,
)
from millwright.llm.tables import read


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    known = language.learn(documents.where(~language.held_out(F.col("doc_id"))).select("lang", "text"))
    return language.identify(documents.select("doc_id", "text"), known).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected",
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), with_kept=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_bytes") - F.col("n_removed")).alias("n_kept")
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read(spark, sf_dir, "documents")).drop("matches")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _of_kind(k: int):
    return lambda s: s["kind"] == k


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        )), ",")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        *[
            F.size(F.filter("secrets", _of_kind(k))).cast("long").alias(f"n_{name}")
            for k, name in enumerate(secrets.KINDS[:3])
        ],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
    )


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op11_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    found = katz.score(read(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with planted faults: rows dropped, emptied, cut off, repeated or given to the user."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.translate(or_space("text"), ".!?", "")).otherwise(or_space("text"))
    times = F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(or_space("role")).alias("role"), text.alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    found, rows = turns.repair(damaged(conversations))
    known = found.withColumnRenamed("conv_id", "id")
    digest = turns.digests(rows).withColumnRenamed("conv_id", "id_")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (
        conversations.select("conv_id").distinct()
        .join(known, F.col("conv_id").eqNullSafe(F.col("id")), "left")
        .join(digest, F.col("conv_id").eqNullSafe(F.col("id_")), "left")
        .select(
            "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def registry() -> dict:
    from corpus_pipeline import run

    found = [
        op1_simhash, op2_language, op3_decontaminate, op4_repeats, op5_urls, op6_licenses, op7_sharding,
        op8_secrets, op9_neighbours, op10_packing, op11_katz, op12_ranking, op13_conversations,
    ]
    return {f.__name__: f for f in found} | {"pipeline": run}
