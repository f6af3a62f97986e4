"""Language identification by compression.

Each language has a raw-content dictionary for zstandard, made of a bounded sample of its labelled texts. A
text is cut into chunks (all of it, so that a dictionary counts as much at the end as at the start); every
chunk is compressed with every dictionary, and the language with the smallest total is chosen. A narrow
margin to the next one is a rejection.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The bounded sample per language: so many distinct texts, so many characters from each.
TEXTS, CHARACTERS = 128, 1000
CHUNK_BYTES = 8192
LEVEL = 5
#: The winner is smaller than the next language by this share at least, or the text is rejected.
MARGIN = 0.002
UNKNOWN = "und"
#: All dictionaries together, which every task holds.
MOST_BYTES = 64 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame) -> list[tuple[str, bytes]]:
    """A dictionary per language, from (lang, text) rows; null and letterless texts teach nothing.

    The sample is drawn by a hash of the text, so it doesn't depend on the order or the number of rows, and a
    text counts once however often it is repeated.
    """
    teaching = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("text", F.lit("sample")).alias("order"),
        # the middle of a long text: its start may be a boilerplate line
        F.expr(
            f"substring(text, greatest(1, cast(length(text) / 2 as int) - {CHARACTERS // 2}), {CHARACTERS})"
        ).alias("part"),
    )
    # a row per distinct text, cut to TEXTS rows per language and task before the shuffle
    drawn = (
        teaching.select("lang", "order").distinct()
        .withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("order")))
        .where(F.col("n") <= TEXTS).select("lang", "order")
    )
    best = (
        teaching.join(F.broadcast(drawn), ["lang", "order"])
        .groupBy("lang", "order").agg(F.min("part").alias("part"))
        .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("order", "part"))).alias("parts"))
        .select("lang", F.array_join(F.transform("parts", lambda p: p["part"]), "\n").alias("content"))
    )
    rows = best.collect()  # at most TEXTS * CHARACTERS characters per language
    if sum(len(r["content"]) for r in rows) * 4 > MOST_BYTES:
        raise ValueError(f"{len(rows)} languages need more than {MOST_BYTES} bytes of dictionaries")
    return sorted((r["lang"], plain(r["content"])) for r in rows)


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple) -> list:
    found = []
    for lang, content in dictionaries:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        found.append((lang, zstandard.ZstdCompressor(
            level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
        )))
    return found


#: ASCII other than small letters becomes a space; what languages write beyond ASCII stays.
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def plain(text: str) -> bytes:
    """A text as the compressor sees it: small letters and spaces."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS)


def sizes(text: str, compressors: list) -> list[tuple[int, str]]:
    data = plain(text)
    chunks = [data[k: k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
    return sorted((sum(len(c.compress(x)) for x in chunks), lang) for lang, c in compressors)


def _judge(text: str, compressors: list) -> tuple[str, float, bool]:
    ranked = sizes(text, compressors)
    if len(ranked) == 1:
        return ranked[0][1], 1.0, False
    margin = 1 - ranked[0][0] / ranked[1][0]
    return ranked[0][1], min(1.0, max(0.0, margin)), margin < MARGIN


def classify(text: Column, dictionaries: list[tuple[str, bytes]]) -> Column:
    """struct(lang, score, rejected) of a text. The score is the margin: the share by which the best
    language's size is below the next one's. Null, a text without a letter, or no learned language: `und`,
    score 0, rejected. Equal sizes: the language first in order, rejected."""
    frozen = tuple(dictionaries)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        use = _compressors(frozen)
        rows = [(UNKNOWN, 0.0, True) if x is None or not use else _judge(x, use) for x in texts]
        return pd.DataFrame(rows, columns=["lang", "score", "rejected"])

    return run(F.when(text.rlike(r"\p{L}"), text))


def identify(documents: DataFrame, dictionaries: list[tuple[str, bytes]]) -> DataFrame:
    """The documents with a column `language` (see classify). Every row is judged by its whole text alone."""
    columns = [c for c in documents.columns if c != "language"]
    return documents.select(*columns, classify(F.col("text"), dictionaries).alias("language"))


def accepted(documents: DataFrame, dictionaries: list[tuple[str, bytes]]) -> DataFrame:
    """The documents that aren't rejected, all their columns unchanged."""
    return documents.where(~classify(F.col("text"), dictionaries)["rejected"])
