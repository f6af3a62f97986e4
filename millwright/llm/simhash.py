"""SimHash near-duplicates, found with vantage-point trees.

Whole 64-bit fingerprints of different texts lie about 32 bits apart from everything, so a triangle bound of 4
prunes next to nothing. The bits are therefore cut into three blocks: two fingerprints at most 4 bits apart
agree in one block up to 1 bit, and within a block of 21 or 22 bits the bound is sharp. Each block has a
vantage-point tree. Its upper part is fitted to a bounded sample and deals the fingerprints to shards; a
fingerprint lives in one shard per block and visits those whose boundary lies within the bound. Every shard
grows its own tree further, compares whole fingerprints in the leaves and returns links that span its groups,
never all pairs. Connected components join the shards' links.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from millwright.llm.components import components
from millwright.llm.tables import saved, text_key

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: (shift, bits) of the blocks.
BLOCKS = [(0, 21), (21, 21), (42, 22)]
#: Bits that a linked pair may differ in its best block.
BLOCK_DISTANCE = DISTANCE // len(BLOCKS)
#: Fingerprints of the sample that the upper tree is fitted to, and of a shard on average.
SAMPLE, SHARD = 4096, 1 << 15
#: A leaf inside a shard.
LEAF = 256


def _fingerprint(text: str | None) -> int:
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as on bytes
    if not found:
        return 0
    if len(found) < SHINGLE:
        shingles = iter([b" ".join(found)])
    else:
        shingles = map(b" ".join, zip(*(islice(found, k, None) for k in range(SHINGLE))))
    digest, total, sums = xxhash.xxh64_digest, 0, np.zeros(64, np.int64)
    while part := [digest(s, SEED) for s in islice(shingles, 255 * 256)]:
        total += len(part)
        bits = np.unpackbits(np.frombuffer(b"".join(part), np.uint8))
        lanes = np.zeros((-(-len(part) // 255) * 255, 8), np.uint64)
        lanes[: len(part)] = bits.view(np.uint64).reshape(-1, 8)
        # eight one-byte counters at a time: 255 ones fit
        sums += lanes.reshape(-1, 255, 8).sum(axis=1).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * sums > total).tobytes(), "big", signed=True)


@F.pandas_udf(LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    return pd.Series([_fingerprint(x) for x in text], dtype="int64")


def hex_digits(fingerprint_: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint_), 16, "0"))


def _block(values: np.ndarray, block: tuple[int, int]) -> np.ndarray:
    return (values >> np.uint64(block[0])) & np.uint64((1 << block[1]) - 1)


def _grow(sample: np.ndarray, share: float, most: float, rng) -> tuple | None:
    """A node (vantage point, radius, inside, outside), or None for a leaf that holds at most `most`."""
    if share <= most or len(sample) < 8:
        return None
    vantage = sample[rng.integers(len(sample))]
    far = np.bitwise_count(sample ^ vantage)
    radius = int(np.median(far))
    inside = far <= radius
    if inside.all():
        radius -= 1
        inside = far <= radius
    if not inside.any():
        return None
    part = inside.mean()
    return (
        vantage, radius, _grow(sample[inside], share * part, most, rng),
        _grow(sample[~inside], share * (1 - part), most, rng),
    )


def _walk(node, values, rows, home, reach, leaf=0):
    """(leaf number, rows, which of them live there) of every leaf that the rows live in or visit."""
    if not len(rows):
        return
    if node is None:
        yield leaf, rows, home
        return
    vantage, radius, inside, outside = node
    far = np.bitwise_count(values[rows] ^ vantage).astype(np.int64)
    near, away = far <= radius, far > radius
    go = far - reach <= radius
    yield from _walk(inside, values, rows[go], (home & near)[go], reach, 2 * leaf + 1)
    go = far + reach > radius
    yield from _walk(outside, values, rows[go], (home & away)[go], reach, 2 * leaf + 2)


def _leaf_links(all_: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of a leaf: members and homes at most DISTANCE apart, in blocks."""
    step = max(1, (1 << 20) // max(1, len(home)))
    near = lambda a: np.bitwise_count(a[:, None] ^ home[None, :]) <= DISTANCE
    linked = np.concatenate([
        (near(all_[k: k + step]) & (all_[k: k + step, None] != home[None, :])).any(axis=1)
        for k in range(0, len(all_), step)
    ] or [np.zeros(0, bool)])
    rows = all_[linked]
    if not len(rows):
        return rows, rows
    touched = np.zeros(len(home), bool)
    for k in range(0, len(rows), step):
        touched |= near(rows[k: k + step]).any(axis=0)
    home = home[touched]
    step = max(1, (1 << 20) // len(home))
    label, of_home = rows.copy(), home.copy()
    while True:  # the least label spreads along links
        before = label.copy()
        for k in range(0, len(rows), step):
            adjacent = near(rows[k: k + step])
            label[k: k + step] = np.minimum(
                label[k: k + step], np.where(adjacent, of_home[None, :], np.uint64(2**64 - 1)).min(axis=1)
            )
            of_home = np.minimum(
                of_home, np.where(adjacent, label[k: k + step, None], np.uint64(2**64 - 1)).min(axis=0)
            )
        if (before == label).all():
            return np.concatenate([rows, home]), np.concatenate([label, of_home])


def _star(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same groups with one link per member."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (before == label).all():
            return names, names[label]


def _shard_links(pdf: pd.DataFrame) -> pd.DataFrame:
    block = BLOCKS[int(pdf["block"].iloc[0])]
    values = pdf["fp"].to_numpy().view(np.uint64)
    home = pdf["home"].to_numpy()
    parts = _block(values, block)
    rng = np.random.default_rng(7)
    pool = parts[home]
    tree = _grow(pool, len(pool), LEAF, rng) if len(pool) else None
    a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    # leaves hold homes of this shard; what visits the shard visits its leaves by the same bound
    for _, rows, lives in _walk(tree, parts, np.arange(len(values)), home, BLOCK_DISTANCE):
        if lives.any():
            x, y = _leaf_links(values[rows], values[rows[lives]])
            a.append(x)
            b.append(y)
    a, b = _star(np.concatenate(a), np.concatenate(b))
    keep = a != b
    return pd.DataFrame({"a": a[keep].view(np.int64), "b": b[keep].view(np.int64)})


def links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints `fp` at most DISTANCE bits apart into the same groups."""
    known = saved(fingerprints.select("fp").distinct(), "fingerprints")
    count = known.count()
    sample = np.array(
        [r["fp"] for r in known.orderBy(F.xxhash64("fp", F.lit("tree")), "fp").limit(SAMPLE).collect()],
        np.int64,
    ).view(np.uint64)
    trees = [
        _grow(_block(sample, block), count, SHARD, np.random.default_rng(k))
        for k, block in enumerate(BLOCKS)
    ]

    def deal(batches):
        for pdf in batches:
            values = pdf["fp"].to_numpy().view(np.uint64)
            for k, (tree, block) in enumerate(zip(trees, BLOCKS)):
                parts = _block(values, block)
                rows = np.arange(len(values))
                for leaf, at, home in _walk(tree, parts, rows, np.ones(len(rows), bool), BLOCK_DISTANCE):
                    yield pd.DataFrame({
                        "block": np.int32(k), "leaf": np.int64(leaf), "fp": values[at].view(np.int64), "home": home,
                    })

    dealt = known.mapInPandas(deal, "block int, leaf long, fp long, home boolean")
    return dealt.groupBy("block", "leaf").applyInPandas(_shard_links, "a long, b long")


def _groups(marked: DataFrame) -> DataFrame:
    """(fp, component) of every fingerprint; a component is named by its least fingerprint."""
    linked = components(links(marked)).select(F.col("node").alias("fp"), "component")
    return marked.select("fp").distinct().join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, fp, fingerprint (hex), component_id (the least doc_id of its group).

    The whole text counts. A null or empty text, or one of white space, has fingerprint zero and is linked
    like any other. Documents are rows: repeated rows are in one group and each is returned. A null doc_id
    names no group; a group of null ids only has a null component. Other columns are ignored.
    """
    marked = saved(
        documents.select("doc_id", fingerprint(F.col("text")).alias("fp")), "document-fingerprints"
    )
    group = _groups(marked)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least")).join(group, "fp")
    least = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = group.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", "fp", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """One document of every group of linked fingerprints, all its columns unchanged: the one with the least doc_id.

    Of several rows with that doc_id, the one whose text has the least hash stays; of rows equal in both, one. A
    group whose ids are all null keeps one row the same way.
    """
    key = ["doc_id", "key_1", "key_2"]
    marked = saved(
        documents.select("doc_id", *text_key(F.col("text")), fingerprint(F.col("text")).alias("fp")),
        "document-fingerprints",
    )
    group = _groups(marked)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), *key))
    of_fp = marked.groupBy("fp").agg(first.alias("first"))
    chosen = (
        of_fp.join(group, "fp").groupBy("component").agg(F.min("first").alias("first")).select("first.*").drop("last")
    )
    times = marked.groupBy(*key).count()
    chosen = _same(chosen, times, key).select(*key, "count")
    keyed = documents.select(F.struct(*documents.columns).alias("_row"), "doc_id", *text_key(F.col("text")))
    once = _same(keyed, chosen.where("count = 1"), key, "left_semi").select("_row.*")
    # whole rows that are repeated are rare; only they are compared with each other
    more = _same(keyed, chosen.where("count > 1"), key, "left_semi").dropDuplicates(key).select("_row.*")
    return once.unionByName(more)


def _same(left: DataFrame, right: DataFrame, key: list[str], how: str = "inner") -> DataFrame:
    """A join on columns where null equals null; the left side's columns keep their names."""
    right = right.select(*[F.col(c).alias(f"_{c}") if c in key else F.col(c) for c in right.columns])
    on = [left[c].eqNullSafe(right[f"_{c}"]) for c in key]
    return left.join(right, on, how)
