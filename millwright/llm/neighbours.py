"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is turned by a fixed random rotation and kept as one sign bit per dimension, with two scalars: its norm,
and the inner product of its direction with its code. From them a query's inner product is estimated, with an
error bound; candidates whose upper bound reaches the best lower bounds are reranked by their original vectors,
in double precision. Equal vectors have one code and a short list of their smallest ids.

The query set meets all candidates in blocks: a task holds one block of either side, whatever the tables' sizes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millwright.llm.tables import saved

NEAREST = 20
#: Distinct vectors of a candidate block and queries of a query block, on average.
BLOCK, QUERIES = 16_384, 4096
#: Width of the error bound in standard errors.
WIDTH = 1.9
SEED = 11
#: Queries estimated at once inside a task.
STEP = 128


def rotation(dimensions: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def valid(vectors: DataFrame, column: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: with an id, not null or empty or zero, all components finite. Of rows
    that share an id the least vector counts."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select("vec_id", v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )


def _matrix(column: pd.Series, dimensions: int) -> np.ndarray:
    out = np.zeros((len(column), dimensions))
    for k, v in enumerate(column):
        out[k, : len(v)] = v
    return out


def search(vectors: DataFrame, column: str = "embedding", nearest: int = NEAREST, every: int = 20) -> DataFrame:
    """For every vec_id divisible by `every`: query_id, rank (from 1), vec_id, score (inner product), best first.

    Ties go to the smaller vec_id. Fewer candidates give fewer rows. Shorter vectors count as filled up with
    zeros. An empty table gives no row; other columns are ignored.
    """
    known = saved(valid(vectors, column), "vectors")
    facts = known.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
    n, d = facts["n"], facts["d"] or 1
    # equal vectors share a code; each keeps as many of its smallest ids as an answer can use (and one more,
    # the query itself)
    same = W.partitionBy("v").orderBy("vec_id")
    distinct = (
        known.withColumn("k", F.row_number().over(same)).where(F.col("k") <= nearest + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    blocks, query_blocks = -(-n // BLOCK) or 1, -(-n // (every * QUERIES)) or 1
    turn = rotation(d)

    def encode(batches):
        for pdf in batches:
            x = _matrix(pdf["v"], d)
            norm = np.linalg.norm(x, axis=1)
            turned = (x / norm[:, None]) @ turn
            bits = turned > 0
            yield pd.DataFrame({
                "v": list(pdf["v"]), "ids": list(pdf["ids"]), "norm": norm,
                "agree": np.abs(turned).sum(axis=1) / np.sqrt(d),  # direction times code
                "code": [b.tobytes() for b in np.packbits(bits, axis=1)],
            })

    coded = (
        distinct.mapInPandas(encode, "v array<double>, ids array<long>, norm double, agree double, code binary")
        .withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    queries = (
        known.where(F.pmod("vec_id", F.lit(every)) == 0)
        .withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        .select(F.col("vec_id").alias("query_id"), "v", "block", "query_block")
    )

    def rerank(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, y = _matrix(c["v"], d), _matrix(q["v"], d)
        ids = [np.asarray(i) for i in c["ids"]]
        norm, agree = c["norm"].to_numpy(), c["agree"].to_numpy()
        bits = np.unpackbits(np.frombuffer(b"".join(c["code"]), np.uint8).reshape(len(c), -1), axis=1)[:, :d]
        code = (2 * bits.astype(np.float32) - 1) / np.sqrt(d)
        turned = (y @ turn).astype(np.float32)
        spread = norm * np.sqrt(np.maximum(0, 1 / agree**2 - 1)) * WIDTH / np.sqrt(max(1, d - 1))
        k = min(nearest + 1, len(c))
        out = []
        for at in range(0, len(q), STEP):
            estimate = (turned[at: at + STEP] @ code.T) * (norm / agree)[None, :]
            error = np.linalg.norm(y[at: at + STEP], axis=1)[:, None] * spread[None, :]
            bar = -np.partition(error - estimate, k - 1, axis=1)[:, k - 1]
            for row, hit in enumerate(estimate + error >= bar[:, None]):
                some = np.nonzero(hit)[0]
                own = q["query_id"].iat[at + row]
                score = x[some] @ y[at + row]
                # the k best vectors and whatever ties with the last of them hold the answer
                if len(some) > k:
                    top = score >= -np.partition(-score, k - 1)[k - 1]
                    some, score = some[top], score[top]
                members = np.concatenate([ids[s] for s in some])
                scores = np.repeat(score, [len(ids[s]) for s in some])
                members, scores = members[members != own], scores[members != own]
                best = np.lexsort((members, -scores))[:nearest]
                out.append((np.full(len(best), own), members[best], scores[best]))
        a, b, s = (np.concatenate(z) for z in zip(*out))
        return pd.DataFrame({"query_id": a.astype(np.int64), "vec_id": b.astype(np.int64), "score": s})

    found = (
        coded.groupBy("block", "query_block").cogroup(queries.groupBy("block", "query_block"))
        .applyInPandas(rerank, "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score"
    )
