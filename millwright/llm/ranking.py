"""Ranked search for many queries at once, with the work that queries share done once.

Items that hold the same terms would add up the same partial scores for a document again and again. Their term sets are
therefore mined for shared parts: terms that occur in the same items form one set, and pairs of sets that two or more
items hold together become a set of their own, round after round. The result is a graph whose leaves are terms with
their multiplicity, whose inner nodes add two or more others, and of which each item is one node. For a batch of documents
every node's accumulator is filled once, children first, and serves every item above it.

Items come in blocks of bounded size, each with a graph of its own; a block is scored against all documents, without a
shuffle of documents. A document leaves only counts of the terms that some item of the block holds. Scores are
integers, so the order of additions doesn't matter.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm.tables import arrow_batch as _batch, arrow_schema as _arrow, saved, words

#: Items and term places of a block. Both bound what the driver and a task hold of the queries; an item beyond
#: the places is a block of its own.
BLOCK_ITEMS, BLOCK_PLACES = 1024, 1 << 18
#: Accumulators held at a time (nodes x documents).
ACCUMULATORS = 1 << 22
TOP = 20

_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_SPACES = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))


def _terms(text: str) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    # splitting on the one sign left keeps white space beyond ASCII inside terms
    return [w for w in text.encode("utf-8", "surrogatepass").lower().translate(_SPACES).split(b" ") if w]


class Graph:
    """The query-sharing graph of a block. Nodes are numbered children first; the first ones are leaves."""

    def __init__(self, leaves: list[tuple], sums: list[list[int]], items: dict):
        #: (term, multiplicity) of a leaf; the parts of each further node; the node of each item.
        self.leaves, self.sums, self.items = leaves, sums, items

    @property
    def additions(self) -> int:
        return sum(len(parts) - 1 for parts in self.sums)


def share(queries: dict) -> Graph:
    """The graph of {item: Counter of terms}. An item without terms is not in it."""
    holders = defaultdict(set)
    for item, terms in queries.items():
        for leaf in terms.items():
            holders[leaf].add(item)
    leaves = sorted(holders)
    sums: list[list[int]] = []
    alike = defaultdict(list)  # leaves that the same items hold
    for k, leaf in enumerate(leaves):
        alike[frozenset(holders[leaf])].append(k)
    parts = defaultdict(set)

    def node(of: list[int]) -> int:
        if len(of) == 1:
            return of[0]
        sums.append(of)
        return len(leaves) + len(sums) - 1

    for who, group in sorted(alike.items(), key=lambda g: g[1]):
        n = node(group)
        for item in who:
            parts[item].add(n)
    while True:
        # private parts (of one item) can't be shared; they are added at the end
        times = Counter(n for mine in parts.values() for n in mine)
        pairs = Counter()
        for mine in parts.values():
            pairs.update(combinations(sorted(n for n in mine if times[n] > 1), 2))
        used, found = set(), []
        for pair, n in sorted(pairs.items(), key=lambda p: (-p[1], p[0])):
            if n < 2:
                break
            if used.isdisjoint(pair):
                used.update(pair)
                found.append(pair)
        if not found:
            break
        partner = {a: (b, len(leaves) + len(sums) + k) for k, (a, b) in enumerate(found)}
        sums.extend(list(pair) for pair in found)
        for mine in parts.values():
            for a in [n for n in mine if n in partner]:
                b, n = partner[a]
                if b in mine:
                    mine -= {a, b}
                    mine.add(n)
    return Graph(leaves, sums, {item: node(sorted(mine)) for item, mine in parts.items()})


def _blocks(benchmark: DataFrame) -> Iterator[dict]:
    """The items in blocks of {item_id: Counter of terms}; rows with the same item_id are one item each."""
    rows = benchmark.select("item_id", words(F.col("text")).alias("words"))
    block, places = {}, 0
    for k, (item, found) in enumerate(rows.toLocalIterator()):
        terms = Counter(found)
        if block and (len(block) == BLOCK_ITEMS or places + len(terms) > BLOCK_PLACES):
            yield block
            block, places = {}, 0
        if terms:
            block[(item, k)] = terms
            places += len(terms)
    if block:
        yield block


def postings(documents: DataFrame, terms: list[str]) -> DataFrame:
    """Per document with a term at all: doc_id, n (its terms with repeats), and where and how often those of `terms`
    occur in it (places in the list, counts)."""
    place = {t.encode("utf-8", "surrogatepass"): k for k, t in enumerate(terms)}
    schema = T.StructType([
        documents.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
        T.StructField("times", T.ArrayType(T.LongType())),
    ])
    out = _arrow(schema)

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                found = _terms(text)
                if found:
                    known = Counter(filter(place.__contains__, found))
                    rows.append((doc_id, len(found), [place[t] for t in known], list(known.values())))
            yield _batch(rows, out)

    return documents.where("text is not null").select("doc_id", "text").mapInArrow(run, schema)


def _best(scores: np.ndarray, least: int, top: int) -> np.ndarray:
    """Places of the `top` highest scores of at least `least`, equal ones by place."""
    if len(scores) > top:
        least = max(least, np.partition(scores, len(scores) - top)[len(scores) - top])
    at = np.flatnonzero(scores >= least)
    return at[np.argsort(-scores[at], kind="stable")][:top]


def _weights(df: list[int], documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df], np.int64)


def _accumulate(graph: Graph, contributions: np.ndarray) -> np.ndarray:
    """The accumulators of all nodes for a batch: leaves from the terms' contributions, then sums, children first."""
    known = np.empty((len(graph.leaves) + len(graph.sums), contributions.shape[1]), np.int64)
    for k, (term, times) in enumerate(graph.leaves):
        np.multiply(contributions[term], times, out=known[k])
    for k, parts in enumerate(graph.sums, len(graph.leaves)):
        known[parts].sum(axis=0, out=known[k])
    return known


def _scored(found: DataFrame, graph: Graph, weights: np.ndarray, n_documents: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): for every task the best documents of each item, no more than `top`."""
    items = sorted(graph.items.items(), key=lambda i: i[1])
    step = max(1, ACCUMULATORS // max(1, len(graph.leaves) + len(graph.sums) + len(weights)))
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), found.schema["doc_id"], T.StructField("score", T.LongType()),
    ])
    out = _arrow(schema)

    def scores_of(part: list[tuple]) -> np.ndarray:
        length = np.array([100 - 25 + (25 * n * n_documents) // n_terms for _, n, _, _ in part], np.int64)
        column = np.repeat(np.arange(len(part)), [len(terms) for _, _, terms, _ in part])
        term = np.fromiter((t for _, _, terms, _ in part for t in terms), np.int64, len(column))
        times = np.fromiter((t for *_, times in part for t in times), np.int64, len(column))
        contributions = np.zeros((len(weights), len(part)), np.int64)
        contributions[term, column] = weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * length[column]))
        return _accumulate(graph, contributions)

    def run(batches):
        best: list[list[tuple]] = [[] for _ in items]  # (-score, id is null, id or 0), least first
        for batch in batches:
            rows = sorted(zip(*[c.to_pylist() for c in batch.columns]), key=lambda r: (r[0] is None, r[0] or 0))
            for at in range(0, len(rows), step):
                part = rows[at: at + step]
                scores = scores_of(part)
                for k, (_, node) in enumerate(items):
                    least = -best[k][-1][0] if len(best[k]) == top else 1
                    if (scores[node] >= least).any():
                        new = [(-int(scores[node, c]), part[c][0] is None, part[c][0] or 0) for c in _best(scores[node], least, top)]
                        best[k] = sorted(best[k] + new)[:top]
        yield _batch([(k, None if null else i, -s) for k, mine in enumerate(best) for s, null, i in mine], out)

    return found.select("doc_id", "n", "terms", "times").mapInArrow(run, schema)


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The `top` documents with the highest scores above 0 for every item: item_id, rank (from 1), doc_id, score.

    Equal scores go by ascending doc_id, a null one last. Every row is a document and every row of `items` an item; a
    null text has no terms, and an item without terms finds nothing. Other columns are ignored. The weights' statistics
    cover all documents.
    """
    spark = documents.sparkSession
    out = T.StructType([
        items.schema["item_id"], T.StructField("rank", T.IntegerType()), documents.schema["doc_id"], T.StructField("score", T.LongType()),
    ])
    results = []
    for block in _blocks(items):
        terms = sorted({t for counts in block.values() for t in counts})
        number = {t: k for k, t in enumerate(terms)}
        found = saved(postings(documents, terms), "postings")
        totals = found.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).head()
        if not totals["documents"]:
            continue
        df = [0] * len(terms)
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a block's terms at most
            df[r["term"]] = r["count"]
        graph = share({item: Counter({number[t]: c for t, c in counts.items()}) for item, counts in block.items()})
        scored = _scored(found, graph, _weights(df, totals["documents"]), totals["documents"], totals["terms"], top)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = sorted(graph.items.items(), key=lambda i: i[1])
        named = spark.createDataFrame(
            [(k, item) for k, ((item, _), _) in enumerate(names)],
            T.StructType([T.StructField("item", T.IntegerType()), items.schema["item_id"]]),
        )
        # the names are a block's items at most
        results.append(saved(ranked.join(F.broadcast(named), "item").select(*out.names), "ranked"))
    found = spark.createDataFrame([], out)
    for result in results:
        found = found.unionByName(result)
    return found
