"""Ranked search against a plain version, and its edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from millwright.llm import ranking
from millwright.llm.queries import registry


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    for item, text in items:
        found = []
        for i, c in counts:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        for k, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top], 1):
            yield item, k, i, -s


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, n int, terms string, item int").repartition(4),
        spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, rank int"),
    )


def made_up():
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "Of", "é", "naïve", "x1"]) if rng.random() < 0.4 else f"w{int(rng.expovariate(0.02))}"
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    docs = [(k, text(rng.randrange(1, 80))) for k in range(400)]
    docs += [(k, docs[5][1]) for k in range(1000, 1060)]  # more equal scores than places
    docs += [(2**60 + k, docs[5][1]) for k in range(3)] + [(2000, None), (2001, ""), (2002, "--"), (None, docs[5][1]), (None, docs[6][1]), (7, docs[7][1])]
    docs += [(3000, text(30_000))]
    items = [(k, text(rng.randrange(1, 40))) for k in range(60)] + [(100, docs[5][1]), (101, docs[5][1]), (102, None), (103, "?"), (104, "nowhere"), (3, "the the the"), (None, "of")]
    return docs, items


def got(frame):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect())


def test_search(spark):
    docs, items = made_up()
    found = ranking.search(*tables(spark, docs, items))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert got(found) == Counter(plain(docs, items))


def test_search_in_blocks(spark, monkeypatch):
    docs, items = made_up()
    monkeypatch.setattr(ranking, "BLOCK_ITEMS", 20)
    assert got(ranking.search(*tables(spark, docs, items))) == Counter(plain(docs, items))


def test_empty_tables(spark):
    docs, items = made_up()
    assert got(ranking.search(*tables(spark, [], items))) == Counter()
    assert got(ranking.search(*tables(spark, docs, []))) == Counter()
    assert got(ranking.search(*tables(spark, [(1, None)], items))) == Counter()


def test_registered(spark, tmp_path):
    docs, items = made_up()
    for name, table in zip(("documents", "benchmark"), tables(spark, docs, items)):
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    assert got(registry()["op12_ranking"](spark, str(tmp_path))) == Counter(plain(docs, items))


def test_graph_adds_what_the_items_hold():
    rng = random.Random(5)
    common = [rng.sample(range(200), 12) for _ in range(6)]
    queries = {}
    for k in range(50):
        mine = Counter(rng.choices(range(200), k=5))
        for part in rng.sample(common, rng.randrange(3)):
            mine.update(dict.fromkeys(part, 1))
        queries[k] = mine
    graph = ranking.share(queries)
    values = np.array([[rng.randrange(10**6)] for _ in range(200)], np.int64)
    found = ranking._accumulate(graph, values)
    for k, terms_ in queries.items():
        assert found[graph.items[k], 0] == sum(values[t, 0] * c for t, c in terms_.items())
    assert graph.additions < 0.7 * sum(len(q) - 1 for q in queries.values())
    assert all(max(parts) < len(graph.leaves) + k for k, parts in enumerate(graph.sums))


def test_terms():
    for text in ("A-b_C9 é\xa0ü", "", "--", "\x00a\x7fb", "x y z", "İSTANBUL Ж"):
        assert [t.decode() for t in ranking._terms(text)] == terms(text)
