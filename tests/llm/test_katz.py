"""The language model against one written with dictionaries, and its edge cases."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import katz
from millwright.llm.queries import registry
from tests.conftest import SMALL


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


class Plain:
    """Katz backoff over dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.count = [Counter() for _ in range(order + 1)]
        for text in texts:
            padded = ["<s>"] * (order - 1) + tokens(text)
            for i in range(order - 1, len(padded)):
                for n in range(1, order + 1):
                    self.count[n][tuple(padded[i - n + 1: i + 1])] += 1
        self.kept = [None, *[katz.discounts([sum(c == r for c in self.count[n].values()) for r in range(1, 7)]) for n in range(1, order + 1)]]
        self.next = [defaultdict(dict) for _ in range(order + 1)]
        for n in range(1, order + 1):
            for gram, c in self.count[n].items():
                self.next[n][gram[:-1]][gram[-1]] = c
        self.weights, self.lefts = {}, {}

    def share(self, n, c):
        return self.kept[n][min(c, 6)] * c

    def left(self, context):
        if context not in self.lefts:
            self.lefts[context] = self.find_left(context)
        return self.lefts[context]

    def find_left(self, context):
        n, seen = len(context) + 1, self.next[len(context) + 1][context]
        total, kept = sum(seen.values()), sum(self.share(n, c) for c in seen.values())
        total += kept >= total
        return total, 1 - kept / total if total else 1.0

    def p(self, word, context):
        n = len(context) + 1
        seen = self.next[n].get(context)
        if seen is None:
            return self.p(word, context[1:]) if context else 1.0
        total, rest = self.left(context)
        if word in seen:
            return self.share(n, seen[word]) / total
        if not context:
            return rest
        if context not in self.weights:
            self.weights[context] = rest / (1 - sum(self.p(w, context[1:]) for w in seen))
        return self.weights[context] * self.p(word, context[1:])

    def score(self, text):
        padded = ["<s>"] * (self.order - 1) + tokens(text)
        m = self.order - 1
        return sum(math.log10(self.p(padded[i], tuple(padded[i - m: i]))) for i in range(m, len(padded)))


def expected(rows, order):
    train = [t for i, t in rows if not held_out(i)]
    model, unigrams = Plain(train, order), Counter(w for t in train for w in tokens(t))
    n, v = sum(unigrams.values()), len(unigrams)
    for i, text in rows:
        mine = tokens(text)
        base = sum(math.log10((unigrams[w] + 0.5) / (n + 0.5 * (v + 1))) for w in mine)
        yield (i, held_out(i), len(mine), sum(w in unigrams for w in mine), n), (base, model.score(text))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def same(found, want):
    key = lambda r: (r[0][0] is None, str(r[0]), r[1])
    found = sorted((((r.doc_id, not r.trained, r.n_tokens, r.n_known, r.train_tokens), (r.base_score, r.score)) for r in found.collect()), key=key)
    want = sorted(want, key=key)
    assert [a for a, _ in found] == [a for a, _ in want]
    for (_, a), (_, b) in zip(found, want):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-9)


def trained():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))


def made_up():
    rng = random.Random(4)
    word = lambda: rng.choice(["the", "The", "of", "é", "x.", "|"]) if rng.random() < 0.5 else f"w{int(rng.expovariate(0.05))}"
    rows = [(k, rng.choice([" ", "\n", " \t"]).join(word() for _ in range(rng.randrange(1, 60)))) for k in range(300)]
    rows += [(k, rows[7][1]) for k in range(300, 330)]  # copies
    rows += [(400, None), (401, ""), (402, " \n"), (403, "only new words here"), (404, "a\xa0b  c"), (5, "the"), (5, "the"), (None, "the of")]
    rows += [(500, "again " * 30_000), (501, " ".join(f"l{k % 700}" for k in range(20_000)))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id long, text string, row long, words string, block int").repartition(3)


@pytest.mark.parametrize("order", [2, 3])
def test_katz(spark, monkeypatch, order):
    rows = made_up()
    monkeypatch.setattr(katz, "BUCKET", 5_000)  # several buckets and ranges
    monkeypatch.setattr(katz, "CHUNK", 100)
    monkeypatch.setattr(katz, "STORED", 300)
    monkeypatch.setattr(katz, "HEAD", 50)  # most words are not among the frequent ones
    same(katz.score(frame(spark, rows), trained(), order), expected(rows, order))


@pytest.mark.parametrize("order, hot, head", [(3, 0, 1 << 16), (2, 0, 1), (3, 100, 20)])
def test_hot_words(spark, monkeypatch, order, hot, head):
    """With a low bound all or some words take the way of hot ones."""
    rows = made_up()
    monkeypatch.setattr(katz, "HEAD", head)
    same(katz.score(frame(spark, rows), trained(), order, hot=hot), expected(rows, order))


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = registry()["op11_katz"](spark, SMALL)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(found.withColumn("trained", ~F.col("held_out")), expected(rows, katz.ORDER))


def test_probabilities_add_up():
    rng = random.Random(1)
    model = Plain([" ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(40)) for _ in range(30)], 3)
    words = [w for w, in model.count[1]] + ["unknown"]
    for context in list(model.next[3])[:50] + [("unknown", "a"), ("a", "unknown")]:
        assert sum(model.p(w, context) for w in words) == pytest.approx(1)


def test_discounts():
    assert katz.discounts([100, 40, 20, 12, 8, 5])[6] == 1
    for n in ([0] * 6, [5, 0, 0, 0, 0, 0], [0, 9, 0, 0, 0, 0], [1, 50, 3, 90, 1, 2], [10**6, 10**5, 3, 2, 1, 0]):
        kept = katz.discounts(n)
        assert ((kept[1:-1] > 0) & (kept[1:-1] < 1) | (kept[1:-1] == 1)).all() and kept[1] < 1


def test_chunks_keep_middle_words_together():
    v = np.repeat([1, 2, 3, 4, 9], [3, 2, 9, 1, 1])
    size = np.arange(1, len(v) + 1)
    whole = katz._Grams(v, v, v, v, size, np.arange(size.sum()))
    parts = list(whole.chunks(4))
    assert [p.v.tolist() for p in parts] == [[1] * 3, [2] * 2, [3] * 9, [4, 9]]
    assert np.concatenate([p.rows for p in parts]).tolist() == whole.rows.tolist()
    assert [len(p.rows) for p in parts] == [p.size.sum() for p in parts]


def test_words_in_ranges():
    words = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000))
    for parts in (1, 7, 1 << 20):
        part = katz._part(words, parts)
        assert (np.diff(part) >= 0).all() and part.min() >= 0 and part.max() < parts


@pytest.mark.parametrize("rows", [[], [(1, "a b")], [(2, None)]])
def test_tables_without_training(spark, rows):
    found = katz.score(frame(spark, rows), F.lit(False))
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in found.collect()] == [(0, 0, 0.0, 0.0)] * len(rows)


def test_packed_arrays():
    for values in ([], [0], [255, 0, 256], [2**62, 1, 5], list(range(1000))):
        a = np.array(values, np.int64)
        assert katz._unpack(katz._pack(a)).tolist() == values
        assert katz._unpack_sorted(katz._pack_sorted(np.sort(a))).tolist() == sorted(values)
