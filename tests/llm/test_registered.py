"""The registered queries without check SQL, over the whole smallest tables, and the pipeline against a plain chain."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwright.llm import language, secrets
from millwright.llm.queries import registry
from tests.conftest import SMALL
from tests.llm import plain


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def rows_of(spark, name, *columns):
    found = registry()[name](spark, SMALL)
    return [tuple(r) for r in (found.select(*columns) if columns else found).collect()]


def test_near_duplicates(spark, documents):
    found = rows_of(spark, "op1_simhash", "doc_id", "fingerprint", "component_id")
    assert Counter(found) == Counter(plain.near_duplicates(documents))


def test_language(spark, documents):
    found = registry()["op2_language"](spark, SMALL).collect()
    known = dict(documents)
    langs = {r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("lang").distinct().collect()}
    assert sorted(r.doc_id for r in found) == sorted(known)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        has_letter = any(x.isalpha() for x in known[r.doc_id] or "")
        assert (r.lang_pred in langs) if has_letter else (r.lang_pred == "und")


def test_licenses(spark, documents):
    found = rows_of(spark, "op6_licenses", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter(found) == Counter(plain.license_base(documents))
    both = rows_of(spark, "op6_licenses", "base_labels", "labels", "score")
    assert all(set(filter(None, b.split(","))) <= set(x.split(",")) and 0 <= s <= 1 for b, x, s in both)


def test_shards_are_near_equal(spark, documents):
    found = registry()["op7_sharding"](spark, SMALL).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 1, plain.crc(t)) for i, t in documents
    )
    size, slots = defaultdict(int), defaultdict(list)
    for r in found:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(size) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) <= 2 * max(r.size for r in found)


def test_secrets(spark, documents):
    found = rows_of(spark, "op8_secrets", "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert Counter(found) == Counter(plain.secret_base(documents))


def test_neighbours(spark):
    vectors = [
        (r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
        if r.embedding is not None and len(r.embedding) and None not in r.embedding
    ]
    vectors = sorted((i, v) for i, v in vectors if np.isfinite(v).all() and v.any())
    ids, matrix = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors])
    of = defaultdict(dict)
    for q, rank, v, score in rows_of(spark, "op9_neighbours", "query_id", "rank", "vec_id", "score"):
        of[q][rank] = (v, score)
    assert set(of) == {int(i) for i in ids if i % 20 == 0}
    place, hit = {int(i): k for k, i in enumerate(ids)}, 0
    for q, mine in of.items():
        assert sorted(mine) == list(range(1, 21))
        exact = matrix @ matrix[place[q]]
        best = [int(ids[k]) for k in np.lexsort((ids, -exact)) if ids[k] != q][:20]
        hit += len(set(best) & {v for v, _ in mine.values()})
        assert all(score == pytest.approx(exact[place[v]]) for v, score in mine.values())
    assert hit >= 0.9 * 20 * len(of)


def pieces(documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, text in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        for k in range(0, len(ids), 4096):
            part = ids[k: k + 4096]
            yield i, k, len(part), zlib.crc32(part.tobytes()), len(ids)


def check_sequences(found):
    at = defaultdict(list)
    for r in found:
        at[r.sequence_id].append((r.offset, r.length))
    for mine in at.values():
        end = 0
        for offset, length in sorted(mine):
            assert offset == end
            end += length
        assert end <= 4096
    # near the least number of sequences possible
    assert len(at) <= 1.02 * -(-sum(r.length for r in found) // 4096) + 1


def test_packing(spark, documents):
    found = registry()["op10_packing"](spark, SMALL).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == Counter(pieces(documents))
    check_sequences(found)


def test_pipeline_rows_equal_a_plain_chain(spark, documents):
    """Groups, contamination and token pieces by the plain versions; compression and masks by their operators, row by row."""
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    known = language.learn(frame.where(~language.held_out(F.col("doc_id"))).select("lang", "text"))
    told = {r.doc_id for r in language.identify(frame, known).where("not language.rejected").select("doc_id").collect()}
    rows = [d for d in documents if d[0] in told]
    least = {c for *_, c in plain.near_duplicates(rows)}
    rows = [d for d in rows if d[0] in least]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {i for i, *_, contaminated in plain.contamination(rows, items) if contaminated}
    rows = [d for d in rows if d[0] not in bad]
    masked = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    import corpus_pipeline

    found = corpus_pipeline.run(spark, SMALL).collect()
    assert 0 < len(rows) < len(documents) and bad
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == Counter(
        pieces([(r.doc_id, r.text) for r in masked])
    )
    check_sequences(found)


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, None, None, 1)], [(1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1)],
])
def test_every_stage_takes_nulls_empty_tables_and_clashing_names(spark, rows):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, fp int"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns and after.count() <= len(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == len(rows)
