"""Removal of long repeated byte strings by distributed prefix doubling.

Ranks of byte strings double in length: a position's rank at twice a length is made from its own rank and the
rank that many bytes on. Ranks are 64-bit hashes, so that a task doubles them up to ANCHOR bytes without an
exchange. Carrying every position of the corpus through a sort would move many times the input; instead each
400-byte window is looked at through its anchor, the position with the least rank at length ANCHOR in it (the first
of equals). Equal windows have equal anchors at equal places, so nothing is lost:

1. Neighbouring windows with one anchor form a segment. Anchors whose rank is unique are settled.
2. Segments of the other anchors are ranked as wholes. One that occurs twice is repeated in all its windows; if all
   segments of an anchor are unique wholes but one, they are settled too.
3. Only what is left is taken apart: its windows are ranked at the full length and compared one by one.

Every count is summed up before its shuffle, and no group is collected.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.ngrams import BitTable
from millwright.llm.tables import saved, text_key

WINDOW = 400
#: Length at which anchors are chosen: a power of two below the window.
ANCHOR = 256
#: Bytes of text a Python worker ranks at once.
BATCH_BYTES = 2 << 20

_BYTES = np.random.default_rng(1).integers(0, 2**64, 256, dtype=np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0xBF58476D1CE4E5B9) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _ranks(data: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all strings of `anchor` and of `window` bytes (anchor < window <= 2 * anchor)."""
    rank, length = _BYTES[data], 1
    while length < anchor:
        rank = _pair(rank[:-length], rank[length:])
        length *= 2
    more = window - anchor
    return rank, _pair(rank[: len(data) - window + 1], rank[more: more + len(data) - window + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    least, done = values, 1
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    return np.minimum(least[: len(least) - (width - done)], least[width - done:]) if done < width else least


def _segments(texts: list[bytes], window: int, anchor: int):
    """(text, start, windows, anchor rank, segment rank), column by column, of texts laid end to end."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    if len(data) < window:
        return [np.zeros(0, np.int64)] * 5
    rank, whole = _ranks(data, window, anchor)
    least = _least(rank, window - anchor + 1)[: len(whole)]
    of = np.repeat(np.arange(len(texts)), lengths)
    at = np.nonzero(of[: len(whole)] == of[window - 1:])[0]
    if not len(at):
        return [np.zeros(0, np.int64)] * 5
    low, doc = least[at], of[at]
    new = np.ones(len(at), bool)
    # a new anchor: another text, another rank, or the last window began at its own anchor
    new[1:] = (doc[1:] != doc[:-1]) | (low[1:] != low[:-1]) | (rank[at[:-1]] == low[:-1])
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(at)) - 1
    n = at[last] - at[first] + 1
    segment = _pair(_pair(whole[at[first]], whole[at[last]]), n.astype(np.uint64))
    start = at[first] - (ends - lengths)[doc[first]]
    return doc[first], start, n, low[first].view(np.int64), segment.view(np.int64)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _in_batches(texts: list[bytes], window: int):
    """(texts' numbers, offsets, pieces) of about BATCH_BYTES together. A longer text is cut; its pieces overlap so that
    every window lies in one of them. A segment that a cut divides is taken apart later, with the same result."""
    of, offsets, pieces, held = [], [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - window + 1), BATCH_BYTES):
            piece = t[at: at + BATCH_BYTES + window - 1]
            of.append(k)
            offsets.append(at)
            pieces.append(piece)
            held += len(piece)
            if held >= BATCH_BYTES:
                yield np.array(of), np.array(offsets), pieces
                of, offsets, pieces, held = [], [], [], 0
    if pieces:
        yield np.array(of), np.array(offsets), pieces


def _segment_rows(documents: DataFrame, window: int, anchor: int) -> DataFrame:
    """(row, start, n, anchor, segment) of all texts of at least a window; `row` is the text's key."""

    def run(batches):
        for pdf in batches:
            texts = [_bytes(t) for t in pdf["text"]]
            key_1, key_2 = pdf["key_1"].to_numpy(), pdf["key_2"].to_numpy()
            for of, offsets, pieces in _in_batches(texts, window):
                piece, start, n, low, segment = _segments(pieces, window, anchor)
                doc, start = of[piece], start + offsets[piece]
                yield pd.DataFrame({
                    "key_1": key_1[doc], "key_2": key_2[doc], "start": start.astype(np.int32),
                    "n": n.astype(np.int32), "anchor": low, "segment": segment,
                })

    text = F.col("text")
    return documents.where(F.octet_length(text) >= window).select(*text_key(text), "text").mapInPandas(
        run, "key_1 long, key_2 long, start int, n int, anchor long, segment long"
    )


def _window_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key_1, key_2, start, anchor, window, times) of the windows in the segments (start, n, anchor, times)."""

    def rank(held: list[tuple]) -> pd.DataFrame:
        key_1, key_2, start, n, low, times, parts = zip(*held)
        n = np.array(n)
        _, whole = _ranks(np.frombuffer(b"".join(parts), np.uint8), window, anchor)
        which = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return pd.DataFrame({
            "key_1": np.array(key_1)[which], "key_2": np.array(key_2)[which],
            "start": (np.array(start)[which] + inside).astype(np.int32), "anchor": np.array(low)[which],
            # the parts lie end to end, each with a window's rest after its last window
            "window": whole[which * (window - 1) + np.arange(len(which))].view(np.int64),
            "times": np.array(times, np.int32)[which],
        })

    def run(batches):
        for pdf in batches:
            held, size = [], 0
            for key_1, key_2, text, segments in zip(pdf["key_1"], pdf["key_2"], pdf["text"], pdf["segments"]):
                data = _bytes(text)
                for s in segments:
                    part = data[s["start"]: s["start"] + s["n"] + window - 1]
                    held.append((key_1, key_2, s["start"], s["n"], s["anchor"], s["times"], part))
                    size += len(part)
                    if size >= BATCH_BYTES:
                        yield rank(held)
                        held, size = [], 0
            if held:
                yield rank(held)

    return texts.mapInPandas(
        run, "key_1 long, key_2 long, start int, anchor long, window long, times int"
    )


def _per_text(parts: DataFrame, name: str) -> DataFrame:
    """`parts` (key_1, key_2, ...) gathered per text as `name`, each once."""
    return saved(
        parts.groupBy("key_1", "key_2").agg(F.collect_set(F.struct(
            *[c for c in parts.columns if c not in ("key_1", "key_2")]
        )).alias(name)), name,
    )


def _with_text(documents: DataFrame, per_text: DataFrame) -> DataFrame:
    """The documents whose text has a row in `per_text`, with that row. The others are sorted out by a bit table of
    bounded size before the exchange (a full table only sorts out less)."""
    table = BitTable(per_text.select(F.col("key_1").alias("hash")), per_text.count())
    keyed = documents.select(*text_key(F.col("text")), *documents.columns)
    return keyed.where(table.may_hold(F.col("key_1"))).join(per_text, ["key_1", "key_2"])


def repeated(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(key_1, key_2, runs): per text with such, the runs (start, n) of window starts, in bytes, whose window also starts
    elsewhere in the documents."""
    own = documents.select("text")
    segments = saved(_segment_rows(own, window, anchor), "segments")
    again = segments.groupBy("anchor").count().where("count > 1").select("anchor")
    left = saved(segments.join(again, "anchor"), "repeated-anchors")
    first = F.min(F.struct("key_1", "key_2", "start", "n"))
    whole = saved(
        left.groupBy("anchor", "segment").agg(F.count("*").alias("times"), first.alias("one")), "ranked-segments"
    )
    full = whole.where("times > 1").select("anchor", "segment")
    settled = left.join(full, ["anchor", "segment"]).select("key_1", "key_2", "start", "n")
    mixed = whole.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    apart = whole.join(mixed, "anchor").select(
        "one.*", "anchor", F.least("times", F.lit(2)).cast("int").alias("times")
    )
    # of equal texts one is taken apart: its segments' counts stand for all
    texts = _with_text(own, _per_text(apart, "segments")).dropDuplicates(["key_1", "key_2"])
    windows = saved(_window_rows(texts, window, anchor), "windows")
    twice = windows.groupBy("anchor", "window").agg(F.sum("times").alias("times")).where("times > 1")
    single = windows.where("times = 1").drop("times").join(twice.select("anchor", "window"), ["anchor", "window"])
    return _per_text(settled.unionByName(
        single.select("key_1", "key_2", "start", F.lit(1).alias("n"))
    ), "runs")


def _merge(runs, window: int) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for start, n in sorted((r["start"], r["n"]) for r in runs):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], start + n - 1 + window)
        else:
            spans.append([start, start + n - 1 + window])
    return [tuple(s) for s in spans]


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, with_kept: bool = True
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (of removed bytes, end exclusive), kept.

    Every byte inside a `window`-byte string that also starts anywhere else, in the same document or another, is
    removed. Strings are judged on the input. Matches never cross documents. A null or empty text, and one
    shorter than a window, loses nothing. Documents are rows: a repeated row's long text is removed whole, in each
    of them. `kept` is binary, since a span may begin inside a character; `with_kept` leaves it out.
    """
    runs = repeated(documents, window, anchor)
    text = F.coalesce(F.col("text"), F.lit(""))
    hit = _with_text(documents.select("doc_id", "text"), runs)

    def cut(batches):
        for pdf in batches:
            rows = []
            for doc_id, t, r in zip(pdf["doc_id"], pdf["text"], pdf["runs"]):
                data, spans = _bytes(t), _merge(r, window)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                rest = b"".join([*kept, data[at:]])
                rows.append((
                    doc_id, len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(),
                    [{"start": a, "end": b} for a, b in spans], rest if with_kept else None,
                ))
            yield pd.DataFrame(rows, columns=[
                "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept",
            ]).astype({"doc_id": "object"})

    names = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept binary"
    kind = documents.schema["doc_id"].dataType.simpleString()
    changed = hit.mapInPandas(cut, f"doc_id {kind}, {names}")
    keys = runs.select("key_1", "key_2")
    same = (
        documents.select("doc_id", *text_key(F.col("text")), F.octet_length(text).cast("long").alias("n_bytes"),
                         F.sha2(text, 256).alias("kept_sha256"), text.cast("binary").alias("kept"))
        .join(keys, ["key_1", "key_2"], "left_anti")
        .select(
            "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
            "kept_sha256", F.array().cast("array<struct<start:int,end:int>>").alias("spans"), "kept",
        )
    )
    found = changed.unionByName(same)
    return found if with_kept else found.drop("kept")
