"""Katz backoff: a language model of word n-grams, counted, stored and evaluated in buckets.

A gram (u, v, w) lives in the bucket of its middle word v. With it live the bigrams (v, w), the contexts (u, v) and v
itself, so that a bucket has all that the recursion asks for: the trigram's discounted count, or the weight of its
context times the bigram's, or the weight of v times the unigram's. Unigrams need no table there: words are numbered in
classes of equal count, and the bounds of the classes (about as many as the square root of twice the tokens at most)
turn a number into its count.

The steps, each a Spark job over packed arrays rather than rows:

1. Documents become blocks of about a million tokens with a dictionary each.
2. Dictionaries are merged by ranges of word hashes; words get their numbers, the frequent ones small ones, and every
   block gets those of its words.
3. Blocks deal the grams of their tokens, each with its document, to the buckets; a bucket is sorted and stored once.
4. Counts of counts give the Good-Turing discounts of each order.
5. Buckets are evaluated; documents add up what they get.

A word with more than HOT tokens does not get a bucket: its grams stay spread over the blocks that they come from, their
counts are merged with Spark's own aggregations and joins, and the probabilities are joined back. Words are told apart by
63 bits of their XXH64 alone. What a step no longer needs is deleted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.llm.tables import arrow_batch, arrow_schema, give_back, saved
from millwright.session import shared_dir
from millwright.sources.layout import delete

ORDER = 3
#: Counts up to this one are discounted.
MOST_DISCOUNTED = 5
#: Tokens of a block; tokens of a bucket, and words of a dictionary's range, on average.
BLOCK, BUCKET = 1 << 21, 1 << 20
#: Tokens of a word that still has a bucket.
HOT = 1 << 22
#: The most frequent words, at most so many, are numbered without gaps.
HEAD = 1 << 16
#: Grams of a bucket that are evaluated at a time, if they are of several middle words.
CHUNK = 1 << 16
#: Grams of a stored row, likewise.
STORED = 1 << 18
#: Numbers of the unknown word and of what stands before a document; known words follow.
UNKNOWN, START, FIRST = 0, 1, 2
#: The end of a document; no word holds a line feed.
END = b"\n"


# --- packed arrays -------------------------------------------------------------------------------


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, in as few bytes each as the largest needs, compressed byte by byte."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in half the room, if they fit."""
    return values.astype(np.int32) if len(values) and values.max() < 2**31 else values


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data))


def _joined(parts: Iterable[bytes], unpack=_unpack) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int32), *(_narrow(unpack(p)) for p in parts)])


def _each(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows one at a time: packed arrays are large."""
    for k in range(batch.num_rows):
        yield tuple(c[k].as_py() for c in batch.columns)


def _opens(*keys: np.ndarray) -> np.ndarray:
    """Where a new run of equal keys starts."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for key in keys:
        change[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(change)


def _order(*keys: np.ndarray) -> np.ndarray:
    """An order by the first key, then the next ones; in one sort where the keys, or ranks of the first, fit 63 bits."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    first, widths = keys[0], [int(k.max()).bit_length() for k in keys]
    if sum(widths) > 63:
        first = np.unique(first, return_inverse=True)[1]
        widths[0] = int(first.max()).bit_length()
    if sum(widths) > 63:
        return np.lexsort(keys[::-1])
    one = first.astype(np.int64)
    for key, width in zip(keys[1:], widths[1:]):
        one <<= width
        one |= key
    return np.argsort(one, kind="stable")  # what is equal stays in order: documents, which then pack better


def _sums(values: np.ndarray, opens: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, opens) if len(opens) else values[:0]


def _sizes(opens: np.ndarray, count: int) -> np.ndarray:
    return np.diff(opens, append=count)


# --- blocks --------------------------------------------------------------------------------------


class _Index(dict):
    """Numbers words as they are met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The range of each hash of 63 bits, in ascending order like the hashes."""
    return (keys >> 31) * parts >> 32


#: Kinds of rows that a block leaves, each in a folder of its own.
DOCS, TOKENS, WORDS = "docs", "tokens", "words"


def blocks(documents: DataFrame, trained: Column) -> DataFrame:
    """Blocks of whole documents, three rows each, by `kind`: the documents (row, doc_id, trained); tokens, as places in the
    block's dictionary, with the documents' rows, lengths and whether they are trained on; the dictionary's hashes in
    ascending order, their places, and their counts in training documents and in all.
    """
    doc_id = documents.select("doc_id").schema["doc_id"].dataType
    of_doc = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", doc_id), T.StructField("trained", T.BooleanType())])
    schema = T.StructType(
        [T.StructField("block", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("docs", T.ArrayType(of_doc))]
        + [T.StructField(c, T.BinaryType()) for c in ("tokens", "places", "rows", "lengths", "trained", "words", "known", "total")]
        + [T.StructField("n", T.LongType())]
    )
    out = arrow_schema(schema)

    def block(docs, found, index):
        tokens = np.concatenate(found)
        rows, lengths, is_trained = (np.array([d[k] for d in docs], np.int64) for k in (0, 3, 2))
        # places go by frequency: small numbers pack well
        times = np.bincount(tokens, minlength=len(index))
        by_count = np.argsort(-times, kind="stable")
        place = np.empty(len(index), np.int32)
        place[by_count] = np.arange(len(index))
        words = np.array([xxhash.xxh64_intdigest(w) >> 1 for w in index], np.int64)
        known = np.bincount(tokens[np.repeat(is_trained == 1, lengths)], minlength=len(index))
        order = np.argsort(words)
        name = docs[0][0]
        listed = [{"row": r, "doc_id": i, "trained": t} for r, i, t, _ in docs]
        return arrow_batch([
            (name, DOCS, listed, *[None] * 8, len(docs)),
            (name, TOKENS, None, _pack(place[tokens]), None, _pack_sorted(rows), _pack(lengths), _pack(is_trained), None, None, None, len(tokens)),
            (name, WORDS, None, None, _pack(place[order]), None, None, None, _pack_sorted(words[order]), _pack(known[order]), _pack(times[order]), len(words)),
        ], out)

    def run(batches):
        docs, places, index, held = [], [], _Index(), 0
        for batch in batches:
            for row, doc_id, is_trained, text in _each(batch):
                found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII only, as on bytes
                found.append(END)
                places.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
                docs.append((row, doc_id, is_trained, len(found)))
                held += len(found)
                if held >= BLOCK:
                    whole = block(docs, places, index)
                    docs, places, index, held = [], [], _Index(), 0
                    give_back()
                    yield whole
        if docs:
            whole = block(docs, places, index)
            docs, places, index = [], [], _Index()
            give_back()
            yield whole

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(trained, F.lit(True)).alias("trained"), "text"
    )
    return numbered.mapInArrow(run, schema)


# --- words and their numbers ---------------------------------------------------------------------


@dataclass
class Words:
    """What turns a word's number into its count: classes of equal (hot, count), in order of number."""

    base: np.ndarray  # the first number of each class
    count: np.ndarray
    types: np.ndarray  # how many words it has
    dense: np.ndarray  # whether its words are numbered without gaps; if so, all are listed here:
    head: np.ndarray  # hashes, ascending
    head_numbers: np.ndarray
    first_cold: int  # numbers from FIRST up to here are hot
    parts: int

    @property
    def tokens(self) -> int:
        return int((self.count * self.types).sum())

    def of_class(self, cold: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The classes of words. They go by (cold, -count), which makes one ascending key."""
        key = lambda is_cold, count: (is_cold.astype(np.int64) << 62) - count
        return np.searchsorted(key(self.base >= self.first_cold, self.count), key(cold, counts))

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        if not len(self.base):
            return np.zeros(len(numbers), np.int64)
        at = np.searchsorted(self.base, numbers, "right") - 1
        return np.where(numbers >= FIRST, self.count[at], 0)

    def probabilities(self) -> tuple[np.ndarray, float]:
        """Per class the discounted probability of one of its words, and that of the unknown word."""
        n = [int(self.types[self.count == r].sum()) for r in range(1, MOST_DISCOUNTED + 2)]
        kept = discounts(n)[np.minimum(self.count, MOST_DISCOUNTED + 1)] * self.count
        total = float(self.tokens)
        if not (kept < self.count).any():
            total += 1  # nothing was discounted: one token more leaves room
        return kept / total, 1 - float((kept * self.types).sum()) / total

    def unigram(self, numbers: np.ndarray) -> np.ndarray:
        known, unknown = self.probabilities()
        if not len(self.base):
            return np.full(len(numbers), unknown)
        at = np.searchsorted(self.base, numbers, "right") - 1
        return np.where(numbers >= FIRST, known[at], unknown)


def discounts(n: list[int]) -> np.ndarray:
    """The share of a count that is kept, by count: Good-Turing for 1 to k, 1 beyond.

    `n` holds how many grams were counted once, twice, and so on. k is the largest up to MOST_DISCOUNTED for which
    all shares lie between 0 and 1. Where no k gives that (few grams, or most of them in copies), the part that absolute
    discounting estimates is taken off each of these counts.
    """
    kept = np.ones(MOST_DISCOUNTED + 2)
    r = np.arange(1, MOST_DISCOUNTED + 1)
    for k in range(MOST_DISCOUNTED, 0, -1):
        if min(n[: k + 1]) > 0 and (common := (k + 1) * n[k] / n[0]) < 1:
            shares = np.array([((i + 1) * n[i] / (i * n[i - 1]) - common) / (1 - common) for i in range(1, k + 1)])
            if ((shares > 0) & (shares < 1)).all():
                kept[1: k + 1] = shares
                return kept
    part = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    kept[1:-1] = (r - part) / r
    return kept


def _requests(known: DataFrame, parts: int, *counts: str) -> DataFrame:
    """The words of each block by range: part, block, words and the counts named."""
    schema = T.StructType(
        [T.StructField("part", T.LongType()), T.StructField("block", T.LongType())]
        + [T.StructField(c, T.BinaryType()) for c in ("words", *counts)]
    )
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for block, words, *packed in _each(batch):
                words, *columns = _unpack_sorted(words), *map(_unpack, packed)
                part = _part(words, parts)
                cuts = _opens(part)
                yield arrow_batch([
                    (int(part[a]), block, _pack_sorted(words[a:b]), *[_pack(c[a:b]) for c in columns])
                    for a, b in zip(cuts, np.append(cuts[1:], len(part)))
                ], out)

    return known.select("block", "words", *counts).mapInArrow(run, schema)


def _vocabulary(requests: DataFrame, hot: int) -> DataFrame:
    """Per range its words seen in training: words (ascending), counts, is_hot, and its classes (hot, count, n)."""
    of_class = T.StructType([T.StructField("hot", T.BooleanType()), T.StructField("count", T.LongType()), T.StructField("n", T.LongType())])
    schema = T.StructType(
        [T.StructField("part", T.LongType())] + [T.StructField(c, T.BinaryType()) for c in ("words", "counts", "is_hot")]
        + [T.StructField("classes", T.ArrayType(of_class))]
    )
    out = arrow_schema(schema)

    def merge(table: pa.Table) -> pa.Table:
        words = _joined(table["words"].to_pylist(), _unpack_sorted)
        order = np.argsort(words, kind="stable")
        words = words[order]
        opens = _opens(words)
        known, total = (_sums(_joined(table[c].to_pylist())[order], opens) for c in ("known", "total"))
        seen = known > 0
        words, known, is_hot = words[opens][seen], known[seen], total[seen] > hot
        classes, n = np.unique(2 * known + is_hot, return_counts=True)
        listed = [{"hot": bool(c & 1), "count": int(c >> 1), "n": int(k)} for c, k in zip(classes, n)]
        row = (table["part"][0].as_py(), _pack_sorted(words), _pack(known), _pack(is_hot.astype(np.int64)), listed)
        return pa.Table.from_batches([arrow_batch([row], out)])

    return requests.groupBy("part").applyInArrow(merge, schema)


def _frequent(vocabulary: DataFrame, least: int) -> np.ndarray:
    """(cold, -count, hash) of the words counted at least so often, in that order; HEAD of them at most."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("cold", "count", "word")])

    def run(batches):
        for batch in batches:
            for words, counts, is_hot in _each(batch):
                words, counts, is_hot = _unpack_sorted(words), _unpack(counts), _unpack(is_hot)
                head = counts >= least
                columns = [pa.array(c[head]) for c in (1 - is_hot, counts, words)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = vocabulary.select("words", "counts", "is_hot").mapInArrow(run, schema).collect()
    return np.array(sorted((r["cold"], -r["count"], r["word"]) for r in rows), np.int64).reshape(-1, 3)


def _classes(vocabulary: DataFrame, parts: int) -> Words:
    # at most twice as many rows as there are different counts, and these add up to no more than the tokens
    rows = sorted((
        (not r["hot"], -r["count"], r["most"], r["n"])
        for r in vocabulary.select(F.explode("classes").alias("c")).groupBy("c.hot", "c.count")
        .agg(F.max("c.n").alias("most"), F.sum("c.n").alias("n")).collect()
    ))
    least = 1 + sum(-r[1] * r[3] for r in rows) // HEAD
    base, at, first_cold = [], FIRST, FIRST
    for cold, count, most, n in rows:
        base.append(at)
        at += n if -count >= least else most * parts
        if not cold:
            first_cold = at
    as_array = lambda values: np.array(list(values), np.int64)
    words = Words(
        as_array(base), as_array(-r[1] for r in rows), as_array(r[3] for r in rows), np.array([-r[1] >= least for r in rows], bool),
        np.zeros(0, np.int64), np.zeros(0, np.int64), first_cold, parts,
    )
    found = _frequent(vocabulary, least)
    of = words.of_class(found[:, 0] == 1, -found[:, 1])
    opens = _opens(of)
    numbers = words.base[of] + np.arange(len(of)) - np.repeat(opens, _sizes(opens, len(of)))
    order = np.argsort(found[:, 2])
    words.head, words.head_numbers = found[order, 2], numbers[order]
    return words


def _numbers(part: int, keys: np.ndarray, counts: np.ndarray, is_hot: np.ndarray, words: Words) -> np.ndarray:
    """The numbers of a range's words. Ranges take turns in a class, so that they need not know of each other; only the
    frequent words are numbered in one row."""
    of = words.of_class(~is_hot, counts)
    order = np.argsort(of, kind="stable")
    opens = _opens(of[order])
    place = np.empty(len(of), np.int64)
    place[order] = np.arange(len(of)) - np.repeat(opens, _sizes(opens, len(of)))
    numbers = words.base[of] + place * words.parts + part
    dense = words.dense[of]
    numbers[dense] = words.head_numbers[np.searchsorted(words.head, keys[dense])]
    return numbers


def _replies(requests: DataFrame, vocabulary: DataFrame, words: Words) -> DataFrame:
    """For each block and range the numbers of its words, in the words' order: block, part, numbers."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("part", T.LongType()), T.StructField("numbers", T.BinaryType())])
    out = arrow_schema(schema)

    def look_up(asked: pa.Table, table: pa.Table) -> pa.Table:
        rows, known, numbers = [], np.zeros(0, np.int64), None
        if table.num_rows:
            known = _unpack_sorted(table["words"][0].as_py())
            counts, is_hot = (_unpack(table[c][0].as_py()) for c in ("counts", "is_hot"))
            numbers = _numbers(table["part"][0].as_py(), known, counts, is_hot == 1, words)
        for part, block, found in zip(*[asked[c].to_pylist() for c in ("part", "block", "words")]):
            found = _unpack_sorted(found)
            reply = np.full(len(found), UNKNOWN)
            if len(known):
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                reply = np.where(known[at] == found, numbers[at], UNKNOWN)
            rows.append((block, part, _pack(reply)))
        return pa.Table.from_batches([arrow_batch(rows, out)])

    return requests.groupBy("part").cogroup(
        vocabulary.select("part", "words", "counts", "is_hot").groupBy("part")
    ).applyInArrow(look_up, schema)


def _numbered(known: DataFrame, replies: DataFrame) -> DataFrame:
    """block, numbers: those of a block's words by their place there."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("numbers", T.BinaryType())])
    out = arrow_schema(schema)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [b for _, b in sorted(zip(right["part"].to_pylist(), right["numbers"].to_pylist()))]
        places = _unpack(left["places"][0].as_py())
        numbers = np.empty(len(places), np.int64)
        numbers[places] = _joined(parts)
        return pa.Table.from_batches([arrow_batch([(left["block"][0].as_py(), _pack(numbers))], out)])

    return known.select("block", "places").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(gather, schema)


# --- grams ---------------------------------------------------------------------------------------

#: Kinds of rows in the stored table: grams of a bucket, grams of hot words, figures of a block's documents.
COLD_GRAMS, HOT_GRAMS, FIGURES = 0, 1, 2
_GRAMS = T.StructType(
    [T.StructField("bucket", T.LongType()), T.StructField("kind", T.IntegerType())]
    + [T.StructField(c, T.BinaryType()) for c in ("v", "u", "w", "size", "rows")]
)


def _dealt(known: DataFrame, numbered: DataFrame, words: Words, order: int, buckets: int, hot_pieces: int, start_is_hot: bool) -> DataFrame:
    """The grams of all tokens by bucket, and per block the figures of its documents (unigram sums, known tokens).

    In the bucket of a word that isn't hot, `v` only tells middle words apart; their numbers aren't needed again.
    """
    out = arrow_schema(_GRAMS)
    n, v_types = words.tokens, int(words.types.sum())

    def home(numbers: np.ndarray, block: int) -> np.ndarray:
        """The buckets of grams by their middle word."""
        spread = block ^ (block >> 33)
        hot = (numbers >= FIRST) & (numbers < words.first_cold) | ((numbers == START) & start_is_hot)
        of = numbers.astype(np.int64) % buckets  # numbers go by frequency, so this deals evenly
        # an unknown word has no grams in training: its tokens need no company and stay spread
        of[numbers == UNKNOWN] = spread % buckets
        of[hot] = buckets + spread % max(1, hot_pieces)
        return _narrow(of)

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left["block"][0].as_py()
        rows, length, trained, tokens = (
            unpack(left[c][0].as_py())
            for c, unpack in (("rows", _unpack_sorted), ("lengths", _unpack), ("trained", _unpack), ("tokens", _unpack))
        )
        numbers = _narrow(_unpack(right["numbers"][0].as_py()))
        opens = np.cumsum(length) - length
        # what depends on a word alone is worked out once for the block's dictionary
        counts = words.counts(numbers)
        base = _sums(np.log10((counts + 0.5) / (n + 0.5 * (v_types + 1)))[tokens], opens)
        n_known = _sums((counts > 0).astype(np.int32)[tokens], opens)
        out_rows = [(-1 - block, FIGURES, _pack_sorted(rows), _pack(length), _pack(n_known), base.tobytes(), None)]
        bucket = np.roll(home(numbers, block)[tokens], 1)
        bucket[opens] = home(np.array([START]), block)[0]
        w = numbers[tokens]
        del tokens
        v, u = np.roll(w, 1), np.roll(w, 2)
        v[opens] = START
        u[opens] = START
        u[(opens + 1)[length > 1]] = START
        if order == 2:
            u[:] = START
        by = _order(bucket, v)
        bucket, v, u, w = bucket[by], v[by], u[by], w[by]
        # the lowest bit says whether the document is trained on
        row = np.repeat(2 * rows + trained, length)[by]
        del by
        cuts = _opens(bucket)
        for a, b in zip(cuts, np.append(cuts[1:], len(bucket))):
            kind = HOT_GRAMS if bucket[a] >= buckets else COLD_GRAMS
            middle = v[a:b]
            if kind == COLD_GRAMS:  # a bucket's middle words differ by multiples of the buckets; the unknown word stays apart
                middle = np.where(middle == UNKNOWN, 0, middle // buckets + 1)
            out_rows.append((int(bucket[a]), kind, _pack_sorted(middle), _pack(u[a:b]), _pack(w[a:b]), None, _pack(row[a:b])))
        del v, u, w, row, bucket
        give_back()
        return pa.Table.from_batches([arrow_batch(out_rows, out)])

    mine = known.select("block", "tokens", "rows", "lengths", "trained").groupBy("block")
    return mine.cogroup(numbered.groupBy("block")).applyInArrow(deal, schema=_GRAMS)


def _sorted_grams(table: pa.Table) -> pa.Table:
    """A bucket's different grams in order of (v, u, w), how often each occurs, and the documents; in rows of about STORED
    grams, a hot piece in one row."""
    kind = table["kind"][0].as_py()
    if kind == FIGURES:
        return table
    v = _joined(table["v"].to_pylist(), _unpack_sorted)
    u, w, rows = (_joined(table[c].to_pylist()) for c in ("u", "w", "rows"))
    order = _order(v, u, w)
    # one after the other, so that each old array goes before the next new one
    v = v[order]
    u = u[order]
    w = w[order]
    rows = rows[order]
    opens = _opens(v, u, w)
    size = _sizes(opens, len(order))
    del order
    whole = _Grams(v[opens], u[opens], w[opens], size, size, rows)
    del v, u, w, rows, opens
    bucket, batches = table["bucket"][0].as_py(), []
    for g in whole.chunks(STORED) if kind == COLD_GRAMS else [whole]:
        row = (bucket, kind, _pack_sorted(g.v), _pack(g.u), _pack(g.w), _pack(g.size), _pack(g.rows))
        batches.append(arrow_batch([row], table.schema))
    del whole
    give_back()
    return pa.Table.from_batches(batches)


@dataclass
class _Grams:
    """The different grams of a stored row, their counts in training, and where they occur."""

    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    count: np.ndarray
    size: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, v: bytes, u: bytes, w: bytes, size: bytes, rows: bytes) -> _Grams:
        narrow = lambda packed, unpack=_unpack: _narrow(unpack(packed))
        size, rows = narrow(size), _unpack(rows)
        opens = np.cumsum(size, dtype=np.int64) - size
        count = _narrow(_sums((rows & 1).astype(np.int32), opens))
        rows >>= 1
        return cls(narrow(v, _unpack_sorted), narrow(u), narrow(w), count, size, rows)

    def chunks(self, most: int) -> Iterator[_Grams]:
        """Parts of about `most` grams; a middle word's grams stay together, and a part can be evaluated by itself."""
        begins = _opens(self.v)
        cuts = [0]
        for a, b in zip(begins, np.append(begins[1:], len(self.v))):
            if b - cuts[-1] > most and a > cuts[-1]:
                cuts.append(int(a))
        rows = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        for a, b in zip(cuts, [*cuts[1:], len(self.v)]):
            yield _Grams(*(x[a:b] for x in (self.v, self.u, self.w, self.count, self.size)), self.rows[rows[a]: rows[b]])

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order by (v, w), the opening places of each bigram in it, and the bigrams' counts."""
        order = _order(self.v, self.w)
        opens = _opens(self.v[order], self.w[order])
        return order, opens, _sums(self.count[order], opens)

    def per_row(self, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and their sums over all places."""
        rows, at = np.unique(self.rows, return_inverse=True)
        return rows, np.bincount(at, np.repeat(logs, self.size), len(rows))


def backed_off(count: np.ndarray, opens: np.ndarray, lower: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Probabilities by Katz's rule of grams whose contexts are runs that open at `opens`.

    `lower` has the probability of each gram without its first word. A seen gram gets its discounted share; what the
    discounts leave goes to the others in proportion to `lower`. All grams seen in a context must be there; of the
    unseen, any. A context without training grams passes `lower` on. Where nothing was discounted, the total counts one more.
    """
    shares = kept[np.minimum(count, MOST_DISCOUNTED + 1)] * count
    total, left = _sums(count, opens).astype(float), _sums(shares, opens)
    room = total + (left >= total)
    seen = _sums(np.where(count > 0, lower, 0.0), opens)
    weight = np.where(total > 0, (1 - left / room) / np.maximum(1 - seen, 1e-300), 1.0)
    at = np.repeat(np.arange(len(opens)), _sizes(opens, len(count)))
    return np.where(count > 0, shares / room[at], weight[at] * lower)


def _times(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, MOST_DISCOUNTED + 2)]


def _counted(grams: DataFrame) -> dict[str, list[int]]:
    """Counts of counts of the buckets' bigrams and trigrams."""
    schema = T.StructType([T.StructField("gram", T.StringType()), T.StructField("r", T.LongType()), T.StructField("n", T.LongType())])
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for stored in _each(batch):
                g = _Grams.of(*stored)
                found = {"vw": _times(g.bigrams()[2]), "uvw": _times(g.count)}
                yield arrow_batch([(k, r, n) for k, times in found.items() for r, n in enumerate(times, 1)], out)

    rows = grams.where(F.col("kind") == COLD_GRAMS).select("v", "u", "w", "size", "rows").mapInArrow(run, schema)
    found = {k: [0] * (MOST_DISCOUNTED + 1) for k in ("vw", "uvw")}
    for r in rows.groupBy("gram", "r").agg(F.sum("n").alias("n")).collect():  # twice MOST_DISCOUNTED + 1 rows
        found[r["gram"]][r["r"] - 1] = r["n"]
    return found


_LOGS = T.StructType([T.StructField("row", T.LongType()), T.StructField("log", T.DoubleType())])


def _cold_logs(grams: DataFrame, words: Words, kept: list[np.ndarray]) -> DataFrame:
    """(row, log): what each bucket adds to each document."""

    def evaluated(g: _Grams) -> tuple[np.ndarray, np.ndarray]:
        order, opens, count = g.bigrams()
        first = order[opens]
        p2 = backed_off(count, _opens(g.v[first]), words.unigram(g.w[first]), kept[0])
        p = np.empty(len(g.v))
        p[order] = np.repeat(p2, _sizes(opens, len(order)))
        if len(kept) > 1:
            p = backed_off(g.count, _opens(g.v, g.u), p, kept[1])
        return g.per_row(np.log10(p))

    def run(batches):
        for batch in batches:
            for stored in _each(batch):
                for chunk in _Grams.of(*stored).chunks(CHUNK):
                    rows, logs = evaluated(chunk)
                    yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(logs)], names=["row", "log"])
                give_back()

    return grams.where(F.col("kind") == COLD_GRAMS).select("v", "u", "w", "size", "rows").mapInArrow(run, _LOGS)


# --- hot words, by Spark's own joins -------------------------------------------------------------


def _hot_rows(grams: DataFrame) -> DataFrame:
    """The grams of hot words as rows: bucket, place (in its order), u, v, w, count (there)."""
    names = ("bucket", "place", "u", "v", "w", "count")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names])

    def run(batches):
        for batch in batches:
            for bucket, *stored in _each(batch):
                g = _Grams.of(*stored)
                n = len(g.v)
                columns = (np.full(n, bucket), np.arange(n), g.u, g.v, g.w, g.count)
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)
                give_back()

    hot = grams.where(F.col("kind") == HOT_GRAMS)
    return hot.select("bucket", "v", "u", "w", "size", "rows").mapInArrow(run, schema)


def _with_unigram(grams: DataFrame, words: Words) -> DataFrame:
    """Adds p1, the probability of w alone, to bigrams (v, w, count)."""
    names = ("v", "w", "count")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in names] + [T.StructField("p1", T.DoubleType())])

    def run(batches):
        for batch in batches:
            p1 = words.unigram(batch.column("w").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p1)], names=schema.names)

    return grams.select(*names).mapInArrow(run, schema)


def _hot_times(grams: DataFrame) -> list[int]:
    found = [0] * (MOST_DISCOUNTED + 1)
    rows = grams.where(F.col("count").between(1, MOST_DISCOUNTED + 1)).groupBy("count").agg(F.count("*").alias("n"))
    for r in rows.collect():
        found[r["count"] - 1] = r["n"]
    return found


def _hot_backed_off(grams: DataFrame, context: list[str], lower: str, kept: np.ndarray, out: str) -> DataFrame:
    """`backed_off` for rows with `count`: adds the column `out`."""
    share = F.col("count").cast("double")
    for r in range(1, MOST_DISCOUNTED + 1):
        share = F.when(F.col("count") == r, F.lit(float(kept[r] * r))).otherwise(share)
    grams = grams.withColumn("_share", share)
    sums = grams.groupBy(*context).agg(
        F.sum("count").cast("double").alias("_total"), F.sum("_share").alias("_left"),
        F.sum(F.when(F.col("count") > 0, F.col(lower)).otherwise(0.0)).alias("_seen"),
    )
    room = F.col("_total") + (F.col("_left") >= F.col("_total")).cast("double")
    weight = F.when(
        F.col("_total") > 0, (1 - F.col("_left") / room) / F.greatest(1 - F.col("_seen"), F.lit(1e-300))
    ).otherwise(1.0)
    p = F.when(F.col("count") > 0, F.col("_share") / room).otherwise(weight * F.col(lower))
    return grams.join(sums, context).withColumn(out, p).drop("_share", "_total", "_left", "_seen")


def _hot_logs(grams: DataFrame, hot: DataFrame, whole: DataFrame, pairs: DataFrame, kept: list[np.ndarray]) -> DataFrame:
    """(row, log) of the grams of hot words. `whole` are their merged trigrams, `pairs` their bigrams."""
    p = _hot_backed_off(pairs, ["v"], "p1", kept[0], "p").select("v", "w", "p")
    p = whole.select("u", "v", "w", "count").join(p, ["v", "w"])
    if len(kept) > 1:
        p = _hot_backed_off(p, ["u", "v"], "p", kept[1], "q").withColumn("p", F.col("q"))
    logs = hot.select("bucket", "place", "u", "v", "w").join(
        p.select("u", "v", "w", F.log10("p").alias("log")), ["u", "v", "w"]
    ).select("bucket", "place", "log")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        g = _Grams.of(*[left[c][0].as_py() for c in ("v", "u", "w", "size", "rows")])
        found = np.empty(len(g.v))
        found[right["place"].to_numpy()] = right["log"].to_numpy()
        rows, sums = g.per_row(found)
        del g, found
        give_back()
        return pa.table({"row": rows, "log": sums})

    mine = grams.where(F.col("kind") == HOT_GRAMS).select("bucket", "v", "u", "w", "size", "rows")
    return mine.groupBy("bucket").cogroup(logs.groupBy("bucket")).applyInArrow(add, _LOGS)


# --- the model -----------------------------------------------------------------------------------


def _figures(grams: DataFrame) -> DataFrame:
    """(row, n_tokens, n_known, base_score) of every document."""
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("row", "n_tokens", "n_known")] + [T.StructField("base_score", T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            for rows, length, known, base in _each(batch):
                columns = [_unpack_sorted(rows), _unpack(length), _unpack(known), np.frombuffer(base)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return grams.where(F.col("kind") == FIGURES).select("v", "u", "w", "size").mapInArrow(run, schema)


def score(documents: DataFrame, trained: Column, order: int = ORDER, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, trained, n_tokens, n_known (tokens seen in training), train_tokens, base_score, score.

    The model learns from the documents where `trained` holds (null: holds) and scores all. Tokens are the words between
    ASCII white space, A-Z lower-cased, and the document's end. base_score is the log10 probability by unigrams with one
    half added to every count; score that of the Katz model of the given order (2 or 3). A word not seen in training is
    the unknown word, whose probability is what the unigrams' discounts leave. Null and empty texts are the end alone.
    Documents are rows: repeated ids are scored each. Without training documents everything is unknown. Other columns are
    ignored.
    """
    spark = documents.sparkSession
    path = shared_dir(spark, "katz-blocks")
    cut = blocks(documents, trained)
    cut.write.partitionBy("kind").parquet(path)
    known = spark.read.schema(cut.schema).parquet(path)
    of_kind = lambda kind: known.where(F.col("kind") == kind)
    size = {r["kind"]: r["n"] for r in known.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    parts, buckets = 1 + size.get(WORDS, 0) // BUCKET, 1 + size.get(TOKENS, 0) // BUCKET
    start_is_hot = size.get(DOCS, 0) > hot

    vocabulary = saved(_vocabulary(_requests(of_kind(WORDS), parts, "known", "total"), hot), "katz-words")
    words = _classes(vocabulary, parts)
    replies = _replies(_requests(of_kind(WORDS), parts), vocabulary, words)
    numbered = saved(_numbered(of_kind(WORDS), replies), "katz-numbers")
    delete(spark, path, [f"kind={WORDS}"])
    hot_classes = words.base < words.first_cold
    has_hot = bool(hot_classes.any()) or start_is_hot
    hot_tokens = int((words.count * words.types)[hot_classes].sum())
    dealt = _dealt(of_kind(TOKENS), numbered, words, order, buckets, 1 + hot_tokens // BUCKET, start_is_hot)
    # a bucket is a few rows from here on
    grams = saved(dealt.groupBy("bucket").applyInArrow(_sorted_grams, _GRAMS), "katz-grams", group_bytes=8 << 20)
    delete(spark, path, [f"kind={TOKENS}"])

    times = _counted(grams)
    if has_hot:
        rows = _hot_rows(grams)
        whole = saved(rows.groupBy("u", "v", "w").agg(F.sum("count").alias("count")), "katz-hot")
        pairs = _with_unigram(whole.groupBy("v", "w").agg(F.sum("count").alias("count")), words)
        for name, more in (("vw", _hot_times(pairs)), ("uvw", _hot_times(whole))):
            times[name] = [a + b for a, b in zip(times[name], more)]
    kept = [discounts(times[g]) for g in ("vw", "uvw")[: order - 1]]
    logs = _cold_logs(grams, words, kept)
    if has_hot:
        logs = logs.unionByName(_hot_logs(grams, rows, whole, pairs, kept))
    sums = logs.groupBy("row").agg(F.sum("log").alias("score"))
    docs = of_kind(DOCS).select(F.explode("docs").alias("d")).select("d.row", "d.doc_id", "d.trained")
    return (
        docs.join(_figures(grams), "row").join(sums, "row")
        .select(
            "doc_id", "trained", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"), "base_score", "score"
        )
    )
