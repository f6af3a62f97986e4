"""Packing into training sequences: shortest-pack-first over the histogram of lengths.

Documents become token ids and an end mark. A document longer than a sequence gives full sequences and a rest;
the rests' lengths are counted (a histogram of bounded size), the histogram is packed longest length first,
each time into the shortest pattern that has room, and the patterns' counts are joined back to the pieces by
their rank within their length.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millwright.llm.tables import saved

SEQUENCE = 4096
END = 2
#: Distinct space-free strings, and pieces of them, whose ids a Python worker keeps.
KEPT = (450_000, 600_000)
#: When a memory is full, strings up to this length stay, if they fill no more than half of it: they recur most.
SHORT = 6
LONGEST_KEPT = 200
#: Documents tokenized at once; bounds a worker's memory.
BATCH_CHARACTERS = 1 << 22


class Tokens:
    """Ids as little-endian 32-bit numbers, with a memory of what was tokenized before.

    The tokenizer never joins across spaces and line ends, so a text's ids are those of its space-free strings in a row,
    and most strings recur. A string of ASCII and Latin letters is cut as the tokenizer's own pattern cuts it, and its
    pieces recur even more often. All ids come from the tokenizer; strings of other characters go to it whole.
    """

    #: In strings joined by spaces: those with another character than ASCII and Latin letters.
    OTHER = re.compile("(?<![^ ])[!-~\u00c0-\u012f\u0131-\u017f]*+[^ ]+")
    #: The pattern of the tokenizer's pre-tokenizer (fixed values), for plain strings in lower case, and the space between.
    CUT = re.compile(
        "'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f ]+| "
    )
    #: Stands for that space among ids, all of which are smaller: an id's last byte is never 255.
    GAP = b"\xff" * 4

    def __init__(self, name: str, kept: tuple[int, int]):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.known_layout = name == "word_bpe_49k.json"  # the cut above is this tokenizer's
        ends = [t.endswith("</w>") for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])]
        self.ends = np.array(ends)
        self.most_strings, self.most_pieces = kept
        self.strings: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _learn_pieces(self, new: list[str]) -> None:
        parts = [new[k: k + 512] for k in range(0, len(new), 512)]
        for part in parts:
            [e] = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            # a piece's ids end with the first one that ends a word
            ids = np.array(e.ids, "<u4")
            at = ((np.nonzero(self.ends[ids])[0] + 1) * 4).tolist()
            if len(at) != len(part):
                raise ValueError("the tokenizer cuts words in another way than expected")
            held = ids.tobytes()
            self.pieces.update(zip(part, [held[i:j] for i, j in zip([0, *at], at)]))

    def _learn(self, new: list[str]) -> None:
        other = new
        if self.known_layout:
            joined = " ".join(new)
            special = {w for w in new if "<|" in w} if "<|" in joined else set()
            other = list(special.union(self.OTHER.findall(joined)))
        plain = list(set(new).difference(other))
        if plain:
            self._learn_plain(plain)
        for k in range(0, len(other), 1024):
            part = other[k: k + 1024]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.strings[w] = np.array(e.ids, "<u4").tobytes()

    def _learn_plain(self, plain: list[str]) -> None:
        """All strings are cut, looked up and divided again at once."""
        cuts = self.CUT.findall(" ".join(plain).lower())
        wanted = set(cuts)
        wanted.discard(" ")
        missing = list(wanted.difference(self.pieces))
        if len(self.pieces) + len(missing) > self.most_pieces:
            self.pieces = _shortest(self.pieces, self.most_pieces)
            missing = list(wanted.difference(self.pieces))
        self._learn_pieces(missing)
        self.pieces[" "] = self.GAP
        held = b"".join(map(self.pieces.__getitem__, cuts)).split(self.GAP)
        self.strings.update(zip(plain, held, strict=True))
        for p in missing:
            if len(p) > LONGEST_KEPT:
                del self.pieces[p]

    def ids(self, texts: list[str]) -> list[bytes]:
        split = [x.replace("\n", " ").split(" ") for x in texts]
        words = set().union(*split)
        new = list(words.difference(self.strings))
        if len(self.strings) + len(new) > self.most_strings:
            self.strings = _shortest(self.strings, self.most_strings) | {"": b""}
            new = list(words.difference(self.strings))
        self._learn(new)
        look_up = self.strings.__getitem__
        out = [b"".join(map(look_up, s)) for s in split]
        for w in new:
            if len(w) > LONGEST_KEPT:
                del self.strings[w]
        return out


def _shortest(memory: dict[str, bytes], most: int) -> dict[str, bytes]:
    short = {w: i for w, i in memory.items() if len(w) <= SHORT}
    return short if len(short) <= most // 2 else {}


_tokens = lru_cache(maxsize=2)(Tokens)


def token_ids(texts: list[str], name: str, kept: tuple[int, int] = KEPT) -> list[bytes]:
    return _tokens(name, kept).ids(texts)


PIECES = "array<struct<start:long,length:int,ids_crc32:long>>"


def _pieces(ids: bytes, sequence: int) -> list[dict]:
    step = 4 * sequence
    return [
        {"start": k // 4, "length": min(step, len(ids) - k) // 4, "ids_crc32": zlib.crc32(ids[k: k + step])}
        for k in range(0, len(ids), step)
    ]


def cut(text: Column, tokenizer: str, sequence: int, end: int, kept: tuple[int, int] = KEPT) -> Column:
    """The pieces of every text: full sequences and a rest. Null is empty: one piece, the end mark alone."""
    mark = np.array([end], "<u4").tobytes()

    @F.pandas_udf(PIECES)
    def run(texts: pd.Series) -> pd.Series:
        out, batch, held = [], [], 0
        for x in texts:
            batch.append(x or "")
            held += len(batch[-1])
            if held >= BATCH_CHARACTERS:
                out += [_pieces(i + mark, sequence) for i in token_ids(batch, tokenizer, kept)]
                batch, held = [], 0
        out += [_pieces(i + mark, sequence) for i in token_ids(batch, tokenizer, kept)]
        return pd.Series(out, dtype=object)

    return run(text)


def pack_histogram(histogram: dict[int, int], sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths) and how often each is used, by shortest-pack-first.

    Lengths are placed longest first; each goes into the open pattern with the most room, as often as both
    last. The number of patterns depends on the number of distinct lengths, not on the number of pieces.
    """
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, count]
    roomiest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while roomiest and not open_.get(roomiest):
                roomiest -= 1
            if roomiest < length:
                # a new pattern is the shortest from now on, so it takes this length while there is room
                times = sequence // length
                for n, count in ((times, left // times), (left % times, 1)):
                    if n and count:
                        open_[sequence - n * length].append([(length,) * n, count])
                        roomiest = max(roomiest, sequence - n * length)
                break
            pattern, count = open_[roomiest].pop()
            used = min(count, left)
            if count > used:
                open_[roomiest].append([pattern, count - used])
            # a pattern takes as many of this length as fit, one at a time, through the loop
            open_[roomiest - length].append([pattern + (length,), used])
            left -= used
    return [(tuple(p), c) for parts in open_.values() for p, c in parts]


def _slots(patterns) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, in rank order: first rank, first sequence and offset of each run of equal placements."""
    by_length: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, count in sorted(patterns, reverse=True):
        offset = 0
        for length in pattern:
            by_length[length].append((used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    return {n: tuple(np.array(x, np.int64) for x in zip(*rows)) for n, rows in by_length.items()}


def pack(
    documents: DataFrame, tokenizer: str = "word_bpe_49k.json", sequence: int = SEQUENCE, end: int = END,
    kept: tuple[int, int] = KEPT,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document lies in one piece; no sequence exceeds `sequence` ids and its offsets have no
    gaps. A null or empty text is the end mark alone. Repeated rows are packed each; an empty table gives no
    piece. Other columns are ignored. `kept` bounds the strings and pieces that a worker remembers.
    """
    cut_up = documents.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), cut(F.col("text"), tokenizer, sequence, end, kept).alias("pieces")
    )
    # one written copy: all ranks and counts below refer to it
    pieces = saved(
        cut_up.withColumn("doc_tokens", F.expr("aggregate(pieces, 0L, (n, p) -> n + p.length)"))
        .select("doc_id", "row", "doc_tokens", F.explode("pieces").alias("p"))
        .select("doc_id", "row", "doc_tokens", "p.start", "p.length", "p.ids_crc32"),
        "pieces",
    ).withColumn("part", F.shiftright("row", 33))  # the task that cut it: a length is never ranked in one task
    histogram = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = histogram.withColumn("before", F.coalesce(F.sum("n").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ), F.lit(0))).drop("n")
    counts = {
        r["length"]: r["n"] for r in histogram.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }  # at most `sequence` rows
    slots = _slots(pack_histogram(counts, sequence))
    inside = W.partitionBy("length", "part").orderBy("row", "start")
    ranked = (
        pieces.withColumn("n", F.row_number().over(inside))
        .join(before, ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("n") - 1)
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), np.int64)
        of, at = length.to_numpy(), rank.to_numpy()
        for n in np.unique(of):
            rows = of == n
            first, seq, offset = slots[int(n)]
            k = np.searchsorted(first, at[rows], side="right") - 1
            out[rows, 0] = seq[k] + at[rows] - first[k]
            out[rows, 1] = offset[k]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    return ranked.withColumn("place", place("length", "rank")).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        "place.sequence_id", "place.offset",
    )
