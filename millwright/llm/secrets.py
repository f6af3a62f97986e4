"""Secret scans: known forms, and strings that a battery of randomness tests can't tell from random ones.

A candidate is a run of letters and digits (with the signs that encodings use, cut where it mixes the signs of
two encodings) whose encoding is inferred from the characters in it. Under the hypothesis that it is random over the encoding's alphabet, three tests
give p-values: chi-squared uniformity of the alphabet, the number of runs above and below its middle, and
serial correlation at lag one. The least of them, times three, is the candidate's p-value. Candidates that
are rejected as not random are ordinary text. The rejection level is set per length class over the whole
corpus, each distinct string once, by Benjamini and Hochberg's rule, so that the share of real secrets among what is dismissed stays
below a bound for short and long strings alike; p-values are counted in fixed bins for that, never collected.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in order, and their forms (fixed values).
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Name, alphabet in the order of its values.
ENCODINGS = [
    ("hex", "0123456789abcdef"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("hex-upper", "0123456789ABCDEF"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base36-upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
]
#: The smallest alphabets first; an encoding is the first that holds a token.
BY_SIZE = sorted(ENCODINGS, key=lambda e: len(e[1]))
#: Least length by encoding: below it the tests have too little power to dismiss ordinary text.
SHORTEST = {
    "hex": 32, "base32": 32, "base62": 24, "base64": 24, "base64url": 24, "hex-upper": 32, "base36": 28,
    "base36-upper": 28,
}
#: Signs of base64 and of base64url. A run that holds both kinds is cut at either kind in turn.
SIGNS = [re.compile(r"[^/+]+"), re.compile(r"[^_-]+")]
#: Length classes: up to 31, 47, 63, 127, 255 characters, and more.
CLASSES = [32, 48, 64, 128, 256]
#: Share of random strings among those dismissed, at most.
FALSE_SHARE = 0.05
#: p-values are counted in bins of a tenth of a power of ten.
BINS = 200


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_tail(x: float, k: int) -> float:
    """Upper tail by Wilson and Hilferty's cube root."""
    if x <= 0:
        return 1.0
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: str) -> tuple[str, list[int]] | None:
    """The smallest encoding that holds the token, and the characters' values. A token that lacks letters or
    digits, or mixes in too few of a class to be drawn from the alphabet, has none."""
    if not any(c.isdigit() for c in token) or not any(c.isalpha() for c in token):
        return None
    held = set(token)
    for name, alphabet in BY_SIZE:
        if held <= set(alphabet):
            if len(token) < SHORTEST[name]:
                return None
            return name, [alphabet.index(c) for c in token]
    return None


def battery(values: list[int], size: int) -> float:
    """p-value of `values`, numbers below `size`, under randomness."""
    n = len(values)
    # uniformity over at most n / 5 equal classes of the alphabet, so that each expects five
    bins = max(2, min(size, n // 5))
    counts = [0] * bins
    for v in values:
        counts[v * bins // size] += 1
    expected = [sum(1 for v in range(size) if v * bins // size == b) * n / size for b in range(bins)]
    chi = sum((c - e) ** 2 / e for c, e in zip(counts, expected))
    p = [_chi_squared_tail(chi, bins - 1)]
    above = [2 * v >= size for v in values]
    a, b = sum(above), n - sum(above)
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(above, above[1:]))
        mean = 2 * a * b / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p.append(_normal_tail((runs - mean) / math.sqrt(spread)) if spread > 0 else 0.0)
    else:
        p.append(0.0)
    middle = sum(values) / n
    around = [v - middle for v in values]
    total = sum(x * x for x in around)
    if total:
        r = sum(x * y for x, y in zip(around, around[1:])) / total
        p.append(_normal_tail((r + 1 / n) * math.sqrt(n)))
    else:
        p.append(0.0)
    return min(1.0, 3 * min(p))


def _length_class(n: int) -> int:
    return bisect_right(CLASSES, n)


def _name(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode()) - (1 << 63)


def _bin(p: float) -> int:
    return min(BINS - 1, int(-10 * math.log10(p))) if p > 0 else BINS - 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, in order."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int, float]]:
    """(start, end, length class, p) of the strings that have an encoding."""
    found = []
    for start, end in _pieces(text):
        token = text[start:end].rstrip("=")
        if (e := encoding(token)) is not None:
            size = next(len(a) for name, a in ENCODINGS if name == e[0])
            found.append((start, end, _length_class(len(token)), battery(e[1], size)))
    return found


def _pieces(text: str) -> list[tuple[int, int]]:
    """Candidate runs. One that mixes the signs of two encodings belongs to neither: its pieces between the signs
    of one kind, and those between the signs of the other, are candidates; they may overlap."""
    found = []
    for m in CANDIDATE.finditer(text):
        if not any(kind.fullmatch(m[0]) for kind in SIGNS):
            found += sorted({
                (m.start() + x.start(), m.start() + x.end()) for kind in SIGNS for x in kind.finditer(m[0])
            })
        else:
            found.append(m.span())
    return found


def levels(documents: DataFrame, share: float = FALSE_SHARE) -> list[int]:
    """Per length class the bin from which on a p-value is a rejection of randomness. A string counts once, however
    often it stands in the corpus."""
    @F.pandas_udf("array<struct<name:long,length:int,bin:int>>")
    def p_values(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [
                {"name": _name(x[start:end].rstrip("=")), "length": c, "bin": _bin(p)}
                for start, end, c, p in candidates(x or "")
            ]
            for x in texts
        ], dtype=object)

    counted = (
        documents.select(F.explode(p_values(F.col("text"))).alias("c")).select("c.*").distinct()
        .groupBy("length", "bin").count().collect()  # at most 6 * BINS rows
    )
    found = []
    for k in range(len(CLASSES) + 1):
        by_bin = {r["bin"]: r["count"] for r in counted if r["length"] == k}
        total, seen, level = sum(by_bin.values()), 0, BINS
        for b in range(BINS - 1, -1, -1):  # from the smallest p-values up
            seen += by_bin.get(b, 0)
            if seen and 10 ** (-b / 10) * total <= share * seen:
                level = b
        found.append(level)
    return found


def spans(text: str | None, rejected_from: list[int]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans by start, then kind."""
    text = text or ""
    extra = [
        (start, 3, end) for start, end, c, p in candidates(text) if _bin(p) < rejected_from[c]
    ]
    return sorted(base_spans(text) + extra)


SPANS = "array<struct<start:int,kind:int,end:int>>"


def scan(text: Column, rejected_from: list[int]) -> Column:
    """All spans of a text in code points, end exclusive; `kind` indexes KINDS. Null: none."""

    @F.pandas_udf(SPANS)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"start": s, "kind": k, "end": e} for s, k, e in spans(x, rejected_from)] for x in texts
        ], dtype=object)

    return run(text)


def find(documents: DataFrame) -> DataFrame:
    """The documents with a column `secrets` (see scan). A null or empty text has none; every row is judged."""
    columns = [c for c in documents.columns if c != "secrets"]
    return documents.select(*columns, scan(F.col("text"), levels(documents)).alias("secrets"))


def redact(documents: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by the mask; overlapping spans become one. All rows stay, null
    texts stay null, other columns are unchanged."""
    rejected_from = levels(documents)

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for x in texts:
            if x is None:
                out.append(None)
                continue
            parts, at = [], 0
            for start, _, end in spans(x, rejected_from):
                if start >= at:
                    parts += [x[at:start], mask]
                at = max(at, end)
            out.append("".join(parts) + x[at:])
        return pd.Series(out, dtype=object)

    return documents.withColumn("text", run(F.col("text")))
