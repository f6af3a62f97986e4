"""Plain single-process versions of the operators' results, written from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text))


def fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if not found:
        return 0
    grams = [" ".join(found[k: k + 4]) for k in range(len(found) - 3)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    """[(doc_id, fingerprint, component_id)] of [(doc_id, text)], by comparing all pairs."""
    fps = [(i, fingerprint(t)) for i, t in docs]
    group = list(range(len(fps)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= 4:
                group[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [(i, f"{f:016x}", least.get(root(k))) for k, (i, f) in enumerate(fps)]


def contamination(docs, items):
    lists = [(i, words(t)) for i, t in items]
    found = defaultdict(set)
    for i, w in lists:
        for k in range(max(1, len(w) - 12)) if w else ():
            found[tuple(w[k: k + 13])].add(i)
    out = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(g) for g in found}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k: k + n])) in found:
                    hit |= set(range(k, k + n))
                    names |= found[g]
        listed = ",".join(sorted(str(x) for x in names if x is not None))
        out.append((
            doc_id, len(w), len(hit), len(names - {None}), hashlib.sha256(listed.encode()).hexdigest(),
            bool(hit) and 20 * len(hit) >= len(w),
        ))
    return out


def repeats(docs, window=400):
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(d[k: k + window] for _, d in data for k in range(len(d) - window + 1))
    out = []
    for doc_id, d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - window + 1):
            if seen[d[k: k + window]] > 1:
                gone[k: k + window] = b"\1" * window
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc_id, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def url_rule(url):
    """host, path, rule, verdict."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    host, path = lower_ascii(host), slash + path
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    return host, path, rule, verdict


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(docs):
    out = []
    for doc_id, text in docs:
        w = words(text)
        at = [
            (k, label) for phrase, label in PHRASES.items() for k in range(len(w))
            if w[k: k + len(phrase.split())] == phrase.split()
        ]
        starts = [k for k, _ in at]
        out.append((doc_id, len(w), len(at), min(starts, default=None), max(starts, default=None),
                    ",".join(sorted({x for _, x in at}))))
    return out


def secret_base(docs):
    forms = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         re.I | re.A, lambda m: len(m[2]) >= 8),
        ("access", "AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 16),
        ("hex", "[0-9a-f]+", 0, lambda m: len(m[0]) >= 32),
    ]
    out = []
    for doc_id, text in docs:
        found, count = [], []
        for k, (name, form, flags, keep) in enumerate(forms):
            mine = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in re.finditer(form, text or "", flags) if keep(m)]
            count.append(len(mine))
            found += mine
        listed = ",".join(x for *_, x in sorted(found))
        out.append((doc_id, *count, hashlib.sha256(listed.encode()).hexdigest()))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())
