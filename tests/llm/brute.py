"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def byte_dedup(texts, width=200):
    raw = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for r in raw:
        for i in range(len(r) - width + 1):
            seen[r[i : i + width]] += 1
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(r), sum(gone), spans, sha(bytes(b for b, g in zip(r, gone) if not g))))
    return out


def word_dedup(docs, width=50):
    """docs: (doc_id, text)."""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            first[k] = min(first.get(k, d), d)
    out = []
    for (d, _), w in zip(docs, words):
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def near_components(docs, k=4, like=80):
    """docs: (doc_id, text) with distinct ids; rows (doc_id, n_shingles, component_id, kept)."""
    sets = {}
    for d, t in docs:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    inverted = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)
    common = defaultdict(int)
    for ids in inverted.values():
        for i, a in enumerate(ids):
            for b in ids[:i]:
                common[a, b] += 1
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), c in common.items():
        if 100 * c >= like * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return [(d, len(s), find(d), find(d) == d) for d, s in sets.items()]
