"""Plain Python versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WHITE = re.compile(rb"[\x20\x09-\x0D]+")


def text_bytes(text):
    return (text or "").encode()


def removed(docs, width=50):
    """doc_id -> n_bytes, n_removed, n_spans, sha256 of what is left."""
    first = {}
    for doc_id, text in docs:
        data = text_bytes(text)
        for i in range(len(data) - width + 1):
            window = data[i : i + width]
            first[window] = min(doc_id, first.get(window, doc_id))
    out = {}
    for doc_id, text in docs:
        data = text_bytes(text)
        gone = [False] * len(data)
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < doc_id:
                gone[i : i + width] = [True] * width
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def exact_groups(docs):
    """doc_id -> keep_id, group_size."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text_bytes(text).translate(None, b" \t\n\x0b\x0c\r")].append((-len(text or ""), doc_id))
    return {doc_id: (min(g)[1], len(g)) for g in groups.values() for _, doc_id in g}


def shingle_sets(docs, size=5):
    fold = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
    out = {}
    for doc_id, text in docs:
        words = [w for w in WHITE.split(text_bytes(text).translate(fold)) if w]
        full = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        out[doc_id] = full or ({tuple(words)} if words else set())
    return out


def near_groups(docs, percent=75):
    """doc_id -> n_shingles, component_id."""
    sets = shingle_sets(docs)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for d, s in sets.items():
        shared = Counter(o for x in s for o in holders[x] if o < d)
        for o, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}
