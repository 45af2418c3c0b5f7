"""Plain versions of the document operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def repeated_bytes(docs, window=100):
    """doc_id to (bytes, covered flags); docs: (doc_id, text) of distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - window + 1):
            piece = raw[at : at + window]
            if piece in seen:
                gone[at : at + window] = b"\1" * window
            seen.add(piece)
        out[doc_id] = (raw, gone)
    return out


def removal_report(docs):
    out = {}
    for doc_id, (raw, gone) in repeated_bytes(docs).items():
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def without_repeats(docs):
    out = {}
    for doc_id, (raw, gone) in repeated_bytes(docs).items():
        text, kept, at = raw.decode(), [], 0
        for char in text:
            size = len(char.encode())
            if not all(gone[at : at + size]):
                kept.append(char)
            at += size
        out[doc_id] = "".join(kept)
    return out


def bag(text):
    w = words(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def similarity(a, b):
    shared = sum(min(n, b[x]) for x, n in a.items())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def near_classes(docs, least=0.8):
    """A class (least id) per row of docs: (doc_id, text)."""
    bags = [bag(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if bags[i] is None or bags[j] is None:
                alike = bags[i] is bags[j] and (docs[i][1] or "") == (docs[j][1] or "")
            else:
                alike = similarity(bags[i], bags[j]) >= least - 1e-9
            if alike:
                up[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low[find(i)] for i in range(len(docs))]


def benchmark_hits(text, items, window=10):
    """(number of words, set of hit words, names of items hit)."""
    w, hit, names = words(text), set(), set()
    for name, item in items:
        x = words(item)
        n = min(window, len(x))
        grams = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(w), hit, names
