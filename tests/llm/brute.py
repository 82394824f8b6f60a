"""Brute-force versions of the operators that SQL does not express, for small tables."""

import hashlib
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, width=5):
    own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)))


def near_duplicates(rows, percent=85):
    """(id, number of shingles, component, kept) for each (id, text)."""
    sets = [shingle_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, own in enumerate(sets):
        for x in own:
            holders.setdefault(x, []).append(i)
    shared = Counter(pair for held in holders.values() for pair in combinations(held, 2))
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least[find(i)], least[find(i)] == doc_id) for i, (doc_id, _) in enumerate(rows)]


def remove_repeats(rows, window=200):
    """(id, bytes, removed, spans, sha256 of the rest) for each (id, text)."""
    raw = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    seen = Counter(text[i : i + window] for _, text in raw for i in range(len(text) - window + 1))
    out = []
    for doc_id, text in raw:
        gone = bytearray(len(text) + 1)
        for i in range(len(text) - window + 1):
            if seen[text[i : i + window]] > 1:
                gone[i : i + window] = b"\x01" * window
        spans = sum(1 for i in range(len(text)) if gone[i] and not gone[i + 1])
        rest = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out
