"""Frames and brute-force versions that the tests of the text operators share."""

import re
from itertools import combinations

WHITE = r"[\x20\x09-\x0D]+"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))


def frame(spark, texts, extra=""):
    """Documents numbered from 0, or from (id, text) pairs."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def words(text):
    return [w for w in re.split(WHITE, text or "") if w]


def passages(texts, window=20):
    """doc -> (words, removed flags) by comparing every window with all earlier ones."""
    seen, out = set(), {}
    for doc, text in sorted(texts, key=lambda r: r[0]):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        out[doc] = (own, gone)
    return out


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width=3):
    own = words(lowered(text))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)))


def linked(texts, percent=90, width=3):
    """doc -> lowest doc reachable by links, comparing all pairs."""
    sets = {doc: shingles(text, width) for doc, text in texts}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            one, two = sorted((find(a), find(b)))
            root[two] = one
    return {doc: find(doc) for doc in sets}
