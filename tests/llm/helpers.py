"""Small corpora and brute-force twins for the operator tests."""

from __future__ import annotations

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_components(texts: dict, n: int, percent: int = 80) -> dict:
    """Component of each id by comparing all pairs."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def odd_documents() -> list[tuple]:
    """Nulls, blanks, ties, repeats, a very long text."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = "the quick brown fox jumps over the lazy dog and runs far away from the old house " * 3
    return [
        (0, "a b  c", "en", "s1", 6),
        (1, "a b c", "en", "s1", 5),
        (2, "a\tb\nc", None, "s2", 5),
        (3, None, "en", None, None),
        (4, "", "en", "s2", 0),
        (5, " ", "en", "s2", 1),
        (6, "  ", None, None, 2),
        (7, long, "en", "s1", len(long)),
        (8, long, "de", "s3", len(long)),
        (9, long + " tail", "de", "s3", 1),
        (10, base + "one", "en", "s1", 1),
        (11, base + "two", "en", "s1", 1),
        (12, "Single", "en", "s1", 6),
        (13, "single", "en", "s1", 6),
        (13, "single", "en", "s1", 6),
        (14, "été Straße 日本語", "fr", "s\u00e9", 14),
        (None, "a b c", "en", "s1", 5),
        (None, None, None, None, None),
    ]
