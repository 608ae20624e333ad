"""Rows with every awkward value, and brute-force helpers."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, k long, slot string, score string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    """Nulls, empties, white space, very long and repeated texts, repeated and null ids; clashing extra columns."""
    long = " ".join(f"word{i % 997} tail{i}" for i in range(15_000))
    base = [f"alpha{i}" for i in range(60)]
    near = base[:30] + ["changed"] + base[31:]
    texts = [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()), (4, " ".join(base)),
        (5, None), (6, ""), (7, " \t\n"), (8, "one"), (9, "one"), (10, "one two three"), (11, "ONE  two\tthree"),
        (12, long), (13, long + " more"), (14, "über größe straße müde " * 5), (15, "日本語 text 🎉 ok"),
        (None, "no id here at all"), (None, "no id here at all"), (None, None), (16, " ".join(base)), (16, " ".join(base)),
        (16, "another text under the same id"), (-5, "a negative id with some words"), (20, "tail " * 40), (25, "x"),
    ]
    return [(i, t, None if n % 5 == 4 else "en", None if n % 7 == 6 else f"src{n % 3}", None, n, n, "s", "s") for n, (i, t) in enumerate(texts)]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall((text or "").translate(_LOW))


def shingles(text, k):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + k]) for i in range(max(1, len(found) - k + 1)))


def components(docs, k, percent):
    """Smallest doc_id in reach of every row of ``[(doc_id, text)]``, by comparing all pairs of sets."""
    sets = [shingles(t, k) for _, t in docs]
    to = list(range(len(docs)))

    def find(x):
        while to[x] != x:
            x = to[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                to[max(find(i), find(j))] = min(find(i), find(j))
    lowest = {}
    for i, (doc_id, _) in enumerate(docs):
        known = [x for x in (lowest.get(find(i)), doc_id) if x is not None]
        lowest[find(i)] = min(known) if known else None
    return [(docs[i][0], len(sets[i]), lowest[find(i)] if sets[i] else docs[i][0]) for i in range(len(docs))]
