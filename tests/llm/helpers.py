"""Plain versions of the operators for small fixtures."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta gamma. " * 30_000

#: Rows that every operator has to survive: NULLs, empty and blank texts, a very long one, repeats, odd characters.
EDGES = [
    (1, "One two three four five six seven eight nine ten eleven.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b\x0c\r ", "en", ""),
    (5, LONG, "en", "a"),
    (6, "One two three four five six seven eight nine ten eleven.", "en", "a"),
    (6, "One two three four five six seven eight nine ten eleven.", "en", "a"),
    (7, "émoji 😀 naïve\x1cseparated\x1c words here   and ẞ ß İ.", "fr", "b"),
    (None, "A row without an id has a text of its own, with enough words.", "en", "a"),
    (8, "###\n| a | b | c | d |\nSHOUTING ALL THE DAY LONG!!\nAll rights reserved.", "de", "b"),
    (9, "x" * 50_000, "en", "b"),
]
#: Columns whose names the operators use inside.
CLASHES = ("n_words kept id line bucket removed key bands n rep root node score predicted h pos item_id "
           "size row _row words url host tokens length start piece").split()


def edge_frame(spark, rows=None):
    frame = spark.createDataFrame(EDGES if rows is None else rows,
                                  "doc_id bigint, text string, lang string, source string")
    return frame.selectExpr("*", "cast(length(text) as bigint) as n_chars",
                            *[f"cast(1 as int) as `{c}`" for c in CLASHES])


def docs_frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")


def repeated_words(words, n=5):
    windows = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit.update(range(i, i + n))
    return len(hit)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def grams(items, n):
    if not items:
        return frozenset()
    return frozenset(tuple(items[i:i + n]) for i in range(max(1, len(items) - n + 1)))


def near(a, b, p=4, q=5):
    return len(a & b) * (p + q) >= (len(a) + len(b)) * p
