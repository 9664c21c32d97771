import math
import random
from fractions import Fraction
from itertools import combinations

import numpy as np

from holdfast.llm import line_dedup, ngram_join
from holdfast.llm.components import components
from tests.llm import helpers as H


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(-5, 7), (3, 3)]
    frame = spark.createDataFrame(links + [(None, 4)], "a bigint, b bigint")
    want = H.components({x for e in links if e[0] != e[1] for x in e}, [e for e in links if e[0] != e[1]])
    assert {r.node: r.root for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


def test_banding_reaches_the_recall():
    for t, recall, most in ((0.8, 0.9995, 128), (0.8, 0.99, 64), (0.9, 0.999, 32)):
        bands, rows = ngram_join.banding(t, recall, most)
        assert bands * rows <= most and 1 - (1 - t ** rows) ** bands >= recall
        more = rows + 1
        assert math.ceil(math.log1p(-recall) / math.log1p(-t ** more)) * more > most


def words(text):
    found = (c.lower().strip(ngram_join._PUNCTUATION) for c in (text or "").split())
    return [w for w in found if w]


def near_copies(rng, n, base_words, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(copy) + ".")
    return out


def brute_join(texts):
    sets = {i: H.grams(words(t), 5) for i, t in texts.items()}
    by = {}
    for i in sorted(sets):
        if sets[i]:
            by.setdefault(sets[i], []).append(i)
    reps = {v[0]: s for s, v in by.items()}
    links = [(a, b) for a, b in combinations(sorted(reps), 2) if H.near(reps[a], reps[b])]
    root = H.components(reps, links)
    count = {i: sum(i in e for e in links) for i in reps}
    out = {i: (i, i, 1, 0) for i in texts}
    for members in by.values():
        first = members[0]
        out |= {i: (root[first], first, len(members), count[first]) for i in members}
    return out


def test_join_against_brute_force(spark):
    rng = random.Random(2)
    texts = near_copies(rng, 90, 120, 9) + near_copies(rng, 8, 400, 6) + near_copies(rng, 20, 30, 2)
    texts += [texts[0]] * 30 + [texts[3].upper()] + [None, "", "a", "a", "a b", "?!", "a b c d e"]
    texts += [" ".join(f"u{rng.randrange(500)}" for _ in range(60)) for _ in range(40)]
    frame = H.docs_frame(spark, texts)
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.join(frame).collect()}
    assert got == brute_join(dict(enumerate(texts)))
    left = ngram_join.firsts(frame)
    assert left.columns == frame.columns
    assert {r.doc_id for r in left.collect()} == {i for i, v in got.items() if v[0] == i}


def test_blocks_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 1500)  # forces pairs of blocks
    texts = near_copies(random.Random(4), 80, 100, 6)
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.join(H.docs_frame(spark, texts)).collect()}
    assert got == brute_join(dict(enumerate(texts)))


def test_join_on_edges(spark):
    rows = ngram_join.join(H.edge_frame(spark)).collect()
    assert len(rows) == len(H.EDGES)
    by = {r.doc_id: r for r in rows}
    assert by[1].class_id == by[6].class_id == 1 and by[1].n_copies == 3
    assert all(by[i].class_id == i and by[i].n_links == 0 for i in (2, 3, 4, 5, 7, 8, 9))
    assert by[None].class_id is None
    left = [r.doc_id for r in ngram_join.firsts(H.edge_frame(spark)).collect()]
    assert 6 not in left and None in left and set(left) == {None, 1, 2, 3, 4, 5, 7, 8, 9}
    assert ngram_join.join(H.edge_frame(spark, [])).count() == 0


def test_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in ngram_join.op8_ngram_jaccard_join(spark, sf).collect()}
    assert got == brute_join(docs)


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(1, 2 ** 63, 900, np.uint64))
    b = np.unique(np.concatenate([a[:700], rng.integers(1, 2 ** 63, 150, np.uint64)]))
    factors = ngram_join._odd(4000, 11)
    same = (ngram_join.signature(a, factors) == ngram_join.signature(b, factors)).mean()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(same - true) < 0.05
    assert ngram_join._least_shared(18, Fraction(4, 5)) == 8


# ---------------------------------------------------------------- lines

def line_set(line):
    return H.grams(line, line_dedup.SHINGLE)


def brute_lines(texts):
    """Places removed per document id; documents in order."""
    occ = [(d, k, x.strip(" \t\n\x0b\x0c\r").lower()) for d, t in sorted(texts.items())
           for k, x in enumerate((t or "").split("\n")) if H.WORD.search(x)]
    lines = sorted({x for _, _, x in occ})
    sets = [line_set(x) for x in lines]
    root = H.components(range(len(lines)), [(a, b) for a, b in combinations(range(len(lines)), 2)
                                            if H.near(sets[a], sets[b])])
    at, seen, gone = {x: i for i, x in enumerate(lines)}, set(), {}
    for d, k, x in occ:
        r = root[at[x]]
        if r in seen:
            gone.setdefault(d, []).append(k)
        seen.add(r)
    return gone


def test_lines_against_brute_force(spark):
    rng = random.Random(6)
    lines = near_copies(rng, 70, 60, 6) + near_copies(rng, 6, 25, 2) + ["Of.", "of.", "  Of. ", "The end of it."]
    lines += [" ".join(f"u{rng.randrange(300)}" for _ in range(20)) for _ in range(40)] + ["", " ", "same line here."] * 9
    rng.shuffle(lines)
    texts = ["\n".join(lines[i:i + 5]) for i in range(0, len(lines), 5)] + [None, "", "Of."]
    frame = H.docs_frame(spark, texts)
    got = {r.doc_id: list(r.removed) for r in line_dedup.repeats(frame).collect()}
    want = brute_lines(dict(enumerate(texts)))
    assert got == want
    left = line_dedup.deduplicated(frame)
    assert left.columns == frame.columns and left.schema == frame.schema
    rows = {r.doc_id: r for r in left.collect()}
    for i, text in enumerate(texts):
        parts = [x for k, x in enumerate((text or "").split("\n")) if k not in want.get(i, [])]
        if i in want and not any(H.WORD.search(x) for x in parts):
            assert i not in rows
        else:
            assert rows[i].text == (text if text is None else "\n".join(parts))
            assert rows[i].n_chars == (None if text is None else len(rows[i].text)) or i not in want


def test_blocks_of_lines(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 2500)
    texts = near_copies(random.Random(8), 120, 50, 8)
    got = {r.doc_id for r in line_dedup.repeats(H.docs_frame(spark, texts)).collect()}
    assert got == set(brute_lines(dict(enumerate(texts))))


def test_lines_on_edges(spark):
    frame = H.edge_frame(spark)
    left = line_dedup.deduplicated(frame)
    assert left.columns == frame.columns
    got = sorted((r.doc_id or 0) for r in left.collect())
    assert got == [0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert line_dedup.deduplicated(H.edge_frame(spark, [])).count() == 0


def test_line_query_against_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = brute_lines(docs)
    rows = line_dedup.op9_line_dedup(spark, sf).collect()
    assert {r.doc_id: list(r.removed) for r in rows if r.n_removed} == want
    assert {r.doc_id for r in rows} == set(docs)
