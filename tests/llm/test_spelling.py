import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from holdfast.llm import spelling as S
from tests.llm import helpers as H

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    count = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            count[word] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(words):
    """Near words by filing each word under itself with one letter left out, and checking."""
    by = {}
    for w in words:
        for key in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            by.setdefault(key, []).append(w)
    near = {w: set() for w in words}
    for group in by.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def got_of(frame):
    rows = frame.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = got_of(S.op13_spelling_variants(spark, sf))
    assert got == brute(counted(rows)) and sum(v[0] is not None for v in got.values()) > 5


def near_of(frame):
    return {r.word: (r.n_near, r.form_n, r.form) for r in frame.collect()}


def brute_near(words):
    out = {}
    for w in words:
        others = [o for o in words if one_edit(w, o)]
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            out[w] = (len(others), words[best], best)
    return out


def many_words(rng, n, letters, sizes):
    words = set()
    while len(words) < n:
        words.add("".join(rng.choice(letters) for _ in range(rng.choice(sizes))))
    return {w: rng.randrange(3, 40) for w in sorted(words)}


def test_near_words_against_all_pairs(spark):
    rng = random.Random(4)
    words = many_words(rng, 500, "abé", (5, 6, 7)) | many_words(rng, 150, "ab", (5, 6, 7, 8, 9, 10))
    words |= {"a" * k: k for k in range(5, 12)} | {"x" * 3000: 9, "x" * 2999 + "y": 7, "x" * 3001: 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = brute_near(words)
    assert near_of(S.near_words(frame)) == want
    assert near_of(S.near_words(frame, block=7)) == want  # blocks of a file


def test_small_buffers_give_the_same(spark, monkeypatch):
    words = many_words(random.Random(8), 900, "abc", (5, 6, 7))
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    want = brute_near(words)
    monkeypatch.setattr(S, "CELLS", 3000)
    monkeypatch.setattr(S, "ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        assert near_of(S.near_words(frame)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_checksums_of_joined_texts():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcéß") for _ in range(rng.randrange(1, 120))).encode() for _ in range(200)]
    docs = ["", "0", "-5", "123456789012345"]
    doc, word = (np.array(x) for x in zip(*[(rng.randrange(4), k) for k in range(200)]))
    want = [zlib.crc32(f"{docs[d]}:".encode() + words[w]) for d, w in zip(doc, word)]
    assert S._checksums(docs, doc, words, word).tolist() == want


def test_counts_against_plain():
    texts = ["Élan éLAN ÀB×CD÷ naïve don't foo_bar x1y2 ÿÿÿÿÿ", "", None, "ABCDE abcde Abcde ŒUVRE œuvre ẞtraße", "z" * 90]
    docs = [3, 4, 5, None, 97]
    got = Counter()
    batch = S._counts(pa.array(docs, pa.int64()), pa.array([t or "" for t in texts], pa.large_string()))
    for w, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
        got[w] += n
    want = Counter()
    for d, t in zip(docs, texts):
        for w, n in counted([(d, t)] * 3).items():
            want[w] += n
    assert {w: 3 * n for w, n in got.items()} == want


def test_chains_of_forms(spark):
    chain = [(f"abcde{'f' * k}", 4 * 2 ** k) for k in range(12)]
    got = {r.word: r.root for r in S.roots(spark.createDataFrame(
        [(a, b) for (a, _), (b, _) in zip(chain, chain[1:])], "word string, form string")).collect()}
    assert got == {a: chain[-1][0] for a, _ in chain[:-1]}
    text = " ".join(w for w, n in chain[:6] for _ in range(n))
    rows = [(10_007, text)]
    assert got_of(S.variants(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(counted(rows))


def test_edges(spark):
    want = brute(counted([(i, t) for i, t, *_ in H.EDGES]))
    assert got_of(S.variants(H.edge_frame(spark))) == want and "alpha" in want
    assert S.variants(H.edge_frame(spark, [])).count() == 0
