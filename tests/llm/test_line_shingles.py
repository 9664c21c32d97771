"""Line dedup against character n-grams of the lines, counted plainly."""

import random
from itertools import combinations

import numpy as np

from holdfast.llm import line_dedup
from tests.llm import helpers as H


def chars(line):
    return H.grams(line, line_dedup.SHINGLE)


def brute_removed(texts):
    """Places removed per document id, by all pairs of lines."""
    occ = [(d, k, x.strip(" \t\n\x0b\x0c\r").lower()) for d, t in enumerate(texts)
           for k, x in enumerate((t or "").split("\n")) if H.WORD.search(x)]
    lines = sorted({x for _, _, x in occ})
    sets = [chars(x) for x in lines]
    root = H.components(range(len(lines)), [(a, b) for a, b in combinations(range(len(lines)), 2)
                                            if H.near(sets[a], sets[b])])
    at, seen, gone = {x: i for i, x in enumerate(lines)}, set(), {}
    for d, k, x in occ:
        if root[at[x]] in seen:
            gone.setdefault(d, []).append(k)
        seen.add(root[at[x]])
    return gone


def test_shingles_are_the_character_runs():
    lines = ["a", "abcdef", "abcdefg", "abcdefgh", "aaaaaaaaaaaa", "é😀 naïve\tẞ", "https://example.org/a/b?c=1"]
    for line, got in zip(lines, line_dedup.grams(lines)):
        assert len(got) == len(chars(line))
    for a, b in combinations(range(len(lines)), 2):
        x, y = line_dedup.grams([lines[a], lines[b]])
        assert len(np.intersect1d(x, y)) == len(chars(lines[a]) & chars(lines[b]))


def test_one_letter_and_lines_without_blanks(spark):
    line = "several small letters make twelve words in one line of plain text"
    url = "https://www.example.org/archive/2024/reports/quarterly-results/index.html?page=12&lang=en"
    row = "\t".join(f"value{k}" for k in range(12))
    texts = [line + "s and the end of it", line.replace("twelve", "twilve") + "s and the end of it", url, url + "1", row,
             row.replace("value7", "other7"), "一二三四五六七八九十一二三四五六七八九十甲乙丙丁", "一二三四五六七八九十一二三四五六七八九十甲乙丙戊",
             "something else that no other line says"]
    got = {r.doc_id: list(r.removed) for r in line_dedup.repeats(H.docs_frame(spark, texts)).collect()}
    want = brute_removed(texts)
    assert got == want and {1, 3} <= set(want)


def edited(rng, line):
    out = list(line)
    for _ in range(rng.randrange(3)):
        out[rng.randrange(len(out))] = rng.choice("abcdefghij ")
    return "".join(out)


def test_short_and_long_lines_against_brute_force(spark):
    rng = random.Random(11)
    base = [" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9)))
                     for _ in range(rng.choice((1, 6, 18, 40)))) for _ in range(25)]
    lines = [edited(rng, x) for x in base for _ in range(5)] + ["ab", "AB ", "a"]
    rng.shuffle(lines)
    texts = ["\n".join(lines[i:i + 4]) for i in range(0, len(lines), 4)] + [None, ""]
    # enough bands that no pair is left to chance
    got = {r.doc_id: list(r.removed) for r in line_dedup.repeats(H.docs_frame(spark, texts), bands=60, rows=2).collect()}
    assert got == brute_removed(texts)


def test_recall_of_short_lines():
    """Pairs just similar enough meet as often as independent permutations promise, however few their shingles."""
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x9000)]
    bands, rows = line_dedup.BANDS, line_dedup.ROWS
    assert 1 - (1 - 0.8 ** rows) ** bands >= line_dedup.RECALL
    for shared, own in ((8, 1), (9, 1), (16, 2)):
        pairs = []
        for _ in range(4000):  # the last letters differ, so that the last shingles do
            line = "".join(rng.sample(letters, shared + own + line_dedup.SHINGLE - 1))
            pairs += [line, line[:len(line) - own] + "".join(rng.sample(letters, own))]
        sets = [chars(x) for x in pairs[:2]]
        assert len(sets[0] & sets[1]) == shared and len(sets[0]) == shared + own
        hashes = line_dedup.band_hashes(line_dedup.lowest(pairs, bands * rows), bands, rows)
        missed = int((~(hashes[:, ::2] == hashes[:, 1::2]).any(axis=0)).sum())
        assert missed <= 10, (shared, own, missed)  # 2 are expected at 0.9995


def test_rows_without_id_or_with_one_id_lose_only_their_own_lines(spark):
    rows = [(1, "the first line of all the texts"),
            (None, "the first line of all the texts\nonly the second row holds this one"),
            (None, "only the third row starts with this\nthe first line of all the texts"),
            (2, "the first line of all the texts\nwritten in one text under the number two"),
            (2, "another text under the number two begins\nthe first line of all the texts"),
            (None, "no other row\nis like this")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id or 0), r.text) for r in line_dedup.deduplicated(frame).collect())
    first = rows[0][1]
    assert got == sorted(((i or 0), "\n".join(x for x in t.split("\n") if i == 1 or x != first)) for i, t in rows)


def test_one_line_of_rows_without_id_stays_once(spark):
    frame = spark.createDataFrame([(None, f"a line that two rows hold\nbut this is row {'abc' * k} alone {k}")
                                   for k in (1, 9)], "doc_id bigint, text string")
    left = [r.text for r in line_dedup.deduplicated(frame).collect()]
    assert len(left) == 2 and sum("two rows" in t for t in left) == 1


def test_different_lines_with_one_hash_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    plain = line_dedup.lines_of
    monkeypatch.setattr(line_dedup, "lines_of", lambda docs: plain(docs).withColumn(
        "id", F.when(F.col("line").startswith("first"), F.lit(7)).otherwise(F.col("id"))))
    texts = ["first of all a line about rivers", "first of all, but this one is about mountains",
             "first of all a line about rivers\nand another line", "first things that nobody says twice"]
    got = {r.doc_id: list(r.removed) for r in line_dedup.repeats(H.docs_frame(spark, texts)).collect()}
    assert got == brute_removed(texts) == {2: [0]}


def test_few_bits_agree_where_sets_do():
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefghij ") for _ in range(400))
    lines = [base] + [edited(rng, edited(rng, base)) for _ in range(40)] + ["".join(rng.choice("klmnop ") for _ in range(400))]
    planes = line_dedup._planes(line_dedup.lowest(lines, 100)).view(np.uint64).reshape(line_dedup.PLANES, 2, -1)
    differ = np.bitwise_count(np.bitwise_or.reduce(planes ^ planes[:, :, :1], axis=0)).sum(axis=0)
    least = line_dedup.least_equal(100, 80)
    for k, line in enumerate(lines):
        if H.near(chars(base), chars(line)):
            assert 100 - differ[k] >= least
    assert 100 - differ[-1] < least
