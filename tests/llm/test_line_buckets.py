"""Buckets of lines, sorted as numbers in the tasks."""

import numpy as np
from pyspark.sql import functions as F

from holdfast.llm import line_dedup


def shared(pairs):
    """Ids of each bucket that has several."""
    want = {}
    for bucket, i in pairs:
        want.setdefault(bucket, set()).add(i)
    return {b: ids for b, ids in want.items() if len(ids) > 1}


def test_buckets_with_several_ids():
    for n in (0, 1, 2, 3, 50, 400):
        rng = np.random.default_rng(n)
        buckets, ids = rng.integers(-30, 30, n), rng.integers(-9, 9, n)
        want, got = shared(zip(buckets.tolist(), ids.tolist())), {}
        rows = list(zip(*(x.tolist() for x in line_dedup.met(buckets, ids))))
        for bucket, i, least, m in rows:
            assert least in want[bucket] and m == len(want[bucket])
            got.setdefault(bucket, set()).add(i)
        assert got == want and len(rows) == sum(map(len, want.values()))


def test_members_of_lines_with_several_rows(spark):
    """A line has a row for each batch that holds it, and is one member all the same."""
    rng = np.random.default_rng(4)
    lines = {int(i): [int(x) for x in rng.integers(-2 ** 62, 2 ** 62, 3)] for i in rng.integers(-2 ** 62, 2 ** 62, 60)}
    ids = list(lines)
    for a, b in zip(ids[::3], ids[1::3]):
        lines[b][0] = lines[a][0]
    rows = [(i, lines[i]) for i in ids + ids[::2] + ids[::5]]
    signed = spark.createDataFrame([(i, np.array(bands, np.int64).tobytes()) for i, bands in rows],
                                   "id bigint, bands binary").repartition(5)
    got = line_dedup.bucket_members(signed, 3)
    want = shared((b, i) for i, bands in rows for b in bands)
    assert {r.bucket: set(r.ids) for r in got.groupBy("bucket").agg(F.collect_list("id").alias("ids")).collect()} == want
    assert got.count() == sum(map(len, want.values()))
    assert line_dedup.bucket_members(signed.limit(0), 3).count() == 0
    assert got.filter("m != 2").count() == 0
    assert got.select("bucket", "least").distinct().count() == len(want) == 20


def test_slots_keep_a_bucket_together(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "DEALT", 8)
    signed = spark.createDataFrame([(i, np.array([i % 7, -5, i - 20], np.int64).tobytes()) for i in range(40)],
                                   "id bigint, bands binary")
    rows = line_dedup.dealt(signed, 4).collect()
    pairs = [(b, i, r.slot) for r in rows for b, i in zip(r.bucket, r.id, strict=True)]
    assert len(pairs) == 120 and len({(b, s) for b, _, s in pairs}) == len({b for b, _, _ in pairs})
    assert {(b, i) for b, i, _ in pairs} == {(b, i) for i in range(40) for b in (i % 7, -5, i - 20)}


def test_lines_are_compared_without_blanks_at_their_ends(spark):
    blanks = [" ", "\t", "\x0b", "\x0c", "\r", " \t\r"]
    raw = ["Words Of A Line"] + [b + "Words Of A Line" for b in blanks] + ["Words Of A Line" + b for b in blanks]
    frame = spark.createDataFrame([(1, "\n".join(raw + blanks + [""])), (2, None), (3, ""), (4, " \n\t")],
                                  "doc_id bigint, text string")
    found = line_dedup.lines_of(frame).collect()
    assert {(r.doc_id, r.line) for r in found} == {(1, "words of a line")} and len(found) == len(raw)
