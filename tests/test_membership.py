"""Key checks by bit sets against plain grouping and joins."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import membership as M

KEY = "a int, b bigint"


def plain_repeated(rows, width=2):
    seen = {}
    for r in rows:
        seen[r[:width]] = seen.get(r[:width], 0) + 1
    return {k: n for k, n in seen.items() if n > 1}


def found(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


CASES = {
    "empty": [],
    "one": [(1, 1)],
    "nulls are equal": [(None, 1), (None, 1), (1, None), (None, None), (None, None), (1, 1)],
    "negative": [(-5, 7), (-5, 7), (5, -7), (2, 0)],
    "all equal": [(3, 3)] * 50,
    "far apart": [(1, -(1 << 62)), (1, 1 << 62), (1, 1 << 62)],
    "widest": [(-(1 << 31), -(1 << 63)), ((1 << 31) - 1, (1 << 63) - 1), (0, (1 << 63) - 1), (0, (1 << 63) - 1)],
    "many": [(i % 700, i // 900) for i in range(3000)],
}


@pytest.mark.parametrize("case", CASES)
def test_repeated_keys(spark, case):
    df = spark.createDataFrame(CASES[case], KEY).withColumn("_set", F.lit("x")).withColumn("_at", F.lit(1))
    assert found(M.repeated_keys(df, ["a", "b"])) == plain_repeated(CASES[case])
    extra = sum(n - 1 for n in plain_repeated(CASES[case]).values())
    assert M.duplicate_rows(df, ["a", "b"]).first()[0] == extra


@pytest.mark.parametrize("case", CASES)
def test_orphans(spark, case):
    rows = CASES[case]
    known = [r for i, r in enumerate(rows) if i % 3] + [(99, 99), (None, 5)]
    child, parent = spark.createDataFrame(rows, KEY), spark.createDataFrame(known, KEY)
    there = {r for r in known if None not in r}
    want = {}
    for r in rows:
        if r not in there:
            want[r] = want.get(r, 0) + 1
    assert found(M.orphan_keys(child, parent, ["a", "b"])) == want
    assert M.orphan_rows(child, parent, ["a", "b"]).first()[0] == sum(want.values())


def test_without_a_parent_row_all_are_orphans(spark):
    child = spark.range(100).select(F.col("id").alias("k"))
    assert M.orphan_rows(child, child.where("k < 0"), ["k"]).first()[0] == 100
    assert M.orphan_rows(child.where("k < 0"), child, ["k"]).first()[0] == 0


def test_only_sets_in_doubt_are_shuffled(spark):
    df = spark.range(0, 1_000_000, 1, 4).select(F.col("id").alias("k"))
    again = df.unionByName(df.where("k = 700000"))
    box = M.measure([again], ["k"])
    doubt = M._of_sets(again, box, M.bit_sets(again, box).where("_rows > bitmap_count(_bits)"))
    assert doubt.count() <= M.BITS + 1
    assert found(M.repeated_keys(again, ["k"])) == {(700_000,): 2}
    rows = M._suspects(again, df.where("k <> 123456"), ["k"], box)
    assert rows.count() <= M.BITS + 1
    assert found(M.orphan_keys(again, df.where("k <> 123456"), ["k"])) == {(123_456,): 1}


def test_scattered_keys_are_grouped(spark):
    df = spark.range(0, 200_000, 1, 4).select((F.xxhash64("id") % 1_000_000_007).alias("k"))
    assert M.measure([df], ["k"]) is None
    both = df.unionByName(df)
    assert M.duplicate_rows(both, ["k"]).first()[0] == 400_000 - df.distinct().count()


def test_text_keys_are_grouped(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert M.measure([df], ["k"]) is None
    assert found(M.repeated_keys(df, ["k"])) == {("a",): 2, (None,): 2}
    assert found(M.orphan_keys(df, df.where("k = 'a'"), ["k"])) == {(None,): 2, ("b",): 1}
