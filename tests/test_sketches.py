"""Profiles from sketches per file: against the exact profile, and without reading a file twice."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import profiling as P
from holdfast.operators import sketches as S


@pytest.fixture(scope="module")
def rows(spark):
    # "word" is one value in a third of the rows, "id" is unique, "gap" is mostly NULL, "none" has no value
    return spark.range(60_000).select(
        "id", (F.pow(F.rand(5), 3) * 1000).alias("amount"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 2000).cast("string"))).alias("word"),
        F.when(F.col("id") % 50 == 0, F.col("id") % 7).alias("gap"), F.lit(None).cast("string").alias("none"),
        F.lit(None).cast("double").alias("empty"), (F.col("id") % 2 == 0).alias("odd name`s"))


def write(df, path, files):
    df.repartition(files).write.mode("append").parquet(path)


def test_estimates_lie_within_their_bounds(spark, rows, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "s")
    write(rows, path, 5)
    table = spark.read.parquet(path)
    assert S.refresh(table, store) == 5
    exact = {r["column"]: r for r in P.profile(table.select("id", "amount", "word", "gap")).collect()}
    got = {r["column"]: r for r in S.stored_profile(table, store).collect()}
    assert set(got) == set(rows.columns)
    for c, x in exact.items():
        g = got[c]
        assert g.rows == 60_000 and g.non_null == x.non_null
        assert abs(g["distinct"] - x["distinct"]) <= max(1, x["distinct"] * S.DISTINCT_ERROR)
        assert (g.top, g.freq) == (x.top, x.freq)
        if c != "word":
            assert (g.min, g.max) == (x.min, x.max)
            assert g.mean == pytest.approx(x.mean) and g.std == pytest.approx(x.std)
            values = sorted(r[0] for r in table.select(c).where(f"{c} is not null").collect())
            for q, p in S.QUARTILES.items():
                below, upto = sum(v < g[q] for v in values), sum(v <= g[q] for v in values)
                assert below <= (p + S.RANK_ERROR) * len(values) and upto >= (p - S.RANK_ERROR) * len(values)
    for c in ("none", "empty"):
        assert got[c].non_null == 0 and got[c]["distinct"] == 0
        assert [got[c][k] for k in ("top", "freq", "mean", "std", "min", "q1", "median", "q3", "max")] == [None] * 9
    assert got["odd name`s"].mean == 0.5 and got["odd name`s"]["distinct"] == 2


def test_only_new_files_are_read(spark, rows, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "s")
    write(rows.where("id < 30000"), path, 3)
    assert S.refresh(spark.read.parquet(path), store) == 3
    write(rows.where("id >= 30000"), path, 2)
    whole = spark.read.parquet(path)
    assert S.refresh(whole, store) == 2 and S.refresh(whole, store) == 0
    assert spark.read.parquet(store).select("file").distinct().count() == 5
    late = {r["column"]: r for r in S.stored_profile(whole, store).collect()}
    once = {r["column"]: r for r in S.merged(S.sketch_by(whole, F.lit("all"))).collect()}
    for c in ("id", "amount", "word"):
        assert late[c].rows == once[c].rows == 60_000 and late[c].freq == once[c].freq
        assert late[c].std == (None if c == "word" else pytest.approx(once[c].std))
    # a file that is gone no longer counts
    some = spark.read.parquet(*whole.inputFiles()[:4])
    assert S.stored_profile(some, store).first().rows == some.count()


def test_one_scan_and_no_rows_per_cell(rows):
    plan = S.sketch_by(rows, F.lit("all"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Generate") == 1  # the one behind the aggregate
    assert plan.index("Generate") < plan.index("Aggregate")


def test_empty_table(spark, rows, tmp_path):
    assert S.merged(S.sketch_by(rows.limit(0), F.lit("all"))).count() == 0
