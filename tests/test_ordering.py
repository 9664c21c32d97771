import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.operators import ordering as O

PATHS = [pytest.param(10**9, id="small"), pytest.param(0, id="distributed")]


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Keep all range partitions, so that the distributed path really has several slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one value; some values are NULL."""
    return spark.range(3001).selectExpr(
        "id", "if(id % 3 = 0, 7, if(id % 11 = 0, null, cast(pmod(hash(id), 500) as int))) as v",
        "id % 5 as g").repartition(6)


@pytest.mark.parametrize("small", PATHS)
def test_global_rank_equals_row_number(rows, small):
    order = [F.col("v").asc_nulls_last(), F.col("id").desc()]
    got = O.global_rank(rows, order, "r", "n", small_rows=small)
    want = rows.withColumn("w", F.row_number().over(W.orderBy(*order)))
    assert got.join(want, "id").where("r <> w").count() == 0
    assert {r["n"] for r in got.select("n").distinct().collect()} == {3001}


@pytest.mark.parametrize("small", PATHS)
def test_running_totals(rows, small):
    df = rows.select("id", F.coalesce("v", F.lit(0)).cast("bigint").alias("v"))
    got = O.running_totals(df, ["id"], {"v": "upto"}, small_rows=small)
    want = df.withColumn("w", F.sum("v").over(W.orderBy("id").rowsBetween(W.unboundedPreceding, 0)))
    assert got.count() == 3001
    assert got.join(want, "id").where("upto <> w").count() == 0


@pytest.mark.parametrize("small", PATHS)
def test_quantiles_equal_percentile(rows, small):
    probs = {"lo": 0.0, "q": 0.3, "m": 0.5, "hi": 1.0}
    for by in ([], ["g"]):
        got = O.exact_quantiles(rows, "v", probs, by, small_rows=small)
        want = rows.groupBy(*by).agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_hot_value_is_spread_over_slices(rows):
    """Ordering by the value and a tie-break must not leave the hot value in one slice."""
    laid = O._sliced(rows, ["v", "id"])
    assert laid.where("v = 7").select("_slice").distinct().count() > 1


def test_slices_follow_the_rows_and_not_the_shuffle_partitions(spark, rows):
    """The driver samples sort keys for each slice: with many shuffle partitions, few rows still make few slices."""
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        laid = O._sliced(rows, ["v", "id"])
        assert 1 < laid.select("_slice").distinct().count() <= 8
        got = O.global_rank(rows, [F.col("v").desc(), "id"], "r", small_rows=0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    want = rows.withColumn("w", F.row_number().over(W.orderBy(F.col("v").desc(), "id")))
    assert got.join(want, "id").where("r = w").count() == 3001


@pytest.mark.parametrize("n,k", [(15, 10), (10, 10), (3, 10), (101, 7), (1, 4)])
def test_ntile_and_position_tiles(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
    got = df.select("r", O.ntile_of(F.col("r"), F.col("n"), k).alias("t"),
                    O.position_tile_of(F.col("r"), F.col("n"), k).alias("p"),
                    F.ntile(k).over(W.orderBy("r")).alias("w")).collect()
    assert all(r["t"] == r["w"] for r in got)
    assert [r["p"] for r in got] == [(r["r"] - 1) * k // n + 1 for r in got]


def test_average_rank(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.5,)], "p double")
    got = {r["p"]: r["rank"] for r in O.average_rank(df, "p", "rank").collect()}
    assert got == {0.1: 1.0, 0.2: 2.5, 0.5: 4.0}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_quantile_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    a = O.exact_quantiles(df, "v", {"q": 0.25, "m": 0.5}, small_rows=0).first()
    b = df.agg(F.percentile("v", 0.25).alias("q"), F.percentile("v", 0.5).alias("m")).first()
    assert (a["q"], a["m"]) == (b["q"], b["m"])


@pytest.fixture
def sliced(monkeypatch):
    """Every operator on its path for large inputs: range-sorted slices, shuffled joins."""
    from functools import partial

    from holdfast.operators import joins, star, telemetry
    rank, totals, quantiles, small = O.global_rank, O.running_totals, O.exact_quantiles, joins.join_small

    def use():
        for module in (O, star):
            monkeypatch.setattr(module, "global_rank", partial(rank, small_rows=0))
        monkeypatch.setattr(O, "running_totals", partial(totals, small_rows=0))
        for module in (O, telemetry):
            monkeypatch.setattr(module, "exact_quantiles", partial(quantiles, small_rows=0))
        for module in (O, star, telemetry):
            monkeypatch.setattr(module, "join_small", partial(small, max_rows=0))
    return use


def test_large_path_equals_small_path(spark, sliced):
    from holdfast.operators import evaluation as E
    from holdfast.operators.star import surrogate_dim
    from holdfast.operators.telemetry import peer_ratios
    df = spark.range(300).selectExpr("id", "cast(id * 7 % 11 as double) as v", "if(id % 3 = 0, 'hot', 'x') as g",
                                     "cast(id % 5 = 0 as int) as y", "id * 13 % 17 / 17.0D as p",
                                     "cast(id % 23 as double) as avg_latency_ms",
                                     "cast(id % 29 as double) as avg_download_mbps")

    def results():
        return [sorted(map(tuple, d.collect())) for d in (
            O.position_tiles(df.select("id", "v"), ["v", "id"], 7, "t"), O.ntile(df.select("id"), ["id"], 7, "t"),
            O.average_rank(df, "v", "r"), surrogate_dim(df, ["g", "v"], "k"),
            O.exact_quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.93}, ["g"]),
            E.decile_lift(df, "y", "p", "id"), E.roc_points(df, "y", "p").fillna(-1.0), E.roc_auc(df, "y", "p"),
            peer_ratios(df, "g").select("id", "latency_ratio", "speed_ratio").fillna(-1.0))]

    small = results()
    sliced()
    assert results() == small


def quantile_case(spark):
    rows = [(g, v) for g in ("a", "b", None) for v in (
        [0.5] * 700 + [((k * 7919) % 1000) / 7 for k in range(500)] + [None] * 5 + [-1e9, 1e9])] + [("c", 2.0), ("d", None)]
    return spark.createDataFrame(rows, "g string, v double")


def test_quantiles_by_narrowing_equal_percentile(spark):
    probs = {"p0": 0.0, "p01": 0.01, "p25": 0.25, "p50": 0.5, "p77": 0.777, "p999": 0.999, "p100": 1.0}
    df = quantile_case(spark)
    for by in ([], ["g"]):
        want = df.where("v is not null").groupBy(*by).agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
        got = O.exact_quantiles(df, "v", probs, by, small_rows=0)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    plain, slacks = O._neighbours, []

    def narrow(fixed, probs, by, accuracy, slack):
        slacks.append(slack)
        return plain(fixed, [p for p in probs], by, accuracy, slack) if len(slacks) > 1 else plain(
            fixed, probs, by, accuracy, slack).withColumn("_lo", F.lit(None).cast("double"))

    monkeypatch.setattr(O, "_neighbours", narrow)
    df = quantile_case(spark)
    got = O.exact_quantiles(df, "v", {"m": 0.5}, small_rows=0).first()["m"]
    assert got == df.agg(F.percentile("v", 0.5)).first()[0] and len(slacks) == 2 and slacks[1] > slacks[0]


def test_narrowing_does_not_sort_the_table(spark):
    df = spark.range(300_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v"))
    fixed = O.cut(df.withColumnRenamed("v", "_v"))
    few = O._neighbours(fixed, [0.5], [], 10_000, 2 / 10_000)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    got = O.exact_quantiles(df, "v", {"m": 0.5, "q": 0.9}, small_rows=1000).first()
    assert tuple(got) == tuple(df.agg(F.percentile("v", 0.5), F.percentile("v", 0.9)).first())
