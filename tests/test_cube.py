"""Measures from a stored cube against the measures of the rows."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators.sketches import DISTINCT_ERROR
from holdfast.plans import cube as C
from holdfast.plans import measures as M

BY = ["contract", "internet", "band"]


@pytest.fixture(scope="module")
def customers(spark):
    n = F.col("id")
    return spark.range(3000).select(
        F.when(n % 5 > 0, F.concat(F.lit("c"), n % 4)).alias("contract"), F.concat(F.lit("i"), n % 3).alias("internet"),
        F.concat(F.lit("b"), n % 7).alias("band"), F.when(n % 11 > 0, (n % 13 == 0).cast("int")).alias("churn_flag"),
        F.when(n % 17 > 0, n % 9000 / 100).alias("monthly_charges"), (n * 37 % 100000 / 100).alias("total_charges"),
        F.when(n % 3 > 0, n % 9999 / 10000).alias("churn_probability"),
        F.when(n % 6 > 0, n % 1000 / 10).alias("network_quality_score"), (n % 72).cast("int").alias("tenure_months"),
        F.when(n % 4 == 0, "High").otherwise("Low").alias("risk_band"), F.lit(1).alias("_p_n"))


@pytest.fixture(scope="module")
def cube(customers, tmp_path_factory):
    return C.Cube.build(customers, BY, str(tmp_path_factory.mktemp("cube") / "c"), C.customer_layer(),
                        [["contract"], ["contract", "internet"], []])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def of_rows(df, by, filters=None):
    return rows(M.evaluate(df, M.customer_measures() | M.tenure_measures(), by=by, filters=filters))


def names():
    return [*M.customer_measures(), *M.tenure_measures()]


@pytest.mark.parametrize("by, filters, source", [
    ([], None, ()),
    (["contract"], None, ("contract",)),
    (["internet"], None, ("contract", "internet")),
    (["internet"], {"contract": ["c1", "c2"], "band": None}, ("contract", "internet")),
    (["contract"], {"band": "b3"}, tuple(BY)),
    ([], {"contract": "no such"}, ("contract",)),
    (["band"], {"contract": "no such"}, tuple(BY)),
])
def test_equal_to_the_rows(cube, customers, by, filters, source):
    assert cube.source(by, filters) == source
    assert rows(cube.answer(names(), by, filters)) == of_rows(customers, by, filters)


def test_extremes(cube, customers):
    want = customers.groupBy("internet").agg(F.min("monthly_charges"), F.max("monthly_charges"))
    assert rows(cube.answer(["lowest_monthly_charges", "highest_monthly_charges"], ["internet"])) == rows(want)


def test_read_back(spark, cube, customers):
    again = C.Cube(spark, cube.root, C.customer_layer())
    assert again.tables == cube.tables
    assert rows(again.answer(names(), ["band"])) == of_rows(customers, ["band"])


def test_new_rows_are_merged(cube, customers, tmp_path):
    new = customers.where("internet = 'i1'").withColumn("contract", F.lit("new"))
    more = cube.extended(new, str(tmp_path / "more"))
    both = customers.unionByName(new)
    assert [t[0] for t in more.tables] == [t[0] for t in cube.tables]
    for by in ([], ["contract"], ["contract", "band"]):
        assert rows(more.answer(names(), by)) == of_rows(both, by)
    assert rows(cube.answer(names(), ["contract"])) == of_rows(customers, ["contract"])


def test_no_rows(customers, tmp_path):
    none = customers.limit(0)
    cube = C.Cube.build(none, BY, str(tmp_path / "c"), C.customer_layer(), [["band"]])
    assert rows(cube.answer(names(), ["band"])) == [] and rows(cube.answer(names())) == of_rows(none, [])


def test_refusals(cube, customers, tmp_path, monkeypatch):
    with pytest.raises(KeyError):
        cube.answer(["customers"], ["risk_band"])
    with pytest.raises(ValueError):
        C.Cube.build(customers, ["contract"], str(tmp_path / "a"), C.customer_layer(), [["band"]])
    with pytest.raises(FileExistsError):
        C.Cube.build(customers, BY, cube.root, C.customer_layer())
    monkeypatch.setattr(C, "MOST_CELLS", 10)
    with pytest.raises(ValueError):
        C.Cube.build(customers, BY, str(tmp_path / "b"), C.customer_layer())


def test_distinct_customers_within_the_stated_error(spark, tmp_path):
    n = F.col("id")
    monthly = spark.range(60_000).select(
        (n % 20_000).alias("customer_key"), F.concat(F.lit("2023-0"), F.floor(n / 20_000) + 1).alias("month"),
        (n % 2).cast("int").alias("churn_flag"), *[(n % 50 / 7).alias(c) for c in (
            "dropped_call_pct", "avg_latency_ms", "avg_download_mbps")],
        (n % 9).alias("outage_minutes"), (n % 3).alias("complaints"))
    cube = C.Cube.build(monthly, ["month"], str(tmp_path / "c"), C.monthly_layer())
    seen = cube.answer(["customers_seen", "customer_months"]).first()
    assert abs(seen[0] - 20_000) <= DISTINCT_ERROR * 20_000 and seen[1] == 60_000
    exact = M.evaluate(monthly, M.monthly_measures() | M.labelled_monthly_measures(), by=["month"])
    assert rows(cube.answer([*M.monthly_measures(), *M.labelled_monthly_measures()], ["month"])) == rows(exact)
