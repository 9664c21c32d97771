import pytest
from pyspark.sql import functions as F

from holdfast.functions.columns import inclusive_bucket, round_even, round_up
from holdfast import contract as K
from holdfast.operators.cleaning import conform
from holdfast.operators.customer_features import customer_features, quartile_band
from holdfast.operators.telemetry import (add_quality, missing_months, month_spine, raw_aggregates,
                                          telemetry_features)


@pytest.fixture(scope="module")
def clean(raw_frame):
    return conform(raw_frame())


def by_id(df):
    return {r["customer_id"]: r for r in df.collect()}


def test_tenure_buckets(spark):
    df = spark.createDataFrame([(m,) for m in (-1, 0, 12, 13, 72, 90)], "m int")
    got = [r[0] for r in df.select(inclusive_bucket("m", K.TENURE_BUCKETS)).collect()]
    assert got == ["00-12 months", "00-12 months", "00-12 months", "13-24 months",
                   "49-72 months", "49-72 months"]


def test_customer_features(clean):
    f = by_id(customer_features(clean))
    assert f["K-17"]["num_addon_services"] == 4 and f["K-58"]["num_addon_services"] == 0
    assert f["K-58"]["has_internet"] == 0 and f["K-58"]["is_auto_payment"] == 1
    assert f["K-17"]["is_auto_payment"] == 0 and f["K-23"]["is_month_to_month"] == 1
    assert f["K-58"]["lifetime_avg_monthly"] == 19.65 and f["K-58"]["charge_ratio"] == 0.992
    assert f["K-23"]["lifetime_avg_monthly"] == 54.35


def test_equal_quartile_edges_give_one_band(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (9.0,)], "x double")
    assert {r["band"] for r in quartile_band(df, "x", "band").collect()} == {"Mid"}


def test_quartile_bands_are_right_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 6)] + [(None,)], "x double")
    got = {r["x"]: r["band"] for r in quartile_band(df, "x", "band").collect()}
    assert got == {1.0: "Low", 2.0: "Low", 3.0: "Mid", 4.0: "High", 5.0: "Premium", None: None}


def test_telemetry_aggregates_and_score(clean, kpi_frame):
    f = by_id(telemetry_features(customer_features(clean), kpi_frame(["K-17", "K-58"])))
    a, b = f["K-17"], f["K-23"]
    assert a["kpi_months"] == 12 and b["kpi_months"] == 0 and len(a) == 49
    assert (a["avg_dropped_call_pct"], a["l3m_dropped_call_pct"]) == (1.71, 1.44)
    assert a["dropped_call_trend_pp"] == -0.27 and a["latency_trend_pct"] == 13.6
    assert a["download_trend_pct"] == -5.4 and a["avg_latency_ms"] == 49.75
    assert (a["total_outage_minutes"], a["l3m_outage_minutes"]) == (42, 22)
    assert (a["network_complaints"], a["l3m_complaints"]) == (3, 0)
    assert b["network_quality_band"] == "No telemetry" and b["network_quality_score"] is None
    assert b["network_complaints"] == 0 and b["total_outage_minutes"] is None
    assert 0 <= a["network_quality_score"] <= 100
    assert a["network_quality_band"] in {"Poor", "Fair", "Good", "Excellent"}


def test_without_telemetry_nothing_is_added(clean, kpi_frame):
    feats = customer_features(clean)
    assert telemetry_features(feats, None).columns == feats.columns
    assert telemetry_features(feats, kpi_frame([])).columns == feats.columns


def test_null_zero_and_absent_recent_values(spark):
    rows = [("old", 1, None), ("nulls", 12, None), ("mixed", 11, 4), ("mixed", 12, None)]
    kpis = spark.createDataFrame(rows, "customer_id string, month_index int, outage_minutes int") \
        .withColumns({c: F.lit(None).cast("double") for c in (
            "dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "data_usage_gb")}) \
        .withColumn("complaints", F.lit(0))
    got = {r["customer_id"]: (r["total_outage_minutes"], r["l3m_outage_minutes"])
           for r in raw_aggregates(kpis).collect()}
    assert got == {"old": (0, None), "nulls": (0, 0), "mixed": (4, 4)}


def test_fractions_of_minutes_and_fine_readings_count(spark):
    rows = [("a", 11, 0.9, 0.123456), ("a", 12, 0.9, 0.1), ("b", 1, 0.25, None)]
    kpis = spark.createDataFrame(rows, "customer_id string, month_index int, outage_minutes double, "
                                       "dropped_call_pct double").withColumns(
        {c: F.lit(None).cast("double") for c in ("avg_download_mbps", "avg_latency_ms", "data_usage_gb")}) \
        .withColumn("complaints", F.lit(0))
    got = by_id(raw_aggregates(kpis))
    assert got["a"]["total_outage_minutes"] == got["a"]["l3m_outage_minutes"] == 1.8
    assert got["a"]["avg_dropped_call_pct"] == 0.111728 and got["b"]["avg_dropped_call_pct"] is None
    assert got["b"]["total_outage_minutes"] == 0.25 and got["b"]["l3m_outage_minutes"] is None


def test_score_without_peer_column_uses_one_group(spark, kpi_frame):
    base = spark.createDataFrame([("a",), ("b",)], "customer_id string")
    scored = telemetry_features(base, kpi_frame(["a"])).collect()
    assert {r["customer_id"]: r["network_quality_band"] for r in scored}["b"] == "No telemetry"


def test_month_spine_and_gaps(spark, kpi_frame):
    customers = spark.createDataFrame([("a", 0), ("b", 3), ("c", 90)],
                                      "customer_id string, tenure_months int")
    counts = {r["customer_id"]: r["count"] for r in month_spine(customers).groupBy(
        "customer_id").count().collect()}
    assert counts == {"a": 1, "b": 3, "c": 12}
    kpis = kpi_frame(["b", "c"]).where("month_index <> 11")
    gaps = {tuple(r) for r in missing_months(customers, kpis).collect()}
    assert gaps == {("a", 12), ("b", 11), ("c", 11)}


def test_rounding_rules(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(round_even("x", 0)).collect()] == [0.0, 2.0, 2.0, -2.0]
    assert [r[0] for r in df.select(round_up("x", 0)).collect()] == [1.0, 2.0, 3.0, -2.0]


def test_large_group_size_does_not_change_the_median(spark):
    """Half of all rows share one peer group and one value."""
    df = spark.range(4000).selectExpr(
        "cast(id as string) as customer_id", "if(id % 2 = 0, 'hot', cast(id % 7 as string)) as tech",
        "if(id % 4 = 0, 5.0D, cast(id % 100 as double)) as avg_latency_ms",
        "1.0D as avg_download_mbps", "0.0D as avg_dropped_call_pct", "0L as total_outage_minutes",
        "0L as network_complaints", "1L as kpi_months")
    want = {r["tech"]: r["m"] for r in df.groupBy("tech").agg(
        F.median("avg_latency_ms").alias("m")).collect()}
    from holdfast.operators.telemetry import peer_medians
    got = {r["peer"]: r["median_avg_latency_ms"]
           for r in peer_medians(df, "tech", ["avg_latency_ms"]).collect()}
    assert got == want
    assert add_quality(df, "tech").count() == 4000
