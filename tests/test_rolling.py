"""Window aggregates kept up to date against one whole run."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators import telemetry as T
from holdfast.operators.rolling import MOST_MONTHS, RollingTelemetry

IDS = [f"K-{i}" for i in range(40)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def uneven(kpi_frame, months=12):
    """Customers who begin late, miss months, or send NULL readings."""
    i, n = F.col("month_index"), F.substring("customer_id", 3, 9).cast("int")
    return (kpi_frame(IDS, months).where((i > n % 5) & ((i + n) % 7 != 0))
            .withColumn("avg_latency_ms", F.when((n + i) % 4 != 0, F.col("avg_latency_ms") + n / 7))
            .withColumn("complaints", F.when(n % 3 != 0, F.col("complaints"))))


@pytest.fixture
def feed(kpi_frame):
    return uneven(kpi_frame)


def test_monthly_loads_equal_one_run(feed, tmp_path):
    state = RollingTelemetry.create(feed.where("month_index = 1"), str(tmp_path / "s"), buckets=4)
    for i in (3, 2, *range(4, 13)):  # one month comes late
        state.load(feed.where(F.col("month_index") == i))
    whole = T.raw_aggregates(feed)
    got = state.read()
    assert got.columns == whole.columns and got.dtypes == whole.dtypes
    assert rows(got) == rows(whole)
    assert rows(T.round_means(T.add_trends(got))) == rows(T.telemetry_aggregates(feed))


def test_repeated_load_writes_nothing(feed, tmp_path):
    state = RollingTelemetry.create(feed, str(tmp_path / "s"), buckets=4)
    before = state.table.versions()
    assert state.load(feed.where("month_index = 12")) == [] and state.load(feed.limit(0)) == []
    assert state.table.versions() == before


def test_sent_again_replaces(feed, tmp_path):
    state = RollingTelemetry.create(feed.withColumn("avg_latency_ms", F.lit(1.0)), str(tmp_path / "s"), buckets=3)
    state.load(feed)
    assert rows(state.read()) == rows(T.raw_aggregates(feed))


def test_only_buckets_of_the_load_are_written(feed, tmp_path):
    state = RollingTelemetry.create(feed.where("month_index < 12"), str(tmp_path / "s"), buckets=16)
    assert len(state.load(feed.where("month_index = 12 and customer_id = 'K-8'"))) == 1


def test_customers_that_are_new(feed, tmp_path):
    few = F.col("customer_id").isin("K-1", "K-2")
    state = RollingTelemetry.create(feed.where(few), str(tmp_path / "s"), buckets=16)
    state.load(feed.where(~few))
    assert rows(state.read()) == rows(T.raw_aggregates(feed))


def test_months_leave_the_window(kpi_frame, tmp_path):
    feed = uneven(kpi_frame)
    state = RollingTelemetry.create(feed.where("month_index <= 4"), str(tmp_path / "s"), 6, 4)
    for lo in (5, 8, 11):
        state.load(feed.where(F.col("month_index").between(lo, lo + 2)))
    last = feed.where("month_index > 6").withColumn("month_index", F.col("month_index") - 6)
    assert rows(state.read(recent=2)) == rows(T.raw_aggregates(last, 6, 2))
    assert state.table.read().agg(F.max(F.size("months"))).first()[0] <= 6


def test_a_month_older_than_the_window_changes_nothing(kpi_frame, tmp_path):
    feed = kpi_frame(["K-1"])
    state = RollingTelemetry.create(feed.where("month_index > 6"), str(tmp_path / "s"), 6, 2)
    assert state.load(feed.where("month_index <= 6")) == []


def test_null_keys_extra_columns_and_copies(kpi_frame, tmp_path):
    feed = kpi_frame(["K-1", "K-2"])
    odd = (feed.unionByName(feed.where("month_index = 3"))
           .unionByName(feed.withColumn("customer_id", F.lit(None).cast("string")))
           .unionByName(feed.withColumn("month", F.lit(None).cast("string")))
           .withColumns({"months": F.lit(1), "_new": F.lit(2), "_at": F.lit(3), "_rows": F.lit("x"), "changed": F.lit(True)}))
    state = RollingTelemetry.create(odd.limit(0), str(tmp_path / "s"), buckets=2)
    assert rows(state.read()) == []
    state.load(odd)
    assert rows(state.read()) == rows(T.raw_aggregates(feed.unionByName(feed.where("month_index = 3"))))


def test_fractions_of_minutes(kpi_frame, tmp_path):
    feed = kpi_frame(IDS[:5]).withColumn("outage_minutes", F.col("outage_minutes") + 0.1)
    state = RollingTelemetry.create(feed.where("month_index < 5"), str(tmp_path / "s"), buckets=2)
    state.load(feed.where("month_index >= 5"))
    got = rows(state.read(whole=False).select("customer_id", "total_outage_minutes", "l3m_outage_minutes"))
    assert got == rows(T.raw_aggregates(feed).select("customer_id", "total_outage_minutes", "l3m_outage_minutes"))


def test_reading_does_not_shuffle_the_customers(feed, tmp_path):
    state = RollingTelemetry.create(feed, str(tmp_path / "s"), buckets=4)
    plan = state.read(last=2023 * 12 + 12)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_too_long_a_window_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        RollingTelemetry(spark, str(tmp_path / "s"), MOST_MONTHS + 1)
