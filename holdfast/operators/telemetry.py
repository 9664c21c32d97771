"""Features derived from customer-month telemetry, and gap detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import (mean_skip_null, minmax_score, ratio, read_avg, read_sum,
                                        right_closed_band, round_even)
from holdfast.operators.joins import join_small
from holdfast.operators.ordering import exact_quantiles
from holdfast.session import cut

def raw_aggregates(kpis: DataFrame, window: int = K.WINDOW_MONTHS,
                   recent: int = K.RECENT_MONTHS) -> DataFrame:
    """Whole-window and recent-window aggregates in one pass, means not yet rounded.

    A customer without recent rows gets NULL recent sums; one whose recent values
    are all NULL gets 0. Counts stay whole numbers if the feed has whole numbers.
    """
    whole = {c for c, t in kpis.dtypes if t in ("tinyint", "smallint", "int", "bigint")}
    late = F.col("month_index") > window - recent

    def mean(c: str) -> Column:
        return read_avg(c)

    def late_mean(c: str) -> Column:
        return read_avg(F.when(late, F.col(c)))

    def _sum(c: str, value: Column) -> Column:
        return F.coalesce(F.sum(value).cast("bigint") if c in whole else read_sum(value), F.lit(0))

    def total(c: str) -> Column:
        return _sum(c, F.col(c))

    def late_total(c: str) -> Column:
        return F.when(F.count(F.when(late, 1)) > 0, _sum(c, F.when(late, F.col(c))))

    return kpis.groupBy("customer_id").agg(
        F.count("month_index").alias("kpi_months"),
        mean("dropped_call_pct").alias("avg_dropped_call_pct"),
        mean("avg_download_mbps").alias("avg_download_mbps"),
        mean("avg_latency_ms").alias("avg_latency_ms"),
        total("outage_minutes").alias("total_outage_minutes"),
        mean("data_usage_gb").alias("avg_data_usage_gb"),
        total("complaints").alias("network_complaints"),
        late_mean("dropped_call_pct").alias("l3m_dropped_call_pct"),
        late_mean("avg_download_mbps").alias("l3m_download_mbps"),
        late_mean("avg_latency_ms").alias("l3m_latency_ms"),
        late_total("outage_minutes").alias("l3m_outage_minutes"),
        late_total("complaints").alias("l3m_complaints"))


def add_trends(agg: DataFrame) -> DataFrame:
    """Recent window against the whole window, from unrounded means."""
    def change(recent: str, whole: str) -> Column:
        return round_even((ratio(F.col(recent), F.col(whole)) - 1) * 100, 1)

    return agg.select(
        "*",
        round_even(F.col("l3m_dropped_call_pct") - F.col("avg_dropped_call_pct"), 3).alias(
            "dropped_call_trend_pp"),
        change("l3m_latency_ms", "avg_latency_ms").alias("latency_trend_pct"),
        change("l3m_download_mbps", "avg_download_mbps").alias("download_trend_pct"))


def round_means(agg: DataFrame) -> DataFrame:
    means = {"avg_dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "avg_data_usage_gb",
             "l3m_dropped_call_pct", "l3m_download_mbps", "l3m_latency_ms"}
    return agg.select(*[round_even(c, 2).alias(c) if c in means else F.col(c)
                        for c in agg.columns])


def telemetry_aggregates(kpis: DataFrame, window: int = K.WINDOW_MONTHS,
                         recent: int = K.RECENT_MONTHS) -> DataFrame:
    return round_means(add_trends(raw_aggregates(kpis, window, recent)))


def attach_telemetry(customers: DataFrame, agg: DataFrame) -> DataFrame:
    """Left join; only the month and complaint counts are filled with 0."""
    out = customers.join(agg, "customer_id", "left")
    filled = {"kpi_months", "network_complaints"}
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in filled else F.col(c)
                        for c in out.columns])


def coverage(customers: DataFrame, kpis: DataFrame) -> DataFrame:
    """Share of customers with telemetry."""
    seen = kpis.select("customer_id").distinct().withColumn("_seen", F.lit(1))
    return customers.join(seen, "customer_id", "left").agg(
        F.count("*").alias("customers"), F.count("_seen").alias("with_telemetry"),
        (100.0 * F.count("_seen").cast("double") / F.nullif(F.count("*").cast("double"), F.lit(0.0)))
        .alias("coverage_pct"))


def peer_medians(df: DataFrame, peer: str | None, metrics: list[str]) -> DataFrame:
    """Exact median of each metric per peer group, one row per group.

    All metrics go through one histogram pass; no group is handled by one task.
    """
    group = F.col(peer) if peer else F.lit("All")
    cells = df.select(group.alias("peer"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics
    ])).alias("cell")).select("peer", "cell.metric", "cell.v")
    med = exact_quantiles(cells.where(F.col("peer").isNotNull()), "v", {"median": 0.5},
                          by=["peer", "metric"])
    return med.groupBy("peer").agg(*[
        F.max(F.when(F.col("metric") == m, F.col("median"))).alias(f"median_{m}")
        for m in metrics])


def peer_ratios(df: DataFrame, peer: str | None = "internet_service") -> DataFrame:
    """Latency and speed relative to the median of the customer's own technology."""
    if peer is not None and peer not in df.columns:
        peer = None
    med = peer_medians(df, peer, ["avg_latency_ms", "avg_download_mbps"])
    keyed = df.withColumn("peer", F.col(peer) if peer else F.lit("All"))
    joined = join_small(keyed, med, ["peer"], "left")
    return joined.select(
        *df.columns,
        ratio(F.col("avg_latency_ms"), F.col("median_avg_latency_ms")).alias("latency_ratio"),
        ratio(F.col("avg_download_mbps"), F.col("median_avg_download_mbps")).alias("speed_ratio"))


def quality_score(components: dict[str, tuple[float, float, bool]] = K.QUALITY_COMPONENTS,
                  ) -> Column:
    """Mean of the bounded components a customer has, on a 0-100 scale."""
    parts = [minmax_score(F.col(c).cast("double"), lo, hi, up)
             for c, (lo, hi, up) in components.items()]
    return round_even(mean_skip_null(parts) * 100, 1)


def add_quality(df: DataFrame, peer: str | None = "internet_service",
                components: dict[str, tuple[float, float, bool]] = K.QUALITY_COMPONENTS,
                ) -> DataFrame:
    """0-100 score and band; customers without telemetry get NULL and their own band."""
    scored = peer_ratios(df, peer).withColumn("network_quality_score", quality_score(components))
    silent = F.coalesce(F.col("kpi_months"), F.lit(0)) == 0
    return scored.select(
        *df.columns,
        F.when(~silent, F.col("network_quality_score")).alias("network_quality_score"),
        F.when(silent, K.NO_TELEMETRY).otherwise(
            right_closed_band("network_quality_score", K.QUALITY_BANDS, -0.1)).alias(
            "network_quality_band"))


def telemetry_features(customers: DataFrame, kpis: DataFrame | None,
                       window: int = K.WINDOW_MONTHS, recent: int = K.RECENT_MONTHS) -> DataFrame:
    """Telemetry is optional: without it the customer frame comes back unchanged.

    Peer medians and the final frame both need the aggregates, so these are fixed
    once and the telemetry is read and shuffled a single time.
    """
    if kpis is None or kpis.isEmpty():
        return customers
    return add_quality(attach_telemetry(customers, cut(telemetry_aggregates(kpis, window, recent))))


def month_spine(customers: DataFrame, window: int = K.WINDOW_MONTHS) -> DataFrame:
    """One row per customer and active month index: the latest clip(tenure, 1, window) months."""
    active = F.least(F.greatest(F.col("tenure_months"), F.lit(1)), F.lit(window))
    return customers.select("customer_id", F.explode(
        F.sequence(F.lit(window) - active + 1, F.lit(window))).alias("month_index"))


def missing_months(customers: DataFrame, kpis: DataFrame,
                   window: int = K.WINDOW_MONTHS) -> DataFrame:
    """Months a customer was active but sent no telemetry."""
    seen = kpis.select("customer_id", "month_index").distinct()
    return month_spine(customers, window).join(seen, ["customer_id", "month_index"], "left_anti")
