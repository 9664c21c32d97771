"""F: feature engineering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import _late_avg, _late_sum, ravg, rhe
from holdfast.functions.columns import minmax_score, round_even
from holdfast.operators import customer_features as CF
from holdfast.operators import rolling
from holdfast.operators import telemetry as T

services = ["num_addon_services", "has_internet", "has_phone", "has_streaming",
            "is_month_to_month"]

add("f01_tenure_bucket", lambda s: CF.service_features(s.m.customers).select(
    "customer_id", "tenure_months", "tenure_bucket"),
    "SELECT customer_id, tenure_months, tenure_bucket FROM service_feat")
add("f02_addon_count", lambda s: CF.service_features(s.m.customers).select(
    "customer_id", "num_addon_services"),
    "SELECT customer_id, num_addon_services FROM service_feat")
add("f03_service_flags", lambda s: CF.service_features(s.m.customers).select(
    "customer_id", *services[1:]),
    f"SELECT customer_id, {', '.join(services[1:])} FROM service_feat")
add("f04_auto_payment", lambda s: CF.service_features(s.m.customers).select(
    "customer_id", "payment_method", "is_auto_payment"),
    "SELECT customer_id, payment_method, is_auto_payment FROM service_feat")
add("f05_lifetime_average", lambda s: CF.billing_features(s.m.customers).select(
    "customer_id", "lifetime_avg_monthly"),
    "SELECT customer_id, lifetime_avg_monthly FROM service_feat")
add("f06_charge_ratio", lambda s: CF.billing_features(s.m.customers).select(
    "customer_id", "charge_ratio"), "SELECT customer_id, charge_ratio FROM cust_feat")
add("f07_revenue_band", lambda s: CF.quartile_band(
    s.m.customers, "monthly_charges", "revenue_band").select("customer_id", "monthly_charges",
                                                             "revenue_band"),
    "SELECT customer_id, monthly_charges, revenue_band FROM cust_feat")


def bounded_scores(s: Source) -> DataFrame:
    f = s.m.features
    return f.select("customer_id", *[
        minmax_score(F.col(c).cast("double"), lo, hi, up).alias(f"score_{c}")
        for c, (lo, hi, up) in K.QUALITY_COMPONENTS.items() if c in f.columns])


def _score_sql(c: str) -> str:
    from holdfast.catalog.sqlbase import _score
    return f"{_score(c, *K.QUALITY_COMPONENTS[c])} AS score_{c}"


add("f08_minmax_scores", bounded_scores, "SELECT customer_id, " + ", ".join(
    _score_sql(c) for c in ("avg_dropped_call_pct", "total_outage_minutes",
                            "network_complaints")) + " FROM features")

whole = ["kpi_months", "avg_dropped_call_pct", "avg_download_mbps", "avg_latency_ms",
         "total_outage_minutes", "avg_data_usage_gb", "network_complaints"]
recent = ["l3m_dropped_call_pct", "l3m_download_mbps", "l3m_latency_ms", "l3m_outage_minutes",
          "l3m_complaints"]
add("f09_window_aggregates", lambda s: T.raw_aggregates(s.m.kpis).select("customer_id", *whole),
    f"SELECT customer_id, {', '.join(whole)} FROM kpi_raw")
add("f10_recent_aggregates", lambda s: T.raw_aggregates(s.m.kpis).select("customer_id", *recent),
    f"SELECT customer_id, {', '.join(recent)} FROM kpi_raw")

# the oracle computes the two windows apart and joins them; the operator fuses both
add("f11_aggregate_join", lambda s: T.raw_aggregates(s.m.kpis).select(
    "customer_id", "kpi_months", "avg_latency_ms", "l3m_latency_ms", "l3m_outage_minutes"), f"""
SELECT a.customer_id, a.kpi_months, a.avg_latency_ms, b.l3m_latency_ms, b.l3m_outage_minutes
FROM (SELECT customer_id, COUNT(month_index) AS kpi_months,
             {ravg('avg_latency_ms')} AS avg_latency_ms FROM kpis GROUP BY customer_id) a
LEFT JOIN (SELECT customer_id, {ravg('avg_latency_ms')} AS l3m_latency_ms,
                  CAST(COALESCE(SUM(outage_minutes), 0) AS BIGINT) AS l3m_outage_minutes
           FROM kpis WHERE month_index > 9 GROUP BY customer_id) b
  ON a.customer_id = b.customer_id""")


def shorter_window(s: Source) -> DataFrame:
    """Another window length: the same operator with 6 and 2 months."""
    six = s.m.kpis.where("month_index <= 6")
    return T.raw_aggregates(six, window=6, recent=2).select("customer_id", "kpi_months", *recent)


def _parametric_sql() -> str:
    out = f"""SELECT customer_id, COUNT(month_index) AS kpi_months,
  {_late_avg('dropped_call_pct')} AS l3m_dropped_call_pct,
  {_late_avg('avg_download_mbps')} AS l3m_download_mbps,
  {_late_avg('avg_latency_ms')} AS l3m_latency_ms,
  {_late_sum('outage_minutes')} AS l3m_outage_minutes, {_late_sum('complaints')} AS l3m_complaints
FROM kpis WHERE month_index <= 6 GROUP BY customer_id"""
    return out.replace("month_index > 9", "month_index > 4")


def fractional(s: Source) -> DataFrame:
    """Telemetry with fractions of outage minutes and finer readings than any feed declares."""
    return s.m.kpis.select("customer_id", "month", "month_index",
                           (F.col("dropped_call_pct") + F.col("month_index") * 0.0012347).alias("dropped_call_pct"),
                           "avg_download_mbps", "avg_latency_ms",
                           (F.col("outage_minutes") * 0.9 + 0.125).alias("outage_minutes"),
                           "data_usage_gb", "complaints")


# the oracle adds plain doubles; both sides are rounded after the aggregation only
_FRACTIONS = ("(SELECT customer_id, month_index, dropped_call_pct + month_index * 0.0012347e0 AS d, "
              "outage_minutes * 0.9e0 + 0.125e0 AS o FROM kpis)")
add("f09c_fractional_readings", lambda s: T.raw_aggregates(fractional(s)).select(
    "customer_id", *[round_even(c, 6).alias(c) for c in (
        "avg_dropped_call_pct", "total_outage_minutes", "l3m_dropped_call_pct", "l3m_outage_minutes")]), f"""
SELECT customer_id, {rhe('AVG(d)', 6)} AS avg_dropped_call_pct, {rhe('SUM(o)', 6)} AS total_outage_minutes,
  {rhe('AVG(d) FILTER (month_index > 9)', 6)} AS l3m_dropped_call_pct,
  {rhe('SUM(o) FILTER (month_index > 9)', 6)} AS l3m_outage_minutes FROM {_FRACTIONS} GROUP BY customer_id""")


def month_by_month(s: Source) -> DataFrame:
    """Twelve monthly loads, the last one twice and one month sent first with wrong readings."""
    month = F.col("month_index")
    wrong = s.m.kpis.where(month == 7).withColumn("avg_latency_ms", F.lit(1.0))
    state = rolling.RollingTelemetry.create(s.m.kpis.where(month == 1), s.scratch("rolling"), buckets=4)
    state.load(wrong)
    for i in [*range(2, 13), 12]:
        state.load(s.m.kpis.where(month == i))
    return state.read()


add("f09d_window_month_by_month", month_by_month,
    f"SELECT customer_id, {', '.join(whole + recent)} FROM kpi_raw")


def last_six(s: Source) -> DataFrame:
    """A state of six months after twelve months came in: the window is the last six, two of them recent."""
    state = rolling.RollingTelemetry.create(s.m.kpis.where("month_index <= 7"), s.scratch("rolling"), 6, buckets=4)
    state.load(s.m.kpis.where("month_index between 8 and 10"))
    state.load(s.m.kpis.where("month_index > 10"))
    return state.read(recent=2).select("customer_id", "kpi_months", "avg_latency_ms", "total_outage_minutes", *recent)


def _last_six_sql() -> str:
    out = f"""SELECT customer_id, COUNT(month_index) AS kpi_months, {ravg('avg_latency_ms')} AS avg_latency_ms,
  CAST(COALESCE(SUM(outage_minutes), 0) AS BIGINT) AS total_outage_minutes,
  {_late_avg('dropped_call_pct')} AS l3m_dropped_call_pct,
  {_late_avg('avg_download_mbps')} AS l3m_download_mbps,
  {_late_avg('avg_latency_ms')} AS l3m_latency_ms,
  {_late_sum('outage_minutes')} AS l3m_outage_minutes, {_late_sum('complaints')} AS l3m_complaints
FROM kpis WHERE month_index > 6 GROUP BY customer_id"""
    return out.replace("month_index > 9", "month_index > 10")


add("f10c_months_leave_the_window", last_six, _last_six_sql())
add("f10b_recent_aggregates_other_window", shorter_window, _parametric_sql())

add("f12_trend_points", lambda s: T.telemetry_aggregates(s.m.kpis).select(
    "customer_id", "dropped_call_trend_pp"), "SELECT customer_id, dropped_call_trend_pp FROM kpi_agg")
add("f13_trend_percent", lambda s: T.telemetry_aggregates(s.m.kpis).select(
    "customer_id", "latency_trend_pct", "download_trend_pct"),
    "SELECT customer_id, latency_trend_pct, download_trend_pct FROM kpi_agg")
add("f14_late_rounding", lambda s: T.telemetry_aggregates(s.m.kpis),
    "SELECT * FROM kpi_agg")


def joined(s: Source) -> DataFrame:
    return T.attach_telemetry(CF.service_features(s.m.customers),
                              T.telemetry_aggregates(s.m.kpis))


add("f15_peer_median", lambda s: T.peer_medians(
    joined(s), "internet_service", ["avg_latency_ms", "avg_download_mbps"]), """
SELECT peer, median_latency AS median_avg_latency_ms, median_speed AS median_avg_download_mbps
FROM peer_median""")
add("f16_peer_ratio", lambda s: T.peer_ratios(joined(s)).select(
    "customer_id", "latency_ratio", "speed_ratio"),
    "SELECT customer_id, latency_ratio, speed_ratio FROM peer_ratio")
add("f17_quality_score", lambda s: T.peer_ratios(joined(s)).select(
    "customer_id", T.quality_score().alias("raw_score")),
    "SELECT customer_id, raw_score FROM quality_raw")
add("f18_quality_band", lambda s: T.add_quality(joined(s)).select(
    "customer_id", "network_quality_score", "network_quality_band"),
    "SELECT customer_id, network_quality_score, network_quality_band FROM features")
add("f19_attach_telemetry", lambda s: joined(s).select("customer_id", *whole, *recent),
    f"SELECT customer_id, {', '.join(whole + recent)} FROM joined_feat")
add("f19b_coverage", lambda s: T.coverage(s.m.customers, s.m.kpis), """
SELECT COUNT(*) AS customers, COUNT(k.customer_id) AS with_telemetry,
  100e0 * CAST(COUNT(k.customer_id) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS coverage_pct
FROM clean c LEFT JOIN (SELECT DISTINCT customer_id FROM kpis) k ON k.customer_id = c.customer_id""")
add("f20_feature_frame", lambda s: T.telemetry_features(CF.customer_features(s.m.customers),
                                                        s.m.kpis), "SELECT * FROM features")
add("f21_month_spine", lambda s: T.month_spine(s.m.customers), """
SELECT customer_id, CAST(unnest(range(12 - least(greatest(tenure_months, 1), 12) + 1, 13)) AS INTEGER)
  AS month_index FROM clean""")
add("f21b_missing_months", lambda s: T.missing_months(s.m.customers, s.m.kpis), """
SELECT s.customer_id, s.month_index FROM (
  SELECT customer_id, CAST(unnest(range(12 - least(greatest(tenure_months, 1), 12) + 1, 13)) AS INTEGER)
    AS month_index FROM clean) s
LEFT JOIN kpis k ON k.customer_id = s.customer_id AND k.month_index = s.month_index
WHERE k.customer_id IS NULL""")


add("f09b_rounded_means", lambda s: T.round_means(T.raw_aggregates(s.m.kpis)).select(
    "customer_id", "avg_latency_ms", "avg_data_usage_gb"),
    f"SELECT customer_id, {rhe('avg_latency_ms', 2)} AS avg_latency_ms, "
    f"{rhe('avg_data_usage_gb', 2)} AS avg_data_usage_gb FROM kpi_raw")
