"""Metric layer: named aggregate expressions over the star, evaluated by any grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import (exact_avg, exact_sum, order_index, ratio, read_avg,
                                        text_ordinal)



def _where(condition: Column, value: Column | None = None) -> Column:
    return F.when(condition, F.lit(1) if value is None else value)


def customer_measures() -> dict[str, Column]:
    """Measures over ``fact_customer`` (or any frame with its columns)."""
    gone = F.col("churn_flag") == 1
    n, lost = F.count(F.lit(1)), F.count(_where(gone))
    mrr = exact_sum("monthly_charges", 2)
    mrr_lost = exact_sum(F.when(gone, F.col("monthly_charges")), 2)
    high = F.count(_where(F.col("risk_band") == "High"))
    p_units = F.rint(F.col("churn_probability") * 10000).cast("bigint")
    cents = F.rint(F.col("monthly_charges") * 100).cast("bigint")
    return {
        "customers": n,
        "churned_customers": lost,
        "retained_customers": n - lost,
        "churn_rate": ratio(lost, n),
        "retention_rate": 1 - ratio(lost, n),
        "monthly_recurring_revenue": mrr,
        "mrr_lost_to_churn": mrr_lost,
        "mrr_lost_share": ratio(mrr_lost, mrr),
        "arpu": ratio(mrr, n),
        "arpu_churned": ratio(mrr_lost, lost),
        "lifetime_revenue": exact_sum("total_charges", 2),
        "avg_churn_probability": exact_avg("churn_probability", 4),
        "expected_mrr_at_risk": F.sum(cents * p_units).cast("double") / 1e6,
        "high_risk_customers": high,
        "high_risk_share": ratio(high, n),
        "avg_network_quality_score": exact_avg("network_quality_score", 1),
    }


def tenure_measures() -> dict[str, Column]:
    """Measures over ``dim_customer``."""
    return {"avg_tenure_months": exact_avg("tenure_months", 0)}


def monthly_measures() -> dict[str, Column]:
    """Measures over the monthly fact."""
    return {
        "avg_dropped_call_pct": read_avg("dropped_call_pct"),
        "avg_latency_ms": read_avg("avg_latency_ms"),
        "avg_download_mbps": read_avg("avg_download_mbps"),
        "outage_minutes": F.sum("outage_minutes"),
        "complaints": F.sum("complaints"),
        "complaints_per_1k_customer_months": ratio(F.sum("complaints"), F.count("*")) * 1000,
    }


def labelled_monthly_measures() -> dict[str, Column]:
    """Measures over monthly rows that carry the customer's label (network_monthly view)."""
    latency = F.col("avg_latency_ms")
    return {
        "avg_latency_churned": read_avg(F.when(F.col("churn_flag") == 1, latency)),
        "avg_latency_retained": read_avg(F.when(F.col("churn_flag") == 0, latency)),
    }


def latency_trend(recent: int = K.RECENT_MONTHS) -> dict[str, Column]:
    """Last months against the months before them. Needs ``months_before_snapshot``."""
    late = F.col("months_before_snapshot") < recent
    after = read_avg(F.when(late, F.col("avg_latency_ms")))
    before = read_avg(F.when(~late, F.col("avg_latency_ms")))
    return {"latency_trend": ratio(after - before, before)}


def dq_measures() -> dict[str, Column]:
    """Measures over the audit table."""
    passed = F.count(_where(F.col("status") == "PASS"))
    failed = F.count(_where(F.col("status") == "FAIL"))
    warned = F.count(_where(F.col("status") == "WARN"))
    return {
        "dq_checks_passed": passed,
        "dq_checks_total": F.count("*"),
        "dq_pass_rate": ratio(passed, F.count("*")),
        "dq_status_label": F.when(failed > 0, "❌ FAIL").when(warned > 0, "⚠ WARN").otherwise(
            "✅ PASS"),
    }


def slice_by(df: DataFrame, **filters) -> DataFrame:
    """Slicer panel: keep rows whose columns take one of the chosen values; None keeps all."""
    for column, chosen in filters.items():
        if chosen is not None:
            values = [chosen] if isinstance(chosen, (str, int, float)) else list(chosen)
            df = df.where(F.col(column).isin(*values))
    return df


def evaluate(df: DataFrame, measures: dict[str, Column], names: list[str] | None = None,
             by: list[str] | None = None, filters: dict | None = None) -> DataFrame:
    """Chosen measures per group of the (optionally sliced) frame, in one aggregate."""
    chosen = [measures[n].alias(n) for n in (names or measures)]
    return slice_by(df, **(filters or {})).groupBy(*(by or [])).agg(*chosen)


def against_base(df: DataFrame, by: list[str], filters: dict | None = None) -> DataFrame:
    """Churn lift and share of all churn; the base ignores filters and grouping."""
    m = customer_measures()
    base = df.agg(F.struct(m["churn_rate"].alias("rate"),
                           m["churned_customers"].alias("gone")).alias("base"))
    seg = evaluate(df, m, ["customers", "churned_customers", "churn_rate"], by, filters)
    return seg.withColumn("_b", base.scalar()).select(
        *seg.columns, ratio(F.col("churn_rate"), F.col("_b.rate")).alias("churn_lift_vs_base"),
        ratio(F.col("churned_customers"), F.col("_b.gone")).alias("share_of_all_churn"))


def month_totals(monthly: DataFrame, value: str = "outage_minutes") -> DataFrame:
    return monthly.groupBy("month").agg(F.sum(value).alias(value)).withColumn(
        "month_ordinal", text_ordinal("month"))


def month_over_month(monthly: DataFrame, value: str = "outage_minutes") -> DataFrame:
    """Change against the calendar month before; a missing month gives NULL.

    Both sides are one row per month.
    """
    now = month_totals(monthly, value)
    before = now.select((F.col("month_ordinal") + 1).alias("month_ordinal"),
                        F.col(value).alias("previous"))
    return now.join(before, "month_ordinal", "left").select(
        "month", value, "previous",
        ratio(F.col(value) - F.col("previous"), F.col("previous")).alias("mom_change"))


def rolling_months(monthly: DataFrame, value: str = "outage_minutes", months: int = 3) -> DataFrame:
    """Sum over the calendar months ending here, on one row per month."""
    w = W.orderBy("month_ordinal").rangeBetween(-(months - 1), 0)
    return month_totals(monthly, value).select(
        "month", value, F.sum(value).over(w).alias(f"rolling_{months}m"))


def tenure_bucket_sort(c: str = "tenure_bucket") -> Column:
    return order_index(c, [label for _, _, label in K.TENURE_BUCKETS])


def risk_band_sort(c: str = "risk_band") -> Column:
    return order_index(c, [label for _, _, label in reversed(K.RISK_BANDS)])
