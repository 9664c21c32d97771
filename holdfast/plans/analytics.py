"""The eight business questions over the star tables.

Each takes the dict of star tables and returns one small result. Charges are
summed in whole cents, so answers do not move with partitioning. Dimension tables
read from storage carry their size, which lets the optimizer decide on broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import exact_avg, exact_sum, pct, read_avg, round_up
from holdfast.operators.ordering import ntile

Star = dict[str, DataFrame]


def churn_rate() -> Column:
    return pct(F.sum("churn_flag"), F.count("*"))


def lost_cents() -> Column:
    return F.sum(F.when(F.col("churn_flag") == 1, _cents()).otherwise(0))


def _cents() -> Column:
    return F.rint(F.col("monthly_charges") * 100).cast("bigint")


def _mean(c: str, places: int) -> Column:
    """Money and scores have declared decimals; telemetry counts as it was read."""
    declared = K.DECIMALS.get(c)
    return round_up(read_avg(c) if declared is None else exact_avg(c, declared), places)


def churn_by_contract(t: Star) -> DataFrame:
    return (t["fact_customer"].join(t["dim_contract"], "contract_key").groupBy("contract").agg(
        F.count("*").alias("customers"), F.sum("churn_flag").alias("churned"),
        round_up(churn_rate(), 1).alias("churn_rate_pct"),
        _mean("monthly_charges", 2).alias("avg_monthly_charges"),
        (lost_cents() / F.lit(100.0)).alias("monthly_revenue_lost"),
        round_up(pct(lost_cents(), F.sum(_cents())), 1).alias("revenue_lost_pct"))
        .orderBy(F.col("churn_rate_pct").desc()))


def churn_by_internet_and_payment(t: Star) -> DataFrame:
    g = (t["fact_customer"].join(t["dim_services"], "services_key")
         .join(t["dim_contract"], "contract_key").groupBy("internet_service", "payment_method")
         .agg(F.count("*").alias("customers"), F.sum("churn_flag").alias("churned")))
    n, bad = F.col("customers"), F.col("churned")
    return g.select(
        "internet_service", "payment_method", "customers", "churned",
        round_up(pct(bad, n), 1).alias("churn_rate_pct"),
        round_up(pct(n, F.sum(n).over(W.partitionBy())), 1).alias("share_of_base_pct"),
        F.rank().over(W.orderBy((bad.cast("double") / n).desc())).cast("bigint").alias(
            "churn_rank")).orderBy(F.col("churn_rate_pct").desc())


def tenure_curve(t: Star) -> DataFrame:
    by_month = (t["fact_customer"].join(t["dim_customer"].select("customer_key", "tenure_months"),
                                        "customer_key")
                .groupBy("tenure_months")
                .agg(F.count("*").alias("customers"), F.sum("churn_flag").alias("churned")))
    upto = W.orderBy("tenure_months").rowsBetween(W.unboundedPreceding, 0)
    running = F.sum("churned").over(upto)
    return by_month.select(
        "tenure_months", "customers", "churned",
        round_up(pct(F.col("churned"), F.col("customers")), 1).alias("churn_rate_pct"),
        running.alias("cumulative_churned"),
        round_up(pct(running, F.sum("churned").over(W.partitionBy())), 1).alias(
            "cumulative_churn_share_pct")).orderBy("tenure_months")


def addon_effect(t: Star) -> DataFrame:
    """Both groupings of the internet customers from one scan (grouping sets)."""
    base = (t["fact_customer"].join(t["dim_services"], "services_key")
            .where("has_internet = 1")
            .select("num_addon_services", "tech_support", "churn_flag", "monthly_charges"))
    g = base.groupingSets([["num_addon_services"], ["tech_support"]],
                          "num_addon_services", "tech_support").agg(
        F.grouping("num_addon_services").alias("_by_support"),
        F.count("*").alias("customers"), round_up(churn_rate(), 1).alias("churn_rate_pct"),
        _mean("monthly_charges", 2).alias("avg_monthly_charges"))
    by_support = F.col("_by_support") == 1
    return g.select(
        F.when(by_support, "By tech support").otherwise("By add-on count").alias("analysis"),
        F.when(by_support, F.col("tech_support")).otherwise(
            F.col("num_addon_services").cast("string")).alias("segment"),
        "customers", "churn_rate_pct", "avg_monthly_charges").orderBy("analysis", "segment")


def quality_vs_churn(t: Star) -> DataFrame:
    return (t["fact_customer"].where("kpi_months > 0").groupBy("network_quality_band").agg(
        F.count("*").alias("customers"), F.sum("churn_flag").alias("churned"),
        round_up(churn_rate(), 1).alias("churn_rate_pct"),
        _mean("network_quality_score", 1).alias("avg_quality_score"),
        _mean("avg_dropped_call_pct", 2).alias("avg_dropped_call_pct"),
        _mean("avg_latency_ms", 1).alias("avg_latency_ms"),
        _mean("total_outage_minutes", 0).alias("avg_outage_minutes"),
        _mean("network_complaints", 2).alias("avg_complaints")).orderBy("avg_quality_score"))


def revenue_by_decile(t: Star) -> DataFrame:
    ranked = ntile(t["fact_customer"].select("customer_key", "monthly_charges", "churn_flag"),
                   [F.col("monthly_charges").asc_nulls_first(), "customer_key"], 10,
                   "charge_decile")
    g = ranked.groupBy("charge_decile").agg(
        F.count("*").alias("customers"),
        round_up(F.min("monthly_charges"), 2).alias("min_monthly"),
        round_up(F.max("monthly_charges"), 2).alias("max_monthly"),
        round_up(churn_rate(), 1).alias("churn_rate_pct"), lost_cents().alias("_lost"))
    return g.select(
        F.col("charge_decile").cast("bigint").alias("charge_decile"), "customers", "min_monthly",
        "max_monthly", "churn_rate_pct",
        (F.col("_lost") / F.lit(100.0)).alias("monthly_revenue_lost"),
        round_up(pct(F.col("_lost"), F.sum("_lost").over(W.partitionBy())), 1).alias(
            "share_of_lost_revenue_pct")).orderBy("charge_decile")


def trend_churned_vs_retained(t: Star) -> DataFrame:
    group = F.when(F.col("churn_flag") == 1, "Churned").otherwise("Retained")
    g = (t["fact_network_monthly"].join(t["fact_customer"].select("customer_key", "churn_flag"),
                                        "customer_key")
         .groupBy("month_key", group.alias("customer_group")).agg(
             F.count("*").alias("customer_months"),
             _mean("dropped_call_pct", 3).alias("avg_dropped_call_pct"),
             _mean("avg_latency_ms", 1).alias("avg_latency_ms"),
             _mean("avg_download_mbps", 1).alias("avg_download_mbps"),
             _mean("outage_minutes", 1).alias("avg_outage_minutes"),
             _mean("complaints", 3).alias("avg_complaints")))
    return (g.join(t["dim_date"].select("month_key", "month", "month_index"), "month_key")
            .select("month", "month_index", "customer_group", "customer_months",
                    "avg_dropped_call_pct", "avg_latency_ms", "avg_download_mbps",
                    "avg_outage_minutes", "avg_complaints")
            .orderBy("month_index", "customer_group"))


def risk_segments(t: Star) -> DataFrame:
    p = F.rint(F.coalesce(F.col("churn_probability"), F.lit(0.0)) * 10000).cast("bigint")
    return (t["fact_customer"].join(t["dim_contract"], "contract_key")
            .groupBy(F.coalesce("risk_band", F.lit("Unscored")).alias("risk_band"), "contract")
            .agg(F.count("*").alias("customers"),
                 round_up(churn_rate(), 1).alias("actual_churn_rate_pct"),
                 _mean("churn_probability", 3).alias("avg_predicted_probability"),
                 exact_sum("monthly_charges", 2).alias("monthly_revenue"),
                 round_up(F.sum(_cents() * p) / F.lit(1e6), 2).alias(
                     "expected_monthly_revenue_at_risk"))
            .orderBy(F.col("avg_predicted_probability").desc_nulls_last(),
                     F.col("monthly_revenue").desc()))


QUESTIONS = {
    "churn_by_contract": churn_by_contract,
    "churn_by_internet_and_payment": churn_by_internet_and_payment,
    "tenure_curve": tenure_curve,
    "addon_services_effect": addon_effect,
    "network_quality_vs_churn": quality_vs_churn,
    "revenue_at_risk_by_decile": revenue_by_decile,
    "network_trend_churned_vs_retained": trend_churned_vs_retained,
    "risk_segments": risk_segments,
}
NEEDS_TELEMETRY = {"network_trend_churned_vs_retained"}


def answer_all(t: Star, extra: dict | None = None) -> dict[str, DataFrame]:
    """Every question by name; those that need telemetry are left out without it.

    ``extra`` adds questions, each a function of the star tables.
    """
    asked = {**QUESTIONS, **(extra or {})}
    return {name: ask(t) for name, ask in asked.items()
            if name not in NEEDS_TELEMETRY or "fact_network_monthly" in t}
