"""Report pages: headline figures, driver views and chart-ready frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import exact_avg, exact_sum, order_index, pct, ratio
from holdfast.operators.joins import null_safe_join
from holdfast.operators.profiling import rate_matrix
from holdfast.plans.measures import customer_measures, dq_measures, evaluate
from holdfast.session import cut

INFLUENCERS = ["contract", "internet_service", "payment_method", "tech_support",
               "online_security", "senior_citizen", "paperless_billing", "tenure_bucket",
               "num_addon_services"]
TREE_LEVELS = ["contract", "internet_service", "payment_method", "tenure_bucket"]


def headline(by_contract: DataFrame) -> DataFrame:
    """Totals and the two extreme contracts, from the churn-by-contract answer."""
    rank = F.struct("churn_rate_pct", "contract")
    return by_contract.agg(
        F.sum("customers").alias("customers"), F.sum("churned").alias("churned"),
        pct(F.sum("churned"), F.sum("customers")).alias("churn_rate_pct"),
        exact_sum("monthly_revenue_lost", 2).alias("monthly_revenue_lost"),
        F.max(rank).getField("contract").alias("highest_contract"),
        F.max("churn_rate_pct").alias("highest_rate_pct"),
        F.min(rank).getField("contract").alias("lowest_contract"),
        F.min("churn_rate_pct").alias("lowest_rate_pct"))


def run_summary(cleaning: DataFrame, dq: DataFrame) -> DataFrame:
    """Cleaning counters next to the gate's status counts; one row."""
    status = F.col("status")
    gate = dq.agg(F.struct(
        F.count_if(status == "PASS").alias("checks_pass"),
        F.count_if(status == "WARN").alias("checks_warn"),
        F.count_if(status == "FAIL").alias("checks_fail"), F.count("*").alias("checks")).alias("g"))
    return cleaning.withColumn("_g", gate.scalar()).select(*cleaning.columns, "_g.*")


def model_comparison(runs: list) -> DataFrame:
    """One row per feature set and engine; the boosted benchmark has no best threshold."""
    none = F.lit(None).cast("double")
    rows = [run.metrics.select("feature_set", "engine", "roc_auc_test", "f1_at_050", "recall_at_050",
                               "best_f1_threshold", "f1_at_best") for run in runs]
    rows += [run.boosted.select("feature_set", "engine", "roc_auc_test", F.col("f1").alias("f1_at_050"),
                                F.col("recall").alias("recall_at_050"), none.alias("best_f1_threshold"),
                                none.alias("f1_at_best")) for run in runs if run.boosted is not None]
    return reduce(DataFrame.unionByName, rows)


def billed_tenure_curve(curve: DataFrame) -> DataFrame:
    return curve.where("tenure_months > 0").select(
        "tenure_months", "churn_rate_pct", "cumulative_churn_share_pct")


def first_year(curve: DataFrame, rows: int = 12) -> DataFrame:
    return curve.orderBy("tenure_months").limit(rows)


def ordered_bands(by_band: DataFrame) -> DataFrame:
    labels = [label for _, label in K.QUALITY_BANDS]
    out = by_band.withColumn("band_order", order_index("network_quality_band", labels))
    return out.where("band_order is not null").orderBy("band_order")


def gain_points(lift: DataFrame, deciles: tuple[int, ...] = (2, 3, 5)) -> DataFrame:
    return lift.where(F.col("decile").isin(*deciles)).select(
        "decile", "cumulative_customers_pct", "cumulative_churners_pct")


def gain_line(lift: DataFrame) -> DataFrame:
    return lift.select("decile", "cumulative_customers_pct", "cumulative_churners_pct")


def kpi_cards(customers: DataFrame, dq: DataFrame) -> DataFrame:
    """Five cards in one row."""
    cards = evaluate(customers, customer_measures(),
                     ["customers", "churn_rate", "mrr_lost_to_churn", "expected_mrr_at_risk"])
    label = evaluate(dq, dq_measures(), ["dq_status_label"])
    return cards.withColumn("dq_status_label", label.scalar())


def decomposition_tree(df: DataFrame, levels: list[str] = TREE_LEVELS) -> DataFrame:
    """Follow the highest churn rate down the levels.

    One rollup answers every level; the walk then runs over its few result rows.
    """
    nodes = df.rollup(*levels).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("customers"),
        F.sum("churn_flag").alias("churned"))
    fixed = cut(nodes.withColumn("churn_rate", ratio(F.col("churned"), F.col("customers"))))
    n, steps = len(levels), []
    parents = None
    for depth in range(1, n + 1):
        at = fixed.where(F.col("_set") == (1 << (n - depth)) - 1)
        if parents is not None:
            at = null_safe_join(at, parents, levels[:depth - 1], "left_semi")
        best = at.groupBy().agg(F.max_by(F.struct(*levels[:depth], "customers", "churn_rate"),
                                         F.struct("churn_rate", "customers",
                                                  *levels[:depth])).alias("b"))
        best = best.where("b is not null").select("b.*")
        parents = best.select(*levels[:depth])
        steps.append(best.select(
            F.lit(depth).alias("level"), F.lit(levels[depth - 1]).alias("column"),
            F.col(levels[depth - 1]).alias("value"), "customers", "churn_rate"))
    return reduce(lambda a, b: a.unionByName(b), steps)


def key_influencers(df: DataFrame, columns: list[str] = INFLUENCERS) -> DataFrame:
    """Churn rate of every (column, value) against the rest of the base, ranked."""
    cells = df.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("customers"),
        F.sum("churn_flag").alias("churned"))
    n, every = len(columns), (1 << len(columns)) - 1
    named = cells.select("customers", "churned", F.inline(F.array_compact(F.array(*[
        F.when(F.col("_set") == every - (1 << (n - 1 - i)),
               F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for i, c in enumerate(columns)]))))
    base = df.agg(F.struct(F.count("*").alias("n"), F.sum("churn_flag").alias("gone")).alias("b"))
    rate = ratio(F.col("churned"), F.col("customers"))
    rest = ratio(F.col("_b.gone") - F.col("churned"), F.col("_b.n") - F.col("customers"))
    return (named.withColumn("_b", base.scalar())
            .select("column", "value", "customers", rate.alias("churn_rate"),
                    rest.alias("rest_rate"), ratio(rate, rest).alias("times_the_rest"))
            .orderBy(F.col("times_the_rest").desc_nulls_last(), "column", "value"))


def score_scatter(df: DataFrame) -> DataFrame:
    return df.groupBy("internet_service", "tenure_bucket").agg(
        exact_avg("network_quality_score", 1).alias("avg_network_quality_score"),
        ratio(F.sum("churn_flag"), F.count("*")).alias("churn_rate"),
        F.count("*").alias("customers"))


def risk_matrix(df: DataFrame, contracts: list[str] | None = None) -> DataFrame:
    """Risk band by contract: customers, churn rate and expected revenue at risk per cell."""
    m = customer_measures()
    names = ["customers", "churn_rate", "expected_mrr_at_risk"]
    values = contracts or list(K.DOMAINS["contract"])
    return df.groupBy("risk_band").pivot("contract", values).agg(*[m[n].alias(n) for n in names])


def payment_internet_matrix(df: DataFrame) -> DataFrame:
    return rate_matrix(df, "payment_method", "internet_service",
                       list(K.DOMAINS["internet_service"]))


def call_list(df: DataFrame, n: int | None = None) -> DataFrame:
    """Customers by falling risk; the first ``n`` of them where a number is given."""
    ranked = df.orderBy(F.col("churn_probability").desc_nulls_last(), "customer_id")
    return (ranked if n is None else ranked.limit(n)).select(
        "customer_id", "contract", "tenure_months", "monthly_charges", "churn_probability",
        "risk_band", "network_quality_band")


def dq_page(dq: DataFrame) -> DataFrame:
    """Pass rate, total and last refresh."""
    m = dq_measures()
    return dq.agg(m["dq_pass_rate"].alias("dq_pass_rate"),
                  m["dq_checks_total"].alias("dq_checks_total"),
                  F.max("run_ts").alias("last_refresh"))
