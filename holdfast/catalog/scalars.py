"""X: scalar functions, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import number, rhe
from holdfast.functions import columns as L
from holdfast.operators.cleaning import unknown_map, unknown_values


def over_orders(name: str, spark: Callable[[], Column], sql: str) -> None:
    add(name, lambda s: s.t("orders").select("o_orderkey", spark().alias("v")),
        f"SELECT o_orderkey, {sql} AS v FROM orders")


def over_customers(name: str, spark: Callable[[], Column], sql: str,
                   stage: str = "features") -> None:
    def run(s: Source) -> DataFrame:
        frame = s.m.features if stage == "features" else s.m.scored
        return frame.select("customer_id", spark().alias("v"))
    add(name, run, f"SELECT customer_id, {sql} AS v FROM {stage}")


date, price = "o_orderdate", "o_totalprice"

add("x01_strip", lambda s: s.m.raw.select("feed_seq", L.strip("customerID").alias("v")),
    "SELECT feed_seq, customer_id AS v FROM trimmed")
over_orders("x02_substring", lambda: F.substring("o_orderpriority", 3, 4),
            "substr(o_orderpriority, 3, 4)")
over_orders("x03_contains_any_case", lambda: L.contains_ci("o_orderpriority", "Medium"),
            "o_orderpriority ILIKE '%medium%'")
over_customers("x04_feature_name", lambda: L.feature_name(
    F.concat(F.lit("payment_method_"), "payment_method")),
    "replace(replace(replace('payment_method_' || payment_method, ' ', '_'), '(', ''), ')', '')")
over_customers("x05_join_list", lambda: F.array_join(F.array_sort(F.array(
    "contract", "internet_service", "payment_method")), ", "),
    "array_to_string(list_sort([contract, internet_service, payment_method]), ', ')")
over_customers("x06_percent_and_padding", lambda: F.concat(
    L.percent_text(F.col("num_addon_services") / 8.0), F.lit("|"),
    F.lpad(F.col("tenure_months").cast("string"), 4, "0")),
    "printf('%.1f%%', num_addon_services / 8e0 * 100) || '|' || "
    "lpad(CAST(tenure_months AS VARCHAR), 4, '0')")
over_orders("x07_concat_prefix", lambda: F.concat_ws("_", F.lit("unique"), "o_orderstatus",
                                                     "o_orderpriority"),
            "'unique_' || o_orderstatus || '_' || o_orderpriority")
over_orders("x08_number_to_text", lambda: F.col("o_custkey").cast("string"),
            "CAST(o_custkey AS VARCHAR)")
over_orders("x09_rounding", lambda: L.round_even(F.col(price) / 7, 2), rhe("o_totalprice / 7e0", 2))
over_orders("x10_absolute", lambda: F.abs(F.col(price) - 250000), "abs(o_totalprice - 250000)")
over_customers("x11_clip", lambda: L.clip(F.col("latency_trend_pct"), -20.0, 20.0),
               "CASE WHEN latency_trend_pct IS NOT NULL "
               "THEN least(greatest(latency_trend_pct, -20e0), 20e0) END")
over_customers("x12_logistic", lambda: L.round_even(L.logistic(
    (F.col("tenure_months") - 60) / 10.0), 6),
    rhe("1e0 / (1e0 + exp(-((tenure_months - 60) / 10e0)))", 6))
over_orders("x13_exp_log", lambda: L.round_even(F.log(F.col(price)) + F.exp(-F.col(price) / 1e6), 9),
            rhe("ln(o_totalprice) + exp(-o_totalprice / 1e6)", 9))
over_orders("x14_integer_division", lambda: F.expr("o_orderkey * 10 div 15000"),
            "o_orderkey * 10 // 15000")
over_orders("x15_square", lambda: (F.col(price) - 1000) * (F.col(price) - 1000),
            "(o_totalprice - 1000) * (o_totalprice - 1000)")
over_customers("x16_row_mean", lambda: L.mean_skip_null([
    F.col("avg_latency_ms"), F.col("avg_download_mbps"), F.col("monthly_charges")]),
    "(COALESCE(avg_latency_ms, 0e0) + COALESCE(avg_download_mbps, 0e0) + "
    "COALESCE(monthly_charges, 0e0)) / NULLIF(CAST((avg_latency_ms IS NOT NULL)::INT + "
    "(avg_download_mbps IS NOT NULL)::INT + (monthly_charges IS NOT NULL)::INT AS DOUBLE), 0)")
over_orders("x17_case", lambda: F.when(F.col(price) > 300000, "big").when(
    F.col(price) > 100000, "mid").otherwise("small"),
    "CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid' "
    "ELSE 'small' END")
over_customers("x18_coalesce", lambda: F.coalesce("network_quality_score", F.lit(-1.0)),
               "COALESCE(network_quality_score, -1e0)")
over_customers("x19_zero_to_null", lambda: F.nullif("network_complaints", F.lit(0)),
               "NULLIF(network_complaints, 0)")
over_customers("x20_safe_division", lambda: F.coalesce(F.try_divide(
    F.col("total_charges"), F.col("num_addon_services").cast("double")), F.lit(0.0)),
    "COALESCE(total_charges / NULLIF(num_addon_services, 0), 0e0)")
over_customers("x21_switch", lambda: L.order_index("risk_band", ["High", "Medium", "Low"]),
               "CAST(CASE risk_band WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 END "
               "AS INTEGER)", "scored")
over_customers("x22_value_map", lambda: F.element_at(F.create_map(
    F.lit("Yes"), F.lit(1), F.lit("No"), F.lit(0)), F.col("partner")),
    "CASE partner WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END")
over_orders("x23_month_key", lambda: (F.year(date) * 100 + F.month(date)),
            "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)")
over_orders("x24_month_name", lambda: F.date_format(date, "MMM"), "strftime(o_orderdate, '%b')")
over_orders("x25_quarter_label", lambda: F.concat(F.lit("Q"), F.quarter(date).cast("string")),
            "'Q' || CAST(quarter(o_orderdate) AS VARCHAR)")
over_orders("x26_first_of_month", lambda: F.trunc(F.col(date).cast("date"), "MM"),
            "CAST(date_trunc('month', o_orderdate) AS DATE)")
over_orders("x27_month_arithmetic", lambda: F.add_months(F.trunc(F.col(date).cast("date"), "MM"), -1),
            "CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE)")
over_orders("x28_trailing_period", lambda: (
    L.month_ordinal(date) > 2001 * 12 + 8 - 3) & (L.month_ordinal(date) <= 2001 * 12 + 8),
    "o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' AND o_orderdate < TIMESTAMP '2001-09-01 00:00:00'")
over_orders("x29_utc_stamp", lambda: F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')")
add("x30_text_to_number", lambda s: s.m.raw.select(
    "feed_seq", L.to_number("TotalCharges").alias("v")),
    f"SELECT feed_seq, {number('total_charges')} AS v FROM trimmed")
over_orders("x31_narrow_decimal", lambda: (F.col(price) / 1000).cast("decimal(5,1)"),
            "CAST(o_totalprice / 1000 AS DECIMAL(5,1))")
over_orders("x32_double_cast", lambda: F.col("o_orderkey").cast("double") / 3,
            "CAST(o_orderkey AS DOUBLE) / 3")
over_orders("x33_to_json", lambda: F.to_json(F.struct("o_orderkey", "o_orderstatus")),
            "'{\"o_orderkey\":' || CAST(o_orderkey AS VARCHAR) || ',\"o_orderstatus\":\"' "
            "|| o_orderstatus || '\"}'")


def sorted_values(s: Source) -> DataFrame:
    """Sorted distinct list per group; the lists are bounded by the five priorities."""
    pairs = s.t("orders").select("o_orderstatus", "o_orderpriority").distinct()
    return pairs.groupBy("o_orderstatus").agg(
        F.array_join(F.array_sort(F.collect_list("o_orderpriority")), ", ").alias("v"))


add("x34_sorted_distinct_list", sorted_values, """
SELECT o_orderstatus, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS v
FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders) GROUP BY o_orderstatus""")


add("x35_map_from_entries", lambda s: unknown_map(unknown_values(s.m.customers)).select(F.to_json("unknown").alias("v")), """
SELECT '{"payment_method":[' || string_agg('"' || v || '"', ',' ORDER BY v) || ']}' AS v
FROM (SELECT DISTINCT payment_method AS v FROM clean WHERE payment_method NOT IN ('Bank transfer (automatic)',
  'Credit card (automatic)', 'Electronic check', 'Mailed check'))""")
over_orders("x36_literal_column", lambda: F.lit("By add-on count"), "'By add-on count'")
