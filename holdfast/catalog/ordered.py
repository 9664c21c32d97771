"""W and K: window functions, sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import big, date_dim, div, pct
from holdfast.functions.columns import order_index
from holdfast.functions.columns import pct as pct_of
from holdfast.operators import evaluation as E
from holdfast.operators import ordering as O
from holdfast.operators.cleaning import first_per_key, unknown_values
from holdfast.operators.star import date_dim as build_date_dim
from holdfast.operators.star import surrogate_dim
from holdfast.plans import measures as M
from holdfast.plans import report as R


def share_of_total(s: Source) -> DataFrame:
    g = s.t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return g.select("o_orderpriority", "n", pct_of(F.col("n"), F.sum("n").over(W.partitionBy()))
                    .alias("share_pct"))


add("w01_share_of_total", share_of_total, f"""
SELECT o_orderpriority, COUNT(*) AS n, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS share_pct
FROM orders GROUP BY o_orderpriority""")


def ranked_groups(s: Source) -> DataFrame:
    g = s.m.customers.groupBy("contract", "payment_method").agg(
        F.sum("churn_flag").alias("churned"), F.count("*").alias("n"))
    return g.withColumn("churn_rank", F.rank().over(W.orderBy(
        (F.col("churned").cast("double") / F.col("n")).desc())).cast("bigint"))


add("w02_rank_of_groups", ranked_groups, f"""
SELECT contract, payment_method, {big('SUM(churn_flag)')} AS churned, COUNT(*) AS n,
  RANK() OVER (ORDER BY {div('SUM(churn_flag)', 'COUNT(*)')} DESC) AS churn_rank
FROM clean GROUP BY contract, payment_method""")


def running_sum(s: Source) -> DataFrame:
    by_month = M.month_totals(s.m.monthly)
    return by_month.select("month", F.sum("outage_minutes").over(
        W.orderBy("month").rowsBetween(W.unboundedPreceding, 0)).alias("running"))


MONTHS = f"SELECT month, {big('SUM(outage_minutes)')} AS outage_minutes FROM monthly GROUP BY month"
add("w03_running_sum", running_sum, f"""
SELECT month, {big('SUM(outage_minutes) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING)')} AS running
FROM ({MONTHS})""")
add("w03b_running_sum_over_rows", lambda s: O.running_totals(
    s.t("orders").select("o_orderkey", F.rint(F.col("o_totalprice") * 100).cast("bigint").alias(
        "cents")), ["o_orderkey"], {"cents": "running"}, small_rows=1000).select(
    "o_orderkey", "running"), f"""
SELECT o_orderkey, {big('SUM(CAST(round_even(o_totalprice * 100, 0) AS BIGINT)) OVER (ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)')}
  AS running FROM orders""")
add("w04_grand_total", lambda s: M.month_totals(s.m.monthly).select(
    "month", "outage_minutes", F.sum("outage_minutes").over(W.partitionBy()).alias("total")), f"""
SELECT month, outage_minutes, {big('SUM(outage_minutes) OVER ()')} AS total FROM ({MONTHS})""")
price_then_key = ["o_totalprice", "o_orderkey"]
add("w05_ntile", lambda s: O.ntile(s.t("orders").select(*price_then_key), price_then_key, 10,
                                   "decile"), """
SELECT o_totalprice, o_orderkey,
  CAST(NTILE(10) OVER (ORDER BY o_totalprice, o_orderkey) AS INTEGER) AS decile FROM orders""")


def ntile_distributed(s: Source) -> DataFrame:
    ranked = O.global_rank(s.t("orders").select("o_orderpriority", "o_orderkey"),
                           ["o_orderpriority", "o_orderkey"], "r", "n", small_rows=1000)
    return ranked.select("o_orderkey", O.ntile_of(F.col("r"), F.col("n"), 7).alias("tile"))


add("w05b_ntile_heavy_ties", ntile_distributed, """
SELECT o_orderkey, CAST(NTILE(7) OVER (ORDER BY o_orderpriority, o_orderkey) AS INTEGER) AS tile
FROM orders""")
add("w06_position_decile", lambda s: O.position_tiles(
    s.m.scored.select("customer_id", "churn_probability"),
    [F.col("churn_probability").desc(), F.col("customer_id").asc()], 10, "decile"), """
SELECT customer_id, churn_probability,
  CAST((ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id) - 1) * 10
       // COUNT(*) OVER () + 1 AS INTEGER) AS decile FROM scored""")


def cumulative_share(s: Source) -> DataFrame:
    g = s.m.customers.groupBy("tenure_months").agg(F.sum("churn_flag").alias("gone"))
    upto = W.orderBy("tenure_months").rowsBetween(W.unboundedPreceding, 0)
    return g.select("tenure_months", pct_of(F.sum("gone").over(upto),
                                            F.sum("gone").over(W.partitionBy())).alias("cum_pct"))


add("w07_cumulative_share", cumulative_share, f"""
SELECT tenure_months, {pct('SUM(SUM(churn_flag)) OVER (ORDER BY tenure_months ROWS UNBOUNDED PRECEDING)',
                           'SUM(SUM(churn_flag)) OVER ()')} AS cum_pct
FROM clean GROUP BY tenure_months""")
add("w08_average_tie_rank", lambda s: O.average_rank(s.m.scored, "churn_probability", "avg_rank"), """
SELECT churn_probability, COUNT(*) AS rows, AVG(rn) AS avg_rank
FROM (SELECT churn_probability, ROW_NUMBER() OVER (ORDER BY churn_probability) AS rn FROM scored)
GROUP BY churn_probability""")


def cumulative_hits(s: Source) -> DataFrame:
    hist = E.score_histogram(s.m.scored, "churn_flag", "churn_probability")
    return O.running_totals(hist, [F.col("score").desc()], {"pos": "tp", "neg": "fp"},
                            small_rows=100).select("score", "tp", "fp")


add("w09_cumulative_hits", cumulative_hits, f"""
SELECT churn_probability AS score,
  {big('SUM(SUM(churn_flag)) OVER (ORDER BY churn_probability DESC)')} AS tp,
  {big('SUM(SUM(1 - churn_flag)) OVER (ORDER BY churn_probability DESC)')} AS fp
FROM scored GROUP BY churn_probability""")
add("w10_surrogate_numbering", lambda s: surrogate_dim(
    s.m.features, ["contract", "network_quality_band", "l3m_complaints"], "band_key"), """
SELECT ROW_NUMBER() OVER (ORDER BY contract ASC NULLS LAST, network_quality_band ASC NULLS LAST,
  l3m_complaints ASC NULLS LAST) AS band_key, contract, network_quality_band, l3m_complaints
FROM (SELECT DISTINCT contract, network_quality_band, l3m_complaints FROM features)""")
add("w11_month_index", lambda s: build_date_dim(s.m.monthly), date_dim("monthly"))
add("w12_previous_month", lambda s: M.month_over_month(s.m.monthly).select(
    "month", "outage_minutes", "previous"), f"""
SELECT a.month, a.outage_minutes, b.outage_minutes AS previous
FROM (SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS o FROM ({MONTHS})) a
LEFT JOIN (SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS o FROM ({MONTHS})) b
  ON b.o = a.o - 1""")
add("w13_rolling_3m", lambda s: M.rolling_months(s.m.monthly), f"""
SELECT month, outage_minutes, {big('SUM(outage_minutes) OVER (ORDER BY o RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)')}
  AS rolling_3m
FROM (SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS o FROM ({MONTHS}))""")
add("w14_total_ignoring_filters", lambda s: M.against_base(
    s.m.scored, ["contract"], {"internet_service": "DSL"}).select("contract", "churn_lift_vs_base"),
    f"""
SELECT contract, {div(div('SUM(churn_flag)', 'COUNT(*)'),
                      '(SELECT AVG(churn_flag) FROM scored)')} AS churn_lift_vs_base
FROM scored WHERE internet_service = 'DSL' GROUP BY contract""")
add("w15_first_per_key", lambda s: first_per_key(
    s.t("events").select("user_id", "event_type", "event_id", "value"),
    ["user_id", "event_type"], "event_id"), """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")

# -- sorts and top-k ----------------------------------------------------------------

add("k01_multi_key_sort", lambda s: s.m.customers.groupBy("contract", "payment_method").agg(
    F.count("*").alias("n")).orderBy("contract", F.col("n").desc()),
    "SELECT contract, payment_method, COUNT(*) AS n FROM clean GROUP BY 1, 2 ORDER BY 1, 3 DESC")
add("k02_top_n", lambda s: s.t("orders").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(
    5).select("o_orderkey", "o_totalprice"), """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
CURVE = "SELECT tenure_months, COUNT(*) AS customers FROM clean GROUP BY tenure_months"
add("k03_head", lambda s: R.first_year(s.m.customers.groupBy("tenure_months").agg(
    F.count("*").alias("customers"))), f"{CURVE} ORDER BY tenure_months LIMIT 12")
add("k04_business_order", lambda s: s.m.features.groupBy("network_quality_band").agg(
    F.count("*").alias("n")).select("network_quality_band", "n", order_index(
        "network_quality_band", [b for _, b in K.QUALITY_BANDS]).alias("position")).orderBy(
    "position"), """
SELECT network_quality_band, COUNT(*) AS n, CAST(CASE network_quality_band WHEN 'Poor' THEN 1
  WHEN 'Fair' THEN 2 WHEN 'Good' THEN 3 WHEN 'Excellent' THEN 4 END AS INTEGER) AS position
FROM features GROUP BY network_quality_band""")
add("k05_sort_by_size", lambda s: s.m.features.where("latency_trend_pct is not null").orderBy(
    F.abs("latency_trend_pct").desc(), "customer_id").select(
    "customer_id", "latency_trend_pct"), """
SELECT customer_id, latency_trend_pct FROM features WHERE latency_trend_pct IS NOT NULL
ORDER BY abs(latency_trend_pct) DESC, customer_id""")
add("k06_arg_max_with_ties", lambda s: s.t("orders").groupBy("o_orderpriority").agg(
    F.max(F.struct("o_totalprice", "o_orderkey")).alias("b")).select(
    "o_orderpriority", "b.o_totalprice", "b.o_orderkey"), """
SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders QUALIFY ROW_NUMBER() OVER (
  PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey DESC) = 1""")
add("k07_call_list", lambda s: R.call_list(s.m.scored, 200), """
SELECT customer_id, contract, tenure_months, monthly_charges, churn_probability, risk_band,
  network_quality_band FROM scored ORDER BY churn_probability DESC, customer_id LIMIT 200""")


def first_bad_values(s: Source) -> DataFrame:
    bad = unknown_values(s.m.customers.withColumnRenamed("tenure_months", "months").withColumn(
        "months", F.col("months").cast("string")), {"months": ("72", "73", "74", "75")})
    return bad.orderBy("value").limit(10).select("column", "value", "rows")


add("k08_first_bad_values", first_bad_values, """
SELECT 'months' AS "column", CAST(tenure_months AS VARCHAR) AS value, COUNT(*) AS rows FROM clean
WHERE tenure_months NOT IN (72, 73, 74, 75) GROUP BY tenure_months ORDER BY value LIMIT 10""")
