"""A and R: business questions and the report built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import big, pct, ravg, rhu, units, unknown_sql, xavg, xsum
from holdfast.operators import quality as Q
from holdfast.operators.cleaning import cleaning_report
from holdfast.plans import analytics as A
from holdfast.plans import report as R

cents = units("monthly_charges", 2)
LOST = f"SUM(CASE WHEN churn_flag = 1 THEN {cents} ELSE 0 END)"
RATE = rhu(pct("SUM(churn_flag)", "COUNT(*)"), 1)


def mean(c: str, places: int, decimals: int = 2) -> str:
    return f"{rhu(xavg(c, decimals), places)}"


def reading(c: str, places: int) -> str:
    return rhu(ravg(c), places)


SQL_BY_QUESTION: dict[str, str] = {
    "churn_by_contract": f"""
SELECT c.contract, COUNT(*) AS customers, {big('SUM(churn_flag)')} AS churned,
  {RATE} AS churn_rate_pct, {mean('monthly_charges', 2)} AS avg_monthly_charges,
  CAST({LOST} AS DOUBLE) / 100e0 AS monthly_revenue_lost,
  {rhu(pct(LOST, f'SUM({cents})'), 1)} AS revenue_lost_pct
FROM fact_customer f JOIN dim_contract c ON c.contract_key = f.contract_key GROUP BY c.contract""",
    "churn_by_internet_and_payment": f"""
SELECT s.internet_service, c.payment_method, COUNT(*) AS customers,
  {big('SUM(churn_flag)')} AS churned, {RATE} AS churn_rate_pct,
  {rhu(pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()'), 1)} AS share_of_base_pct,
  RANK() OVER (ORDER BY CAST(SUM(churn_flag) AS DOUBLE) / COUNT(*) DESC) AS churn_rank
FROM fact_customer f JOIN dim_services s ON s.services_key = f.services_key
JOIN dim_contract c ON c.contract_key = f.contract_key
GROUP BY s.internet_service, c.payment_method""",
    "tenure_curve": f"""
SELECT tenure_months, customers, churned, {rhu(pct('churned', 'customers'), 1)} AS churn_rate_pct,
  {big('SUM(churned) OVER (ORDER BY tenure_months ROWS UNBOUNDED PRECEDING)')}
    AS cumulative_churned,
  {rhu(pct('SUM(churned) OVER (ORDER BY tenure_months ROWS UNBOUNDED PRECEDING)',
           'SUM(churned) OVER ()'), 1)} AS cumulative_churn_share_pct
FROM (SELECT d.tenure_months, COUNT(*) AS customers, {big('SUM(churn_flag)')} AS churned
      FROM fact_customer f JOIN dim_customer d ON d.customer_key = f.customer_key
      GROUP BY d.tenure_months)""",
    "addon_services_effect": f"""
SELECT 'By add-on count' AS analysis, CAST(s.num_addon_services AS VARCHAR) AS segment,
  COUNT(*) AS customers, {RATE} AS churn_rate_pct, {mean('monthly_charges', 2)} AS avg_monthly_charges
FROM fact_customer f JOIN dim_services s ON s.services_key = f.services_key
WHERE s.has_internet = 1 GROUP BY s.num_addon_services
UNION ALL
SELECT 'By tech support', s.tech_support, COUNT(*), {RATE}, {mean('monthly_charges', 2)}
FROM fact_customer f JOIN dim_services s ON s.services_key = f.services_key
WHERE s.has_internet = 1 GROUP BY s.tech_support""",
    "network_quality_vs_churn": f"""
SELECT network_quality_band, COUNT(*) AS customers, {big('SUM(churn_flag)')} AS churned,
  {RATE} AS churn_rate_pct, {mean('network_quality_score', 1)} AS avg_quality_score,
  {reading('avg_dropped_call_pct', 2)} AS avg_dropped_call_pct,
  {reading('avg_latency_ms', 1)} AS avg_latency_ms,
  {reading('total_outage_minutes', 0)} AS avg_outage_minutes,
  {mean('network_complaints', 2)} AS avg_complaints
FROM fact_customer WHERE kpi_months > 0 GROUP BY network_quality_band""",
    "revenue_at_risk_by_decile": f"""
SELECT charge_decile, COUNT(*) AS customers, {rhu('MIN(monthly_charges)', 2)} AS min_monthly,
  {rhu('MAX(monthly_charges)', 2)} AS max_monthly, {RATE} AS churn_rate_pct,
  CAST({LOST} AS DOUBLE) / 100e0 AS monthly_revenue_lost,
  {rhu(pct(LOST, f'SUM({LOST}) OVER ()'), 1)} AS share_of_lost_revenue_pct
FROM (SELECT *, NTILE(10) OVER (ORDER BY monthly_charges ASC NULLS FIRST, customer_key)
        AS charge_decile FROM fact_customer) GROUP BY charge_decile""",
    "network_trend_churned_vs_retained": f"""
SELECT d.month, d.month_index,
  CASE WHEN f.churn_flag = 1 THEN 'Churned' ELSE 'Retained' END AS customer_group,
  COUNT(*) AS customer_months, {reading('n.dropped_call_pct', 3)} AS avg_dropped_call_pct,
  {reading('n.avg_latency_ms', 1)} AS avg_latency_ms,
  {reading('n.avg_download_mbps', 1)} AS avg_download_mbps,
  {reading('n.outage_minutes', 1)} AS avg_outage_minutes, {reading('n.complaints', 3)} AS avg_complaints
FROM fact_network_monthly n JOIN dim_date d ON d.month_key = n.month_key
JOIN fact_customer f ON f.customer_key = n.customer_key GROUP BY 1, 2, 3""",
    "risk_segments": f"""
SELECT COALESCE(f.risk_band, 'Unscored') AS risk_band, c.contract, COUNT(*) AS customers,
  {RATE} AS actual_churn_rate_pct,
  {mean('churn_probability', 3, 4)} AS avg_predicted_probability,
  {xsum('monthly_charges', 2)} AS monthly_revenue,
  {rhu(f"CAST(SUM({cents} * {units('COALESCE(churn_probability, 0e0)', 4)}) AS DOUBLE) / 1e6", 2)}
    AS expected_monthly_revenue_at_risk
FROM fact_customer f JOIN dim_contract c ON c.contract_key = f.contract_key GROUP BY 1, 2""",
}

for i, (question, ask) in enumerate(A.QUESTIONS.items(), start=1):
    add(f"a{i:02d}_{question}", lambda s, ask=ask: ask(s.star), SQL_BY_QUESTION[question])

# -- report figures ---------------------------------------------------------------------

by_contract = SQL_BY_QUESTION["churn_by_contract"]
add("r01_headline", lambda s: R.headline(A.churn_by_contract(s.star)), f"""
SELECT {big('SUM(customers)')} AS customers, {big('SUM(churned)')} AS churned,
  {pct('SUM(churned)', 'SUM(customers)')} AS churn_rate_pct,
  {xsum('monthly_revenue_lost', 2)} AS monthly_revenue_lost,
  arg_max(contract, row(churn_rate_pct, contract)) AS highest_contract,
  MAX(churn_rate_pct) AS highest_rate_pct,
  arg_min(contract, row(churn_rate_pct, contract)) AS lowest_contract,
  MIN(churn_rate_pct) AS lowest_rate_pct FROM ({by_contract})""")


def run_summary(s: Source) -> DataFrame:
    dq = Q.quality_results(s.m.features, s.m.kpis, run_ts="x")
    return R.run_summary(cleaning_report(s.m.raw), dq)


add("r02_run_summary", run_summary, f"""
SELECT (SELECT COUNT(*) FROM raw_feed) AS rows_in, COUNT(*) AS rows_out,
  (SELECT COUNT(*) FROM raw_feed) - COUNT(*) AS duplicates_removed,
  COUNT(*) FILTER (total_text = '') AS total_charges_blank,
  COUNT(*) FILTER (total_number IS NULL AND tenure_months = 0) AS total_charges_imputed_zero,
  COUNT(*) FILTER (total_number IS NULL) - COUNT(*) FILTER (total_text = '')
    AS total_charges_unparseable,
  (SELECT COUNT(*) FROM ({unknown_sql()})) AS unknown_category_values,
  (SELECT COUNT(*) FROM dq WHERE status = 'PASS') AS checks_pass,
  (SELECT COUNT(*) FROM dq WHERE status = 'WARN') AS checks_warn,
  (SELECT COUNT(*) FROM dq WHERE status = 'FAIL') AS checks_fail,
  (SELECT COUNT(*) FROM dq) AS checks FROM typed""")
curve = SQL_BY_QUESTION["tenure_curve"]
add("r04_billed_tenure_curve", lambda s: R.billed_tenure_curve(A.tenure_curve(s.star)), f"""
SELECT tenure_months, churn_rate_pct, cumulative_churn_share_pct FROM ({curve})
WHERE tenure_months > 0""")
add("r04b_first_year", lambda s: R.first_year(A.tenure_curve(s.star)),
    f"SELECT * FROM ({curve}) ORDER BY tenure_months LIMIT 12")
add("r04c_ordered_bands", lambda s: R.ordered_bands(A.quality_vs_churn(s.star)), f"""
SELECT *, CAST(CASE network_quality_band WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Good' THEN 3
  WHEN 'Excellent' THEN 4 END AS INTEGER) AS band_order
FROM ({SQL_BY_QUESTION['network_quality_vs_churn']})""")
add("r04d_group_split", lambda s: A.trend_churned_vs_retained(s.star).where(
    "customer_group = 'Churned'").select("month_index", "avg_dropped_call_pct", "avg_latency_ms"),
    f"""
SELECT month_index, avg_dropped_call_pct, avg_latency_ms
FROM ({SQL_BY_QUESTION['network_trend_churned_vs_retained']}) WHERE customer_group = 'Churned'""")
heat = list(K.DOMAINS["internet_service"])
add("r04e_payment_internet_matrix", lambda s: R.payment_internet_matrix(s.m.scored),
    "SELECT payment_method, " + ", ".join(
        pct(f"SUM(churn_flag) FILTER (internet_service = '{v}')",
            f"COUNT(*) FILTER (internet_service = '{v}')") + f' AS "{v}"' for v in heat)
    + " FROM scored GROUP BY payment_method")
