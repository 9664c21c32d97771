"""M and L: metric layer and report-page queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import big, div, ravg, units, xavg, xsum
from holdfast.operators import quality as Q
from holdfast.operators import star as S
from holdfast.plans import cube as C
from holdfast.plans import measures as M
from holdfast.plans import report as R

BY = ["contract", "internet_service"]
BY_SQL = ", ".join(BY)
gone = "churn_flag = 1"
lost_mrr = f"SUM(CASE WHEN {gone} THEN {units('monthly_charges', 2)} END)"
mrr_d = xsum("monthly_charges", 2)
lost_d = f"(CAST({lost_mrr} AS DOUBLE) / 1e2)"

# inventory id -> (measure, SQL) over customer rows
CUSTOMER = {
    "m01": ("customers", "COUNT(*)"),
    "m02": ("churned_customers", f"COUNT(*) FILTER ({gone})"),
    "m03": ("retained_customers", f"COUNT(*) - COUNT(*) FILTER ({gone})"),
    "m04": ("churn_rate", div(f"COUNT(*) FILTER ({gone})", "COUNT(*)")),
    "m05": ("retention_rate", f"1 - {div(f'COUNT(*) FILTER ({gone})', 'COUNT(*)')}"),
    "m06": ("monthly_recurring_revenue", mrr_d),
    "m07": ("mrr_lost_to_churn", lost_d),
    "m08": ("mrr_lost_share", div(lost_d, mrr_d)),
    "m09": ("arpu", div(mrr_d, "COUNT(*)")),
    "m10": ("arpu_churned", div(lost_d, f"COUNT(*) FILTER ({gone})")),
    "m11": ("lifetime_revenue", xsum("total_charges", 2)),
    "m13": ("avg_churn_probability", xavg("churn_probability", 4)),
    "m14": ("expected_mrr_at_risk",
            f"CAST(SUM({units('monthly_charges', 2)} * {units('churn_probability', 4)}) AS DOUBLE) / 1e6"),
    "m15": ("high_risk_customers", "COUNT(*) FILTER (risk_band = 'High')"),
    "m16": ("high_risk_share", div("COUNT(*) FILTER (risk_band = 'High')", "COUNT(*)")),
    "m19": ("avg_network_quality_score", xavg("network_quality_score", 1)),
}
for key, (name, text) in CUSTOMER.items():
    add(f"{key}_{name}", lambda s, name=name: M.evaluate(
        s.m.scored, M.customer_measures(), [name], BY),
        f"SELECT {BY_SQL}, {text} AS {name} FROM scored GROUP BY {BY_SQL}")

add("m12_avg_tenure_months", lambda s: M.evaluate(
    s.star["dim_customer"], M.tenure_measures(), by=["gender"]),
    f"SELECT gender, {xavg('tenure_months', 0)} AS avg_tenure_months FROM dim_customer GROUP BY gender")
base = "(SELECT AVG(churn_flag) FROM scored)"
add("m17_churn_lift_vs_base", lambda s: M.against_base(s.m.scored, BY).select(
    *BY, "churn_lift_vs_base"), f"""
SELECT {BY_SQL}, {div(div('SUM(churn_flag)', 'COUNT(*)'), base)} AS churn_lift_vs_base
FROM scored GROUP BY {BY_SQL}""")
add("m18_share_of_all_churn", lambda s: M.against_base(s.m.scored, ["tech_support"], {
    "internet_service": ["DSL", "Fiber optic"]}).select("tech_support", "share_of_all_churn"), f"""
SELECT tech_support, {div('SUM(churn_flag)', '(SELECT SUM(churn_flag) FROM scored)')}
  AS share_of_all_churn
FROM scored WHERE internet_service IN ('DSL', 'Fiber optic') GROUP BY tech_support""")

MONTHLY = {
    "m20": ("avg_dropped_call_pct", ravg("dropped_call_pct")),
    "m21": ("avg_latency_ms", ravg("avg_latency_ms")),
    "m22": ("avg_download_mbps", ravg("avg_download_mbps")),
    "m23": ("outage_minutes", big("SUM(outage_minutes)")),
    "m24": ("complaints", big("SUM(complaints)")),
    "m25": ("complaints_per_1k_customer_months", f"{div('SUM(complaints)', 'COUNT(*)')} * 1000"),
}
for key, (name, text) in MONTHLY.items():
    add(f"{key}_{name}", lambda s, name=name: M.evaluate(
        s.star["fact_network_monthly"], M.monthly_measures(), [name], ["month"]),
        f"SELECT month, {text} AS {name} FROM fact_network_monthly GROUP BY month")


# -- the same measures from a stored cube ---------------------------------------------------

SLICERS = ["contract", "internet_service", "payment_method", "tenure_bucket", "risk_band", "revenue_band"]


def customer_cube(s: Source) -> C.Cube:
    return C.Cube.build(s.m.scored, SLICERS, s.scratch("cube"), C.customer_layer(), [BY, ["risk_band", "contract"]])


def sliced_cube(s: Source) -> DataFrame:
    """The slicer panel over all customer measures."""
    return customer_cube(s).answer(list(M.customer_measures()), ["risk_band"], {
        "contract": ["Month-to-month", "Two year"], "internet_service": "DSL", "payment_method": None})


def extended_cube(s: Source) -> DataFrame:
    """Monthly measures of a cube of the first nine months to which the last three were added."""
    rows, at = S.network_monthly(s.star), ["month", "internet_service"]
    first = C.Cube.build(rows.where("month_index <= 9"), at, s.scratch("cube"), C.monthly_layer(), [["internet_service"]])
    whole = first.extended(rows.where("month_index > 9"), s.scratch("cube"))
    return whole.answer(["customer_months", *M.monthly_measures(), *M.labelled_monthly_measures()], ["internet_service"])


_all_customer = ", ".join(f"{text} AS {name}" for name, text in CUSTOMER.values())
add("m16b_measures_from_cube", lambda s: customer_cube(s).answer(list(M.customer_measures()), BY),
    f"SELECT {BY_SQL}, {_all_customer} FROM scored GROUP BY {BY_SQL}")
add("p10b_slicer_panel_from_cube", sliced_cube, f"""
SELECT risk_band, {_all_customer} FROM scored
WHERE contract IN ('Month-to-month', 'Two year') AND internet_service = 'DSL' GROUP BY risk_band""")
add("m25b_monthly_measures_from_cube", extended_cube, f"""
SELECT internet_service, COUNT(*) AS customer_months, {", ".join(f"{text} AS {name}" for name, text in MONTHLY.values())},
  {ravg('CASE WHEN churn_flag = 1 THEN avg_latency_ms END')} AS avg_latency_churned,
  {ravg('CASE WHEN churn_flag = 0 THEN avg_latency_ms END')} AS avg_latency_retained
FROM (SELECT n.*, f.churn_flag, s.internet_service FROM fact_network_monthly n
      JOIN fact_customer f ON f.customer_key = n.customer_key JOIN dim_services s ON s.services_key = f.services_key)
GROUP BY internet_service""")

LABELLED = ("(SELECT n.*, f.churn_flag, d.months_before_snapshot FROM fact_network_monthly n "
            "JOIN fact_customer f ON f.customer_key = n.customer_key "
            "JOIN dim_date d ON d.month_key = n.month_key)")
for key, name, flag_value in (("m26", "avg_latency_churned", 1), ("m27", "avg_latency_retained", 0)):
    case = f"CASE WHEN churn_flag = {flag_value} THEN avg_latency_ms END"
    add(f"{key}_{name}", lambda s, name=name: M.evaluate(
        S.network_monthly(s.star), M.labelled_monthly_measures(), [name], ["month_index"]),
        f"SELECT CAST(month_index AS BIGINT) AS month_index, {ravg(case)} AS {name} "
        f"FROM {LABELLED} GROUP BY month_index")
after = ravg("CASE WHEN months_before_snapshot < 3 THEN avg_latency_ms END")
before = ravg("CASE WHEN months_before_snapshot >= 3 THEN avg_latency_ms END")
add("m28_latency_trend", lambda s: M.evaluate(
    S.network_monthly(s.star), M.latency_trend(), by=["churn_flag"]), f"""
SELECT churn_flag, {div(f'{after} - {before}', before)} AS latency_trend FROM {LABELLED}
GROUP BY churn_flag""")

MONTHS = f"SELECT month, {big('SUM(outage_minutes)')} AS outage_minutes FROM monthly GROUP BY month"
ORDINAL = f"(SELECT *, substr(month, 1, 4)::INT * 12 + substr(month, 6, 2)::INT AS o FROM ({MONTHS}))"
add("m29_outage_mom", lambda s: M.month_over_month(s.m.monthly).select("month", "mom_change"), f"""
SELECT a.month, {div('a.outage_minutes - b.outage_minutes', 'b.outage_minutes')} AS mom_change
FROM {ORDINAL} a LEFT JOIN {ORDINAL} b ON b.o = a.o - 1""")


def gap_in_calendar(s: Source) -> DataFrame:
    """Without the Februaries, March has no previous month."""
    return M.month_over_month(s.m.monthly.where("month not like '%-02'"), "lines")


LINES = ("(SELECT month, CAST(SUM(lines) AS BIGINT) AS lines, substr(month, 1, 4)::INT * 12 "
         "+ substr(month, 6, 2)::INT AS o FROM monthly WHERE month NOT LIKE '%-02' GROUP BY month)")
add("m29b_mom_with_gaps", gap_in_calendar, f"""
SELECT a.month, a.lines, b.lines AS previous, {div('a.lines - b.lines', 'b.lines')} AS mom_change
FROM {LINES} a LEFT JOIN {LINES} b ON b.o = a.o - 1""")
add("m30_outage_rolling_3m", lambda s: M.rolling_months(s.m.monthly), f"""
SELECT month, outage_minutes,
  {big('SUM(outage_minutes) OVER (ORDER BY o RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS rolling_3m
FROM {ORDINAL}""")
add("m30b_rolling_with_gaps", lambda s: M.rolling_months(
    s.m.monthly.where("month not like '%-02'"), "lines"), f"""
SELECT month, lines, {big('SUM(lines) OVER (ORDER BY o RANGE BETWEEN 2 PRECEDING AND CURRENT ROW)')}
  AS rolling_3m FROM {LINES}""")


def dq(s: Source) -> DataFrame:
    return Q.quality_results(s.m.features, s.m.kpis, run_ts="2001-08-01T00:00:00Z")


passed = "COUNT(*) FILTER (status = 'PASS')"
DQ = {"m31": ("dq_checks_passed", passed), "m32": ("dq_checks_total", "COUNT(*)"),
      "m33": ("dq_pass_rate", div(passed, "COUNT(*)")),
      "m34": ("dq_status_label", "CASE WHEN COUNT(*) FILTER (status = 'FAIL') > 0 THEN '❌ FAIL' "
              "WHEN COUNT(*) FILTER (status = 'WARN') > 0 THEN '⚠ WARN' ELSE '✅ PASS' END")}
for key, (name, text) in DQ.items():
    add(f"{key}_{name}", lambda s, name=name: M.evaluate(dq(s), M.dq_measures(), [name], ["table"]),
        f'SELECT "table", {text} AS {name} FROM dq GROUP BY "table"')
add("m35_tenure_bucket_sort", lambda s: s.star["dim_customer"].select(
    "tenure_bucket", M.tenure_bucket_sort().alias("position")).distinct(), """
SELECT DISTINCT tenure_bucket, CAST(CASE tenure_bucket WHEN '00-12 months' THEN 1
  WHEN '13-24 months' THEN 2 WHEN '25-48 months' THEN 3 WHEN '49-72 months' THEN 4 END AS INTEGER)
  AS position FROM dim_customer""")
add("m36_risk_band_sort", lambda s: s.star["fact_customer"].select(
    "risk_band", M.risk_band_sort().alias("position")).distinct(), """
SELECT DISTINCT risk_band, CAST(CASE risk_band WHEN 'High' THEN 1 WHEN 'Medium' THEN 2
  WHEN 'Low' THEN 3 END AS INTEGER) AS position FROM fact_customer""")

# -- report pages -------------------------------------------------------------------------

add("l01_kpi_cards", lambda s: R.kpi_cards(s.m.scored, dq(s)), f"""
SELECT COUNT(*) AS customers, {CUSTOMER['m04'][1]} AS churn_rate, {lost_d} AS mrr_lost_to_churn,
  {CUSTOMER['m14'][1]} AS expected_mrr_at_risk,
  (SELECT {DQ['m34'][1]} FROM dq) AS dq_status_label FROM scored""")


def _tree_sql() -> str:
    stages, parts, path = [], [], []
    for depth, column in enumerate(R.TREE_LEVELS, start=1):
        path.append(column)
        cols = ", ".join(path)
        parent = ""
        if depth > 1:
            parent = " WHERE " + " AND ".join(
                f"{c} = (SELECT {c} FROM level{depth - 1})" for c in path[:-1])
        order = ", ".join(["churn_rate DESC", "customers DESC", *[f"{c} DESC" for c in path]])
        stages.append(f"level{depth} AS (SELECT {cols}, COUNT(*) AS customers, "
                      f"{div('SUM(churn_flag)', 'COUNT(*)')} AS churn_rate FROM scored{parent} "
                      f"GROUP BY {cols} ORDER BY {order} LIMIT 1)")
        parts.append(f"SELECT {depth} AS level, '{column}' AS \"column\", {column} AS value, "
                     f"customers, churn_rate FROM level{depth}")
    return f"SELECT * FROM (WITH {', '.join(stages)} {' UNION ALL '.join(parts)})"


add("l02_decomposition_tree", lambda s: R.decomposition_tree(s.m.scored), _tree_sql())
add("l03_key_influencers", lambda s: R.key_influencers(s.m.scored), f"""
SELECT "column", value, customers, {div('churned', 'customers')} AS churn_rate,
  {div('gone - churned', 'n - customers')} AS rest_rate,
  {div(div('churned', 'customers'), div('gone - churned', 'n - customers'))} AS times_the_rest
FROM ({" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, COUNT(*) AS customers, "
    f"SUM(churn_flag) AS churned FROM scored GROUP BY {c}" for c in R.INFLUENCERS)}),
  (SELECT COUNT(*) AS n, SUM(churn_flag) AS gone FROM scored)""")
add("l04_score_scatter", lambda s: R.score_scatter(s.m.scored), f"""
SELECT internet_service, tenure_bucket,
  {xavg('network_quality_score', 1)} AS avg_network_quality_score,
  {div('SUM(churn_flag)', 'COUNT(*)')} AS churn_rate, COUNT(*) AS customers
FROM scored GROUP BY internet_service, tenure_bucket""")


def _matrix_sql() -> str:
    cells = []
    for c in K.DOMAINS["contract"]:
        here = f"contract = '{c}'"
        n = f"COUNT(*) FILTER ({here})"
        cells += [f"NULLIF({n}, 0) AS \"{c}_customers\"",
                  f"{div(f'COUNT(*) FILTER ({here} AND {gone})', n)} AS \"{c}_churn_rate\"",
                  f"CAST(SUM({units('monthly_charges', 2)} * {units('churn_probability', 4)}) "
                  f"FILTER ({here}) AS DOUBLE) / 1e6 AS \"{c}_expected_mrr_at_risk\""]
    return f"SELECT risk_band, {', '.join(cells)} FROM scored GROUP BY risk_band"


add("l05_risk_matrix", lambda s: R.risk_matrix(s.m.scored), _matrix_sql())
add("l07_drill_through", lambda s: R.call_list(M.slice_by(s.m.scored, risk_band="High")), """
SELECT customer_id, contract, tenure_months, monthly_charges, churn_probability, risk_band,
  network_quality_band FROM scored WHERE risk_band = 'High'
ORDER BY churn_probability DESC, customer_id""")
add("l08_dq_page", lambda s: R.dq_page(dq(s)), f"""
SELECT {div(passed, 'COUNT(*)')} AS dq_pass_rate, COUNT(*) AS dq_checks_total,
  MAX(run_ts) AS last_refresh FROM dq""")
