"""Oracle side: the bindings and stages again, as plain SQL for an independent engine.

Nothing here is used to compute a Spark result.
"""

from __future__ import annotations

import re

from holdfast import contract as K

# -- expression helpers ----------------------------------------------------------


def rhe(x: str, places: int) -> str:
    """Round half to even."""
    step = f"1e{places}"
    return f"(round_even(CAST(({x}) AS DOUBLE) * {step}, 0) / {step})"


def rhu(x: str, places: int) -> str:
    """Round half up."""
    step = f"1e{places}"
    return f"(floor(CAST(({x}) AS DOUBLE) * {step} + 0.5e0) / {step})"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0e0))"


def pct(a: str, b: str) -> str:
    return f"(100e0 * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0e0))"


def units(c: str, places: int) -> str:
    if places == 0:
        return f"CAST({c} AS BIGINT)"
    return f"CAST(round_even(({c}) * 1e{places}, 0) AS BIGINT)"


def xsum(c: str, places: int) -> str:
    return f"(CAST(SUM({units(c, places)}) AS DOUBLE) / 1e{places})"


def xavg(c: str, places: int) -> str:
    u = units(c, places)
    return (f"(CAST(SUM({u}) AS DOUBLE) / "
            f"NULLIF(CAST(COUNT({u}) * {10 ** places} AS DOUBLE), 0e0))")


def ravg(c: str) -> str:
    """Mean of readings as decimals of nine places."""
    return (f"(CAST(SUM(CAST({c} AS DECIMAL(29,9))) AS DOUBLE) / "
            f"NULLIF(CAST(COUNT({c}) AS DOUBLE), 0e0))")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def number(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"
            f" THEN CAST({x} AS DOUBLE) END)")


def case_map(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} END)"


def cents_text(x: str) -> str:
    return f"(CAST({x} // 100 AS VARCHAR) || '.' || lpad(CAST({x} % 100 AS VARCHAR), 2, '0'))"


WS = "E' \\t\\n\\r'"
MONTH_NO = "(year(o_orderdate) * 12 + month(o_orderdate))"


def _month_text(o: str) -> str:
    return (f"(CAST(({o} - 1) // 12 AS VARCHAR) || '-' || "
            f"lpad(CAST(({o} - 1) % 12 + 1 AS VARCHAR), 2, '0'))")


def _score(x: str, lo: float, hi: float, up: bool) -> str:
    scaled = f"least(greatest((CAST({x} AS DOUBLE) - {lo}e0) / {hi - lo!r}e0, 0e0), 1e0)"
    scaled = scaled if up else f"1e0 - {scaled}"
    return f"(CASE WHEN {x} IS NOT NULL THEN {scaled} END)"


def unknown_sql() -> str:
    """Values outside their domain in the clean feed, with their rows."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS rows FROM clean WHERE {c} NOT IN ("
        + ", ".join(f"'{a}'" for a in allowed) + f") GROUP BY {c}"
        for c, allowed in K.DOMAINS.items())


# -- stages ----------------------------------------------------------------------------

_ADDON_COUNT = {"online_security": "1-URGENT", "online_backup": "2-HIGH",
                "device_protection": "3-MEDIUM", "tech_support": "4-NOT SPECIFIED",
                "streaming_tv": "5-LOW"}
_REGION = {"AFRICA": "Month-to-month", "AMERICA": "Month-to-month", "ASIA": "One year",
           "EUROPE": "One year", "MIDDLE EAST": "Two year"}
_SEGMENT = {"BUILDING": "Fiber optic", "AUTOMOBILE": "Fiber optic", "MACHINERY": "DSL",
            "HOUSEHOLD": "DSL", "FURNITURE": "No"}
_PRIORITY = {"1-URGENT": "Electronic check", "2-HIGH": "Mailed check",
             "3-MEDIUM": "Bank transfer (automatic)", "4-NOT SPECIFIED": "Not specified",
             "5-LOW": "Credit card (automatic)"}


def _addon(name: str) -> str:
    return (f"CASE WHEN internet = 'No' THEN 'No internet service' "
            f"WHEN n_{name} >= 2 THEN 'Yes' ELSE 'No' END")


CTES: dict[str, str] = {}

CTES["order_history"] = f"""
SELECT o_custkey, COUNT(*) AS n_orders, COUNT(DISTINCT {MONTH_NO}) AS n_months,
       {big('SUM(' + units('o_totalprice', 2) + ')')} AS price_cents,
       MIN({MONTH_NO}) AS first_month, MAX(o_orderdate) AS last_order,
       arg_max(o_orderpriority, row(o_orderdate, o_orderkey)) AS priority,
       arg_max(o_orderstatus, row(o_orderdate, o_orderkey)) AS status,
       {", ".join(f"COUNT(*) FILTER (o_orderpriority = '{p}') AS n_{a}"
                  for a, p in _ADDON_COUNT.items())},
       COUNT(*) FILTER (o_orderstatus = 'F') AS n_streaming_movies,
       COUNT(*) FILTER (o_orderstatus = 'P') AS n_pending
FROM orders GROUP BY o_custkey"""

CTES["feed_base"] = f"""
SELECT c_custkey AS k, c_nationkey AS nk, c_acctbal, h.*,
       {case_map('r_name', _REGION)} AS contract,
       {case_map('c_mktsegment', _SEGMENT)} AS internet,
       CASE WHEN c_nationkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS phone,
       CAST(round_even(price_cents / 2500e0, 0) AS BIGINT) AS total_cents,
       COALESCE(CAST(round_even(price_cents / CAST(n_months * 2500 AS DOUBLE), 0) AS BIGINT), 0)
         AS monthly_cents
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN order_history h ON c_custkey = o_custkey"""

CTES["raw_feed"] = f"""
SELECT k * 2 + copy AS feed_seq,
  CASE WHEN k % 2 = 0 THEN ' ' ELSE '' END || 'C' || CAST(k AS VARCHAR)
    || CASE WHEN k % 3 = 0 THEN E'\\t' ELSE '' END AS customerID,
  CASE WHEN nk % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS SeniorCitizen,
  CASE WHEN n_pending >= 4 THEN 'Yes' ELSE 'No' END AS Partner,
  CASE WHEN c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS Dependents,
  CAST(COALESCE(24020 - first_month, 0) AS VARCHAR) AS tenure,
  phone AS PhoneService,
  CASE WHEN phone = 'No' THEN 'No phone service' WHEN n_orders >= 10 THEN 'Yes' ELSE 'No' END
    AS MultipleLines,
  internet AS InternetService,
  {_addon('online_security')} AS OnlineSecurity, {_addon('online_backup')} AS OnlineBackup,
  {_addon('device_protection')} AS DeviceProtection, {_addon('tech_support')} AS TechSupport,
  {_addon('streaming_tv')} AS StreamingTV, {_addon('streaming_movies')} AS StreamingMovies,
  contract AS Contract, CASE WHEN nk % 3 = 0 THEN 'No' ELSE 'Yes' END AS PaperlessBilling,
  CASE WHEN copy = 1 THEN 'Mailed check'
       ELSE COALESCE({case_map('priority', _PRIORITY)}, 'Mailed check') END AS PaymentMethod,
  {cents_text('monthly_cents')} AS MonthlyCharges,
  CASE WHEN copy = 1 THEN '0' WHEN n_orders IS NULL THEN ' '
       WHEN status = 'P' AND nk % 5 = 0 THEN 'n/a' WHEN nk = 24 THEN ''
       ELSE {cents_text('total_cents')} END AS TotalCharges,
  CASE WHEN last_order >= TIMESTAMP '2000-08-01 00:00:00' THEN 'No' ELSE 'Yes' END AS Churn
FROM feed_base CROSS JOIN (VALUES (0), (1)) v(copy) WHERE copy = 0 OR status = 'P'"""

CTES["trimmed"] = "SELECT feed_seq, " + ", ".join(
    f"TRIM({raw}, {WS}) AS {name}" for raw, name in K.RAW_TO_CONFORMED.items()) + " FROM raw_feed"

CTES["deduped"] = """
SELECT * FROM trimmed
QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY feed_seq) = 1"""

CTES["typed"] = f"""
SELECT * REPLACE (
    CAST(COALESCE(trunc({number('tenure_months')}), 0) AS INTEGER) AS tenure_months,
    {number('monthly_charges')} AS monthly_charges),
  total_charges AS total_text, {number('total_charges')} AS total_number
FROM deduped"""

CTES["clean"] = "SELECT " + ", ".join({
    "senior_citizen": """CASE WHEN senior_citizen IN ('0', '0.0', 'No') THEN 'No'
        WHEN senior_citizen IN ('1', '1.0', 'Yes') THEN 'Yes' END AS senior_citizen""",
    "total_charges": """COALESCE(CASE WHEN total_number IS NULL AND tenure_months = 0 THEN 0e0
        ELSE total_number END, monthly_charges * tenure_months) AS total_charges""",
}.get(c, c) for c in K.RAW_TO_CONFORMED.values()) + """,
  CASE WHEN churn = 'Yes' THEN 1 ELSE 0 END AS churn_flag FROM typed"""

CTES["kpi_events"] = f"""
SELECT user_id, CAST(least(((day(ts) - 1) * 12) // 30 + 1, 12) AS INTEGER) AS month_index,
       event_type, value, {units('value', 2)} AS cents FROM events"""

CTES["kpis"] = f"""
SELECT 'C' || CAST(user_id AS VARCHAR) AS customer_id,
  '2025-' || lpad(CAST(month_index AS VARCHAR), 2, '0') AS month, month_index,
  {rhe("COUNT(*) FILTER (event_type = 'error') * 10e0 / COUNT(*)", 3)} AS dropped_call_pct,
  {rhe("SUM(cents) FILTER (event_type = 'view') / CAST(NULLIF(COUNT(*) FILTER (event_type = 'view'), 0) * 100 AS DOUBLE)", 1)} AS avg_download_mbps,
  {rhe("SUM(cents) FILTER (event_type = 'click') / CAST(NULLIF(COUNT(*) FILTER (event_type = 'click'), 0) * 100 AS DOUBLE)", 1)} AS avg_latency_ms,
  CAST(COALESCE(SUM(cents) FILTER (event_type = 'error'), 0) // 400 AS BIGINT) AS outage_minutes,
  {rhe("SUM(cents) / 100e0", 1)} AS data_usage_gb,
  CAST(COUNT(*) FILTER (event_type = 'error' AND value > 100) AS BIGINT) AS complaints
FROM kpi_events GROUP BY user_id, month_index"""

CTES["order_lines"] = f"""
SELECT l_orderkey, COUNT(*) AS lines,
       SUM({units('l_extendedprice', 2)} * (100 - {units('l_discount', 2)})) AS net,
       COUNT(*) FILTER (l_returnflag = 'R') AS returned
FROM lineitem GROUP BY l_orderkey"""

CTES["monthly"] = f"""
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
  {_month_text('month_ordinal')} AS month,
  CAST(((month_ordinal - 1) // 12) * 100 + (month_ordinal - 1) % 12 + 1 AS INTEGER) AS month_key,
  CAST(month_ordinal AS INTEGER) AS month_ordinal,
  CAST(SUM(lines) AS BIGINT) AS lines, CAST(SUM(returned) AS BIGINT) AS outage_minutes,
  CAST(SUM(net) AS DOUBLE) / 10000e0 AS revenue
FROM (SELECT *, {MONTH_NO} AS month_ordinal FROM orders JOIN order_lines ON o_orderkey = l_orderkey)
GROUP BY o_custkey, month_ordinal"""

_yes = " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in K.ADDONS)
CTES["service_feat"] = f"""
SELECT *,
  CASE WHEN tenure_months > 72 THEN '49-72 months'
       {" ".join(f"WHEN tenure_months BETWEEN {lo} AND {hi} THEN '{b}'" for lo, hi, b in K.TENURE_BUCKETS)}
       ELSE '00-12 months' END AS tenure_bucket,
  CAST({_yes} AS INTEGER) AS num_addon_services,
  CASE WHEN internet_service IS DISTINCT FROM 'No' THEN 1 ELSE 0 END AS has_internet,
  CASE WHEN phone_service = 'Yes' THEN 1 ELSE 0 END AS has_phone,
  CASE WHEN streaming_tv = 'Yes' OR streaming_movies = 'Yes' THEN 1 ELSE 0 END AS has_streaming,
  CASE WHEN payment_method ILIKE '%automatic%' THEN 1 ELSE 0 END AS is_auto_payment,
  CASE WHEN contract = 'Month-to-month' THEN 1 ELSE 0 END AS is_month_to_month,
  {rhe(f"CASE WHEN tenure_months > 0 THEN {div('total_charges', 'tenure_months')} ELSE monthly_charges END", 2)} AS lifetime_avg_monthly
FROM clean"""

CTES["charge_edges"] = """
SELECT quantile_cont(monthly_charges, 0.0) AS e0, quantile_cont(monthly_charges, 0.25) AS e1,
       quantile_cont(monthly_charges, 0.5) AS e2, quantile_cont(monthly_charges, 0.75) AS e3,
       quantile_cont(monthly_charges, 1.0) AS e4 FROM clean"""

CTES["cust_feat"] = f"""
SELECT s.*, COALESCE({rhe(div('monthly_charges', 'lifetime_avg_monthly'), 3)}, 1e0) AS charge_ratio,
  CASE WHEN NOT (e0 < e1 AND e1 < e2 AND e2 < e3 AND e3 < e4) THEN 'Mid'
       WHEN monthly_charges IS NULL THEN NULL WHEN monthly_charges <= e1 THEN 'Low'
       WHEN monthly_charges <= e2 THEN 'Mid' WHEN monthly_charges <= e3 THEN 'High'
       ELSE 'Premium' END AS revenue_band
FROM service_feat s CROSS JOIN charge_edges"""

_late = "month_index > 9"


def _late_avg(c: str) -> str:
    return ravg(f"CASE WHEN {_late} THEN {c} END")


def _late_sum(c: str) -> str:
    return (f"CASE WHEN COUNT(*) FILTER ({_late}) > 0 "
            f"THEN CAST(COALESCE(SUM({c}) FILTER ({_late}), 0) AS BIGINT) END")


CTES["kpi_raw"] = f"""
SELECT customer_id, COUNT(month_index) AS kpi_months,
  {ravg('dropped_call_pct')} AS avg_dropped_call_pct,
  {ravg('avg_download_mbps')} AS avg_download_mbps, {ravg('avg_latency_ms')} AS avg_latency_ms,
  CAST(COALESCE(SUM(outage_minutes), 0) AS BIGINT) AS total_outage_minutes,
  {ravg('data_usage_gb')} AS avg_data_usage_gb,
  CAST(COALESCE(SUM(complaints), 0) AS BIGINT) AS network_complaints,
  {_late_avg('dropped_call_pct')} AS l3m_dropped_call_pct,
  {_late_avg('avg_download_mbps')} AS l3m_download_mbps,
  {_late_avg('avg_latency_ms')} AS l3m_latency_ms,
  {_late_sum('outage_minutes')} AS l3m_outage_minutes, {_late_sum('complaints')} AS l3m_complaints
FROM kpis GROUP BY customer_id"""

CTES["kpi_trend"] = f"""
SELECT *, {rhe('l3m_dropped_call_pct - avg_dropped_call_pct', 3)} AS dropped_call_trend_pp,
  {rhe(f"({div('l3m_latency_ms', 'avg_latency_ms')} - 1) * 100", 1)} AS latency_trend_pct,
  {rhe(f"({div('l3m_download_mbps', 'avg_download_mbps')} - 1) * 100", 1)} AS download_trend_pct
FROM kpi_raw"""

_means = ["avg_dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "avg_data_usage_gb",
          "l3m_dropped_call_pct", "l3m_download_mbps", "l3m_latency_ms"]
CTES["kpi_agg"] = ("SELECT * REPLACE (" + ", ".join(f"{rhe(c, 2)} AS {c}" for c in _means)
                   + ") FROM kpi_trend")

CTES["joined_feat"] = """
SELECT c.*, COALESCE(a.kpi_months, 0) AS kpi_months,
  COALESCE(a.network_complaints, 0) AS network_complaints,
  a.* EXCLUDE (customer_id, kpi_months, network_complaints)
FROM cust_feat c LEFT JOIN kpi_agg a ON a.customer_id = c.customer_id"""

CTES["peer_median"] = """
SELECT internet_service AS peer, median(avg_latency_ms) AS median_latency,
       median(avg_download_mbps) AS median_speed
FROM joined_feat WHERE internet_service IS NOT NULL GROUP BY internet_service"""

CTES["peer_ratio"] = f"""
SELECT j.*, {div('avg_latency_ms', 'median_latency')} AS latency_ratio,
  {div('avg_download_mbps', 'median_speed')} AS speed_ratio
FROM joined_feat j LEFT JOIN peer_median ON peer = internet_service"""

_parts = [_score(c, lo, hi, up) for c, (lo, hi, up) in K.QUALITY_COMPONENTS.items()]
_total = " + ".join(f"COALESCE({p}, 0e0)" for p in _parts)
_present = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in K.QUALITY_COMPONENTS)
CTES["quality_raw"] = f"""
SELECT *, {rhe(f"({_total}) / NULLIF(CAST({_present} AS DOUBLE), 0e0) * 100", 1)} AS raw_score
FROM peer_ratio"""

CTES["features"] = """
SELECT * EXCLUDE (raw_score, latency_ratio, speed_ratio),
  CASE WHEN kpi_months > 0 THEN raw_score END AS network_quality_score,
  CASE WHEN kpi_months = 0 THEN 'No telemetry' WHEN raw_score <= -0.1 THEN NULL
       WHEN raw_score <= 55 THEN 'Poor' WHEN raw_score <= 70 THEN 'Fair'
       WHEN raw_score <= 82 THEN 'Good' WHEN raw_score <= 100.1 THEN 'Excellent'
       END AS network_quality_band
FROM quality_raw"""

_z = ("-1e0 + 1.2e0 * is_month_to_month - 0.02e0 * tenure_months - 0.15e0 * num_addon_services "
      "+ 0.01e0 * monthly_charges "
      "+ 0.3e0 * CASE WHEN payment_method = 'Electronic check' THEN 1 ELSE 0 END")
CTES["scored_p"] = f"SELECT *, {rhe(f'1e0 / (1e0 + exp(-({_z})))', 4)} AS churn_probability FROM features"
CTES["scored"] = """
SELECT *, CASE WHEN churn_probability >= 0 AND churn_probability < 0.2e0 THEN 'Low'
  WHEN churn_probability >= 0.2e0 AND churn_probability < 0.5e0 THEN 'Medium'
  WHEN churn_probability >= 0.5e0 AND churn_probability < 1.01e0 THEN 'High'
  WHEN churn_probability IS NOT NULL THEN 'High' END AS risk_band FROM scored_p"""


def _dim(columns: list[str], key: str) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    cols = ", ".join(columns)
    return (f"SELECT ROW_NUMBER() OVER (ORDER BY {order}) AS {key}, {cols} "
            f"FROM (SELECT DISTINCT {cols} FROM scored)")


CTES["dim_customer"] = _dim(K.CUSTOMER_DIM, "customer_key")
CTES["dim_contract"] = _dim(K.CONTRACT_DIM, "contract_key")
CTES["dim_services"] = _dim(K.SERVICES_DIM, "services_key")


def date_dim(source: str) -> str:
    return f"""
SELECT CAST(y * 100 + mo AS INTEGER) AS month_key, month, y AS year, mo AS month_number,
  strftime(make_date(y, mo, 1), '%b') AS month_name,
  'Q' || CAST((mo - 1) // 3 + 1 AS VARCHAR) AS quarter, make_date(y, mo, 1) AS month_start_date,
  ROW_NUMBER() OVER (ORDER BY month) AS month_index,
  COUNT(*) OVER () - ROW_NUMBER() OVER (ORDER BY month) AS months_before_snapshot
FROM (SELECT DISTINCT month, CAST(substr(month, 1, 4) AS INTEGER) AS y,
             CAST(substr(month, 6, 2) AS INTEGER) AS mo FROM {source})"""


CTES["dim_date"] = date_dim("kpis")
CTES["fact_customer"] = (
    "SELECT d.customer_key, c.contract_key, s.services_key, f.customer_id, "
    + ", ".join(f"f.{m}" for m in K.FACT_MEASURES)
    + " FROM scored f JOIN dim_customer d ON d.customer_id = f.customer_id JOIN dim_contract c ON "
    + " AND ".join(f"c.{x} IS NOT DISTINCT FROM f.{x}" for x in K.CONTRACT_DIM)
    + " JOIN dim_services s ON "
    + " AND ".join(f"s.{x} IS NOT DISTINCT FROM f.{x}" for x in K.SERVICES_DIM))
CTES["fact_network_monthly"] = (
    "SELECT d.customer_key, dd.month_key, " + ", ".join(f"k.{c}" for c in K.TELEMETRY_COLUMNS)
    + " FROM kpis k JOIN dim_customer d ON d.customer_id = k.customer_id"
    + " JOIN dim_date dd ON dd.month = k.month")


def checks_sql(customers: str = "features", kpis: str = "kpis", run_ts: str = "",
               expected: str | None = None, parent: str | None = None) -> str:
    """The 43 gate checks as one UNION ALL."""
    rows: list[str] = []

    def add(name: str, table: str, status: str, observed: str, expectation: str,
            details: str = "''", source: str = "") -> None:
        rows.append(f"SELECT {len(rows) + 1} AS seq, '{run_ts}' AS run_ts, '{name}' AS check_name, "
                    f"'{table}' AS \"table\", {status} AS status, {observed} AS observed, "
                    f"{expectation} AS expectation, {details} AS details FROM {source}")

    def lit(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def zero(name: str, table: str, metric: str, unit: str, expectation: str, severity: str,
             source: str, details: str = "''") -> None:
        add(name, table, f"CASE WHEN n = 0 THEN 'PASS' ELSE '{severity}' END",
            f"CAST(n AS VARCHAR) || ' {unit}'", lit(expectation), details,
            f"(SELECT CAST({metric} AS BIGINT) AS n FROM {source})")

    t = "customers"
    if expected is None:
        add("row_count", t, "'PASS'", "CAST(n AS VARCHAR)", "'> 0'",
            "'no expected count configured'", f"(SELECT COUNT(*) AS n FROM {customers})")
    else:
        add("row_count", t, f"CASE WHEN n = {expected} THEN 'PASS' ELSE 'WARN' END",
            "CAST(n AS VARCHAR)", f"'== ' || CAST({expected} AS VARCHAR)",
            f"CASE WHEN n = {expected} THEN '' ELSE 'row count differs from the published dataset size' END",
            f"(SELECT COUNT(*) AS n FROM {customers})")

    def unique(table: str, source: str, key: list[str]) -> None:
        zero("unique_" + "_".join(key), table, "COALESCE(SUM(c - 1), 0)", "duplicates",
             "0 duplicates", "FAIL",
             f"(SELECT COUNT(*) AS c FROM {source} GROUP BY {', '.join(key)})")

    unique(t, customers, ["customer_id"])
    for c in ["customer_id", "tenure_months", "monthly_charges", "total_charges", "churn_flag",
              "contract"]:
        zero(f"not_null_{c}", t, f"COUNT(*) FILTER ({c} IS NULL)", "nulls", "0 nulls", "FAIL",
             customers)
    for c, allowed in K.DOMAINS.items():
        inside = ", ".join(f"'{a}'" for a in allowed)
        bad = (f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {customers} "
               f"WHERE {c} IS NOT NULL AND {c} NOT IN ({inside}))")
        add(f"domain_{c}", t, "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END",
            "CAST(n AS VARCHAR) || ' unknown values'", lit(f"subset of {sorted(allowed)}"),
            "COALESCE(array_to_string(list_sort(l)[1:10], ', '), '')",
            f"(SELECT COUNT(*) AS n, list(v) AS l FROM {bad})")

    def rng(table: str, source: str, c: str, lo, hi, severity: str) -> None:
        zero(f"range_{c}", table, f"COUNT(*) FILTER ({c} < {lo} OR {c} > {hi})", "outside",
             f"[{lo}, {hi}]", severity, source)

    for c in ("tenure_months", "monthly_charges", "total_charges"):
        rng(t, customers, c, *K.RANGES[c], "FAIL")
    rng(t, customers, "churn_flag", 0, 1, "FAIL")
    add("reconcile_total_vs_monthly_x_tenure", t,
        "CASE WHEN s <= 0.05e0 THEN 'PASS' ELSE 'WARN' END",
        "printf('%.1f%%', s * 100) || ' rows deviate > 50%'", "'<= 5% rows'",
        "'large deviations usually mean plan changes, not bad data'",
        f"(SELECT COALESCE(AVG(CASE WHEN abs(total_charges - monthly_charges * tenure_months) "
        f"/ NULLIF(monthly_charges * tenure_months, 0) > 0.5 THEN 1e0 ELSE 0e0 END), 0e0) AS s "
        f"FROM {customers} WHERE tenure_months > 0)")
    add("churn_rate_plausible", t,
        "CASE WHEN s BETWEEN 0.1e0 AND 0.45e0 THEN 'PASS' ELSE 'WARN' END",
        "printf('%.1f%%', s * 100)", "'between 10% and 45%'", "''",
        f"(SELECT COALESCE(AVG(churn_flag), 0e0) AS s FROM {customers})")

    t = "network_kpis_monthly"
    unique(t, kpis, ["customer_id", "month"])
    for c in ("customer_id", "month", "month_index"):
        zero(f"not_null_{c}", t, f"COUNT(*) FILTER ({c} IS NULL)", "nulls", "0 nulls", "FAIL", kpis)
    zero("fk_customer_id_exists", t,
         f"COUNT(*) FILTER (customer_id IS NULL OR customer_id NOT IN "
         f"(SELECT customer_id FROM {parent or customers} WHERE customer_id IS NOT NULL))",
         "orphan rows", "0 orphans", "FAIL", kpis,
         "'every KPI row must belong to a known customer'")
    rng(t, kpis, "month_index", 1, 12, "FAIL")
    for c in ("dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "outage_minutes",
              "data_usage_gb", "complaints"):
        rng(t, kpis, c, *K.RANGES[c], "WARN")
    return " UNION ALL ".join(rows)


CTES["dq"] = checks_sql(run_ts="2001-08-01T00:00:00Z")

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def with_stages(body: str) -> str:
    """Prefix the stages a query refers to, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in needed:
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    return f"WITH {parts}\n{body}"
