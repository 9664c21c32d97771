"""Q, D and U1-U3: quality gate, dimensional model and score refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import CTES, big, checks_sql, div, pct, xavg
from holdfast.functions.columns import round_even
from holdfast.operators import membership
from holdfast.operators import quality as Q
from holdfast.operators import star as S
from holdfast.operators import upsert as U
from holdfast.plans import bindings
from holdfast.plans.measures import dq_measures, evaluate
from holdfast.sources import readers, writers
from holdfast.session import cut
from holdfast.sources.versioned import Versioned, bucket_of
from holdfast.streaming import score_refresh

RUN_TS = "2001-08-01T00:00:00Z"
COLS = 'check_name, "table", status, observed, expectation, details'


def checks(s: Source, rules: list) -> DataFrame:
    frames = {"customers": s.m.features, "network_kpis_monthly": s.m.kpis}
    used = {r.table for r in rules}
    return Q.run_checks({n: f for n, f in frames.items() if n in used or n == "customers"},
                        rules, RUN_TS).select(*Q.RESULT_COLUMNS)


def named(*patterns: str) -> str:
    cond = " OR ".join(f"check_name LIKE '{p}'" for p in patterns)
    return f"SELECT {COLS} FROM dq WHERE {cond}"


def of_kind(kind: type) -> list:
    return [r for r in Q.customer_rules() + Q.telemetry_rules() if isinstance(r, kind)]


add("q01_row_count", lambda s: checks(s, [Q.RowCount("customers", s.t("customer").count())]), f"""
SELECT {COLS} FROM ({checks_sql(expected='(SELECT COUNT(*) FROM customer)')}) WHERE check_name = 'row_count'""")
add("q01b_row_count_warns", lambda s: checks(s, [Q.RowCount("customers", s.t("customer").count() + 1)]), f"""
SELECT {COLS} FROM ({checks_sql(expected='(SELECT COUNT(*) + 1 FROM customer)')})
WHERE check_name = 'row_count'""")
add("q02_unique_key", lambda s: checks(s, of_kind(Q.UniqueKey)), named("unique%"))


def lineitem_unique(s: Source) -> DataFrame:
    return Q.run_checks({"lineitem": s.t("lineitem")},
                        [Q.UniqueKey("lineitem", ("l_orderkey", "l_linenumber"))], RUN_TS).select(
        "check_name", "status", "observed")


add("q02b_unique_key_fails", lineitem_unique, """
SELECT 'unique_l_orderkey_l_linenumber' AS check_name, 'FAIL' AS status,
  CAST(CAST(SUM(c - 1) AS BIGINT) AS VARCHAR) || ' duplicates' AS observed
FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")


def orders_of_lines(s: Source) -> DataFrame:
    """Line items without their order: urgent orders are left out of the parent."""
    return membership.orphan_keys(s.t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
                                  s.t("orders").where("o_orderpriority <> '1-URGENT'"), ["o_orderkey"], "lines")


add("q02c_repeated_keys", lambda s: membership.repeated_keys(s.t("lineitem"), ["l_orderkey", "l_linenumber"], "lines"), """
SELECT l_orderkey, l_linenumber, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
add("q02d_key_of_one_day", lambda s: membership.repeated_keys(s.t("events").select(
    F.unix_date(F.to_date("ts")).alias("day"), "user_id"), ["day", "user_id"], "events"), """
SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) :: INTEGER AS day, user_id, COUNT(*) AS events
FROM events GROUP BY 1, 2 HAVING COUNT(*) > 1""")
add("q06b_orphan_keys", orders_of_lines, """
SELECT l_orderkey AS o_orderkey, COUNT(*) AS lines FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')
GROUP BY 1""")
add("q03_not_null", lambda s: checks(s, of_kind(Q.NotNull)), named("not_null%"))


def absent_column(s: Source) -> DataFrame:
    rules = [Q.NotNull("kpis", "no_such_column"), Q.NotNull("kpis", "avg_latency_ms")]
    return Q.run_checks({"kpis": s.m.kpis}, rules, RUN_TS).select("check_name", "status", "observed")


add("q03b_not_null_absent_column", absent_column, """
SELECT 'not_null_no_such_column' AS check_name, 'FAIL' AS status,
  CAST(COUNT(*) AS VARCHAR) || ' nulls' AS observed FROM kpis
UNION ALL SELECT 'not_null_avg_latency_ms', 'FAIL',
  CAST(COUNT(*) FILTER (avg_latency_ms IS NULL) AS VARCHAR) || ' nulls' FROM kpis""")
add("q04_domain", lambda s: checks(s, of_kind(Q.OneOf)), named("domain%"))


def many_unknown(s: Source) -> DataFrame:
    """More unknown values than are listed."""
    rules = [Q.OneOf("orders", "o_orderdate", ("1995-01-01 00:00:00",))]
    days = s.t("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    return Q.run_checks({"orders": days}, rules, RUN_TS).select("check_name", "status", "observed",
                                                                "details")


add("q04b_domain_many_unknown", many_unknown, """
SELECT 'domain_o_orderdate' AS check_name, 'FAIL' AS status,
  CAST(COUNT(*) AS VARCHAR) || ' unknown values' AS observed,
  array_to_string(list_sort(list(d))[1:10], ', ') AS details
FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)""")
add("q05_range", lambda s: checks(s, of_kind(Q.InRange)), named("range%"))


def orphan_check(s: Source) -> DataFrame:
    known = s.m.features.where("contract <> 'Two year'")
    return Q.run_checks({"network_kpis_monthly": s.m.kpis, "customers": known},
                        [Q.ForeignKey("network_kpis_monthly", "customer_id", "customers")],
                        RUN_TS).select(*Q.RESULT_COLUMNS)


add("q06_referential", orphan_check, f"""
SELECT {COLS} FROM ({checks_sql(parent="(SELECT * FROM features WHERE contract <> 'Two year')")})
WHERE check_name LIKE 'fk%'""")
add("q07_reconciliation", lambda s: checks(s, of_kind(Q.TotalsReconcile)), named("reconcile%"))
add("q08_rate_plausible", lambda s: checks(s, of_kind(Q.ChurnRatePlausible)),
    named("churn_rate_plausible"))


def results(s: Source) -> DataFrame:
    return Q.quality_results(s.m.features, s.m.kpis, run_ts=RUN_TS)


add("q09_quality_gate", lambda s: results(s).withColumn("seq", F.col("seq").cast("int")),
    f"SELECT seq, run_ts, {COLS} FROM dq")
add("q10_status_summary", lambda s: Q.status_counts(results(s)),
    "SELECT status, COUNT(*) AS checks FROM dq GROUP BY status")
add("q10b_status_label", lambda s: evaluate(results(s), dq_measures()), f"""
SELECT COUNT(*) FILTER (status = 'PASS') AS dq_checks_passed, COUNT(*) AS dq_checks_total,
  {div("COUNT(*) FILTER (status = 'PASS')", "COUNT(*)")} AS dq_pass_rate,
  CASE WHEN COUNT(*) FILTER (status = 'FAIL') > 0 THEN '❌ FAIL'
       WHEN COUNT(*) FILTER (status = 'WARN') > 0 THEN '⚠ WARN' ELSE '✅ PASS' END
    AS dq_status_label FROM dq""")
add("q11_not_passed", lambda s: Q.not_passed(results(s)),
    'SELECT check_name, "table", status, observed, expectation FROM dq WHERE status <> \'PASS\'')


def two_runs(s: Source) -> DataFrame:
    older = Q.run_checks({"customers": s.m.features}, Q.customer_rules(), "2001-07-01T00:00:00Z")
    return Q.latest_run(older.unionByName(results(s))).select("run_ts", *Q.RESULT_COLUMNS)


add("q12_latest_run", two_runs, f"SELECT run_ts, {COLS} FROM dq")


def schema_constraints(s: Source) -> DataFrame:
    """Primary, unique, not-null and foreign key constraints of the star as rules."""
    t = {n: s.star[n] for n in ("dim_customer", "dim_contract", "fact_customer",
                                "fact_network_monthly")}
    rules = [
        Q.UniqueKey("dim_customer", ("customer_key",)), Q.UniqueKey("dim_customer", ("customer_id",)),
        Q.NotNull("dim_customer", "tenure_bucket"), Q.UniqueKey("dim_contract", ("contract_key",)),
        Q.UniqueKey("fact_customer", ("customer_key",)), Q.NotNull("fact_customer", "churn_flag"),
        Q.ForeignKey("fact_customer", "customer_key", "dim_customer", ""),
        Q.ForeignKey("fact_customer", "contract_key", "dim_contract", ""),
        Q.UniqueKey("fact_network_monthly", ("customer_key", "month_key")),
        Q.ForeignKey("fact_network_monthly", "customer_key", "dim_customer", "")]
    return Q.run_checks(t, rules, RUN_TS).select("table", "check_name", "status", "observed")


def _constraint_sql() -> str:
    def dup(t: str, cols: list[str]) -> str:
        return (f"SELECT '{t}' AS \"table\", 'unique_{'_'.join(cols)}' AS check_name, n, "
                f"'duplicates' AS unit FROM (SELECT COALESCE(SUM(c - 1), 0) AS n FROM (SELECT "
                f"COUNT(*) AS c FROM {t} GROUP BY {', '.join(cols)}))")

    def nulls(t: str, c: str) -> str:
        return (f"SELECT '{t}', 'not_null_{c}', COUNT(*) FILTER ({c} IS NULL), 'nulls' FROM {t}")

    def fk(t: str, c: str, p: str) -> str:
        return (f"SELECT '{t}', 'fk_{c}_exists', COUNT(*) FILTER (p.{c} IS NULL), 'orphan rows' "
                f"FROM {t} c LEFT JOIN {p} p ON p.{c} = c.{c}")

    parts = [dup("dim_customer", ["customer_key"]), dup("dim_customer", ["customer_id"]),
             nulls("dim_customer", "tenure_bucket"), dup("dim_contract", ["contract_key"]),
             dup("fact_customer", ["customer_key"]), nulls("fact_customer", "churn_flag"),
             fk("fact_customer", "customer_key", "dim_customer"),
             fk("fact_customer", "contract_key", "dim_contract"),
             dup("fact_network_monthly", ["customer_key", "month_key"]),
             fk("fact_network_monthly", "customer_key", "dim_customer")]
    return (f"SELECT \"table\", check_name, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"CAST({big('n')} AS VARCHAR) || ' ' || unit AS observed FROM ("
            + " UNION ALL ".join(parts) + ")")


add("q13_schema_constraints", schema_constraints, _constraint_sql())
def blank_months(s: Source) -> DataFrame:
    """A blank cell of a column with a default takes the default on load."""
    fact = s.star["fact_customer"].withColumn("kpi_months", F.when(F.col("churn_flag") == 0, F.col("kpi_months")))
    path = writers.write_csv(fact, s.scratch("defaults"))
    return readers.typed_load(s.spark, path, "fact_customer").select("customer_id", "kpi_months")


add("q13b_default_on_load", blank_months, """
SELECT customer_id, CAST(CASE WHEN churn_flag = 0 THEN COALESCE(kpi_months, 0) ELSE 0 END AS INTEGER) AS kpi_months
FROM fact_customer""")


def _reconciled_sql(where: str) -> str:
    return f"""
SELECT 'dim_customer' AS tbl, COUNT(*) AS rows_ FROM dim_customer WHERE {where}
UNION ALL SELECT 'fact_customer', COUNT(*) FROM fact_customer
UNION ALL SELECT 'fact_network_monthly', COUNT(*) FROM fact_network_monthly
UNION ALL SELECT 'orphan_network_rows', COUNT(*) FROM fact_network_monthly n
  LEFT JOIN (SELECT * FROM dim_customer WHERE {where}) d
    ON d.customer_key = n.customer_key WHERE d.customer_key IS NULL"""


add("q14_load_reconciliation", lambda s: Q.load_reconciliation(s.star), _reconciled_sql("true"))
add("q14b_reconciliation_finds_orphans", lambda s: Q.load_reconciliation(
    {**s.star, "dim_customer": s.star["dim_customer"].where("gender = 'Male'")}),
    _reconciled_sql("gender = 'Male'"))

# -- dimensional model ------------------------------------------------------------------

add("d01_dim_customer", lambda s: S.surrogate_dim(s.m.scored, K.CUSTOMER_DIM, "customer_key"),
    CTES["dim_customer"])


def second_load(s: Source) -> DataFrame:
    """First load without the two-year contracts and with another gender; the second one holds every customer."""
    first = S.surrogate_dim(s.m.scored.where("contract <> 'Two year'").withColumn("gender", F.lit("?")),
                            K.CUSTOMER_DIM, "customer_key")
    return S.lasting_dim(s.m.scored, K.CUSTOMER_DIM, "customer_key", cut(first), ["customer_id"])


def numbered(columns: list[str], key: str, natural: str, condition: str) -> str:
    """Two loads: the members of the first in order, then the others in order."""
    order = ", ".join(f"{c} NULLS LAST" for c in columns)
    cols = ", ".join(columns)
    return f"""
SELECT ROW_NUMBER() OVER (ORDER BY {natural} NOT IN (SELECT {natural} FROM scored WHERE {condition}),
    {order}) AS {key}, {cols} FROM (SELECT DISTINCT {cols} FROM scored)"""


add("d01d_lasting_customer_keys", second_load, numbered(
    ["customer_id", *K.CUSTOMER_DIM[1:]], "customer_key", "customer_id", "contract <> 'Two year'"))


def third_load(s: Source) -> DataFrame:
    """Three loads of a dimension known by all its columns; members of the first two are not in the last one."""
    load = lambda where, before: cut(S.lasting_dim(s.m.scored.where(where), K.CONTRACT_DIM, "contract_key", before))
    return load("contract = 'Two year'", load("contract = 'One year'", load("contract = 'Month-to-month'", None)))


add("d01e_lasting_contract_keys", third_load, f"""
SELECT ROW_NUMBER() OVER (ORDER BY CASE contract WHEN 'Month-to-month' THEN 1 WHEN 'One year' THEN 2 ELSE 3 END,
  {", ".join(f"{c} NULLS LAST" for c in K.CONTRACT_DIM)}) AS contract_key, {", ".join(K.CONTRACT_DIM)}
FROM (SELECT DISTINCT {", ".join(K.CONTRACT_DIM)} FROM scored)""")
add("d01b_dim_contract", lambda s: S.surrogate_dim(s.m.scored, K.CONTRACT_DIM, "contract_key"),
    CTES["dim_contract"])
add("d01c_dim_services", lambda s: S.surrogate_dim(s.m.scored, K.SERVICES_DIM, "services_key"),
    CTES["dim_services"])
add("d02_dim_date", lambda s: S.date_dim(s.m.kpis), CTES["dim_date"])
add("d03_fact_customer", lambda s: S.customer_fact(
    s.m.scored, s.star["dim_customer"], s.star["dim_contract"], s.star["dim_services"]),
    CTES["fact_customer"])
add("d04_fact_network_monthly", lambda s: S.monthly_fact(
    s.m.kpis, s.star["dim_customer"], s.star["dim_date"]), CTES["fact_network_monthly"])

wide = ["customer_key", *K.CUSTOMER_DIM, *K.CONTRACT_DIM, *K.SERVICES_DIM, "monthly_charges",
        "total_charges", "lifetime_avg_monthly", "charge_ratio", "revenue_band", "churn",
        "churn_flag", "churn_probability", "risk_band", "kpi_months", "avg_dropped_call_pct",
        "avg_download_mbps", "avg_latency_ms", "total_outage_minutes", "network_complaints",
        "network_quality_score", "network_quality_band", "dropped_call_trend_pp",
        "latency_trend_pct", "download_trend_pct"]
add("d05_customer_360", lambda s: S.customer_360(s.star), "SELECT " + ", ".join(
    f"f.{c}" if c != "customer_key" else "d.customer_key" for c in wide)
    + " FROM scored f JOIN dim_customer d ON d.customer_id = f.customer_id")
add("d06_network_monthly", lambda s: S.network_monthly(s.star), """
SELECT n.customer_key, n.month_key, d.month, d.month_start_date, d.month_index,
  d.months_before_snapshot, f.churn_flag, s.internet_service, n.dropped_call_pct,
  n.avg_download_mbps, n.avg_latency_ms, n.outage_minutes, n.data_usage_gb, n.complaints
FROM fact_network_monthly n JOIN dim_date d ON d.month_key = n.month_key
JOIN fact_customer f ON f.customer_key = n.customer_key
JOIN dim_services s ON s.services_key = f.services_key""")

# -- score refresh ----------------------------------------------------------------------


def stale_target(s: Source) -> DataFrame:
    """Fact whose scores are missing for cheap customers, old for dear ones, else current."""
    band, p = F.col("revenue_band"), F.col("churn_probability")
    return s.star["fact_customer"].withColumns({
        "churn_probability": F.when(band == "Premium", round_even(p / 2, 4)).when(band != "Low", p),
        "risk_band": F.when(band == "Premium", "Low").when(band != "Low", F.col("risk_band"))})


def updates(s: Source) -> DataFrame:
    """Scores of the customers who have internet."""
    return s.m.scored.where("has_internet = 1").select("customer_id", "churn_probability",
                                                       "risk_band")


MERGED = """
SELECT customer_id, CASE WHEN changed THEN new_p ELSE old_p END AS churn_probability,
  CASE WHEN changed THEN new_b ELSE old_b END AS risk_band, changed
FROM (SELECT *, COALESCE(matched AND (old_p IS NULL OR old_p <> new_p OR old_b <> new_b), false)
        AS changed
  FROM (SELECT customer_id, has_internet = 1 AS matched, churn_probability AS new_p,
          risk_band AS new_b,
          CASE WHEN revenue_band = 'Premium' THEN round_even(churn_probability / 2 * 1e4, 0) / 1e4
               WHEN revenue_band <> 'Low' THEN churn_probability END AS old_p,
          CASE WHEN revenue_band = 'Premium' THEN 'Low'
               WHEN revenue_band <> 'Low' THEN risk_band END AS old_b FROM scored))"""


def merged(s: Source) -> DataFrame:
    return U.merge_scores(stale_target(s), updates(s))


add("u01_merge_scores", lambda s: merged(s).select("customer_id", *U.SCORE_COLUMNS, "changed"),
    MERGED)
add("u02_change_counts", lambda s: U.change_counts(merged(s)),
    f"SELECT 'UPDATE' AS action_taken, COUNT(*) AS rows_affected FROM ({MERGED}) WHERE changed")
add("u03_band_monotonicity", lambda s: U.band_monotonicity(s.m.scored), f"""
SELECT *, COALESCE(actual_churn_rate_pct <= LAG(actual_churn_rate_pct) OVER
    (ORDER BY avg_predicted DESC), true) AS monotonic
FROM (SELECT risk_band, COUNT(*) AS customers,
        {pct('SUM(churn_flag)', 'COUNT(*)')} AS actual_churn_rate_pct,
        {xavg('churn_probability', 4)} AS avg_predicted FROM scored GROUP BY risk_band)""")


def streamed_refresh(s: Source) -> DataFrame:
    """The same MERGE, fed by a file stream that runs until its input is used up."""
    root, feed = s.scratch("versions"), s.scratch("updates")
    table = Versioned.create(stale_target(s).select("customer_id", *U.SCORE_COLUMNS), root, "customer_id", 8)
    updates(s).withColumn("scored_at", F.lit(1)).write.parquet(feed)
    stream = s.spark.readStream.schema(
        "customer_id string, churn_probability double, risk_band string, scored_at int").parquet(feed)
    score_refresh.refresh(stream, root, s.scratch("progress")).start().awaitTermination()
    return table.read()


add("u01b_streamed_score_refresh", streamed_refresh,
    f"SELECT customer_id, churn_probability, risk_band FROM ({MERGED})")


def touched_merge(s: Source) -> DataFrame:
    """MERGE of one bucket's customers, twice, then removal of what no version needs: what each step wrote."""
    table = Versioned.create(stale_target(s).select("customer_id", *U.SCORE_COLUMNS), s.scratch("touched"), "customer_id", 8)
    one = cut(updates(s).where(bucket_of("customer_id", 8) == 3))
    wrote = [len(table.merge(one, U.merge_scores)) for _ in range(2)]
    removed = len(table.vacuum())
    counts = {"first": wrote[0], "repeated": wrote[1], "removed": removed, "versions": len(table.versions())}
    return table.read().agg(F.count("*").alias("rows"), *[F.lit(v).cast("bigint").alias(c) for c, v in counts.items()])


add("u01c_merge_of_touched_buckets", touched_merge, """
SELECT COUNT(*) AS rows, CAST(1 AS BIGINT) AS first, CAST(0 AS BIGINT) AS repeated, CAST(1 AS BIGINT) AS removed,
  CAST(1 AS BIGINT) AS versions FROM scored""")
add("telemetry_feed", lambda s: bindings.telemetry(s.tables), CTES["kpis"])
add("monthly_history", lambda s: bindings.monthly(s.tables), CTES["monthly"])
