"""P, J, G and U: predicates, joins, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import big, div, pct, rhe, units, xavg, xsum
from holdfast.functions.columns import (contains_ci, count_yes, exact_avg, exact_sum, flag, ratio,
                                        round_even, units as units_of)
from holdfast.functions.columns import pct as pct_of
from holdfast.operators import joins as J
from holdfast.operators import profiling as P
from holdfast.operators import quality as Q
from holdfast.operators import sketches as SK
from holdfast.operators.ordering import exact_quantiles
from holdfast.plans.measures import slice_by

# -- predicates ------------------------------------------------------------------

key_price = ["o_orderkey", "o_custkey", "o_totalprice"]
KP = ", ".join(key_price)

add("p01_equality", lambda s: s.t("orders").where(
    (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW")).select(*key_price),
    f"SELECT {KP} FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'")
add("p02_index_comparison", lambda s: s.m.kpis.where("month_index > 9").select(
    "customer_id", "month", "outage_minutes"),
    "SELECT customer_id, month, outage_minutes FROM kpis WHERE month_index > 9")
add("p03_membership", lambda s: s.t("orders").where(
    F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("1-URGENT", "5-LOW"))
    .select(*key_price), f"""
SELECT {KP} FROM orders WHERE o_orderstatus IN ('F', 'P')
  AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")
add("p04_outside_range", lambda s: s.t("orders").where(
    ~F.col("o_totalprice").between(50000, 400000)).select(*key_price),
    f"SELECT {KP} FROM orders WHERE o_totalprice < 50000 OR o_totalprice > 400000")
add("p05_null_test", lambda s: s.m.kpis.where(
    F.col("avg_latency_ms").isNull() & F.col("avg_download_mbps").isNotNull()).select(
    "customer_id", "month"), """
SELECT customer_id, month FROM kpis WHERE avg_latency_ms IS NULL AND avg_download_mbps IS NOT NULL""")
add("p06_three_valued_or", lambda s: s.m.features.where(
    F.col("network_quality_score").isNull()
    | (F.col("l3m_complaints") != F.col("network_complaints"))
    | (F.col("network_quality_band") != "Poor")).select("customer_id", "network_quality_band"), """
SELECT customer_id, network_quality_band FROM features WHERE network_quality_score IS NULL
  OR l3m_complaints <> network_complaints OR network_quality_band <> 'Poor'""")
add("p07_mask_combination", lambda s: s.m.customers.where(
    (F.col("tenure_months") > 60) & ~((F.col("contract") == "One year") | (F.col("churn_flag") == 1)))
    .select("customer_id"), """
SELECT customer_id FROM clean
WHERE tenure_months > 60 AND NOT (contract = 'One year' OR churn_flag = 1)""")
add("p08_scalar_subquery", lambda s: s.t("orders").where(
    F.col("o_orderdate") == s.t("orders").select(F.max("o_orderdate")).scalar()).select(*key_price),
    f"SELECT {KP} FROM orders WHERE o_orderdate = (SELECT MAX(o_orderdate) FROM orders)")
add("p09_contains_any_case", lambda s: s.m.customers.where(
    contains_ci("payment_method", "AUTOMATIC")).select("customer_id", "payment_method"),
    "SELECT customer_id, payment_method FROM clean WHERE payment_method ILIKE '%automatic%'")
add("p10_slicer_panel", lambda s: slice_by(
    s.m.scored, contract=["Month-to-month", "Two year"], internet_service="DSL",
    payment_method=None, tenure_bucket=["49-72 months"], risk_band=["Low", "Medium"]).select(
    "customer_id", "contract", "risk_band"), """
SELECT customer_id, contract, risk_band FROM scored
WHERE contract IN ('Month-to-month', 'Two year') AND internet_service = 'DSL'
  AND tenure_bucket = '49-72 months' AND risk_band IN ('Low', 'Medium')""")

# -- joins ---------------------------------------------------------------------------

add("j01_fact_to_dimension", lambda s: s.star["fact_customer"].join(
    s.star["dim_contract"], "contract_key").select("customer_key", "contract", "payment_method"), """
SELECT f.customer_key, c.contract, c.payment_method FROM fact_customer f
JOIN dim_contract c ON c.contract_key = f.contract_key""")
add("j02_star_join", lambda s: s.star["fact_customer"].join(
    s.star["dim_services"], "services_key").join(s.star["dim_contract"], "contract_key").select(
    "customer_key", "internet_service", "payment_method", "monthly_charges"), """
SELECT f.customer_key, s.internet_service, c.payment_method, f.monthly_charges
FROM fact_customer f JOIN dim_services s ON s.services_key = f.services_key
JOIN dim_contract c ON c.contract_key = f.contract_key""")
add("j03_fact_to_fact", lambda s: s.star["fact_network_monthly"].join(
    s.star["fact_customer"].select("customer_key", "churn_flag"), "customer_key").join(
    s.star["dim_date"].select("month_key", "month_name"), "month_key").select(
    "customer_key", "month_key", "month_name", "churn_flag", "outage_minutes"), """
SELECT n.customer_key, n.month_key, d.month_name, f.churn_flag, n.outage_minutes
FROM fact_network_monthly n JOIN dim_date d ON d.month_key = n.month_key
JOIN fact_customer f ON f.customer_key = n.customer_key""")
add("j04_composite_natural_key", lambda s: J.join_small(
    s.m.scored.select("customer_id", *K.SERVICES_DIM), s.star["dim_services"], K.SERVICES_DIM)
    .select("customer_id", "services_key"),
    "SELECT f.customer_id, f.services_key FROM fact_customer f")


def null_safe_keys(s: Source) -> DataFrame:
    """A key column that is NULL for most rows: NULL equals NULL on purpose."""
    left = s.m.features.select("customer_id", "network_quality_score", "contract")
    right = left.groupBy("network_quality_score", "contract").agg(F.count("*").alias("peers"))
    return J.null_safe_join(left, right, ["network_quality_score", "contract"])


add("j04b_null_equals_null", null_safe_keys, """
SELECT l.customer_id, l.network_quality_score, l.contract, r.peers
FROM features l JOIN (SELECT network_quality_score, contract, COUNT(*) AS peers FROM features
                      GROUP BY 1, 2) r
  ON l.network_quality_score IS NOT DISTINCT FROM r.network_quality_score
 AND l.contract IS NOT DISTINCT FROM r.contract""")
add("j05_business_key", lambda s: s.m.kpis.join(
    s.star["dim_customer"].select("customer_key", "customer_id"), "customer_id").select(
    "customer_key", "month", "complaints"), """
SELECT d.customer_key, k.month, k.complaints FROM kpis k
JOIN dim_customer d ON d.customer_id = k.customer_id""")
add("j06_month_text", lambda s: s.m.kpis.join(
    s.star["dim_date"].where("quarter <> 'Q1'").select("month", "month_key"), "month").select(
    "customer_id", "month", "month_key"), """
SELECT k.customer_id, k.month, d.month_key FROM kpis k
JOIN dim_date d ON d.month = k.month WHERE d.quarter <> 'Q1'""")
add("j07_left_outer", lambda s: s.m.customers.select("customer_id").join(
    s.m.kpis.groupBy("customer_id").agg(F.sum("complaints").alias("complaints")), "customer_id",
    "left"), f"""
SELECT c.customer_id, k.complaints FROM clean c
LEFT JOIN (SELECT customer_id, {big('SUM(complaints)')} AS complaints FROM kpis GROUP BY 1) k
  ON k.customer_id = c.customer_id""")
add("j08_orphan_rows", lambda s: J.orphan_count(
    s.t("orders").select(F.col("o_custkey").alias("k")),
    s.t("customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("k")), "k"), """
SELECT COUNT(*) AS orphans FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) c
  ON o_custkey = c_custkey WHERE c_custkey IS NULL""")
add("j09_semi_join", lambda s: J.matched_rows(
    s.t("orders").select(F.col("o_custkey").alias("k"), "o_orderkey"),
    s.t("customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("k")), "k"), """
SELECT o_custkey AS k, o_orderkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)""")
add("j10_upsert_match", lambda s: s.star["fact_customer"].select(
    "customer_id", "churn_probability").join(
    s.m.scored.where("tenure_months > 72").select(
        "customer_id", F.col("churn_probability").alias("incoming")), "customer_id", "left"), """
SELECT f.customer_id, f.churn_probability,
  CASE WHEN tenure_months > 72 THEN s.churn_probability END AS incoming
FROM fact_customer f JOIN scored s ON s.customer_id = f.customer_id""")

# -- aggregates -----------------------------------------------------------------------

add("g01_basic_aggregates", lambda s: s.t("orders").groupBy("o_orderpriority").agg(
    F.count("*").alias("n"), F.sum(F.year("o_orderdate").cast("bigint")).alias("sum_year"),
    exact_avg("o_totalprice", 2).alias("avg_price"), F.min("o_totalprice").alias("min_price"),
    F.max("o_totalprice").alias("max_price")), f"""
SELECT o_orderpriority, COUNT(*) AS n, {big('SUM(year(o_orderdate))')} AS sum_year,
  {xavg('o_totalprice', 2)} AS avg_price, MIN(o_totalprice) AS min_price,
  MAX(o_totalprice) AS max_price FROM orders GROUP BY o_orderpriority""")
add("g02_conditional_sum", lambda s: s.t("orders").groupBy("o_orderpriority").agg(
    exact_sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0), 2)
    .alias("finished_price")), f"""
SELECT o_orderpriority, {xsum("CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0e0 END", 2)}
  AS finished_price FROM orders GROUP BY o_orderpriority""")
add("g03_rates", lambda s: s.m.customers.groupBy("contract").agg(
    pct_of(F.sum("churn_flag"), F.count("*")).alias("churn_rate_pct"),
    ratio(F.sum(F.when(F.col("churn_flag") == 1, units_of("monthly_charges", 2)).otherwise(0)),
          F.sum(units_of("monthly_charges", 2))).alias("lost_share")), f"""
SELECT contract, {pct('SUM(churn_flag)', 'COUNT(*)')} AS churn_rate_pct,
  {div(f"SUM(CASE WHEN churn_flag = 1 THEN {units('monthly_charges', 2)} ELSE 0 END)",
       f"SUM({units('monthly_charges', 2)})")} AS lost_share FROM clean GROUP BY contract""")
add("g04_group_by_expression", lambda s: s.star["fact_customer"].groupBy(
    F.when(F.col("churn_flag") == 1, "Churned").otherwise("Retained").alias("customer_group"),
    F.coalesce("network_quality_band", F.lit("none")).alias("band")).agg(
    F.count("*").alias("n")), """
SELECT CASE WHEN churn_flag = 1 THEN 'Churned' ELSE 'Retained' END AS customer_group,
  COALESCE(network_quality_band, 'none') AS band, COUNT(*) AS n FROM fact_customer GROUP BY 1, 2""")
add("g05_sum_of_product", lambda s: s.star["fact_customer"].groupBy("risk_band").agg(
    (F.sum(units_of("monthly_charges", 2)
           * units_of(F.coalesce("churn_probability", F.lit(0.0)), 4)).cast("double") / 1e6)
    .alias("expected_loss")), f"""
SELECT risk_band, CAST(SUM({units('monthly_charges', 2)}
  * {units('COALESCE(churn_probability, 0e0)', 4)}) AS DOUBLE) / 1e6 AS expected_loss
FROM fact_customer GROUP BY risk_band""")
add("g06_non_null_count", lambda s: s.m.kpis.groupBy("month").agg(
    F.count("avg_latency_ms").alias("with_latency"), F.count("*").alias("rows")),
    "SELECT month, COUNT(avg_latency_ms) AS with_latency, COUNT(*) AS rows FROM kpis GROUP BY month")
add("g07_distinct_rows", lambda s: s.m.features.select(
    "contract", "payment_method", "network_quality_band", "l3m_complaints").distinct(),
    "SELECT DISTINCT contract, payment_method, network_quality_band, l3m_complaints FROM features")
add("g08_distinct_values", lambda s: s.t("orders").groupBy("o_orderpriority").agg(
    F.countDistinct("o_custkey").alias("customers")), """
SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers FROM orders
GROUP BY o_orderpriority""")
add("g09_duplicate_count", lambda s: Q.duplicate_rows(
    s.t("lineitem"), ["l_orderkey", "l_linenumber"]), f"""
SELECT {big('COALESCE(SUM(c - 1), 0)')} AS duplicates
FROM (SELECT COUNT(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")


def _quantile_sql(p: float) -> str:
    at = f"((n - 1) * {p}e0)"
    return (f"CASE WHEN l[CAST(floor({at}) AS BIGINT) + 1] = l[CAST(ceil({at}) AS BIGINT) + 1] "
            f"THEN l[CAST(floor({at}) AS BIGINT) + 1] ELSE "
            f"(ceil({at}) - {at}) * l[CAST(floor({at}) AS BIGINT) + 1] "
            f"+ ({at} - floor({at})) * l[CAST(ceil({at}) AS BIGINT) + 1] END")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
QUARTILE_SQL = f"""
SELECT o_orderpriority, {", ".join(f"{_quantile_sql(p)} AS {n}" for n, p in QUARTILES.items())}
FROM (SELECT o_orderpriority, COUNT(*) AS n, list_sort(list(o_totalprice)) AS l FROM orders
      GROUP BY o_orderpriority)"""
add("g10_exact_quantiles", lambda s: exact_quantiles(
    s.t("orders"), "o_totalprice", QUARTILES, ["o_orderpriority"]), QUARTILE_SQL)
add("g10b_exact_quantiles_distributed", lambda s: exact_quantiles(
    s.t("orders"), "o_totalprice", QUARTILES, ["o_orderpriority"], small_rows=1000), QUARTILE_SQL)
add("g11_global_rate", lambda s: s.m.customers.agg(F.avg("churn_flag").alias("base_rate")),
    "SELECT AVG(churn_flag) AS base_rate FROM clean")


def masked_statistics(s: Source) -> DataFrame:
    train = F.col("tenure_months") <= 72
    v = F.when(train, F.col("monthly_charges"))
    return s.m.customers.agg(
        round_even(F.avg(v), 6).alias("mean"),
        round_even(F.coalesce(F.nullif(F.stddev_pop(v), F.lit(0.0)), F.lit(1.0)), 6).alias("std"))


add("g12_masked_mean_std", masked_statistics, f"""
SELECT {rhe('AVG(monthly_charges)', 6)} AS mean,
  {rhe('COALESCE(NULLIF(STDDEV_POP(monthly_charges), 0e0), 1e0)', 6)} AS std
FROM clean WHERE tenure_months <= 72""")
add("g13_value_counts", lambda s: s.t("orders").groupBy("o_orderstatus").agg(
    F.count("*").alias("rows")),
    "SELECT o_orderstatus, COUNT(*) AS rows FROM orders GROUP BY o_orderstatus")

EDA = ["contract", "internet_service", "payment_method", "tech_support", "senior_citizen"]
add("g14_rate_by_columns", lambda s: P.rate_by_columns(s.m.customers, EDA), " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS segment, COUNT(*) AS customers, "
    f"{rhe(pct('SUM(churn_flag)', 'COUNT(*)'), 1)} AS churn_rate FROM clean GROUP BY {c}"
    for c in EDA))
add("g15_band_summary", lambda s: s.m.scored.groupBy("risk_band").agg(
    F.count("*").alias("customers"), F.avg("churn_flag").alias("actual_churn"),
    exact_avg("churn_probability", 4).alias("avg_prob"),
    exact_sum("monthly_charges", 2).alias("mrr")), f"""
SELECT risk_band, COUNT(*) AS customers, AVG(churn_flag) AS actual_churn,
  {xavg('churn_probability', 4)} AS avg_prob, {xsum('monthly_charges', 2)} AS mrr
FROM scored GROUP BY risk_band""")
EVERY = [*K.RAW_TO_CONFORMED.values(), "churn_flag"]
NUMBERS = ["tenure_months", "monthly_charges", "total_charges", "churn_flag"]


def column_profile(s: Source) -> DataFrame:
    p = P.profile(s.m.customers)
    return p.select(*[round_even(c, 6).alias(c) if c in ("mean", "std") else F.col(c) for c in p.columns])


def _profile_sql(c: str) -> str:
    number, none = c in NUMBERS, "CAST(NULL AS DOUBLE)"
    v = f"CAST({c} AS DOUBLE)"
    stats = ([rhe(f"AVG({v})", 6), rhe(f"STDDEV({v})", 6), f"MIN({v})", f"quantile_cont({v}, 0.25)",
              f"median({v})", f"quantile_cont({v}, 0.75)", f"MAX({v})"] if number else [none] * 7)
    top = ("CAST(NULL AS VARCHAR)", "CAST(NULL AS BIGINT)") if number else tuple(
        f"(SELECT {x} FROM (SELECT {c} AS v, COUNT(*) AS n FROM clean WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY n DESC, v LIMIT 1))" for x in ("v", "n"))
    names = ("mean", "std", "min", "q1", "median", "q3", "max")
    return (f"SELECT '{c}' AS \"column\", COUNT({c}) AS non_null, COUNT(DISTINCT {c}) AS \"distinct\", "
            f"{top[0]} AS top, {top[1]} AS freq, "
            + ", ".join(f"{x} AS \"{n}\"" for x, n in zip(stats, names)) + " FROM clean")


add("g16_column_profile", column_profile, " UNION ALL ".join(map(_profile_sql, EVERY)))


def profile_by_sketches(s: Source) -> DataFrame:
    """The customers as four files, sketched in two goes; the estimates beside the exact profile."""
    path, store = s.scratch("profiled"), s.scratch("sketches")
    customers = s.m.customers.select(*EVERY)
    part = F.pmod(F.xxhash64("customer_id"), F.lit(2))
    for k in (0, 1):
        customers.where(part == k).repartition(2).write.mode("append").parquet(path)
        SK.refresh(s.spark.read.parquet(path), store)
    whole = s.spark.read.parquet(path)
    return SK.within_bounds(whole, P.profile(whole), SK.stored_profile(whole, store))


add("g16c_profile_sketches", profile_by_sketches, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS rows, COUNT({c}) AS non_null, TRUE AS distinct_near, "
    + ("TRUE AS quartiles_near, CAST(NULL AS BOOLEAN) AS top_near, "
       f"MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max FROM clean" if c in NUMBERS else
       "CAST(NULL AS BOOLEAN) AS quartiles_near, TRUE AS top_near, CAST(NULL AS DOUBLE) AS min, "
       "CAST(NULL AS DOUBLE) AS max FROM clean") for c in EVERY))
add("g16b_top_values", lambda s: P.top_values(s.m.customers, EVERY), " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS top, COUNT(*) AS freq FROM clean "
    f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY freq DESC, top LIMIT 1)" for c in EVERY))


def _binned(c: str, bins: int) -> str:
    """Rows of the clean feed with their bin over the observed range."""
    return (f"(SELECT CAST(least(floor((v - lo) / ((hi - lo) / {bins}e0)) + 1, {bins}) AS BIGINT) AS bin, "
            f"churn, v, lo, hi FROM (SELECT CAST({c} AS DOUBLE) AS v, churn, "
            f"(SELECT CAST(MIN({c}) AS DOUBLE) FROM clean) AS lo, "
            f"(SELECT CAST(MAX({c}) AS DOUBLE) FROM clean) AS hi FROM clean) WHERE v IS NOT NULL)")


add("g17_histogram", lambda s: P.histogram(s.m.customers, "tenure_months", "churn", 36), f"""
SELECT bin, lo + (bin - 1) * ((hi - lo) / 36e0) AS bin_start, churn, COUNT(*) AS rows
FROM {_binned('tenure_months', 36)} GROUP BY bin, churn, lo, hi""")


def density_rounded(s: Source) -> DataFrame:
    d = P.density(s.m.customers, "monthly_charges", "churn")
    return d.select("churn", "point", round_even("x", 6).alias("x"),
                    round_even("density", 9).alias("density"))


add("g18_density_curve", density_rounded, f"""
SELECT churn, CAST(point AS INTEGER) AS point, {rhe('x', 6)} AS x,
  {rhe('SUM(exp(-0.5e0 * pow((x - centre) / width, 2)) / (width * 2.5066282746310002e0) * rows) / SUM(rows)', 9)}
    AS density
FROM (SELECT h.churn, point, width, rows, lo0 + (bin - 1) * ((hi0 - lo0) / 512e0) + (hi0 - lo0) / 512e0 / 2
          AS centre, o.lo - 3 * width + point * ((o.hi - o.lo + 6 * width) / 199e0) AS x
      FROM (SELECT bin, churn, lo AS lo0, hi AS hi0, COUNT(*) AS rows
            FROM {_binned('monthly_charges', 512)} GROUP BY ALL) h
      JOIN (SELECT churn, MIN(monthly_charges) AS lo, MAX(monthly_charges) AS hi,
              {rhe('STDDEV(monthly_charges) * pow(COUNT(*), -0.2e0)', 6)} AS width
            FROM clean GROUP BY churn) o ON o.churn = h.churn,
      (SELECT unnest(range(0, 200)) AS point) WHERE width > 0)
GROUP BY churn, point, x""")
add("g19_box_summary", lambda s: P.box_summary(
    s.m.features, "avg_latency_ms", ["internet_service", "churn"]), """
SELECT internet_service, churn, MIN(avg_latency_ms) AS min,
  quantile_cont(avg_latency_ms, 0.25) AS q1, median(avg_latency_ms) AS median,
  quantile_cont(avg_latency_ms, 0.75) AS q3, MAX(avg_latency_ms) AS max
FROM features WHERE avg_latency_ms IS NOT NULL GROUP BY internet_service, churn""")
NETS = list(K.DOMAINS["internet_service"])
add("g20_rate_matrix", lambda s: P.rate_matrix(
    s.m.customers, "payment_method", "internet_service", NETS), "SELECT payment_method, " + ", ".join(
    pct(f"SUM(churn_flag) FILTER (internet_service = '{v}')",
        f"COUNT(*) FILTER (internet_service = '{v}')") + f' AS "{v}"' for v in NETS)
    + " FROM clean GROUP BY payment_method")

# -- set operations ----------------------------------------------------------------------


def union_of_groupings(s: Source) -> DataFrame:
    a = s.m.features.groupBy(F.col("num_addon_services").cast("string").alias("segment")).agg(
        F.count("*").alias("customers")).withColumn("analysis", F.lit("add-ons"))
    b = s.m.features.groupBy(F.col("tech_support").alias("segment")).agg(
        F.count("*").alias("customers")).withColumn("analysis", F.lit("support"))
    return a.unionByName(b)


add("u00_union_all", union_of_groupings, """
SELECT CAST(num_addon_services AS VARCHAR) AS segment, COUNT(*) AS customers,
  'add-ons' AS analysis FROM features GROUP BY num_addon_services
UNION ALL
SELECT tech_support, COUNT(*), 'support' FROM features GROUP BY tech_support""")
add("u0b_table_counts", lambda s: Q.load_reconciliation(s.star).where(
    F.col("tbl") != "orphan_network_rows"), """
SELECT 'dim_customer' AS tbl, COUNT(*) AS rows_ FROM dim_customer
UNION ALL SELECT 'fact_customer', COUNT(*) FROM fact_customer
UNION ALL SELECT 'fact_network_monthly', COUNT(*) FROM fact_network_monthly""")
add("u0c_append_rows", lambda s: s.m.kpis.unionByName(
    s.m.kpis.where("month_index = 1").withColumn("customer_id", F.concat(F.lit("Z"), "customer_id")))
    .groupBy(F.substring("customer_id", 1, 1).alias("prefix")).agg(F.count("*").alias("rows")), """
SELECT substr(customer_id, 1, 1) AS prefix, COUNT(*) AS rows FROM (
  SELECT customer_id FROM kpis UNION ALL
  SELECT 'Z' || customer_id FROM kpis WHERE month_index = 1) GROUP BY 1""")
add("u0d_column_concat", lambda s: s.m.features.select(
    "customer_id", flag(F.col("contract") == "One year").cast("double").alias("contract_one_year"),
    flag(F.col("contract") == "Two year").cast("double").alias("contract_two_year"),
    count_yes(K.ADDONS).cast("double").alias("addons")), """
SELECT customer_id, CASE WHEN contract = 'One year' THEN 1e0 ELSE 0e0 END AS contract_one_year,
  CASE WHEN contract = 'Two year' THEN 1e0 ELSE 0e0 END AS contract_two_year,
  CAST(num_addon_services AS DOUBLE) AS addons FROM service_feat""")
add("u0e_set_difference", lambda s: s.t("orders").select(F.col("o_custkey").alias("k")).distinct()
    .join(s.t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k",
          "left_anti"), """
SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0""")
