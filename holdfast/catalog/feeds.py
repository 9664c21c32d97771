"""S and C: sources, sinks and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import CTES, big, unknown_sql
from holdfast.functions.columns import flag, strip, to_number, to_whole, yes_no
from holdfast.operators import cleaning as C
from holdfast.operators.customer_features import customer_features
from holdfast.operators.quality import DataQualityError
from holdfast.operators.star import with_measures
from holdfast.operators.telemetry import telemetry_features
from holdfast.plans import analytics, batch
from holdfast.session import literal_rows
from holdfast.sources import readers, writers

RUN_TS = "2001-08-01T00:00:00Z"
raw_cols = ", ".join(K.RAW_COLUMNS)


def raw_csv(s: Source) -> str:
    return writers.write_csv(s.m.raw.select(*K.RAW_COLUMNS), s.scratch("raw-csv"))


def text_scan(s: Source) -> DataFrame:
    return readers.read_text_csv(s.spark, raw_csv(s)).select(*K.RAW_COLUMNS)


add("s01_csv_text_scan", text_scan, f"SELECT {raw_cols} FROM raw_feed")


def column_contract(s: Source) -> DataFrame:
    extra = s.m.raw.select("Churn", *[c for c in K.RAW_COLUMNS if c != "Churn"],
                           F.lit("x").alias("note"))
    return readers.select_contract(extra, K.RAW_COLUMNS, "raw")


add("s02_column_contract", column_contract, f"SELECT {raw_cols} FROM raw_feed")


def typed_telemetry(s: Source) -> DataFrame:
    complained = F.col("complaints") > 0
    dirty = s.m.kpis.select(
        F.concat(F.lit(" "), "customer_id").alias("customer_id"), "month",
        F.col("month_index").cast("string").alias("month_index"),
        F.col("dropped_call_pct").cast("string").alias("dropped_call_pct"),
        F.col("avg_download_mbps").cast("string").alias("avg_download_mbps"),
        F.when(complained, "n/a").otherwise(F.col("avg_latency_ms").cast("string")).alias(
            "avg_latency_ms"),
        F.col("outage_minutes").cast("string").alias("outage_minutes"),
        F.col("data_usage_gb").cast("string").alias("data_usage_gb"),
        F.when(complained, F.col("complaints").cast("string")).otherwise("none").alias(
            "complaints"))
    return readers.read_telemetry(s.spark, writers.write_csv(dirty, s.scratch("kpi-csv")))


add("s03_typed_telemetry_scan", typed_telemetry, """
SELECT customer_id, month, month_index, dropped_call_pct, avg_download_mbps,
  CASE WHEN complaints > 0 THEN NULL ELSE avg_latency_ms END AS avg_latency_ms,
  CAST(outage_minutes AS DOUBLE) AS outage_minutes, data_usage_gb,
  CAST(complaints AS INTEGER) AS complaints FROM kpis""")


def two_headers(s: Source) -> DataFrame:
    """Files with their columns in two orders, one of them with a column more."""
    root, male = s.scratch("two-headers"), F.col("gender") == "Male"
    writers.write_csv(s.m.raw.where(male).select(*K.RAW_COLUMNS), f"{root}/a")
    writers.write_csv(s.m.raw.where(~male).select(
        "Churn", F.lit("x").alias("note"), *reversed(K.RAW_COLUMNS[:-1])), f"{root}/b")
    return readers.read_text_csv(s.spark, f"{root}/*", K.RAW_COLUMNS)


add("s01b_header_of_each_file", two_headers, f"SELECT {raw_cols} FROM raw_feed")


def quoted_cells(s: Source) -> DataFrame:
    odd = s.m.raw.select("customerID", F.concat(F.lit('He said "'), "Contract", F.lit('", twice\nand "" so on'))
                         .alias("said"), F.concat("gender", F.lit(",")).alias("listed"), "TotalCharges")
    return readers.read_text_csv(s.spark, writers.write_csv(odd, s.scratch("quoted")),
                                 ["customerID", "said", "listed", "TotalCharges"], multi_line=True)


add("s01c_quoted_cells", quoted_cells, """
SELECT customerID, 'He said "' || Contract || '", twice' || chr(10) || 'and "" so on' AS said,
  gender || ',' AS listed, TotalCharges FROM raw_feed""")


def split_cells(s: Source) -> DataFrame:
    """Cells with line breaks, commas and quotes in every row; each file is shared among tasks, and the arrival order of
    the rows is that of the files."""
    broken = s.m.raw.select(*[F.concat(F.col(c), F.lit(',\n"'), F.col(c), F.lit('"\n')).alias(c) if c == "Contract" else F.col(c)
                              for c in K.RAW_COLUMNS])
    rows = readers.read_customers(s.spark, writers.write_csv(broken, s.scratch("split-cells")), multi_line=True)
    return rows.groupBy("Contract").agg(F.count("*").alias("rows"), F.countDistinct("feed_seq").alias("places"),
                                        F.countDistinct("customerID").alias("customers"))


add("s01d_line_breaks_over_tasks", split_cells, """
SELECT Contract || ',' || chr(10) || '"' || Contract || '"' || chr(10) AS Contract, COUNT(*) AS rows, COUNT(*) AS places,
  COUNT(DISTINCT customerID) AS customers FROM raw_feed GROUP BY Contract""")


def file_heads(s: Source) -> DataFrame:
    """Headers of the files of a feed, read from their first kilobytes."""
    root, n = s.scratch("heads"), 3
    writers.write_csv(s.m.raw.select(*K.RAW_COLUMNS).repartition(n), f"{root}/a")
    writers.write_csv(s.m.raw.select(*reversed(K.RAW_COLUMNS)).coalesce(1), f"{root}/b")
    found = readers.headers(s.spark, f"{root}/*")
    known = {tuple(K.RAW_COLUMNS): "contract", tuple(reversed(K.RAW_COLUMNS)): "reversed"}
    return literal_rows(s.spark, [{"header": F.lit(known[names]), "files": F.lit(len(files)).cast("bigint"),
                                   "columns": F.lit(len(names)).cast("bigint")} for names, files in found.items()])


add("s04b_file_heads", file_heads, f"""
SELECT 'contract' AS header, CAST(3 AS BIGINT) AS files, CAST({len(K.RAW_COLUMNS)} AS BIGINT) AS columns
WHERE EXISTS (SELECT 1 FROM raw_feed)
UNION ALL SELECT 'reversed', 1, {len(K.RAW_COLUMNS)} WHERE EXISTS (SELECT 1 FROM raw_feed)""")


def bad_file(s: Source) -> DataFrame:
    """One file without a required column among good ones: refused by name."""
    root = s.scratch("bad-file")
    writers.write_csv(s.m.raw.select(*K.RAW_COLUMNS), f"{root}/a")
    writers.write_csv(s.m.raw.select(*K.RAW_COLUMNS[:-1]), f"{root}/b")
    try:
        return readers.read_customers(s.spark, f"{root}/*")
    except K.SchemaError as error:
        return s.m.raw.agg(F.count("*").alias("rows"), F.lit("Churn" in str(error)).alias("names_it"))


add("s02b_bad_file_among_good", bad_file, "SELECT COUNT(*) AS rows, true AS names_it FROM raw_feed")


def intake(s: Source) -> DataFrame:
    """Two files; the digest of their rows is that of the feed, which another engine can take as well."""
    root = s.scratch("intake")
    writers.write_csv(s.m.raw.where("gender = 'Male'").select(*K.RAW_COLUMNS), f"{root}/a")
    writers.write_csv(s.m.raw.where("gender <> 'Male'").select(*K.RAW_COLUMNS), f"{root}/b")
    files = readers.verify_intake(s.spark, f"{root}/*", K.RAW_COLUMNS, s.m.raw.count())
    return files.agg(F.bool_and("header_ok").alias("header_ok"), F.sum("rows").alias("rows"),
                     F.bool_and("rows_ok").alias("rows_ok"),
                     F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"),
                     F.bool_and(F.col("length") > 0).alias("has_length"))


add("s04_intake_verification", intake, f"""
SELECT true AS header_ok, COUNT(*) AS rows, true AS rows_ok, true AS has_length,
  CAST(SUM(CAST('0x' || substr(md5(concat_ws(chr(1), {raw_cols})), 1, 15) AS HUGEINT)) AS VARCHAR) AS digest
FROM raw_feed""")


def optional_source(s: Source) -> DataFrame:
    absent = readers.read_optional_telemetry(s.spark, s.scratch("no-such-feed"))
    feats = telemetry_features(customer_features(s.m.customers), absent)
    return with_measures(feats).select("customer_id", "revenue_band", "kpi_months",
                                       "avg_latency_ms", "network_quality_band", "churn_probability")


add("s05_optional_source", optional_source, """
SELECT customer_id, revenue_band, CAST(NULL AS BIGINT) AS kpi_months,
  CAST(NULL AS DOUBLE) AS avg_latency_ms, CAST(NULL AS VARCHAR) AS network_quality_band,
  CAST(NULL AS DOUBLE) AS churn_probability FROM cust_feat""")

STAR = ["dim_customer", "dim_contract", "dim_services", "dim_date", "fact_customer",
        "fact_network_monthly"]


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name in STAR:
        part = tables[name].agg(F.lit(name).alias("tbl"), F.count("*").alias("rows_"))
        out = part if out is None else out.unionByName(part)
    return out


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS tbl, COUNT(*) AS rows_ FROM {n}" for n in STAR)


def star_csv(s: Source) -> DataFrame:
    root = s.scratch("star-csv")
    writers.write_star_csv(s.star, root)
    return counted({n: readers.typed_load(s.spark, f"{root}/{n}", n) for n in STAR})


add("s06_star_csv_sink", star_csv, COUNTS_SQL)


def warehouse_tables(s: Source) -> DataFrame:
    root = s.scratch("warehouse")
    writers.save_tables(s.star, root, prefix="hf_")
    fact, dim = s.spark.table("hf_fact_customer"), s.spark.table("hf_dim_customer")
    return (fact.join(dim.select("customer_key", "tenure_bucket"), "customer_key")
            .groupBy("tenure_bucket").agg(F.count("*").alias("customers"),
                                          F.sum("customer_key").alias("key_sum")))


add("s07_warehouse_tables", warehouse_tables, f"""
SELECT tenure_bucket, COUNT(*) AS customers, {big('SUM(f.customer_key)')} AS key_sum
FROM fact_customer f JOIN dim_customer d ON d.customer_key = f.customer_key
GROUP BY tenure_bucket""")


def typed_bulk_load(s: Source) -> DataFrame:
    path = writers.write_csv(s.star["fact_customer"], s.scratch("fact-csv"))
    return readers.typed_load(s.spark, path, "fact_customer")


add("s08_typed_bulk_load", typed_bulk_load, "SELECT " + ", ".join(
    f"CAST({c} AS {t if t != 'string' else 'VARCHAR'}) AS {c}"
    for c, t in K.TYPED_LOAD["fact_customer"].items()) + " FROM fact_customer")


def scores_sink(s: Source) -> DataFrame:
    held = s.m.scored.withColumn("is_test_row", flag(F.col("tenure_months") > 72))
    path = writers.write_scores(held, s.scratch("scores"))
    return s.spark.read.schema("customer_id string, churn_flag int, churn_probability double, "
                               "risk_band string, is_test_row int").option("header", True).csv(path)


add("s09_scores_sink", scores_sink, """
SELECT customer_id, churn_flag, churn_probability, risk_band,
  CASE WHEN tenure_months > 72 THEN 1 ELSE 0 END AS is_test_row FROM scored""")


def feature_sink(s: Source) -> DataFrame:
    return writers.write_parquet(s.m.features, s.scratch("features")).select(
        "customer_id", "tenure_bucket", "charge_ratio", "revenue_band", "kpi_months",
        "network_quality_score", "network_quality_band")


add("s10_feature_sink", feature_sink, """
SELECT customer_id, tenure_bucket, charge_ratio, revenue_band, kpi_months,
  network_quality_score, network_quality_band FROM features""")


def result_sink(s: Source) -> DataFrame:
    paths = writers.write_results(analytics.answer_all(s.star), s.scratch("answers"))
    out = None
    for name, path in sorted(paths.items()):
        part = s.spark.read.option("header", True).csv(path).agg(
            F.lit(name).alias("question"), F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def result_counts_sql() -> str:
    from holdfast.catalog.questions import SQL_BY_QUESTION
    return " UNION ALL ".join(f"SELECT '{n}' AS question, COUNT(*) AS rows FROM ({q})"
                              for n, q in SQL_BY_QUESTION.items())


add("s11_query_result_sink", result_sink, result_counts_sql())


def audit_sink(s: Source) -> DataFrame:
    path = s.scratch("audit")
    try:
        writers.audited_gate(s.m.features, s.m.kpis, path, run_ts=RUN_TS)
    except DataQualityError:
        pass  # the audit must be there all the same
    return readers_audit(s, path)


def readers_audit(s: Source, path: str) -> DataFrame:
    return writers.read_audit(s.spark, path).select("run_ts", "check_name", "table", "status",
                                                    "observed", "expectation", "details")


add("s12_audit_sink_on_failure", audit_sink,
    'SELECT run_ts, check_name, "table", status, observed, expectation, details FROM dq')


def run_manifest(s: Source) -> DataFrame:
    """The whole batch, model included; everything in the manifest but the clock."""
    run = batch.run(s.spark, s.m.raw, s.m.kpis, s.scratch("batch"), fail_on_dq=False)
    info = F.col("info")
    return run.manifest.select(
        "step", (F.col("elapsed_s") >= 0).alias("timed"), F.element_at(info, "rows").alias("rows"),
        F.element_at(info, "duplicates_removed").alias("duplicates_removed"),
        F.element_at(info, "fact_customer").alias("fact_customer"), F.element_at(info, "questions").alias("questions"))


_manifest = {"clean": ("CAST((SELECT COUNT(*) FROM clean) AS VARCHAR)",
                       "CAST((SELECT COUNT(*) FROM raw_feed) - (SELECT COUNT(*) FROM clean) AS VARCHAR)"),
             "load_kpis": ("CAST((SELECT COUNT(*) FROM kpis) AS VARCHAR)", "NULL"),
             "features": ("CAST((SELECT COUNT(*) FROM features) AS VARCHAR)", "NULL"),
             "quality_gate": ("NULL", "NULL"), "model": ("NULL", "NULL"), "warehouse": ("NULL", "NULL"),
             "analytics": ("NULL", "NULL")}
add("s14_run_manifest", run_manifest, " UNION ALL ".join(
    f"SELECT '{step}' AS step, true AS timed, CAST({rows} AS VARCHAR) AS rows, CAST({gone} AS VARCHAR) AS "
    f"duplicates_removed, " + ("CAST((SELECT COUNT(*) FROM fact_customer) AS VARCHAR)" if step == "warehouse"
                               else "CAST(NULL AS VARCHAR)") + " AS fact_customer, "
    + ("'8'" if step == "analytics" else "CAST(NULL AS VARCHAR)") + " AS questions"
    for step, (rows, gone) in _manifest.items()))


def resumed_batch(s: Source) -> DataFrame:
    """The batch without model twice over the same feed: the second run reads every step of the first one."""
    out = s.scratch("resumed")
    for _ in range(2):
        run = batch.run(s.spark, s.m.raw, s.m.kpis, out, with_model=False, fail_on_dq=False, resume=True)
    rows = run.star["fact_network_monthly"].agg(F.count("*")).scalar()
    return run.manifest.select("step", F.element_at("info", "rows").alias("rows"),
                               F.element_at("info", "resumed").alias("resumed"), rows.alias("monthly_rows"))


add("s14b_resumed_batch", resumed_batch, " UNION ALL ".join(
    f"SELECT '{step}' AS step, CAST({rows} AS VARCHAR) AS rows, 'true' AS resumed, "
    "(SELECT COUNT(*) FROM fact_network_monthly) AS monthly_rows"
    for step, (rows, _) in _manifest.items() if step != "model"))

# -- cleaning --------------------------------------------------------------------

names = list(K.RAW_TO_CONFORMED.values())
name_list = ", ".join(names)

add("c01_trim_all", lambda s: C.conform_names(C.trim_all(s.m.raw.select(*K.RAW_COLUMNS))),
    f"SELECT {name_list} FROM trimmed")
add("c02_conform_names", lambda s: C.conform_names(s.m.raw).drop("feed_seq"), "SELECT " + ", ".join(
    f"{r} AS {c}" for r, c in K.RAW_TO_CONFORMED.items()) + " FROM raw_feed")
add("c03_first_per_key", lambda s: C.first_per_key(
    C.conform_names(C.trim_all(s.m.raw, K.RAW_COLUMNS)), ["customer_id"], "feed_seq"),
    f"SELECT feed_seq, {name_list} FROM deduped")


def deduped(s: Source) -> DataFrame:
    return C.first_per_key(C.conform_names(C.trim_all(s.m.raw, K.RAW_COLUMNS)), ["customer_id"],
                           "feed_seq")


add("c04_text_to_number", lambda s: deduped(s).select(
    "customer_id", to_whole("tenure_months").alias("tenure_months"),
    to_number("monthly_charges").alias("monthly_charges"),
    to_number("total_charges").alias("total_number")),
    "SELECT customer_id, tenure_months, monthly_charges, total_number FROM typed")


def total_classes(s: Source) -> DataFrame:
    return C.conform_tagged(s.m.raw).groupBy(F.col("total_class").alias("kind")).agg(
        F.count("*").alias("rows"))


add("c05_total_classes", total_classes, """
SELECT CASE WHEN total_text = '' THEN 'blank' WHEN total_number IS NULL THEN 'unparseable'
  ELSE 'ok' END AS kind, COUNT(*) AS rows FROM typed GROUP BY 1""")


def zero_imputed(s: Source) -> DataFrame:
    total, new = to_number("total_charges"), to_whole("tenure_months") == 0
    return deduped(s).select("customer_id", F.when(total.isNull() & new, 0.0).otherwise(total)
                             .alias("total_charges"))


add("c06_impute_unbilled", zero_imputed, """
SELECT customer_id, CASE WHEN total_number IS NULL AND tenure_months = 0 THEN 0e0
  ELSE total_number END AS total_charges FROM typed""")
add("c07_impute_estimate", lambda s: s.m.customers.select("customer_id", "total_charges"),
    "SELECT customer_id, total_charges FROM clean")
add("c08_yes_no_map", lambda s: s.m.raw.select(
    strip("customerID").alias("customer_id"), "feed_seq",
    yes_no("SeniorCitizen").alias("from_binary"), yes_no("Churn").alias("from_text"),
    yes_no("MultipleLines").alias("from_other")), """
SELECT customer_id, feed_seq,
  CASE senior_citizen WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' END AS from_binary,
  churn AS from_text,
  CASE WHEN multiple_lines IN ('Yes', 'No') THEN multiple_lines END AS from_other FROM trimmed""")
add("c09_binary_label", lambda s: s.m.customers.select("customer_id", "churn", "churn_flag"),
    "SELECT customer_id, churn, churn_flag FROM clean")


add("c10_domain_audit", lambda s: C.unknown_values(s.m.customers), unknown_sql())
add("c11_cleaning_report", lambda s: C.cleaning_report(s.m.raw), """
SELECT (SELECT COUNT(*) FROM raw_feed) AS rows_in, COUNT(*) AS rows_out,
  (SELECT COUNT(*) FROM raw_feed) - COUNT(*) AS duplicates_removed,
  COUNT(*) FILTER (total_text = '') AS total_charges_blank,
  COUNT(*) FILTER (total_number IS NULL AND tenure_months = 0) AS total_charges_imputed_zero,
  COUNT(*) FILTER (total_number IS NULL) - COUNT(*) FILTER (total_text = '')
    AS total_charges_unparseable, (SELECT COUNT(*) FROM (""" + unknown_sql() + """)) AS unknown_category_values
FROM typed""")
add("c11b_unknown_value_lists", lambda s: C.unknown_lists(C.unknown_values(s.m.customers)).select(
    "column", F.array_join("values", "|").alias("values")),
    'SELECT "column", string_agg(value, \'|\' ORDER BY value) AS "values" FROM (' + unknown_sql() + ') GROUP BY ALL')

add("raw_customer_feed", lambda s: s.m.raw, CTES["raw_feed"])
