"""Sinks: star tables, scores, features, query results, audit and manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.quality import quality_results, raise_on_fail
from holdfast.session import cut, together

SCORE_SINK = ["customer_id", "churn_flag", "churn_probability", "risk_band", "is_test_row"]


def write_csv(df: DataFrame, path: str) -> str:
    """Header, LF line ends, NULL as a blank cell, text kept as it is."""
    (df.write.mode("overwrite").option("header", True).option("lineSep", "\n").option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


def write_star_csv(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    spark = next(iter(tables.values())).sparkSession
    return together(spark, {name: lambda n=name, d=df: write_csv(d, f"{root}/{n}")
                            for name, df in tables.items()})


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace ``path`` and return the stored table. Partitioned output is rebalanced
    first: even a month with most of the rows is split into files of target size."""
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(
            partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_star(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Parquet star; the monthly fact is laid out by month so that month filters prune."""
    def task(name: str, df: DataFrame):
        month = "month_key" if name == "fact_network_monthly" else None
        return lambda: write_parquet(df, f"{root}/{name}", month).select(*df.columns)

    spark = next(iter(tables.values())).sparkSession
    return together(spark, {name: task(name, df) for name, df in tables.items()})


ROWS_PER_BUCKET = 2_000_000


def save_tables(tables: dict[str, DataFrame], root: str, prefix: str = "",
                buckets: int | None = None) -> list[str]:
    """Replace catalog tables. Tables with one row per customer are bucketed by
    ``customer_key``, so joins among them need no shuffle; the monthly fact is not,
    because one customer may hold very many rows. The number of buckets follows the customers."""
    names = []
    if buckets is None:
        buckets = max(8, -(-tables["fact_customer"].count() // ROWS_PER_BUCKET))
    for name, df in tables.items():
        writer = df.write.mode("overwrite").option("path", f"{root}/{name}")
        if name in ("dim_customer", "fact_customer"):
            writer = writer.bucketBy(buckets, "customer_key").sortBy("customer_key")
        elif name == "fact_network_monthly":
            writer = df.hint("rebalance", "month_key").write.mode("overwrite").option(
                "path", f"{root}/{name}").partitionBy("month_key")
        writer.saveAsTable(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def score_columns(features: DataFrame) -> DataFrame:
    return features.select(*SCORE_SINK)


def write_scores(features: DataFrame, path: str) -> str:
    return write_csv(score_columns(features), path)


def write_results(results: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Each query result under its own name."""
    return write_star_csv(results, root)


def append_audit(results: DataFrame, path: str) -> None:
    """Add one run to the audit table; earlier runs stay."""
    results.drop("seq").coalesce(1).write.mode("append").partitionBy("run_ts").parquet(path)


def audited_gate(customers: DataFrame, kpis: DataFrame | None, audit_path: str,
                 expected_rows: int | None = None, fail_on_error: bool = True,
                 run_ts: str | None = None) -> DataFrame:
    """Quality gate whose results are stored before a failure is raised."""
    results = cut(quality_results(customers, kpis, expected_rows, run_ts))
    append_audit(results, audit_path)
    if fail_on_error:
        raise_on_fail(results)
    return results


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn(
        "run_ts", F.col("run_ts").cast("string"))


def write_model_artifacts(runs: dict, root: str) -> None:
    """Metrics (and those of the boosted benchmark) as JSON rows, driver and lift tables as CSV."""
    for name, run in runs.items():
        run.metrics.coalesce(1).write.mode("overwrite").json(f"{root}/metrics_{name}")
        if run.boosted is not None:
            run.boosted.coalesce(1).write.mode("overwrite").json(f"{root}/boosted_{name}")
        write_csv(run.drivers.coalesce(1), f"{root}/drivers_{name}")
        write_csv(run.lift.coalesce(1), f"{root}/lift_{name}")


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("append").json(path)
