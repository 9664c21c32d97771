"""Dimensions, facts and reporting views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.operators.joins import join_small, null_safe_join
from holdfast.operators.ordering import global_rank
from holdfast.session import together


def surrogate_dim(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Distinct members numbered 1..n in the order of all columns, NULL last."""
    members = df.select(*columns).distinct()
    order = [F.col(c).asc_nulls_last() for c in columns]
    return global_rank(members, order, key).select(key, *columns)


def lasting_dim(df: DataFrame, columns: list[str], key: str, stored: DataFrame | None,
                natural: list[str] | None = None) -> DataFrame:
    """The next load of a dimension: members that ``stored`` knows keep their keys, new ones are numbered behind its
    greatest key in the order of all columns, and members that are gone stay.

    Members are known by ``natural`` (all columns, if not given; unique in ``df``); their other columns are taken from
    ``df``. Only new members are ordered; the rest is joins on the natural key, NULL equal to NULL.
    """
    if stored is None:
        return surrogate_dim(df, columns, key)
    natural = natural or columns
    members = df.select(*columns).distinct()
    keys = stored.select(key, *natural)
    known = null_safe_join(members, keys, natural).select(key, *columns)
    gone = null_safe_join(stored.select(key, *columns), members.select(*natural), natural, "left_anti")
    new = null_safe_join(members, keys.drop(key), natural, "left_anti")
    greatest = F.coalesce(stored.agg(F.max(key)).scalar(), F.lit(0))
    numbered = global_rank(new, [F.col(c).asc_nulls_last() for c in columns], "_rank").select(
        (greatest + F.col("_rank")).cast("bigint").alias(key), *columns)
    return known.unionByName(gone.select(key, *columns)).unionByName(numbered)


def date_dim(df: DataFrame, month: str = "month") -> DataFrame:
    """One row per observed 'YYYY-MM', with its position from either end of the window."""
    months = df.select(F.col(month).alias("month")).where(F.col(month).isNotNull()).distinct()
    ranked = global_rank(months, ["month"], "month_index", "_n")
    year = F.substring("month", 1, 4).cast("int")
    mon = F.substring("month", 6, 2).cast("int")
    first = F.make_date(year, mon, F.lit(1))
    return ranked.select(
        (year * 100 + mon).alias("month_key"), "month", year.alias("year"),
        mon.alias("month_number"), F.date_format(first, "MMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(first).cast("string")).alias("quarter"),
        first.alias("month_start_date"), "month_index",
        (F.col("_n") - F.col("month_index")).alias("months_before_snapshot"))


def with_measures(features: DataFrame) -> DataFrame:
    """Measures that were not computed become typed NULLs."""
    missing = {c: F.lit(None).cast(t) for c, t in K.FACT_MEASURES.items()
               if c not in features.columns}
    return features.withColumns(missing) if missing else features


def customer_fact(features: DataFrame, dim_customer: DataFrame, dim_contract: DataFrame,
                  dim_services: DataFrame) -> DataFrame:
    """Resolve the three surrogate keys. The junk dimensions join on their natural keys,
    NULL equal to NULL, and are broadcast only after a size check."""
    keyed = with_measures(features).join(
        dim_customer.select("customer_key", "customer_id"), "customer_id")
    keyed = join_small(keyed, dim_contract, K.CONTRACT_DIM)
    keyed = join_small(keyed, dim_services, K.SERVICES_DIM)
    return keyed.select("customer_key", "contract_key", "services_key", "customer_id",
                        *K.FACT_MEASURES)


def monthly_fact(kpis: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Telemetry with its keys; rows of unknown customers or months are dropped."""
    known = kpis.join(dim_customer.select("customer_key", "customer_id"), "customer_id")
    dated = join_small(known, dim_date.select("month_key", "month"), ["month"])
    return dated.select("customer_key", "month_key", *K.TELEMETRY_COLUMNS)


def build_star(features: DataFrame, kpis: DataFrame | None = None,
               previous: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Dimensions and facts. With the dimensions of a ``previous`` load surrogate keys last; else they are numbered anew."""
    before = previous or {}
    dims = {
        "dim_customer": lambda: lasting_dim(features, K.CUSTOMER_DIM, "customer_key", before.get("dim_customer"),
                                            ["customer_id"]),
        "dim_contract": lambda: lasting_dim(features, K.CONTRACT_DIM, "contract_key", before.get("dim_contract")),
        "dim_services": lambda: lasting_dim(features, K.SERVICES_DIM, "services_key", before.get("dim_services")),
    }
    if kpis is not None:
        dims["dim_date"] = lambda: date_dim(kpis)
    tables = together(features.sparkSession, dims)
    tables["fact_customer"] = customer_fact(features, tables["dim_customer"],
                                            tables["dim_contract"], tables["dim_services"])
    if kpis is not None:
        tables["fact_network_monthly"] = monthly_fact(kpis, tables["dim_customer"],
                                                      tables["dim_date"])
    return tables


def customer_360(t: dict[str, DataFrame]) -> DataFrame:
    wide = (t["fact_customer"].join(t["dim_customer"].drop("customer_id"), "customer_key")
            .join(t["dim_contract"], "contract_key").join(t["dim_services"], "services_key"))
    return wide.select(
        "customer_key", *K.CUSTOMER_DIM, *K.CONTRACT_DIM, *K.SERVICES_DIM,
        "monthly_charges", "total_charges", "lifetime_avg_monthly", "charge_ratio",
        "revenue_band", "churn", "churn_flag", "churn_probability", "risk_band", "kpi_months",
        "avg_dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "total_outage_minutes",
        "network_complaints", "network_quality_score", "network_quality_band",
        "dropped_call_trend_pp", "latency_trend_pct", "download_trend_pct")


def network_monthly(t: dict[str, DataFrame]) -> DataFrame:
    """Monthly rows with the customer's label and technology.

    The label side is unique per customer and is assembled first, so the monthly
    rows meet one large join only.
    """
    label = (t["fact_customer"].select("customer_key", "churn_flag", "services_key")
             .join(t["dim_services"].select("services_key", "internet_service"), "services_key")
             .drop("services_key"))
    dates = t["dim_date"].select("month_key", "month_start_date", "months_before_snapshot",
                                 F.col("month_index").alias("date_index"))
    rows = t["fact_network_monthly"].join(label, "customer_key").join(dates, "month_key")
    return rows.select(
        "customer_key", "month_key", "month", "month_start_date",
        F.col("date_index").alias("month_index"), "months_before_snapshot", "churn_flag",
        "internet_service", "dropped_call_pct", "avg_download_mbps", "avg_latency_ms",
        "outage_minutes", "data_usage_gb", "complaints")
