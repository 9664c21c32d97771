"""Features derived from the customer row alone, plus the revenue quartile band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import (contains_ci, count_yes, flag, inclusive_bucket, ratio,
                                        round_even)
from holdfast.operators.ordering import exact_quantiles


def service_features(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        inclusive_bucket("tenure_months", K.TENURE_BUCKETS).alias("tenure_bucket"),
        count_yes(K.ADDONS).alias("num_addon_services"),
        flag(~F.col("internet_service").eqNullSafe("No")).alias("has_internet"),
        flag(F.col("phone_service") == "Yes").alias("has_phone"),
        flag((F.col("streaming_tv") == "Yes") | (F.col("streaming_movies") == "Yes")).alias(
            "has_streaming"),
        flag(contains_ci("payment_method", "automatic")).alias("is_auto_payment"),
        flag(F.col("contract") == "Month-to-month").alias("is_month_to_month"))


def billing_features(df: DataFrame) -> DataFrame:
    tenure, monthly = F.col("tenure_months"), F.col("monthly_charges")
    lifetime = round_even(
        F.when(tenure > 0, ratio(F.col("total_charges"), tenure)).otherwise(monthly), 2)
    return (df.withColumn("lifetime_avg_monthly", lifetime)
            .withColumn("charge_ratio", F.coalesce(
                round_even(ratio(monthly, F.col("lifetime_avg_monthly")), 3), F.lit(1.0))))


def quartile_band(df: DataFrame, value: str, name: str,
                  labels: list[str] = K.REVENUE_BANDS) -> DataFrame:
    """Band by quartile, right-closed, lowest value included.

    When two edges coincide quartiles are undefined and every row is the second label.
    """
    probs = {"e0": 0.0, "e1": 0.25, "e2": 0.5, "e3": 0.75, "e4": 1.0}
    edges = exact_quantiles(df, value, probs).select(F.struct("*").alias("edges"))
    v, e = F.col(value), "_edges."
    distinct = ((F.col(e + "e0") < F.col(e + "e1")) & (F.col(e + "e1") < F.col(e + "e2"))
                & (F.col(e + "e2") < F.col(e + "e3")) & (F.col(e + "e3") < F.col(e + "e4")))
    band = F.when(v.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(("e1", "e2", "e3"), labels):
        band = band.when(v <= F.col(e + edge), label)
    band = band.otherwise(labels[-1])
    return (df.withColumn("_edges", edges.scalar())
            .select(*df.columns,
                    F.when(distinct, band).otherwise(labels[1]).alias(name)))


def customer_features(df: DataFrame) -> DataFrame:
    return quartile_band(billing_features(service_features(df)), "monthly_charges", "revenue_band")
