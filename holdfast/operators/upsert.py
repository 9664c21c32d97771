"""Incremental score refresh of the customer fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import exact_avg, pct

SCORE_COLUMNS = ["churn_probability", "risk_band"]


def merge_scores(target: DataFrame, updates: DataFrame, key: str = "customer_id") -> DataFrame:
    """Target rows with new scores where matched and changed, plus a ``changed`` flag.

    Matched rows change when the old probability is NULL, or probability or band
    differ; a comparison with NULL is unknown and changes nothing. Unmatched
    updates are not inserted and unmatched targets stay.
    """
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in SCORE_COLUMNS],
                         F.lit(True).alias("_matched"))
    differs = (F.col("churn_probability").isNull()
               | (F.col("churn_probability") != F.col("_new_churn_probability"))
               | (F.col("risk_band") != F.col("_new_risk_band")))
    joined = target.join(new, key, "left").withColumn(
        "changed", F.coalesce(F.col("_matched") & differs, F.lit(False)))
    return joined.select(
        *[F.when(F.col("changed"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
          if c in SCORE_COLUMNS else F.col(c) for c in target.columns], "changed")


def change_counts(merged: DataFrame) -> DataFrame:
    return (merged.where("changed").agg(F.count("*").alias("rows_affected"))
            .where("rows_affected > 0").select(F.lit("UPDATE").alias("action_taken"),
                                               "rows_affected"))


def band_monotonicity(fact: DataFrame) -> DataFrame:
    """Bands by falling mean prediction; ``monotonic`` is false where actual churn rises.

    One row per band, so the window is over a handful of rows.
    """
    bands = fact.groupBy("risk_band").agg(
        F.count("*").alias("customers"),
        pct(F.sum("churn_flag"), F.count("*")).alias("actual_churn_rate_pct"),
        exact_avg("churn_probability", 4).alias("avg_predicted"))
    w = W.orderBy(F.col("avg_predicted").desc_nulls_last())
    before = F.lag("actual_churn_rate_pct").over(w)
    return bands.withColumn("monotonic", F.coalesce(
        F.col("actual_churn_rate_pct") <= before, F.lit(True)))
