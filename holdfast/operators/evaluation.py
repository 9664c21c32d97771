"""Model evaluation over scored rows.

Everything that depends on the score order works on the score histogram, which
shrinks before the shuffle however many rows share a score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.columns import flag, round_even
from holdfast.operators.ordering import position_tiles, running_totals
from holdfast.session import literal_rows

# The threshold grids
SWEEP = [round(0.10 + 0.02 * i, 2) for i in range(41)]
COARSE_SWEEP = [round(0.10 + 0.05 * i, 2) for i in range(16)]
EPS = 1e-12


def _big(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def score_histogram(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(flag(F.col(label) == 1)).alias("pos"),
        F.sum(flag(F.col(label) == 0)).alias("neg"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Mann-Whitney AUC with tied scores counted half; NULL when a class is missing."""
    return auc_of(score_histogram(df, label, score))


def auc_of(hist: DataFrame, rows: int | None = None) -> DataFrame:
    """``roc_auc`` from a score histogram (of ``rows`` rows, if it is stored)."""
    run = running_totals(hist, ["score"], {"neg": "neg_upto"}, rows=rows)
    below = F.col("neg_upto") - F.col("neg")
    wins = F.sum(_big(F.col("pos")) * _big(2 * below + F.col("neg")))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return run.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
                   (wins.cast("double") / 2 / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, highest first, after the origin (NULL score)."""
    return points_of(score_histogram(df, label, score))


def points_of(hist: DataFrame, rows: int | None = None) -> DataFrame:
    """``roc_points`` from a score histogram."""
    run = running_totals(hist, [F.col("score").desc()], {"pos": "tp", "neg": "fp"}, rows=rows)
    totals = hist.agg(F.struct(F.greatest(F.sum("pos"), F.lit(1)).alias("p"),
                               F.greatest(F.sum("neg"), F.lit(1)).alias("n")).alias("t"))
    points = run.withColumn("_t", totals.scalar()).select(
        "score", (F.col("fp").cast("double") / F.col("_t.n")).alias("fpr"),
        (F.col("tp").cast("double") / F.col("_t.p")).alias("tpr"))
    origin = literal_rows(hist.sparkSession, [
        {"score": F.lit(None).cast("double"), "fpr": F.lit(0.0), "tpr": F.lit(0.0)}])
    return origin.unionByName(points)


def _safe(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0)))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    precision, recall = _safe(tp, tp + fp), _safe(tp, tp + fn)
    return {
        "accuracy": round_even((tp + tn).cast("double") / (tp + fp + fn + tn), 4),
        "precision": round_even(precision, 4),
        "recall": round_even(recall, 4),
        "f1": round_even(_safe(2 * precision * recall, precision + recall), 4),
    }


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, rates, log loss and Brier score in one aggregate."""
    return metrics_of(score_histogram(df, label, score), threshold)


def metrics_of(hist: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``threshold_metrics`` from a score histogram."""
    p, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    hit, n = p >= threshold, F.sum(pos + neg)

    def total(where: Column, c: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, c)), F.lit(0))

    counts = hist.agg(
        total(hit, pos).alias("tp"), total(hit, neg).alias("fp"),
        total(~hit, pos).alias("fn"), total(~hit, neg).alias("tn"),
        (F.sum(pos * F.log(p + EPS) + neg * F.log(1 - p + EPS)) / n).alias("_ll"),
        (F.sum(pos * (p - 1) * (p - 1) + neg * p * p) / n).alias("_brier"))
    rates = _rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return counts.select(
        F.lit(float(threshold)).alias("threshold"), *[c.alias(n) for n, c in rates.items()],
        round_even(-F.col("_ll"), 4).alias("log_loss"),
        round_even("_brier", 4).alias("brier"), "tp", "fp", "fn", "tn")


def threshold_sweep(df: DataFrame, label: str, score: str,
                    thresholds: list[float] = SWEEP) -> DataFrame:
    """Rates at every threshold from one pass: each row falls between two thresholds,
    so only the counts per gap meet the grid."""
    return sweep_of(df.select(F.col(score).alias("score"), flag(F.col(label) == 1).alias("pos"),
                              flag(F.col(label) != 1).alias("neg")), thresholds)


def sweep_of(hist: DataFrame, thresholds: list[float] = SWEEP) -> DataFrame:
    """``threshold_sweep`` from counts per score."""
    reached = sum((F.col("score") >= t).cast("int") for t in thresholds)
    gaps = hist.groupBy(reached.alias("reached")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("threshold"))
                     for i, t in enumerate(thresholds, start=1)])
    cells = gaps.select("*", F.explode(grid).alias("g"))
    over = F.col("reached") >= F.col("g.i")
    sums = cells.groupBy(F.col("g.threshold").alias("threshold")).agg(
        F.sum(F.when(over, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(over, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(over, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(over, 0).otherwise(F.col("neg"))).alias("tn"))
    rates = _rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return sums.select("threshold", *[c.alias(n) for n, c in rates.items()],
                       "tp", "fp", "fn", "tn")


def best_f1_threshold(df: DataFrame, label: str, score: str,
                      thresholds: list[float] = SWEEP) -> DataFrame:
    """Threshold with the highest f1; ties go to the larger threshold."""
    return best_of(threshold_sweep(df, label, score, thresholds))


def best_of(sweep: DataFrame) -> DataFrame:
    return sweep.agg(F.max(F.struct("f1", "threshold")).alias("b")).select(
        F.col("b.threshold").alias("best_f1_threshold"), F.col("b.f1").alias("f1"))


def decile_lift(df: DataFrame, label: str, score: str, key: str, tiles: int = 10) -> DataFrame:
    """Lift by score decile, best first. Lift uses the rounded rate; the cumulative
    window runs over the ten result rows."""
    ranked = position_tiles(df.select(key, label, score),
                            [F.col(score).desc(), F.col(key).asc()], tiles, "decile")
    g = ranked.groupBy("decile").agg(
        F.count("*").alias("customers"), F.sum(F.col(label).cast("bigint")).alias("churners"),
        round_even(F.min(score), 4).alias("min_probability"),
        round_even(F.max(score), 4).alias("max_probability"))
    everything = W.partitionBy()
    upto = W.orderBy("decile").rowsBetween(W.unboundedPreceding, 0)
    churners, customers = F.col("churners").cast("double"), F.col("customers").cast("double")
    base = F.sum(churners).over(everything) / F.sum(customers).over(everything)
    rate = round_even(churners / customers, 4)

    def cumulative(c: Column) -> Column:
        return round_even(F.sum(c).over(upto) / F.nullif(F.sum(c).over(everything), F.lit(0.0))
                          * 100, 1)

    return g.select(
        "decile", "customers", "churners", "min_probability", "max_probability",
        rate.alias("churn_rate"), round_even(rate / F.nullif(base, F.lit(0.0)), 2).alias("lift"),
        cumulative(churners).alias("cumulative_churners_pct"),
        cumulative(customers).alias("cumulative_customers_pct"))
