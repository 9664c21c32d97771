"""Column profiles, group summaries and the frames behind distribution charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import pct, round_even
from holdfast.operators.ordering import exact_quantiles


def rate_by_columns(df: DataFrame, columns: list[str], label: str = "churn_flag") -> DataFrame:
    """Group size and label rate for several columns in one pass (grouping sets)."""
    cells = df.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("customers"),
        round_even(pct(F.sum(label), F.count("*")), 1).alias("churn_rate"))
    # the grouping id has a 0 bit for the one column that is grouped
    every, n = (1 << len(columns)) - 1, len(columns)
    column = reduce(lambda acc, ic: acc.when(
        F.col("_set") == every - (1 << (n - 1 - ic[0])), ic[1]),
        enumerate(columns[1:], start=1), F.when(F.col("_set") == every - (1 << (n - 1)), columns[0]))
    segment = reduce(lambda acc, c: acc.when(column == c, F.col(c).cast("string")), columns[1:],
                     F.when(column == columns[0], F.col(columns[0]).cast("string")))
    return cells.select(column.alias("column"), segment.alias("segment"), "customers",
                        "churn_rate")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: non-null and distinct count; mean, sd, minimum, quartiles and maximum of numbers;
    most frequent value of texts and how often it occurs.

    Counts per value are taken once for all columns (combined before the shuffle), so that no column's
    values meet in one task; quartiles interpolate between neighbours.
    """
    numeric = [c for c, t in df.dtypes if t not in ("string", "date", "timestamp_ntz")]
    moments = df.agg(F.array(*[F.struct(
        F.lit(c).alias("column"), F.avg(F.col(c).cast("double")).alias("mean"),
        F.stddev(F.col(c).cast("double")).alias("std")) for c in numeric]).alias("s")).select(F.inline("s"))
    cells = df.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("v"))
        for c in df.columns])).alias("cell")).select("cell.*")
    counted = cells.groupBy("column", "value").agg(F.count("*").alias("n"))
    filled = F.col("value").isNotNull()
    text = filled & ~F.col("column").isin(*numeric)
    counts = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_null"),
        F.count("value").alias("distinct"),
        F.min(F.when(text, F.struct((-F.col("n")).alias("n"), "value"))).alias("top"))
    spread = exact_quantiles(cells.where("v is not null"), "v",
                             {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}, ["column"])
    return (counts.join(moments, "column", "left").join(spread, "column", "left")
            .select("column", "non_null", "distinct", F.col("top.value").alias("top"),
                    (-F.col("top.n")).alias("freq"), "mean", "std", "min", "q1", "median", "q3", "max"))


def top_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value of each column; ties go to the smaller value."""
    cells = df.groupingSets([[c] for c in columns], *columns).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("freq"))
    every, n = (1 << len(columns)) - 1, len(columns)
    parts = [(every - (1 << (n - 1 - i)), c) for i, c in enumerate(columns)]
    named = cells.select("freq", F.inline(F.array_compact(F.array(*[
        F.when(F.col("_set") == s, F.struct(F.lit(c).alias("column"),
                                            F.col(c).cast("string").alias("value")))
        for s, c in parts]))))
    return (named.where("value is not null").groupBy("column")
            .agg(F.min_by(F.struct("value", "freq"),
                          F.struct((-F.col("freq")).alias("f"), "value")).alias("t"))
            .select("column", F.col("t.value").alias("top"), F.col("t.freq").alias("freq")))


def _edges(df: DataFrame, value: str) -> Column:
    """Observed minimum and maximum, as one struct for all rows."""
    v = F.col(value).cast("double")
    return df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()


def histogram(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Row counts in equal bins of the observed range, stacked by a label. The maximum belongs to the last bin;
    where all values are equal they fill the first one. Rows without a value are not counted."""
    v, edges = F.col(value).cast("double"), _edges(df, value)
    lo, hi = edges["lo"], edges["hi"]
    bin_no = F.when(hi > lo, F.least(F.floor((v - lo) / ((hi - lo) / bins)) + 1, F.lit(bins))).otherwise(1)
    return (df.where(v.isNotNull()).groupBy(bin_no.cast("bigint").alias("bin"), F.col(by))
            .agg(F.count("*").alias("rows"))
            .select("bin", (lo + (F.col("bin") - 1) * ((hi - lo) / bins)).alias("bin_start"), by, "rows"))


def density(df: DataFrame, value: str, by: str, bins: int = 512, points: int = 200,
            reach: float = 3.0) -> DataFrame:
    """Gaussian density per label, from binned counts, with a bandwidth from the label's own rows: their deviation
    times the fifth root of one over their number. The grid reaches ``reach`` bandwidths beyond their values.

    The rows shrink to one per bin first; each bin then meets the grid points. Labels whose values are all
    equal have no density.
    """
    v, edges = F.col(value).cast("double"), _edges(df, value)
    width = (edges["hi"] - edges["lo"]) / bins
    own = (df.where(v.isNotNull()).groupBy(by).agg(
        F.min(v).alias("lo"), F.max(v).alias("hi"),
        round_even(F.stddev(v) * F.pow(F.count("*"), F.lit(-0.2)), 6).alias("width"))
        .where("width > 0"))
    start, span = F.col("lo") - reach * F.col("width"), F.col("hi") - F.col("lo") + 2 * reach * F.col("width")
    cells = (histogram(df, value, by, bins).withColumn("centre", F.col("bin_start") + width / 2)
             .join(own, by)
             .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
             .withColumn("x", start + F.col("point") * (span / (points - 1))))
    u = (F.col("x") - F.col("centre")) / F.col("width")
    kernel = F.exp(-0.5 * u * u) / (F.col("width") * 2.5066282746310002)  # sqrt(2 pi)
    return cells.groupBy(by, "point", "x").agg(
        (F.sum(kernel * F.col("rows")) / F.sum("rows")).alias("density"))


def box_summary(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return exact_quantiles(df, value, probs, by)


def rate_matrix(df: DataFrame, row: str, column: str, values: list[str],
                label: str = "churn_flag") -> DataFrame:
    """Label rate with one result column per listed value."""
    return df.groupBy(row).pivot(column, values).agg(pct(F.sum(label), F.count(label)))
