"""Column profiles from mergeable sketches, kept per file, for tables too large to be profiled exactly again.

A file is read once, in one aggregate over all of its columns: counts, moments, minimum and maximum, a HyperLogLog
sketch of the distinct values, a quantile sketch of numbers and a sketch of the most frequent texts. What is stored
and shuffled is one row per file and column, however many values there are. A profile merges these rows; a file
that was sketched before is not read again, and one that is gone no longer counts.

Errors, each with a probability of about 99 % (the exact form is ``profiling.profile``): the distinct count is
within ``DISTINCT_ERROR`` of the true one (three standard errors of 2^-7 x 1.04), a quantile's rank is within
``RANK_ERROR`` of the rows, and the frequency of the most frequent text within ``TOP_ERROR`` of the rows (always, exact
up to three quarters of ``TRACKED`` distinct texts). Counts, minimum and maximum are exact.

Defined results: NULL is no value; a column without a value has counts of 0 and NULL for the rest. NaN is left out of
quantiles, minimum and maximum, not of the mean. Among equally frequent texts the smaller one is named, if both are among the
ten that the sketch reports. Columns that are neither numbers, boolean nor text are sketched by their text form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.session import cut

LOG_BUCKETS = 14
RANK_SIZE = 800
TRACKED = 8192
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LOG_BUCKETS / 2)
RANK_ERROR = 0.01
TOP_ERROR = 4 / TRACKED
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _numbers(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def sketch_by(df: DataFrame, part: Column, columns: list[str] | None = None) -> DataFrame:
    """One row per part and column with the sketches of its values: one scan, partial sketches in every task."""
    columns = columns or df.columns
    numbers = set(_numbers(df))
    aggregates = []
    for i, c in enumerate(columns):
        name = _quoted(c)
        text = f"cast({name} as string)"
        number = f"cast({name} as double)" if c in numbers else "cast(null as double)"
        real = f"({number} is not null and not isnan({number}))"
        aggregates += [F.expr(e).alias(f"{n}_{i}") for n, e in {
            "non_null": f"count({name})", "total": f"sum({number})", "mean": f"avg({number})",
            "spread": f"var_pop({number}) * count({number})",
            "low": f"min({number}) filter (where {real})", "high": f"max({number}) filter (where {real})",
            "uniques": f"hll_sketch_agg({text}, {LOG_BUCKETS})",
            "ranks": f"kll_sketch_agg_double({number}, {RANK_SIZE}) filter (where {real})",
            "tops": f"approx_top_k_accumulate({text}, {TRACKED}) filter (where {name} is not null)"}.items()]
    fields = ("non_null", "total", "mean", "spread", "low", "high", "uniques", "ranks", "tops")
    wide = df.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), *aggregates)
    return wide.select("part", "rows", F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(c in numbers).alias("number"), *[F.col(f"{n}_{i}").alias(n) for n in fields])
        for i, c in enumerate(columns)])))


def refresh(files: DataFrame, store: str) -> int:
    """Add the sketches of those files of ``files`` (a Parquet table just read) that ``store`` does not know yet, as a
    new part of ``store``. Returns how many files were read."""
    spark = files.sparkSession
    present = set(files.inputFiles())
    fresh = sorted(present - _known(spark, store))
    if fresh:
        rows = spark.read.schema(files.schema).parquet(*fresh)
        made = sketch_by(rows, F.input_file_name(), files.columns)
        made.withColumnRenamed("part", "file").write.mode("append").parquet(store)
    return len(fresh)


def _known(spark: SparkSession, store: str) -> set[str]:
    """Names of the files in the store; like the listing of a table's files, one short text per file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return set()
    return {r[0] for r in spark.read.parquet(store).select("file").distinct().collect()}


def stored_profile(files: DataFrame, store: str) -> DataFrame:
    """Profile of the files that ``files`` lists now, merged from the store; no file is read."""
    spark = files.sparkSession
    sketches = spark.read.parquet(store).withColumnRenamed("file", "part")
    return merged(sketches.join(listed(spark, files.inputFiles()), "part", "left_semi"))


def listed(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "part string")


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column from sketches of parts, in the columns of the exact profile, plus ``rows``."""
    n, mean = F.col("n"), F.col("grand")
    both = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"), F.max("number").alias("number"),
        F.sum(F.when(F.col("mean").isNotNull(), F.col("non_null"))).alias("n"),
        (F.sum("total") / F.sum(F.when(F.col("mean").isNotNull(), F.col("non_null")))).alias("grand"),
        F.sum("spread").alias("within"), F.sum(F.col("mean") * F.col("total")).alias("between"),
        F.min("low").alias("min"), F.max("high").alias("max"),
        F.hll_union_agg("uniques", F.lit(True)).alias("uniques"),
        F.expr("kll_merge_agg_double(ranks) filter (where low is not null)").alias("ranks"),
        F.expr(f"approx_top_k_combine(tops, {TRACKED})").alias("tops"))
    items = F.expr("approx_top_k_estimate(tops, 10)")
    top = F.when((F.col("non_null") > 0) & ~F.col("number"), F.array_min(F.transform(
        items, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("value")))))
    # between the parts: sum of n_i * mean_i^2, that is mean_i * total_i, less n * mean^2
    variance = (F.col("within") + F.col("between") - n * mean * mean) / (n - 1)
    filled = F.col("min").isNotNull()
    return both.withColumn("top", top).select(
        "column", "rows", "non_null", F.hll_sketch_estimate("uniques").alias("distinct"),
        F.col("top.value").alias("top"), (-F.col("top.n")).alias("freq"), mean.alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("std"), "min",
        *[F.when(filled, F.expr(f"kll_sketch_get_quantile_double(ranks, {p}D)")).alias(q) for q, p in QUARTILES.items()],
        "max")


def within_bounds(df: DataFrame, exact: DataFrame, estimate: DataFrame) -> DataFrame:
    """Per column: rows and values, and whether each estimate lies within its stated error of the exact profile."""
    numbers = _numbers(df)
    estimate = cut(estimate)  # a row per column, read several times
    ranks = []
    for c in numbers:
        own = estimate.where(F.col("column") == c).agg(F.max(F.struct(*QUARTILES))).scalar()
        v = F.col(_quoted(c)).cast("double")
        ok = F.lit(True)
        for q, p in QUARTILES.items():
            below, upto = F.avg((v < own[q]).cast("int")), F.avg((v <= own[q]).cast("int"))
            ok = ok & (below <= p + RANK_ERROR) & (upto >= p - RANK_ERROR)
        ranks.append(F.struct(F.lit(c).alias("column"), ok.alias("quartiles_near")))
    near = df.agg(F.array(*ranks).alias("r")).select(F.inline("r"))
    pair = estimate.alias("e").join(exact.alias("x"), "column").join(near, "column", "left")
    tops = F.abs(F.col("e.freq") - F.col("x.freq")) <= F.col("e.rows") * TOP_ERROR
    return pair.select(
        "column", F.col("e.rows").alias("rows"), F.col("e.non_null").alias("non_null"),
        (F.abs(F.col("e.distinct") - F.col("x.distinct")) <= F.ceil(F.col("x.distinct") * DISTINCT_ERROR))
        .alias("distinct_near"), "quartiles_near", tops.alias("top_near"), F.col("e.min").alias("min"),
        F.col("e.max").alias("max"))
