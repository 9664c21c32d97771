"""Churn propensity model: MLlib pipeline, exact hold-out, interpretable drivers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import (feature_name, left_closed_band, logistic, round_even,
                                        to_number)
from holdfast.operators import evaluation as E
from holdfast.session import cut, cut_counted, in_turn, literal_rows, release, scratch_path, together

LABEL, KEY, P = "churn_flag", "customer_id", "p"
MAX_CATEGORIES = 200  # different values of a categorical input; more are refused
BOOSTED_ROUNDS = 300
ROWS_PER_TREE_TASK = 250_000  # a tree level is one short job: fewer tasks, fewer blocks fetched from other executors
MISSING_CATEGORY = "nan"


@dataclass
class ModelRun:
    """Everything one fitted feature set leaves behind. All members are DataFrames
    except the fitted model."""

    feature_set: str
    model: LogisticRegressionModel
    metrics: DataFrame
    drivers: DataFrame
    lift: DataFrame
    roc: DataFrame
    scores: DataFrame
    boosted: DataFrame | None = None


def model_columns(df: DataFrame, feature_set: str) -> tuple[list[str], list[str]]:
    numeric = [c for c in K.FEATURE_SETS[feature_set] if c in df.columns]
    categorical = [c for c in K.CATEGORICAL_FEATURES if c in df.columns]
    return numeric, categorical


def model_inputs(df: DataFrame, feature_set: str, keep: list[str]) -> DataFrame:
    """Numbers with NULL as 0, categories with NULL as a category of its own."""
    numeric, categorical = model_columns(df, feature_set)
    types = dict(df.dtypes)

    def number(c: str) -> Column:
        return to_number(c) if types[c] == "string" else F.col(c).cast("double")

    return df.select(*keep, *[F.coalesce(number(c), F.lit(0.0)).alias(c) for c in numeric],
                     *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias(c)
                       for c in categorical])


def categories(df: DataFrame, columns: list[str], most: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted categories of every column over all rows. They are made different on the executors; a column with more
    than ``most`` is refused, so that a corrupt one neither fills the driver nor the plan."""
    if not columns:
        return {}
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                                          for c in columns])).alias("cell")).select("cell.*").distinct()
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in cells.limit(most * len(columns) + 1).collect():
        found[row["column"]].append(row["value"])
    wide = [c for c, values in found.items() if len(values) > most]
    if wide:
        raise ValueError(f"more than {most} categories in {', '.join(wide)}; clean the column or raise the bound")
    return {c: sorted(values) for c, values in found.items()}


@dataclass(frozen=True)
class Input:
    """One position of the feature vector: a number, or one category of a column."""

    column: str
    category: str | None = None

    @property
    def name(self) -> str:
        return self.column if self.category is None else f"{self.column}_{self.category}"

    @property
    def kind(self) -> str:
        return "numeric (per 1 SD)" if self.category is None else "one-hot vs baseline"

    def value(self) -> Column:
        if self.category is None:
            return F.col(self.column)
        return F.when(F.col(self.column) == self.category, 1.0).otherwise(0.0)


def vector_inputs(numeric: list[str], values: dict[str, list[str]]) -> list[Input]:
    """Numbers first, then every category but the alphabetically first, the baseline."""
    return [Input(c) for c in numeric] + [Input(c, v) for c, vs in values.items() for v in vs[1:]]


def with_vector(df: DataFrame, inputs: list[Input]) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(*[i.value() for i in inputs])))


def split_hash(key: str = KEY, seed: int = 42) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def stratified_split(df: DataFrame, label: str = LABEL, key: str = KEY, share: float = 0.25,
                     seed: int = 42) -> DataFrame:
    """Add ``is_test_row``: exactly round(n * share) rows per class, by seeded hash order.

    Rows are counted per class and leading 16 bits of the hash; only the range that holds the last held-out row of
    its class is ordered. The wide rows then compare themselves with that row, one literal per class.
    """
    marks = df.select(F.col(label).alias("y"), split_hash(key, seed).alias("h"), F.col(key).alias("k"))
    start = F.substring("h", 1, 4)
    ranges = marks.groupBy("y", start.alias("start")).agg(F.count("*").alias("n"))
    upto = W.partitionBy("y").orderBy("start").rowsBetween(W.unboundedPreceding, 0)
    counted = ranges.select("y", "start", "n", F.sum("n").over(upto).alias("upto"),
                            F.rint(F.sum("n").over(W.partitionBy("y")) * share).cast("bigint").alias("held"))
    edges = counted.where("held > 0 and upto >= held and upto - n < held").select(
        "y", "start", (F.col("held") - F.col("upto") + F.col("n")).alias("take")).collect()  # one row per class
    test = F.lit(False)
    if edges:
        at = [(F.col("y") == e["y"]) & (start == e["start"]) for e in edges]
        inside = marks.where(reduce(lambda a, b: a | b, at)).withColumn(
            "nth", F.row_number().over(W.partitionBy("y").orderBy("h", "k")))
        last = inside.where(reduce(lambda a, b: a | b, [
            c & (F.col("nth") == e["take"]) for c, e in zip(at, edges)])).collect()
        for row in last:
            edge = F.struct(F.lit(row["h"]).alias("h"), F.lit(row["k"]).alias("k"))
            test = test | ((F.col(label) == row["y"]) & (F.struct(
                split_hash(key, seed).alias("h"), F.col(key).alias("k")) <= edge))
    return df.withColumn("is_test_row", F.when(test, 1).otherwise(0))


def train_statistics(df: DataFrame, numeric: list[str]):
    """Mean and population deviation of the training rows (a zero deviation becomes 1),
    and the number of training and test rows, from one pass."""
    train = F.col("is_test_row") == 0
    row = df.agg(
        F.count_if(train).alias("train"), F.count_if(~train).alias("test"),
        *[F.avg(F.when(train, F.col(c))).alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(F.when(train, F.col(c))).alias(f"s_{c}") for c in numeric]).first()
    stats = {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in numeric}
    return stats, (row["train"], row["test"])


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in stats.items()})


def logistic_model(n_train: int) -> LogisticRegression:
    """L2 of strength 1 on the summed loss, intercept not penalised."""
    return LogisticRegression(featuresCol="features", labelCol=LABEL, regParam=1.0 / n_train,
                              elasticNetParam=0.0, standardization=False, tol=1e-10, maxIter=500)


def boosted_model(rounds: int = BOOSTED_ROUNDS, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol=LABEL, maxIter=rounds, stepSize=0.05,
                         maxDepth=4, seed=seed)


def linear_score(inputs: list[Input], coefficients: list[float], intercept: float) -> Column:
    """The fitted linear model as one column expression over the prepared columns, so that
    scoring all rows is a projection: no vectors are assembled and no Python runs."""
    z, by_column = F.lit(float(intercept)), {}
    for item, c in zip(inputs, coefficients):
        if item.category is None:
            z = z + F.col(item.column) * float(c)
        else:
            hit = F.col(item.column) == item.category
            chain = by_column.get(item.column)
            by_column[item.column] = (F.when(hit, float(c)) if chain is None
                                      else chain.when(hit, float(c)))
    for chain in by_column.values():
        z = z + chain.otherwise(0.0)
    return logistic(z)


def drivers(spark, inputs: list[Input], coefficients: list[float]) -> DataFrame:
    """Coefficients by size. One row per model input."""
    raw = literal_rows(spark, [{"name": F.lit(i.name), "type": F.lit(i.kind),
                                "c": F.lit(float(c))} for i, c in zip(inputs, coefficients)])
    coefficient = round_even("c", 4)
    return raw.orderBy(F.abs("c").desc(), "name").select(
        feature_name("name").alias("feature"), coefficient.alias("coefficient"),
        round_even(F.exp("c"), 3).alias("odds_ratio"), "type",
        F.when(coefficient > 0, "increases churn").otherwise("reduces churn").alias("direction"))


@dataclass
class Design:
    """Prepared rows and what each position of their vector means."""

    rows: DataFrame
    inputs: list[Input]
    n_train: int
    n_test: int


def design(df: DataFrame, feature_set: str = "customer", share: float = 0.25,
           seed: int = 42) -> Design:
    """Split (unless ``df`` has ``is_test_row``), standardise on training statistics, and keep only what the model
    needs."""
    marked = df if "is_test_row" in df.columns else stratified_split(df, share=share, seed=seed)
    rows = model_inputs(marked, feature_set, [KEY, LABEL, "is_test_row"])
    numeric, categorical = model_columns(df, feature_set)
    stats, sizes = train_statistics(rows, numeric)
    rows = standardise(rows, stats)
    return Design(rows, vector_inputs(numeric, categories(rows, categorical)), *sizes)


def training_rows(d: Design) -> DataFrame:
    return with_vector(d.rows.where("is_test_row = 0"), d.inputs).select(LABEL, "features")


def tree_tasks(n_train: int) -> int:
    return -(-n_train // ROWS_PER_TREE_TASK) or 1


def side_by_side(spark, n_train: int) -> Callable:
    """How to run independent fits: at the same time while a tree level of one of them has fewer tasks than there are
    cores. Beyond that they only compete: all of them would hold their rows in the executors' memory at once, and the
    driver the state of all their jobs."""
    if tree_tasks(n_train) < spark.sparkContext.defaultParallelism:
        return together
    return in_turn


def boosted_metrics(d: Design, rounds: int = BOOSTED_ROUNDS, seed: int = 42) -> DataFrame:
    """Hold-out metrics of the boosted-tree benchmark. Trees take several jobs each, so the rows are dealt to as many
    tasks as they need."""
    rows = with_vector(d.rows.where("is_test_row = 0"), d.inputs).select(KEY, LABEL, "features")
    dealt = rows.repartition(tree_tasks(d.n_train), KEY)
    model = boosted_model(rounds, seed).fit(dealt.select(LABEL, "features"))
    held = with_vector(d.rows.where("is_test_row = 1"), d.inputs)
    hist, n = cut_counted(E.score_histogram(
        model.transform(held).select(LABEL, vector_to_array("probability")[1].alias(P)), LABEL, P))
    auc = E.auc_of(hist, n).select("roc_auc").scalar()
    return cut(E.metrics_of(hist, 0.5).withColumn("roc_auc_test", round_even(auc, 4)))


def without_summary(spark, model: LogisticRegressionModel) -> LogisticRegressionModel:
    """The model stored and read back: its training summary holds the session, which cannot be sent to tasks once
    something in it was observed."""
    path = scratch_path(spark, "logistic")
    model.write().session(spark).save(path)
    return LogisticRegressionModel.read().session(spark).load(path)


def linear_run(spark, d: Design, feature_set: str) -> ModelRun:
    """Fit on the training rows, score all rows, evaluate on the held-out ones.

    Everything but the lift follows from one histogram of the held-out scores.
    """
    fitted = without_summary(spark, logistic_model(d.n_train).fit(training_rows(d)))
    weights = fitted.coefficients.toArray().tolist()
    scores = cut(d.rows.select(KEY, LABEL, linear_score(d.inputs, weights, fitted.intercept).alias(P),
                               "is_test_row"))
    test = scores.where("is_test_row = 1")
    hist, n = cut_counted(E.score_histogram(test, LABEL, P))
    best = E.best_of(E.sweep_of(hist)).first()["best_f1_threshold"]

    def packed(threshold: float) -> Column:
        return E.metrics_of(hist, threshold).select(F.struct("*")).scalar()

    auc = E.auc_of(hist, n).select("roc_auc").scalar()
    base = F.sum("pos").cast("double") / F.sum(F.col("pos") + F.col("neg"))
    metrics = cut(hist.agg(base.alias("base")).select(
        F.lit(feature_set).alias("feature_set"), F.lit("mllib.LogisticRegression").alias("engine"),
        F.lit(d.n_train).alias("n_train"), F.lit(d.n_test).alias("n_test"),
        F.lit(len(d.inputs)).alias("n_features"), round_even("base", 4).alias("base_churn_rate_test"),
        round_even(auc, 4).alias("roc_auc_test"), F.lit(best).alias("best_f1_threshold"),
        packed(0.5).alias("at_0_50"), packed(best).alias("at_best_f1")).select(
        "*", F.col("at_0_50.f1").alias("f1_at_050"), F.col("at_0_50.recall").alias("recall_at_050"),
        F.col("at_best_f1.f1").alias("f1_at_best")))
    run = ModelRun(feature_set, fitted, metrics, drivers(spark, d.inputs, weights),
                   E.decile_lift(test, LABEL, P, KEY), E.points_of(hist, n), scores)
    release(spark)  # the boosted benchmark beside it goes on for long
    return run


def train(df: DataFrame, feature_set: str = "customer", share: float = 0.25,
          seed: int = 42, boosted_rounds: int = BOOSTED_ROUNDS) -> ModelRun:
    """Both models of one feature set, fitted and evaluated on one split. ``boosted_rounds`` 0 leaves the boosted
    benchmark out.

    The benchmark is a chain of short jobs with few tasks each; the linear model runs beside it, or before it where the
    rows are so many that each of the two keeps the executors busy (``side_by_side``).
    """
    spark = df.sparkSession
    d = design(df, feature_set, share, seed)
    parts = {"linear": lambda: linear_run(spark, d, feature_set)}
    if boosted_rounds:
        parts["boosted"] = lambda: boosted_metrics(d, boosted_rounds, seed).select(
            F.lit(feature_set).alias("feature_set"), F.lit("mllib.GBTClassifier").alias("engine"), "*")
    done = side_by_side(spark, d.n_train)(spark, parts)
    return replace(done["linear"], boosted=done.get("boosted"))


def add_risk_band(df: DataFrame) -> DataFrame:
    """Band of the rounded probability; lower-closed bands."""
    return df.withColumn("risk_band", left_closed_band("churn_probability", K.RISK_BANDS))


def attach_scores(features: DataFrame, run: ModelRun) -> DataFrame:
    """Add churn_probability (4 places), risk_band and is_test_row."""
    rounded = run.scores.select(KEY, round_even(P, 4).alias("churn_probability"), "is_test_row")
    return add_risk_band(features.join(rounded, KEY, "left"))


def train_sets(features: DataFrame, sets: list[str],
               boosted_rounds: int = BOOSTED_ROUNDS) -> dict[str, ModelRun]:
    """Every feature set on one split, at the same time as long as none of them keeps the executors busy alone."""
    spark, marked = features.sparkSession, stratified_split(features)
    n_train = marked.where("is_test_row = 0").count() if len(sets) > 1 else 0
    return side_by_side(spark, n_train)(spark, {
        name: lambda name=name: train(marked, name, boosted_rounds=boosted_rounds) for name in sets})


def train_all(features: DataFrame, with_network: bool,
              boosted_rounds: int = BOOSTED_ROUNDS) -> dict[str, ModelRun]:
    """Every feature set on one split."""
    return train_sets(features, ["customer", "customer_network"] if with_network else ["customer"], boosted_rounds)
