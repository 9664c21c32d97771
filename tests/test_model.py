import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions.columns import left_closed_band
from holdfast import contract as K
from holdfast.operators import evaluation as E
from holdfast.plans import propensity as P
from holdfast.plans import report as R


def scored(spark, y, p):
    return spark.createDataFrame([(f"c{i}", int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "id string, y int, p double")


def pairs_won(y, p):
    """Share of (positive, negative) pairs that the positive wins; ties count half."""
    won = [1.0 if a > b else 0.5 if a == b else 0.0
           for a, u in zip(p, y) if u for b, v in zip(p, y) if not v]
    return sum(won) / len(won)


def test_auc_counts_pairs(spark):
    y = (1, 0, 0, 1, 0, 0, 1, 0, 0)
    for p in ((.3, .3, .1, .7, .7, .2, .05, .3, .6), (.4,) * 9, tuple(.1 * v for v in range(9))):
        got = E.roc_auc(scored(spark, y, p), "y", "p").first()
        assert (got["positives"], got["negatives"]) == (3, 6)
        assert got["roc_auc"] == pytest.approx(pairs_won(y, p), abs=1e-12)
    assert E.roc_auc(scored(spark, (0, 0, 0), (.1, .2, .2)), "y", "p").first()["roc_auc"] is None


def test_threshold_belongs_to_the_positives(spark):
    df = scored(spark, (1, 1, 0, 0, 0), (.35, .34, .6, .1, .35))
    m = E.threshold_metrics(df, "y", "p", 0.35).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (1, 2, 1, 1)
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.4, 0.3333, 0.5, 0.4)
    nothing = E.threshold_metrics(df, "y", "p", 0.99).first()
    assert (nothing["tp"], nothing["precision"], nothing["recall"], nothing["f1"]) == (0, 0.0, 0.0, 0.0)


def test_lift_with_ties_over_a_decile_edge(spark):
    """23 rows: deciles of two and three rows, six of them with one score."""
    p = [round(.97 - .03 * i, 2) for i in range(7)] + [.7] * 6 + [round(.6 - .05 * i, 2) for i in range(10)]
    y = [int(i % 3 == 0 or i < 5) for i in range(23)]
    order = sorted(range(23), key=lambda i: (-p[i], f"c{i}"))
    want = {}
    for place, i in enumerate(order):
        want.setdefault(place * 10 // 23 + 1, []).append(i)
    lift = E.decile_lift(scored(spark, y, p), "y", "p", "id").orderBy("decile").collect()
    assert [(r["decile"], r["customers"], r["churners"], r["min_probability"], r["max_probability"])
            for r in lift] == [(d, len(m), sum(y[i] for i in m), min(p[i] for i in m), max(p[i] for i in m))
                               for d, m in sorted(want.items())]
    assert lift[-1]["cumulative_churners_pct"] == lift[-1]["cumulative_customers_pct"] == 100.0
    first = want[1]
    rate = round(sum(y[i] for i in first) / len(first), 4)
    assert lift[0]["lift"] == round(rate / (sum(y) / 23), 2)


def test_risk_bands_are_closed_below(spark):
    cases = {0.1999: "Low", 0.2001: "Medium", 0.4999: "Medium", 0.5: "High", 1.005: "High", 1.5: "High"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()] + [(None, None)], "p double, want string")
    assert df.select("want", left_closed_band("p", K.RISK_BANDS).alias("got")).where(
        "not want <=> got").count() == 0


def test_best_threshold_takes_the_larger_of_equal_ones(spark):
    df = scored(spark, (1, 1, 0, 0), (.9, .8, .3, .2))
    best = E.best_f1_threshold(df, "y", "p").first()
    assert best["f1"] == 1.0 and best["best_f1_threshold"] == 0.8
    sweep = {r["threshold"]: r for r in E.threshold_sweep(df, "y", "p").collect()}
    for t, row in sweep.items():
        direct = E.threshold_metrics(df, "y", "p", t).first()
        assert all(row[c] == direct[c] for c in ("tp", "fp", "fn", "tn", "f1", "accuracy"))
    assert len(sweep) == 41


def test_roc_points(spark):
    pts = E.roc_points(scored(spark, (0, 1, 1, 0), (.1, .9, .4, .4)), "y", "p").collect()
    assert sorted((r["fpr"], r["tpr"]) for r in pts) == [(0, 0), (0, .5), (.5, 1), (1, 1)]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        tenure, charge = int(rng.integers(0, 73)), float(rng.uniform(18, 118))
        contract = str(rng.choice(["Month-to-month", "One year", "Two year"]))
        z = -1 + 1.5 * (contract == "Month-to-month") - 0.04 * tenure
        rows.append((f"c{i:04d}", tenure, charge, int(rng.integers(0, 7)), 1.0, contract,
                     str(rng.choice(["DSL", "Fiber optic", "No"])),
                     str(rng.choice(["Electronic check", "Mailed check"])) if i % 50 else None,
                     tenure * charge, int(rng.random() < 1 / (1 + math.exp(-z)))))
    return spark.createDataFrame(rows, (
        "customer_id string, tenure_months int, monthly_charges double, num_addon_services int, "
        "charge_ratio double, contract string, internet_service string, payment_method string, "
        "total_charges double, churn_flag int"))


def test_split_is_exact_and_repeatable(frame):
    a, b = P.stratified_split(frame), P.stratified_split(frame.repartition(7))
    for row in a.groupBy("churn_flag").agg(F.count("*").alias("n"), F.sum("is_test_row").alias("t")).collect():
        assert row["t"] == round(row["n"] * 0.25)
    same = a.select("customer_id", "is_test_row").exceptAll(b.select("customer_id", "is_test_row"))
    assert same.count() == 0


@pytest.fixture(scope="module")
def run(frame):
    return P.train(frame, boosted_rounds=4)


def test_training(frame, run):
    m = run.metrics.first()
    assert m["n_train"] + m["n_test"] == 600 and m["roc_auc_test"] > 0.6
    names = {r["feature"] for r in run.drivers.collect()}
    assert "contract_Two_year" in names and "contract_Month-to-month" not in names
    assert "payment_method_nan" in names  # NULL is a category
    assert m["n_features"] == len(names) == 5 + 2 + 2 + 2
    scores = P.attach_scores(frame, run)
    assert scores.count() == 600
    assert {r[0] for r in scores.select("risk_band").distinct().collect()} <= {"Low", "Medium", "High"}


def test_fit_is_the_penalised_optimum(frame, run):
    """Newton steps on the same objective, from a dense copy of the training rows."""
    d = P.design(frame)
    pdf = d.rows.where("is_test_row = 0").toPandas()
    X = np.column_stack([pdf[i.column].astype(float) if i.category is None
                         else (pdf[i.column] == i.category).astype(float) for i in d.inputs])
    X, y = np.column_stack([np.ones(len(X)), X]), pdf["churn_flag"].to_numpy(float)
    w, ridge = np.zeros(X.shape[1]), np.diag([0.0] + [1.0] * (X.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ w))
        w -= np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + ridge, X.T @ (p - y) + ridge @ w)
    fitted = run.model
    assert np.allclose(fitted.coefficients.toArray(), w[1:], atol=1e-5)
    assert abs(fitted.intercept - w[0]) < 1e-5


def test_column_scores_equal_the_model(frame, run):
    d = P.design(frame)
    direct = run.model.transform(P.with_vector(d.rows, d.inputs)).select("customer_id", F.col("prediction").alias("hit"))
    both = run.scores.join(direct, "customer_id")
    assert both.where("cast(p > 0.5 as double) <> hit").count() == 0


def test_boosted_benchmark_is_part_of_the_run(run):
    m, other = run.boosted.first(), run.metrics.first()
    assert m["roc_auc_test"] > 0.55 and m["tp"] + m["fp"] + m["fn"] + m["tn"] == other["n_test"]
    both = R.model_comparison([run]).collect()
    assert [r["engine"] for r in both] == ["mllib.LogisticRegression", "mllib.GBTClassifier"]
    assert P.train.__defaults__[-1] == P.boosted_model().getMaxIter() == 300


def test_metrics_of_the_histogram_equal_those_of_the_rows(run):
    test = run.scores.where("is_test_row = 1")
    y, p = np.array(test.select("churn_flag", "p").collect()).T
    m = run.metrics.first()
    assert m["roc_auc_test"] == pytest.approx(pairs_won(y, p), abs=6e-5)
    at = m["at_0_50"]
    assert (at["tp"], at["fp"]) == (((p >= .5) & (y == 1)).sum(), ((p >= .5) & (y == 0)).sum())
    assert at["brier"] == pytest.approx(((p - y) ** 2).mean(), abs=6e-5)
    assert at["log_loss"] == pytest.approx(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean(), abs=6e-5)


def test_corrupt_category_column_is_refused(frame):
    bad = frame.withColumn("payment_method", F.concat(F.lit("x"), "customer_id"))
    with pytest.raises(ValueError, match="payment_method"):
        P.design(bad)
