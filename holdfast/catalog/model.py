"""ML: propensity model and its evaluation.

Evaluation runs on the fixed points rule, so that another engine can repeat it; the split follows a hash that
another engine has too, and fitted models are checked by invariants: the gradient at the optimum, the rows that are
counted, the parts that have to fit together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.catalog.registry import Source, add
from holdfast.catalog.sqlbase import big, div, rhe
from holdfast.functions.columns import round_even
from holdfast.operators import evaluation as E
from holdfast.plans import propensity as P
from holdfast.plans import report as R
from holdfast.sources import writers

Y, S = "churn_flag", "churn_probability"
_fitted: dict[tuple[str, str, str], P.ModelRun] = {}


def fitted_sets(s: Source, sets: tuple[str, ...]) -> dict[str, P.ModelRun]:
    """One fit per application, table folder and feature set; those that are missing run at the same time."""
    keys = {n: (s.spark.sparkContext.applicationId, s.sf_dir, n) for n in sets}
    missing = [n for n in sets if keys[n] not in _fitted]
    if missing:
        _fitted.update({keys[n]: run for n, run in P.train_sets(s.m.features, missing).items()})
    return {n: _fitted[keys[n]] for n in sets}


def fitted(s: Source, feature_set: str) -> P.ModelRun:
    return fitted_sets(s, (feature_set,))[feature_set]


def design_columns(s: Source) -> DataFrame:
    """Numbers and one-hot columns under their feature names, before standardising."""
    numeric, categorical = P.model_columns(s.m.features, "customer")
    rows = P.model_inputs(s.m.features, "customer", ["customer_id"])
    inputs = P.vector_inputs(numeric, P.categories(rows, categorical))
    return rows.select("customer_id", *[i.value().alias(plain(i.name)) for i in inputs])


def plain(name: str) -> str:
    return name.replace(" ", "_").replace("(", "").replace(")", "")


DOMAINS = {**K.DOMAINS, "payment_method": sorted([*K.DOMAINS["payment_method"], "Not specified"])}
ONE_HOT = [(c, v) for c in K.CATEGORICAL_FEATURES for v in sorted(DOMAINS[c])[1:]]


def _design_sql() -> str:
    cells = [f"COALESCE(CAST({c} AS DOUBLE), 0e0) AS {c}" for c in K.CUSTOMER_NUMERICS]
    cells += [f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS \"{plain(f'{c}_{v}')}\"" for c, v in ONE_HOT]
    return f"SELECT customer_id, {', '.join(cells)} FROM features"


add("ml01_design_matrix", design_columns, _design_sql())

# the split again: held out are the first rows of each class by the hash of the key
SPLIT = """(SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY churn_flag ORDER BY md5(customer_id || '|42'),
  customer_id) <= round_even(COUNT(*) OVER (PARTITION BY churn_flag) * 0.25e0, 0) THEN 1 ELSE 0 END
  AS is_test_row FROM features)"""


def vectors(s: Source) -> DataFrame:
    """The standardised vector of every row, one row per position."""
    d = P.design(s.m.features)
    return d.rows.select("customer_id", "is_test_row", F.posexplode(F.array(
        *[i.value() for i in d.inputs])).alias("position", "value")).select(
        "customer_id", "is_test_row", "position", round_even("value", 6).alias("value"))


def _vectors_sql() -> str:
    stats = ", ".join(f"AVG(COALESCE({c}, 0e0)) AS m_{c}, COALESCE(NULLIF(STDDEV_POP(COALESCE({c}, 0e0)), 0e0), 1e0) "
                      f"AS s_{c}" for c in K.CUSTOMER_NUMERICS)
    values = [rhe(f"(COALESCE({c}, 0e0) - m_{c}) / s_{c}", 6) for c in K.CUSTOMER_NUMERICS]
    values += [f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END" for c, v in ONE_HOT]
    return f"""
SELECT customer_id, is_test_row, unnest(range({len(values)}))::INT AS position, unnest([{', '.join(values)}]) AS value
FROM {SPLIT}, (SELECT {stats} FROM {SPLIT} WHERE is_test_row = 0)"""


add("ml01b_prepared_vectors", vectors, _vectors_sql())
add("ml02_stratified_split", lambda s: P.stratified_split(s.m.features).select(
    "customer_id", Y, "is_test_row"), f"SELECT customer_id, churn_flag, is_test_row FROM {SPLIT}")


def standardised(s: Source) -> DataFrame:
    held = s.m.features.select("customer_id", "monthly_charges", F.col("tenure_months").cast(
        "double").alias("tenure_months"), F.when(F.col("contract") == "Two year", 1).otherwise(0)
        .alias("is_test_row"))
    names = ["monthly_charges", "tenure_months"]
    out = P.standardise(held, P.train_statistics(held, names)[0])
    return out.select("customer_id", *[round_even(c, 6).alias(c) for c in names])


def _standard(c: str) -> str:
    train = "(SELECT {0} FROM features WHERE contract <> 'Two year')"
    mean, sd = train.format(f"AVG({c})"), train.format(f"STDDEV_POP({c})")
    return f"{rhe(f'({c} - {mean}) / {sd}', 6)} AS {c}"


add("ml03_standardise", standardised, f"""
SELECT customer_id, {_standard('monthly_charges')}, {_standard('tenure_months')} FROM features""")


def logistic_scores(s: Source) -> DataFrame:
    """All rows scored; the scores themselves are checked by the optimality of the fit."""
    p = F.col("p")
    return fitted(s, "customer").scores.select("customer_id", Y, "is_test_row",
                                               ((p > 0) & (p < 1)).alias("is_probability"))


add("ml04_logistic_scores", logistic_scores,
    f"SELECT customer_id, churn_flag, is_test_row, true AS is_probability FROM {SPLIT}")


def optimality(s: Source) -> DataFrame:
    """The penalised loss has its minimum where its gradient is 0: mean over the training rows of
    (score - label) * input plus weight / rows, from the scores and the vectors."""
    run, d = fitted(s, "customer"), P.design(s.m.features)
    rows = d.rows.where("is_test_row = 0").join(run.scores.select("customer_id", "p"), "customer_id")
    error = F.col("p") - F.col(Y)
    weights = run.model.coefficients.toArray().tolist()
    names = [i.name for i in d.inputs]
    sums = rows.agg(F.sum(error).alias("g"), F.count("*").alias("n"), *[
        (F.sum(error * i.value()) + w).alias(f"g{k}") for k, (i, w) in enumerate(zip(d.inputs, weights))])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("input"), (round_even(F.col(g) / F.col("n"), 5) + 0.0).alias("gradient"))
        for name, g in [("(intercept)", "g"), *[(x, f"g{k}") for k, x in enumerate(names)]]])))


_INPUTS = [*K.CUSTOMER_NUMERICS, *[f"{c}_{v}" for c, v in ONE_HOT]]
add("ml04b_logistic_optimality", optimality, "SELECT unnest([" + ", ".join(
    f"'{x}'" for x in ["(intercept)", *_INPUTS]) + "]) AS input, 0e0 AS gradient")


def boosted(s: Source) -> DataFrame:
    """300 rounds; the held-out rows are all counted."""
    return fitted(s, "customer").boosted.select(
        "feature_set", "engine", (F.col("tp") + F.col("fn")).alias("positives"),
        (F.col("fp") + F.col("tn")).alias("negatives"),
        F.col("roc_auc_test").between(0.0, 1.0).alias("has_auc"))


add("ml05_boosted_trees", boosted, f"""
SELECT 'customer' AS feature_set, 'mllib.GBTClassifier' AS engine, {big('SUM(churn_flag)')} AS positives,
  {big('SUM(1 - churn_flag)')} AS negatives, true AS has_auc FROM {SPLIT} WHERE is_test_row = 1""")
add("ml06_roc_auc", lambda s: E.roc_auc(s.m.scored, Y, S), f"""
SELECT {big('SUM(churn_flag)')} AS positives, {big('SUM(1 - churn_flag)')} AS negatives,
  CAST(SUM(churn_flag * (2 * below + same)) AS DOUBLE) / 2
    / NULLIF(CAST(SUM(churn_flag) AS DOUBLE) * CAST(SUM(1 - churn_flag) AS DOUBLE), 0) AS roc_auc
FROM (SELECT churn_flag,
        COALESCE(SUM(1 - churn_flag) OVER (ORDER BY churn_probability
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
          - SUM(1 - churn_flag) OVER (PARTITION BY churn_probability) AS below,
        SUM(1 - churn_flag) OVER (PARTITION BY churn_probability) AS same FROM scored)""")


def confusion(t: str) -> str:
    hit = f"churn_probability >= {t}"
    return (f"COUNT(*) FILTER ({hit} AND churn_flag = 1) AS tp, "
            f"COUNT(*) FILTER ({hit} AND churn_flag = 0) AS fp, "
            f"COUNT(*) FILTER (NOT ({hit}) AND churn_flag = 1) AS fn, "
            f"COUNT(*) FILTER (NOT ({hit}) AND churn_flag = 0) AS tn")


PREC = f"(CASE WHEN tp + fp = 0 THEN 0e0 ELSE {div('tp', 'tp + fp')} END)"
REC = f"(CASE WHEN tp + fn = 0 THEN 0e0 ELSE {div('tp', 'tp + fn')} END)"
RATES = f"""{rhe('CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)', 4)} AS accuracy,
  {rhe(PREC, 4)} AS precision, {rhe(REC, 4)} AS recall,
  {rhe(f"CASE WHEN {PREC} + {REC} = 0 THEN 0e0 ELSE 2 * {PREC} * {REC} / ({PREC} + {REC}) END", 4)} AS f1"""
add("ml07_threshold_metrics", lambda s: E.threshold_metrics(s.m.scored, Y, S, 0.3), f"""
SELECT 0.3e0 AS threshold, {RATES}, {rhe('-ll', 4)} AS log_loss, {rhe('br', 4)} AS brier,
  tp, fp, fn, tn
FROM (SELECT {confusion('0.3e0')},
        AVG(churn_flag * ln(churn_probability + 1e-12)
            + (1 - churn_flag) * ln(1 - churn_probability + 1e-12)) AS ll,
        AVG((churn_probability - churn_flag) * (churn_probability - churn_flag)) AS br FROM scored)""")
LIFT = f"""
SELECT decile, customers, churners, min_probability, max_probability, churn_rate,
  {rhe('churn_rate / (CAST(SUM(churners) OVER () AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE))', 2)} AS lift,
  {rhe('CAST(SUM(churners) OVER (ORDER BY decile) AS DOUBLE) / CAST(SUM(churners) OVER () AS DOUBLE) * 100', 1)}
    AS cumulative_churners_pct,
  {rhe('CAST(SUM(customers) OVER (ORDER BY decile) AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE) * 100', 1)}
    AS cumulative_customers_pct
FROM (SELECT decile, COUNT(*) AS customers, {big('SUM(churn_flag)')} AS churners,
        {rhe('MIN(churn_probability)', 4)} AS min_probability,
        {rhe('MAX(churn_probability)', 4)} AS max_probability,
        {rhe('CAST(SUM(churn_flag) AS DOUBLE) / COUNT(*)', 4)} AS churn_rate
      FROM (SELECT *, CAST((ROW_NUMBER() OVER (ORDER BY churn_probability DESC, customer_id) - 1)
              * 10 // COUNT(*) OVER () + 1 AS INTEGER) AS decile FROM scored) GROUP BY decile)"""


def lift(s: Source) -> DataFrame:
    return E.decile_lift(s.m.scored, Y, S, "customer_id")


add("ml08_decile_lift", lift, LIFT)


def sweep_sql(thresholds: list[float]) -> str:
    return " UNION ALL ".join(
        f"SELECT {t!r}e0 AS threshold, {RATES}, tp, fp, fn, tn "
        f"FROM (SELECT {confusion(f'{t!r}e0')} FROM scored)" for t in thresholds)


add("ml09_threshold_sweep", lambda s: E.threshold_sweep(s.m.scored, Y, S), sweep_sql(E.SWEEP))
add("ml09b_coarse_sweep", lambda s: E.threshold_sweep(s.m.scored, Y, S, E.COARSE_SWEEP),
    sweep_sql(E.COARSE_SWEEP))
add("ml09c_best_f1", lambda s: E.best_f1_threshold(s.m.scored, Y, S), f"""
SELECT threshold AS best_f1_threshold, f1 FROM ({sweep_sql(E.SWEEP)})
ORDER BY f1 DESC, threshold DESC LIMIT 1""")
add("ml10_roc_points", lambda s: E.roc_points(s.m.scored, Y, S), """
SELECT CAST(NULL AS DOUBLE) AS score, 0e0 AS fpr, 0e0 AS tpr UNION ALL
SELECT score, CAST(SUM(neg) OVER (ORDER BY score DESC) AS DOUBLE) / greatest(SUM(neg) OVER (), 1),
  CAST(SUM(pos) OVER (ORDER BY score DESC) AS DOUBLE) / greatest(SUM(pos) OVER (), 1)
FROM (SELECT churn_probability AS score, SUM(churn_flag) AS pos, SUM(1 - churn_flag) AS neg
      FROM scored GROUP BY churn_probability)""")
add("ml11_risk_band", lambda s: P.add_risk_band(s.m.scored.select("customer_id", S)),
    "SELECT customer_id, churn_probability, risk_band FROM scored")


def driver_rows(s: Source) -> DataFrame:
    """Every input once, its ratio and direction in keeping with its coefficient."""
    c = F.col("coefficient")
    fits = ((F.abs(F.log("odds_ratio") - c) < 0.02) | (F.abs(c) > 4)) & (
        F.col("direction") == F.when(c > 0, "increases churn").otherwise("reduces churn"))
    return fitted(s, "customer").drivers.select("feature", "type", fits.alias("consistent"))


add("ml12_drivers", driver_rows, "SELECT unnest([" + ", ".join(
    f"'{x.replace(' ', '_').replace('(', '').replace(')', '')}'" for x in _INPUTS)
    + "]) AS feature, unnest([" + ", ".join(
    [*["'numeric (per 1 SD)'"] * len(K.CUSTOMER_NUMERICS), *["'one-hot vs baseline'"] * len(ONE_HOT)])
    + "]) AS type, true AS consistent")
N_NETWORK = len(K.FEATURE_SETS["customer_network"]) + len(ONE_HOT)
add("ml13_network_feature_set", lambda s: fitted(s, "customer_network").metrics.select(
    "feature_set", "engine", "n_train", "n_test", "n_features", "base_churn_rate_test",
    F.col("roc_auc_test").between(0.0, 1.0).alias("has_auc")), f"""
SELECT 'customer_network' AS feature_set, 'mllib.LogisticRegression' AS engine,
  CAST(COUNT(*) FILTER (is_test_row = 0) AS INTEGER) AS n_train,
  CAST(COUNT(*) FILTER (is_test_row = 1) AS INTEGER) AS n_test, {N_NETWORK} AS n_features,
  {rhe('AVG(churn_flag) FILTER (is_test_row = 1)', 4)} AS base_churn_rate_test, true AS has_auc
FROM {SPLIT}""")


def attached(s: Source) -> DataFrame:
    scores = P.attach_scores(s.m.features.select("customer_id", "contract"), fitted(s, "customer"))
    p, band = F.col(S), F.col("risk_band")
    fits = band == F.when(p < 0.2, "Low").when(p < 0.5, "Medium").otherwise("High")
    return scores.select("customer_id", "contract", "is_test_row", fits.alias("band_fits"))


add("ml13b_attach_scores", attached,
    f"SELECT customer_id, contract, is_test_row, true AS band_fits FROM {SPLIT}")


def artifacts(s: Source) -> DataFrame:
    """Both feature sets; every artefact is read back."""
    root, names = s.scratch("model"), ("customer", "customer_network")
    writers.write_model_artifacts(fitted_sets(s, names), root)
    parts = []
    for n in names:
        for kind, read in (("metrics", s.spark.read.json), ("boosted", s.spark.read.json),
                           ("drivers", s.spark.read.option("header", True).csv),
                           ("lift", s.spark.read.option("header", True).csv)):
            parts.append(read(f"{root}/{kind}_{n}").agg(F.lit(n).alias("feature_set"), F.lit(kind).alias("artifact"),
                                                        F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, parts)


add("s13_model_artifacts", artifacts, " UNION ALL ".join(
    f"SELECT '{n}' AS feature_set, '{kind}' AS artifact, CAST({rows} AS BIGINT) AS rows"
    for n, size in (("customer", len(_INPUTS)), ("customer_network", N_NETWORK))
    for kind, rows in (("metrics", 1), ("boosted", 1), ("drivers", size), ("lift", 10))))


def comparison(s: Source) -> DataFrame:
    rows = R.model_comparison(list(fitted_sets(s, ("customer", "customer_network")).values()))
    return rows.select("feature_set", "engine", F.col("roc_auc_test").between(0.0, 1.0).alias("has_auc"),
                       F.col("best_f1_threshold").isNotNull().alias("has_threshold"))


add("r03_model_comparison", comparison, " UNION ALL ".join(
    f"SELECT '{n}' AS feature_set, 'mllib.{engine}' AS engine, true AS has_auc, {best} AS has_threshold"
    for n in ("customer", "customer_network")
    for engine, best in (("LogisticRegression", "true"), ("GBTClassifier", "false"))))
add("r04f_gain_points", lambda s: R.gain_points(lift(s)), f"""
SELECT decile, cumulative_customers_pct, cumulative_churners_pct FROM ({LIFT})
WHERE decile IN (2, 3, 5)""")
add("l06_gain_line", lambda s: R.gain_line(lift(s)),
    f"SELECT decile, cumulative_customers_pct, cumulative_churners_pct FROM ({LIFT})")
