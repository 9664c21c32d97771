import pytest
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.operators import star as S
from holdfast.operators.cleaning import conform
from holdfast.operators.customer_features import customer_features
from holdfast.operators.joins import join_small, null_safe_join
from holdfast.operators.telemetry import telemetry_features
from holdfast.plans import analytics as A
from holdfast.plans import measures as M
from holdfast.plans import report as R


@pytest.fixture(scope="module")
def kpis(kpi_frame):
    return kpi_frame(["K-17", "K-58", "unknown"])


@pytest.fixture(scope="module")
def star(raw_frame, kpis):
    return S.build_star(telemetry_features(customer_features(conform(raw_frame())), kpis), kpis)


def test_shapes(star):
    assert star["dim_customer"].count() == star["fact_customer"].count() == 3
    assert star["fact_customer"].columns == ["customer_key", "contract_key", "services_key",
                                             "customer_id", *K.FACT_MEASURES]
    assert star["dim_date"].count() == 12
    assert star["fact_network_monthly"].count() == 24  # the unknown customer is dropped


def test_missing_scores_are_typed_nulls(star):
    types = dict(star["fact_customer"].dtypes)
    assert types["churn_probability"] == "double" and types["risk_band"] == "string"
    assert star["fact_customer"].where("risk_band is not null").count() == 0


def test_dim_date(star):
    rows = {r["month"]: r for r in star["dim_date"].collect()}
    r = rows["2023-11"]
    assert (r["month_key"], r["month_name"], r["quarter"], str(r["month_start_date"]),
            r["month_index"], r["months_before_snapshot"]) == (202311, "Nov", "Q4", "2023-11-01", 11, 1)


def test_surrogate_keys_are_dense_and_sorted_with_null_last(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", 2), ("a", None)], "x string, y int")
    got = [(r["k"], r["x"], r["y"]) for r in S.surrogate_dim(df, ["x", "y"], "k").orderBy("k").collect()]
    assert got == [(1, "a", 2), (2, "a", None), (3, "b", 1), (4, None, 3)]


def test_null_natural_keys_find_their_row(spark):
    left = spark.createDataFrame([(1, None, "a"), (2, "x", None)], "id int, p string, q string")
    dim = spark.createDataFrame([(None, "a", 10), ("x", None, 20)], "p string, q string, k int")
    assert {(r["id"], r["k"]) for r in null_safe_join(left, dim, ["p", "q"]).collect()} == {(1, 10), (2, 20)}
    big = join_small(left, dim, ["p", "q"], max_rows=0)  # over the bound: no broadcast hint
    assert {(r["id"], r["k"]) for r in big.collect()} == {(1, 10), (2, 20)}
    assert "rightHint" not in big._jdf.queryExecution().optimizedPlan().toString()


def test_without_telemetry_its_question_is_skipped(raw_frame):
    star = S.build_star(customer_features(conform(raw_frame())))
    assert set(star) == {"dim_customer", "dim_contract", "dim_services", "fact_customer"}
    answers = A.answer_all(star)
    assert "network_trend_churned_vs_retained" not in answers and len(answers) == 7
    assert answers["risk_segments"].where("risk_band = 'Unscored'").count() == 3


def test_answers_keep_their_totals(star):
    answers = A.answer_all(star, {"extra": lambda t: t["fact_customer"].select("customer_key")})
    assert answers["extra"].count() == 3
    assert answers["churn_by_contract"].agg(F.sum("customers")).first()[0] == 3
    last = answers["tenure_curve"].orderBy(F.col("tenure_months").desc()).first()
    assert last["cumulative_churn_share_pct"] == 100.0
    assert answers["network_trend_churned_vs_retained"].count() == 24


def test_views(star):
    wide = S.customer_360(star)
    assert wide.count() == 3 and len(wide.columns) == 45
    monthly = S.network_monthly(star)
    assert monthly.count() == 24 and set(monthly.select("churn_flag").distinct().toPandas()["churn_flag"]) == {0, 1}


def test_calendar_measures_respect_missing_months(spark):
    df = spark.createDataFrame([("2024-01", 10), ("2024-03", 30), ("2024-04", 60)], "month string, outage_minutes int")
    mom = {r["month"]: r["mom_change"] for r in M.month_over_month(df).collect()}
    assert mom == {"2024-01": None, "2024-03": None, "2024-04": 1.0}
    roll = {r["month"]: r["rolling_3m"] for r in M.rolling_months(df).collect()}
    assert roll == {"2024-01": 10, "2024-03": 40, "2024-04": 90}


def test_lift_ignores_filters(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 0, "x"), ("b", 0, "y"), ("b", 0, "x")],
                               "seg string, churn_flag int, other string").withColumns(
        {c: F.lit(1.0) for c in ("monthly_charges", "total_charges", "churn_probability",
                                 "network_quality_score")}).withColumn("risk_band", F.lit("Low"))
    got = {r["seg"]: (r["churn_lift_vs_base"], r["share_of_all_churn"])
           for r in M.against_base(df, ["seg"], {"other": "x"}).collect()}
    assert got == {"a": (2.0, 1.0), "b": (0.0, 0.0)}


def test_tree_follows_a_null_branch(spark):
    df = spark.createDataFrame([(None, "p", 1), (None, "q", 0), ("x", "p", 0)], "a string, b string, churn_flag int")
    got = [(r["level"], r["value"], r["customers"]) for r in R.decomposition_tree(df, ["a", "b"]).orderBy("level").collect()]
    assert got == [(1, None, 2), (2, "p", 1)]


def test_keys_last_over_loads(spark):
    schema = "id string, a string, b int"
    one = spark.createDataFrame([("x", "p", 1), ("y", None, 2), (None, "q", 3)], schema)
    first = S.lasting_dim(one, ["id", "a", "b"], "k", None, ["id"])
    before = {r["id"]: r["k"] for r in first.collect()}
    two = spark.createDataFrame([("x", "other", 1), (None, "q", 3), ("w", "p", 1), ("a", None, None), ("w", "p", 1)], schema)
    second = S.lasting_dim(two, ["id", "a", "b"], "k", first, ["id"])
    rows = {r["id"]: r for r in second.collect()}
    assert {i: rows[i]["k"] for i in before} == before and rows["x"]["a"] == "other" and rows["y"]["b"] == 2
    assert (rows["a"]["k"], rows["w"]["k"]) == (4, 5)
    third = S.lasting_dim(two, ["id", "a", "b"], "k", second, ["id"])
    assert sorted(map(str, third.collect())) == sorted(map(str, second.collect()))
    assert S.lasting_dim(one, ["a"], "k", first.select("k", "a").limit(0)).count() == 3


def test_star_over_two_loads(star, raw_frame, kpis):
    from tests.conftest import NEW, PERSON, PHONE_ONLY

    more = raw_frame([{"customerID": "A-1", "Contract": "Two year"}, NEW, {"gender": "Female"}, PHONE_ONLY])
    again = S.build_star(telemetry_features(customer_features(conform(more)), kpis), kpis, star)
    keys = {r["customer_id"]: r["customer_key"] for r in star["dim_customer"].collect()}
    now = {r["customer_id"]: r for r in again["dim_customer"].collect()}
    assert {c: now[c]["customer_key"] for c in keys} == keys and now["A-1"]["customer_key"] == 4
    assert now[PERSON["customerID"]]["gender"] == "Female"
    assert again["fact_customer"].count() == 4 and again["fact_customer"].select("customer_key").distinct().count() == 4
