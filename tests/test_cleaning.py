from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import to_number, to_whole
from holdfast.operators.cleaning import (cleaning_report, conform, first_per_key, unknown_lists, unknown_map,
                                         unknown_values)


def one(df, customer):
    return df.where(F.col("customer_id") == customer).first()


def test_output_columns_and_types(raw_frame):
    clean = conform(raw_frame())
    assert clean.columns == [*K.RAW_TO_CONFORMED.values(), "churn_flag"]
    types = dict(clean.dtypes)
    assert types["tenure_months"] == "int" and types["total_charges"] == "double"


def test_blank_total_of_new_customer_is_zero(raw_frame):
    row = one(conform(raw_frame()), "K-23")
    assert row["total_charges"] == 0.0 and row["senior_citizen"] == "No" and row["churn_flag"] == 0
    report = cleaning_report(raw_frame()).first()
    assert report["total_charges_blank"] == 1 and report["total_charges_imputed_zero"] == 1
    assert report["total_charges_unparseable"] == 0


def test_first_copy_wins_and_is_counted(raw_frame):
    raw = raw_frame([{"Contract": "One year"}, {"Contract": "Two year", "customerID": " K-17\t"}])
    assert [r["contract"] for r in conform(raw).collect()] == ["One year"]
    report = cleaning_report(raw).first()
    assert (report["rows_in"], report["rows_out"], report["duplicates_removed"]) == (2, 1, 1)


def test_hot_key_keeps_one_row_and_limits_before_the_shuffle(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as seq")
    kept = first_per_key(df, ["k"], "seq")
    assert kept.count() == df.select("k").distinct().count()
    assert kept.where("k = 0").first()["seq"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unknown_category_is_reported_and_kept(raw_frame):
    clean = conform(raw_frame([{"Contract": "Weekly"}, {"customerID": "x"}]))
    assert clean.count() == 2
    assert [tuple(r) for r in unknown_values(clean).collect()] == [("contract", "Weekly", 1)]


def test_unknown_values_are_listed_whole(raw_frame):
    raw = raw_frame([{"customerID": f"u{i}", "Contract": f"c{i % 30:02d}", "gender": "X"} for i in range(60)])
    assert cleaning_report(raw).first()["unknown_category_values"] == 31
    lists = {r["column"]: r["values"] for r in unknown_lists(unknown_values(conform(raw))).collect()}
    assert lists == {"contract": [f"c{i:02d}" for i in range(30)], "gender": ["X"]}


def test_unparseable_total_is_estimated(raw_frame):
    raw = raw_frame([{"TotalCharges": "n/a", "tenure": "10", "MonthlyCharges": "50"}])
    assert one(conform(raw), "K-17")["total_charges"] == 500.0
    assert cleaning_report(raw).first()["total_charges_unparseable"] == 1


def test_numbers_from_text(spark):
    cases = {"12": 12.0, " 1.5 ": 1.5, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "12d": None,
             "NaN": None, "inf": None, "": None, "x": None, "-3": -3.0}
    df = spark.createDataFrame(list(cases.items()), "t string, want double")
    assert all(r["got"] == r["want"] for r in df.select("want", to_number("t").alias("got")).collect())
    whole = spark.createDataFrame([("3.9", 3), ("-3.9", -3), ("x", 0), ("1e30", 0)], "t string, w int")
    assert all(r["got"] == r["w"] for r in whole.select("w", to_whole("t").alias("got")).collect())


def test_all_whitespace_is_trimmed(raw_frame):
    clean = conform(raw_frame([{"customerID": "\t  a b  \n"}]))
    assert clean.first()["customer_id"] == "a b"


def test_lists_are_bounded_and_say_how_many_there_are(spark):
    rows = spark.range(3000).selectExpr("'contract' as column", "format_string('v%04d', id) as value", "1L as rows")
    rows = rows.union(spark.sql("select 'gender', 'x', 5L"))
    got = {r["column"]: r for r in unknown_lists(rows, 4).collect()}
    assert got["contract"]["values"] == ["v0000", "v0001", "v0002", "v0003"] and got["contract"]["n_values"] == 3000
    assert unknown_map(rows, 2).first()["unknown"] == {"contract": ["v0000", "v0001"], "gender": ["x"]}
    assert unknown_map(rows.limit(0)).first()["unknown"] == {}
