import pytest
from pyspark.sql import functions as F

from holdfast.operators import quality as Q
from holdfast.operators.cleaning import conform
from holdfast.operators.customer_features import customer_features
from holdfast.operators.joins import matched_rows, orphan_count

IDS = ["K-17", "K-23", "K-58"]


@pytest.fixture(scope="module")
def customers(raw_frame):
    return customer_features(conform(raw_frame()))


def status(results):
    return {r["check_name"]: r["status"] for r in results.collect()}


def test_clean_input_has_no_failure(customers, kpi_frame):
    dq = Q.quality_gate(customers, kpi_frame(IDS), expected_rows=3)
    rows = dq.collect()
    assert len(rows) == 43 and not [r for r in rows if r["status"] == "FAIL"]
    assert len({r["run_ts"] for r in rows}) == 1 and rows[0]["run_ts"].endswith("Z")
    assert sorted(r["seq"] for r in rows) == list(range(1, 44))


def test_without_telemetry_there_are_31_checks(customers):
    assert Q.quality_gate(customers).count() == 31


def test_row_count_differs_is_a_warning(customers, kpi_frame):
    assert status(Q.quality_gate(customers, kpi_frame(IDS), expected_rows=7043))["row_count"] == "WARN"


def test_orphan_telemetry_fails(customers, kpi_frame):
    broken = kpi_frame([*IDS, "K-99"])
    with pytest.raises(Q.DataQualityError, match="fk_customer_id_exists"):
        Q.quality_gate(customers, broken)
    dq = Q.quality_gate(customers, broken, fail_on_error=False)
    row = dq.where("check_name = 'fk_customer_id_exists'").first()
    assert (row["status"], row["observed"]) == ("FAIL", "12 orphan rows")


def test_duplicate_customer_fails(customers):
    with pytest.raises(Q.DataQualityError, match="unique_customer_id"):
        Q.quality_gate(customers.unionByName(customers.limit(1)))


def test_unknown_contract_fails(customers):
    dq = Q.quality_gate(customers.withColumn("contract", F.lit("Weekly")), fail_on_error=False)
    row = dq.where("check_name = 'domain_contract'").first()
    assert (row["status"], row["observed"], row["details"]) == ("FAIL", "1 unknown values", "Weekly")


def test_only_the_first_ten_unknown_values_are_listed(spark):
    df = spark.range(500).selectExpr("concat('v', lpad(id, 3, '0')) as c")
    row = Q.run_checks({"t": df}, [Q.OneOf("t", "c", ("v000",))], "x").first()
    assert row["observed"] == "499 unknown values"
    assert row["details"] == ", ".join(f"v{i:03d}" for i in range(1, 11))


def test_range_ignores_nulls_and_text(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("99",)], "c string")
    row = Q.run_checks({"t": df}, [Q.InRange("t", "c", 0, 10, Q.WARN)], "x").first()
    assert (row["status"], row["observed"], row["expectation"]) == ("WARN", "1 outside", "[0, 10]")


def test_absent_column_counts_as_null(spark):
    row = Q.run_checks({"t": spark.range(4)}, [Q.NotNull("t", "nope")], "x").first()
    assert (row["status"], row["observed"]) == ("FAIL", "4 nulls")


def test_null_keys_are_equal_and_null_children_are_orphans(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert Q.duplicate_rows(df, ["k"]).first()[0] == 1
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    assert orphan_count(df, parent, "k").first()[0] == 2
    assert matched_rows(df, parent, "k").count() == 1


def test_reconciliation_counts_zero_expectation_as_fine(spark):
    rows = [(1.0, 10, 10.0), (0.0, 10, 50.0), (1.0, 10, 30.0), (1.0, 0, 99.0)]
    df = spark.createDataFrame(rows, "monthly_charges double, tenure_months int, total_charges double")
    row = Q.run_checks({"t": df}, [Q.TotalsReconcile("t")], "x").first()
    assert (row["status"], row["observed"]) == ("WARN", "33.3% rows deviate > 50%")
    assert Q.run_checks({"t": df.limit(0)}, [Q.TotalsReconcile("t")], "x").first()["status"] == "PASS"


def test_aggregate_rules_share_one_scan(customers, kpi_frame):
    plan = Q.fused_checks(customers, [(i, r) for i, r in enumerate(Q.customer_rules(), 1)
                                      if isinstance(r, Q.Check)])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [") == 1


def test_latest_run_only(customers):
    a = Q.run_checks({"customers": customers}, [Q.RowCount("customers")], "2024-01-01T00:00:00Z")
    b = Q.run_checks({"customers": customers}, [Q.RowCount("customers")], "2024-01-02T00:00:00Z")
    assert [r["run_ts"] for r in Q.latest_run(a.unionByName(b)).collect()] == ["2024-01-02T00:00:00Z"]
