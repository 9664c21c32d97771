import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.operators.cleaning import conform
from holdfast.operators.quality import DataQualityError
from holdfast.operators.customer_features import customer_features
from holdfast.plans import batch
from holdfast.sources import readers, writers


def csv(path, text):
    path.write_text(text)
    return str(path)


def test_text_scan_keeps_blanks_and_spaces(spark, tmp_path):
    df = readers.read_text_csv(spark, csv(tmp_path / "a.csv", 'a,b,c\n1,, \n"NA","x, y",null\n'))
    assert [tuple(r)[:3] for r in df.collect()] == [("1", "", " "), ("NA", "x, y", "null")]


def test_contract_reorders_drops_and_raises(spark, tmp_path):
    cols = ["extra", *reversed(K.RAW_COLUMNS)]
    path = csv(tmp_path / "raw.csv", ",".join(cols) + "\n" + ",".join(c + "!" for c in cols) + "\n")
    df = readers.read_customers(spark, path)
    assert df.columns == [*K.RAW_COLUMNS, "feed_seq"]
    assert df.first()["Contract"] == "Contract!"
    with pytest.raises(K.SchemaError, match="TotalCharges"):
        readers.check_columns([c for c in cols if c != "TotalCharges"], K.RAW_COLUMNS, "raw")


def test_first_row_of_the_file_wins(spark, tmp_path, raw_frame):
    rows = raw_frame([{"Contract": c} for c in ("One year", "Two year", "Weekly")]).drop("feed_seq")
    path = writers.write_csv(rows.coalesce(1), str(tmp_path / "raw"))
    assert conform(readers.read_customers(spark, path)).first()["contract"] == "One year"


def test_telemetry_coercion(spark, tmp_path):
    text = ",".join(K.TELEMETRY_COLUMNS) + "\n a ,2025-01,1,bad,1.5,,7,x,\nb,2025-02,2,1,2,3,4,5,6\n"
    rows = readers.read_telemetry(spark, csv(tmp_path / "k.csv", text)).collect()
    assert tuple(rows[0]) == ("a", "2025-01", 1, None, 1.5, None, 7.0, None, 0)
    assert rows[1]["complaints"] == 6


def test_optional_telemetry(spark, tmp_path):
    assert readers.read_optional_telemetry(spark, None) is None
    assert readers.read_optional_telemetry(spark, str(tmp_path / "none")) is None


def test_intake(spark, tmp_path):
    head = ",".join(K.RAW_COLUMNS)
    text = head + "\n" + ",".join("1" for _ in K.RAW_COLUMNS) + "\n"
    (tmp_path / "in").mkdir()
    csv(tmp_path / "in" / "a.csv", text)
    csv(tmp_path / "in" / "b c.csv", head.replace("gender", "sex") + "\n")
    rows = readers.verify_intake(spark, str(tmp_path / "in"), expected_rows=2, expected_digest="7",
                                 sha256_up_to=10_000).orderBy("path").collect()
    assert [(r["header_ok"], r["rows"], r["rows_ok"], r["digest_ok"]) for r in rows] == [
        (True, 1, False, False), (False, 0, False, False)]
    assert rows[0]["sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[0]["length"] == len(text)
    again = readers.verify_intake(spark, str(tmp_path / "in" / "a.csv"), expected_rows=1,
                                  expected_digest=rows[0]["digest"]).first()
    assert again["rows_ok"] and again["digest_ok"] and again["sha256"] is None
    with pytest.raises(Exception, match="no SHA-256"):
        readers.verify_intake(spark, str(tmp_path / "in"), sha256_up_to=5).collect()


def test_two_headers_quotes_and_bad_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    csv(tmp_path / "in" / "a.csv", 'k,v\n1,"He said ""hi"", ok"\n')
    csv(tmp_path / "in" / "b.csv", "v,k\nx,2\n")
    csv(tmp_path / "in" / "empty.csv", "")
    rows = readers.read_text_csv(spark, str(tmp_path / "in"), ["k", "v"]).collect()
    assert sorted(map(tuple, rows)) == [("1", 'He said "hi", ok'), ("2", "x")]
    broken = readers.read_text_csv(spark, csv(tmp_path / "c.csv", 'k,v\n1,"a\nb"\n'), multi_line=True)
    assert [tuple(r) for r in broken.collect()] == [("1", "a\nb")]
    for text in ("k,v,w\n1,2,3,4\n", "k,v,w\n1,2\n"):
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            readers.read_text_csv(spark, csv(tmp_path / "d.csv", text), ["k"]).collect()
    csv(tmp_path / "in" / "z.csv", "k\n3\n")
    with pytest.raises(K.SchemaError, match="z.csv"):
        readers.read_text_csv(spark, str(tmp_path / "in"), ["k", "v"])


def test_blank_default_on_typed_load(spark, tmp_path):
    head = ",".join(K.TYPED_LOAD["fact_customer"])
    cells = ",".join("" for _ in K.TYPED_LOAD["fact_customer"])
    row = readers.typed_load(spark, csv(tmp_path / "f.csv", f"{head}\n{cells}\n"), "fact_customer").first()
    assert row["kpi_months"] == 0 and row["total_outage_minutes"] is None


def test_typed_load_fails_on_a_bad_cell(spark, tmp_path):
    head = ",".join(K.TYPED_LOAD["dim_contract"])
    good = readers.typed_load(spark, csv(tmp_path / "g.csv", f"{head}\n1,a,,c,1\n"), "dim_contract")
    assert good.first()["paperless_billing"] is None
    bad = readers.typed_load(spark, csv(tmp_path / "b.csv", f"{head}\nx,a,b,c,1\n"), "dim_contract")
    with pytest.raises(Exception, match="x"):
        bad.collect()


def test_csv_sink_has_header_and_lf(spark, tmp_path):
    df = spark.createDataFrame([(1, " a "), (2, None)], "k int, v string").coalesce(1)
    part = glob.glob(writers.write_csv(df, str(tmp_path / "out")) + "/part-*.csv")[0]
    assert open(part, newline="").read() == 'k,v\n1, a \n2,""\n' or open(part, newline="").read() == "k,v\n1, a \n2,\n"


def test_audit_is_written_before_the_gate_raises(spark, tmp_path, raw_frame):
    bad = customer_features(conform(raw_frame([{"Contract": "Weekly"}])))
    path = str(tmp_path / "audit")
    with pytest.raises(DataQualityError):
        writers.audited_gate(bad, None, path, run_ts="2024-01-01T00:00:00Z")
    writers.audited_gate(bad, None, path, fail_on_error=False, run_ts="2024-01-02T00:00:00Z")
    audit = writers.read_audit(spark, path)
    assert audit.count() == 62 and audit.select("run_ts").distinct().count() == 2


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    keys = spark.range(50).withColumnRenamed("id", "customer_key")
    writers.save_tables({"dim_customer": keys, "fact_customer": keys.withColumn("x", F.lit(1))},
                        str(tmp_path / "wh"), prefix="t_", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_fact_customer").join(spark.table("t_dim_customer"), "customer_key")
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_batch(spark, tmp_path, raw_frame, kpi_frame):
    rows = [{"customerID": f"c{i:03d}", "tenure": str(i % 73), "MonthlyCharges": f"{20 + i % 90}",
             "TotalCharges": str((20 + i % 90) * (i % 73)), "Churn": "Yes" if i % 4 == 0 else "No",
             "Contract": ["Month-to-month", "One year", "Two year"][i % 3],
             "PaymentMethod": ["Electronic check", "Mailed check"][i % 2]} for i in range(120)]
    run = batch.run(spark, raw_frame(rows), kpi_frame([f"c{i:03d}" for i in range(40)]),
                    str(tmp_path / "out"), expected_rows=120, boosted_rounds=2)
    assert [s[1] for s in run.steps] == ["clean", "load_kpis", "features", "quality_gate", "model",
                                         "warehouse", "analytics"]
    assert len(run.features.columns) == 52 and len(run.answers) == 8
    assert run.star["fact_customer"].where("risk_band is null").count() == 0
    assert spark.read.json(str(tmp_path / "out/manifest")).count() == 7
    assert set(run.models) == {"customer", "customer_network"}
    loaded = readers.typed_load(spark, str(tmp_path / "out/star_csv/fact_customer"), "fact_customer")
    assert loaded.count() == 120 and dict(loaded.dtypes)["churn_probability"] == "decimal(6,4)"


def test_stored_steps_go_with_drop_scratch(spark, tmp_path):
    from pathlib import Path

    from holdfast.session import drop_scratch, scratch_path, scratch_root
    other = spark.newSession()
    writers.write_parquet(other.range(3), scratch_path(other, "step"))
    root = Path(scratch_root(other))
    kept = root.rename(root.with_name("kept"))  # other tests of this session still read theirs
    writers.write_parquet(other.range(3), scratch_path(other, "step"))
    assert any(root.iterdir())
    drop_scratch(other)
    assert not root.exists()
    kept.rename(root)


def test_batch_releases_the_driver_before_each_step(spark, tmp_path, raw_frame, kpi_frame, monkeypatch):
    calls, real = [], batch.release
    monkeypatch.setattr(batch, "release", lambda s: (calls.append(s), real(s)))
    run = batch.run(spark, raw_frame(), kpi_frame(["K-17"]), str(tmp_path / "out"), with_model=False, fail_on_dq=False)
    assert len(calls) == len(run.steps) == 6
