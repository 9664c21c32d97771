"""A batch that goes on behind its last whole step."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators.quality import DataQualityError
from holdfast.plans import batch, journal
from holdfast.sources import writers

STEPS = ["clean", "load_kpis", "features", "quality_gate", "model", "warehouse", "analytics"]


class Lost(Exception):
    """Stands for a driver that is gone."""


@pytest.fixture
def feed(raw_frame, kpi_frame):
    ids = [f"c{i:03d}" for i in range(60)]
    rows = [{"customerID": c, "tenure": str(1 + i % 70), "MonthlyCharges": f"{20 + i % 90}",
             "TotalCharges": str((20 + i % 90) * (1 + i % 70)), "Churn": "Yes" if i % 4 == 0 else "No",
             "Contract": ["Month-to-month", "One year", "Two year"][i % 3]} for i, c in enumerate(ids)]
    return raw_frame(rows), kpi_frame(ids[:20])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def lost(*args, **kwargs):
    raise Lost


def test_goes_on_behind_the_gate(spark, feed, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(batch.propensity, "train_all", lost)
        with pytest.raises(Lost):
            batch.run(spark, *feed, out, boosted_rounds=2, resume=True)
    ran = []
    for owner, name in ((batch, "conform_tagged"), (batch, "telemetry_features"), (writers, "audited_gate"),
                        (batch.propensity, "train_all"), (batch, "build_star")):
        whole = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda *a, _n=name, _w=whole, **k: (ran.append(_n), _w(*a, **k))[1])
    run = batch.run(spark, *feed, out, boosted_rounds=2, resume=True)
    assert ran == ["train_all", "build_star"]
    assert run.resumed == STEPS[:4] and [s[1] for s in run.steps] == STEPS
    again = batch.run(spark, *feed, out, boosted_rounds=2, resume=True)
    assert again.resumed == STEPS and ran == ["train_all", "build_star"]
    assert rows(again.features) == rows(run.features) and again.features.columns == run.features.columns
    for name, df in run.star.items():
        assert again.star[name].columns == df.columns and rows(again.star[name]) == rows(df)
    assert set(again.models) == {"customer", "customer_network"}
    for name, model in run.models.items():
        assert rows(again.models[name].metrics) == rows(model.metrics)
        assert list(again.models[name].model.coefficients) == list(model.model.coefficients)
    assert rows(again.dq.drop("run_ts")) == rows(run.dq.drop("run_ts"))
    assert len(again.answers) == 8


def test_a_star_that_was_cut_off_is_written_anew(spark, feed, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(writers, "write_star_csv", lost)  # the Parquet tables are there, the step is not whole
        with pytest.raises(Lost):
            batch.run(spark, *feed, out, with_model=False, resume=True)
    run = batch.run(spark, *feed, out, with_model=False, resume=True)
    assert run.resumed == STEPS[:4]
    plain = batch.run(spark, *feed, str(tmp_path / "plain"), with_model=False)
    assert plain.resumed == [] and rows(plain.star["fact_customer"]) == rows(run.star["fact_customer"])


def test_other_input_or_parameters_share_no_step(spark, feed, tmp_path):
    raw, kpis = feed
    out = str(tmp_path / "out")
    batch.run(spark, raw, kpis, out, with_model=False, resume=True)
    other = raw.withColumn("Churn", F.when(F.col("customerID") == "c003", "Yes").otherwise(F.col("Churn")))
    run = batch.run(spark, other, kpis, out, with_model=False, resume=True)
    assert run.resumed == []
    assert batch.run(spark, raw, None, out, with_model=False, resume=True).resumed == []
    assert batch.run(spark, raw, kpis, out, with_model=False, expected_rows=60, resume=True).resumed == []
    first = batch.run(spark, raw, kpis, out, with_model=False, resume=True)
    assert len(first.resumed) == 6
    assert first.features.agg(F.sum("churn_flag")).first()[0] + 1 == run.features.agg(F.sum("churn_flag")).first()[0]


def test_a_gate_that_raised_runs_again(spark, feed, tmp_path):
    raw, kpis = feed
    bad = kpis.withColumn("month_index", F.lit(99))
    for _ in range(2):
        with pytest.raises(DataQualityError):
            batch.run(spark, raw, bad, str(tmp_path / "out"), with_model=False, resume=True)


def test_fingerprint(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x")], "k string, v string")

    def of(d, **p):
        return journal.fingerprint({"t": d}, p)

    assert of(df) == of(df.orderBy(F.desc("k")).repartition(3))
    different = [of(df), of(df.distinct()), of(df.fillna("")), of(df.limit(0)), of(None), of(df, n=1),
                 of(df.withColumnRenamed("v", "w")), of(df.withColumn("v", F.lit(None).cast("string")))]
    assert len(set(different)) == len(different)
