"""The models of a run are fitted at the same time, with the results they have alone."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from holdfast import session
from holdfast.plans import propensity as P

WAIT = 60


@pytest.fixture(scope="module")
def people(spark):
    rows = [(f"c{i:03d}", i % 60, 20.0 + i * 7 % 90, ("Month-to-month", "One year", "Two year")[i % 3],
             None if i % 41 == 0 else ("DSL", "No")[i % 2], 40.0 + i % 17, int(i * 13 % 10 < 4 - i % 3))
            for i in range(240)]
    return spark.createDataFrame(rows, "customer_id string, tenure_months int, monthly_charges double, "
                                       "contract string, internet_service string, avg_latency_ms double, churn_flag int")


def test_feature_sets_are_trained_at_the_same_time(people, monkeypatch):
    meet = threading.Barrier(2, timeout=WAIT)
    monkeypatch.setattr(P, "train", lambda marked, name, boosted_rounds: (meet.wait(), name)[1])
    assert P.train_all(people, True, 1) == {"customer": "customer", "customer_network": "customer_network"}


def test_boosted_benchmark_runs_beside_the_linear_model(people, monkeypatch):
    meet, linear, boosted = threading.Barrier(2, timeout=WAIT), P.logistic_model, P.boosted_model
    monkeypatch.setattr(P, "logistic_model", lambda n: (meet.wait(), linear(n))[1])
    monkeypatch.setattr(P, "boosted_model", lambda rounds, seed: (meet.wait(), boosted(rounds, seed))[1])
    run = P.train(people, boosted_rounds=2)
    assert run.boosted.first()["engine"] == "mllib.GBTClassifier" and run.metrics.count() == 1


def test_together_gives_what_each_set_gives_alone(people):
    both = P.train_all(people, True, 3)
    marked = P.stratified_split(people)
    for name, run in both.items():
        alone = P.train(marked, name, boosted_rounds=3)
        assert run.feature_set == name
        assert run.metrics.collect() == alone.metrics.collect()
        assert run.boosted.collect() == alone.boosted.collect()
        assert run.drivers.collect() == alone.drivers.collect()
        assert run.scores.exceptAll(alone.scores).count() == 0 == alone.scores.exceptAll(run.scores).count()


def test_large_sets_are_fitted_in_turn(people, monkeypatch):
    """Where a tree level has a task for every core, no two fits hold their rows at the same time."""
    running, most, lock = [], [], threading.Lock()

    def alone(fit):
        def fitted(*args, **kwargs):
            with lock:
                running.append(fit)
                most.append(len(running))
            time.sleep(0.5)
            try:
                return fit(*args, **kwargs)
            finally:
                running.remove(fit)
        return fitted

    want = P.train_all(people, True, 2)
    monkeypatch.setattr(P, "ROWS_PER_TREE_TASK", 20)
    for name in ("linear_run", "boosted_metrics"):
        monkeypatch.setattr(P, name, alone(getattr(P, name)))
    got = P.train_all(people, True, 2)
    assert most == [1] * 4
    for name, run in want.items():
        assert got[name].metrics.collect() == run.metrics.collect()
        assert got[name].boosted.count() == 1
        assert got[name].scores.exceptAll(run.scores).count() == 0 == run.scores.exceptAll(got[name].scores).count()


def test_a_failing_set_is_not_lost(people):
    with pytest.raises(ValueError, match="contract"):
        P.train_all(people.withColumn("contract", F.concat(F.lit("x"), "customer_id")), True, 1)


def test_one_local_folder_however_many_ask(spark, monkeypatch):
    monkeypatch.setattr(session, "_local_folders", {})
    slow = session.tempfile.TemporaryDirectory

    def make(**options):
        threading.Event().wait(0.2)
        return slow(**options)

    monkeypatch.setattr(session.tempfile, "TemporaryDirectory", make)
    found = session.together(spark, {str(i): lambda: session.scratch_root(spark) for i in range(4)})
    assert len(set(found.values())) == 1


def test_the_model_can_be_sent_to_tasks_after_an_observation(spark, people):
    session.cut_measured(spark.range(3).toDF("n"))
    run, d = P.train(people, boosted_rounds=0), P.design(people)
    assert not run.model.hasSummary
    assert run.model.transform(P.with_vector(d.rows, d.inputs)).where("prediction in (0, 1)").count() == 240
