"""The whole batch: feed -> clean -> features -> gate -> model -> star -> answers."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators.cleaning import cleaning_report, conform_tagged, unknown_values
from holdfast.operators.customer_features import customer_features
from holdfast.operators.quality import status_counts, utc_stamp
from holdfast.operators.star import build_star
from holdfast.operators.telemetry import telemetry_features
from holdfast.plans import analytics, propensity
from holdfast.plans.journal import LAYOUT, Journal, fingerprint, load_models, store_models
from holdfast.session import release
from holdfast.sources import writers


@dataclass
class BatchRun:
    features: DataFrame
    dq: DataFrame
    star: dict[str, DataFrame]
    answers: dict[str, DataFrame]
    models: dict[str, propensity.ModelRun]
    manifest: DataFrame
    steps: list[tuple] = field(default_factory=list)
    resumed: list[str] = field(default_factory=list)


def _stored(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write, then count from the file footers."""
    stored = writers.write_parquet(df, path)
    return stored, stored.count()


def run(spark: SparkSession, raw: DataFrame, kpis: DataFrame | None, out: str,
        arrival: str = "feed_seq", with_model: bool = True, fail_on_dq: bool = True,
        expected_rows: int | None = None,
        boosted_rounds: int = propensity.BOOSTED_ROUNDS, resume: bool = False) -> BatchRun:
    """Run every step and store its output below ``out``.

    Each step's result is written once and read back by the later steps, so nothing
    is computed twice and a lost executor costs at most the running step. Before each step the driver collects what
    the steps before it left in its memory.

    With ``resume`` the tables lie below ``out/run-<fingerprint of inputs and parameters>`` and a step that an earlier
    call with the same fingerprint has finished is read, not run: a batch whose driver was lost goes on behind its
    last whole step. A gate that raised is not finished and runs again. Audit table and manifest are common to all runs.
    """
    began, steps, run_ts = time.perf_counter(), [], utc_stamp()
    if kpis is not None and kpis.isEmpty():
        kpis = None
    root = out
    if resume:
        root = f"{out}/run-" + fingerprint({"raw": raw, "telemetry": kpis}, {
            "arrival": arrival, "with_model": with_model, "fail_on_dq": fail_on_dq, "expected_rows": expected_rows,
            "boosted_rounds": boosted_rounds, "layout": LAYOUT})
    journal = Journal(spark, root, keep=resume)

    def step(name: str, work: Callable) -> dict[str, DataFrame]:
        release(spark)
        tables, info = journal.step(name, work)
        steps.append((run_ts, name, round(time.perf_counter() - began, 2), {k: str(v) for k, v in info.items()}))
        return tables

    def clean():
        tagged, n = _stored(conform_tagged(raw, arrival), f"{root}/customers_clean")
        report = cleaning_report(raw, arrival, tagged).first().asDict()
        unknown, _ = _stored(unknown_values(tagged.drop("total_class")), f"{root}/unknown_values")  # whole, however many
        report["unknown_category_values"] = {r["column"]: r["count"] for r in
                                             unknown.groupBy("column").count().collect()}
        return {"customers_clean": tagged}, {"rows": n, **report}

    customers = step("clean", clean)["customers_clean"].drop("total_class")

    def load_kpis():
        stored, n = _stored(kpis, f"{root}/telemetry")
        return {"telemetry": stored}, {"rows": n}

    if kpis is not None:
        kpis = step("load_kpis", load_kpis)["telemetry"]

    def derive():
        stored, n = _stored(telemetry_features(customer_features(customers), kpis), f"{root}/customers_features")
        return {"customers_features": stored}, {"rows": n, "columns": len(stored.columns)}

    features = step("features", derive)["customers_features"]

    def gate():
        found = writers.audited_gate(features, kpis, f"{out}/dq_results", expected_rows, fail_on_dq, run_ts)
        if resume:
            found = writers.write_parquet(found, f"{root}/dq")
        return {"dq": found}, {r["status"]: r["checks"] for r in status_counts(found).collect()}

    dq = step("quality_gate", gate)["dq"]

    models: dict[str, propensity.ModelRun] = {}

    def model():
        models.update(propensity.train_all(features, kpis is not None, boosted_rounds))
        scored, _ = _stored(propensity.attach_scores(features, models["customer"]), f"{root}/customers_scored")
        writers.write_model_artifacts(models, f"{root}/model")
        writers.write_scores(scored, f"{root}/scores")
        return ({"customers_scored": scored} | (store_models(models, root) if resume else {}),
                {k: m.metrics.first()["roc_auc_test"] for k, m in models.items()})

    if with_model:
        tables = step("model", model)
        features = tables["customers_scored"]
        models = models or load_models(tables, root)

    def warehouse():
        star = writers.write_star(build_star(features, kpis), f"{root}/star")
        writers.write_star_csv(star, f"{root}/star_csv")
        return {f"star/{name}": df for name, df in star.items()}, {name: df.count() for name, df in star.items()}

    star = {path.removeprefix("star/"): df for path, df in step("warehouse", warehouse).items()}
    answers = analytics.answer_all(star)

    def analyse():
        writers.write_results(answers, f"{root}/analytics")
        return {}, {"questions": len(answers)}

    step("analytics", analyse)

    manifest = spark.createDataFrame(
        steps, "run_ts string, step string, elapsed_s double, info map<string,string>")
    writers.write_manifest(manifest, f"{out}/manifest")
    return BatchRun(features, dq, star, answers, models, manifest, steps, journal.resumed)
