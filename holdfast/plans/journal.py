"""Steps of a batch that are done, so that a batch whose driver was lost goes on behind its last whole step.

Outputs lie below a folder named after a fingerprint of inputs and parameters: another feed or other parameters never meet
them, and a step that was cut off is written anew in its place. A step counts as done once its record is stored, which is
after its outputs are.

The fingerprint reads the inputs once. It does not depend on the order of rows or on files; repeated rows, NULL against blank
cells, column names and types all change it. An absent table is different from an empty one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.plans.propensity import ModelRun
from holdfast.sources.versioned import Files

LAYOUT = 1  # to be raised when a step of the batch computes or stores something else
MODEL_FRAMES = ("metrics", "drivers", "lift", "roc", "scores", "boosted")


def table_digest(df: DataFrame) -> str:
    """Rows and the sum of 60 bits of each row's MD5: parts add up, so tasks share the work."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in df.columns]
    row = F.md5(F.concat_ws("\u0001", *cells))
    got = df.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias("d")).first()
    return f"{got['n']}:{got['d']}:{df.schema.json()}"


def fingerprint(tables: dict[str, DataFrame | None], parameters: dict[str, Any]) -> str:
    parts = {name: None if df is None else table_digest(df) for name, df in tables.items()}
    text = json.dumps([parts, parameters], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:24]


class Journal:
    """Records of the steps below ``root``; with ``keep=False`` nothing is recorded and every step runs."""

    def __init__(self, spark: SparkSession, root: str, keep: bool = True):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.files = Files(spark, f"{self.root}/_steps") if keep else None
        self.resumed: list[str] = []

    def record(self, step: str) -> dict | None:
        name = f"{step}.json"
        if not self.keep or name not in self.files.names(""):
            return None
        return json.loads(self.files.read(name))

    def table(self, name: str, schema: dict) -> DataFrame:
        """A stored table with its columns in their order, also where one of them is a folder name."""
        kind = T.StructType.fromJson(schema)
        return self.spark.read.schema(kind).parquet(f"{self.root}/{name}").select(*[f"`{c}`" for c in kind.names])

    def step(self, name: str, work: Callable[[], tuple[dict[str, DataFrame], dict[str, Any]]],
             ) -> tuple[dict[str, DataFrame], dict[str, str]]:
        """Tables (by their place below ``root``, where ``work`` has stored them) and figures of a step: as recorded, or
        from running it now."""
        known = self.record(name)
        if known is not None:
            self.resumed.append(name)
            return ({t: self.table(t, s) for t, s in known["tables"].items()}, known["info"] | {"resumed": "true"})
        tables, info = work()
        info = {k: str(v) for k, v in info.items()}
        if self.keep:
            self.files.put(f"{name}.json", json.dumps(
                {"tables": {t: df.schema.jsonValue() for t, df in tables.items()}, "info": info}))
        return tables, info


def store_models(models: dict[str, ModelRun], root: str) -> dict[str, DataFrame]:
    """Fitted models and their frames below ``root``; returns the frames by place."""
    found = {}
    for name, run in models.items():
        run.model.write().overwrite().save(f"{root}/models/{name}/fitted")
        for part in MODEL_FRAMES:
            df = getattr(run, part)
            if df is not None:
                path = f"models/{name}/{part}"
                df.write.mode("overwrite").parquet(f"{root}/{path}")
                found[path] = df
    return found


def load_models(tables: dict[str, DataFrame], root: str) -> dict[str, ModelRun]:
    """Models as ``store_models`` left them."""
    names = dict.fromkeys(path.split("/")[1] for path in tables if path.startswith("models/"))
    return {name: ModelRun(name, LogisticRegressionModel.load(f"{root}/models/{name}/fitted"),
                           **{part: tables[f"models/{name}/{part}"] for part in MODEL_FRAMES
                              if f"models/{name}/{part}" in tables}) for name in names}
