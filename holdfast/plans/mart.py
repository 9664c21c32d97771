"""Stored mart per table folder: each stage is built once per application, when first read."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators.cleaning import conform
from holdfast.operators.customer_features import customer_features
from holdfast.operators.star import build_star
from holdfast.operators.telemetry import telemetry_features
from holdfast.plans import bindings
from holdfast.session import scratch_path, together
from holdfast.sources.writers import write_parquet, write_star


class Mart:
    """Every stage is parquet below the shared folder, so that later stages and queries
    start from files and a lost executor costs at most the running step."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = bindings.tables_at(spark, sf_dir)
        self.root = scratch_path(spark, "mart")

    def _store(self, df: DataFrame, name: str) -> DataFrame:
        return write_parquet(df, f"{self.root}/{name}")

    @cached_property
    def raw(self) -> DataFrame:
        return self._store(bindings.raw_feed(self.tables), "raw")

    @cached_property
    def customers(self) -> DataFrame:
        return self._store(conform(self.raw), "customers")

    @cached_property
    def kpis(self) -> DataFrame:
        return self._store(bindings.telemetry(self.tables), "kpis")

    @cached_property
    def monthly(self) -> DataFrame:
        return self._store(bindings.monthly(self.tables), "monthly")

    @cached_property
    def features(self) -> DataFrame:
        # orders and events have nothing in common until here
        made = together(self.spark, {"customers": lambda: self.customers, "kpis": lambda: self.kpis})
        return self._store(telemetry_features(customer_features(made["customers"]), made["kpis"]),
                           "features")

    @cached_property
    def scored(self) -> DataFrame:
        return self._store(bindings.rule_scores(self.features), "scored")

    @cached_property
    def star(self) -> dict[str, DataFrame]:
        return write_star(build_star(self.scored, self.kpis), f"{self.root}/star")


_marts: dict[tuple[str, str], Mart] = {}


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    return _marts.setdefault((spark.sparkContext.applicationId, sf_dir), Mart(spark, sf_dir))
