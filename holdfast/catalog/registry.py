"""Registered queries: inventory id -> Spark callable, and the oracle text beside it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from holdfast.catalog.sqlbase import with_stages
from holdfast.plans import bindings
from holdfast.plans.mart import Mart, mart
from holdfast.session import scratch_path


@dataclass
class Source:
    """What a query may read: the given tables, and the mart derived from them."""

    spark: SparkSession
    sf_dir: str

    def t(self, name: str) -> DataFrame:
        return bindings.tables_at(self.spark, self.sf_dir)(name)

    @property
    def tables(self) -> bindings.Tables:
        return bindings.tables_at(self.spark, self.sf_dir)

    @property
    def m(self) -> Mart:
        return mart(self.spark, self.sf_dir)

    @property
    def star(self) -> dict[str, DataFrame]:
        return self.m.star

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


Query = Callable[[Source], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def add(name: str, run: Query, sql: str | None = None) -> None:
    if name in _queries:
        raise KeyError(f"query {name} is registered twice")
    _queries[name] = run
    if sql is not None:
        _oracles[name] = sql


def _load() -> None:
    from holdfast.catalog import (feeds, frames, metrics, model, ordered, questions,  # noqa: F401
                                  relational, scalars, warehouse)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, run=run: run(Source(spark, sf_dir)))
            for name, run in _queries.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: with_stages(sql) for name, sql in _oracles.items()}
