"""Stored cube: mergeable partials of the measures by slicer columns, and answers from the smallest table that can give them.

A cube holds one row per combination of its slicer columns that occurs, with counts, whole-unit sums, decimal sums, extremes
and distinct sketches. The finest table is built in one pass over the rows; coarser ones are merged from the smallest stored
table that holds their columns, never from the rows. A question (measures, grouping, filters) is answered from the stored table
with the fewest rows among those that hold all its columns, by merging partials; the figures are those of ``measures.evaluate``
over the rows, digit by digit, but for distinct counts, which carry the error of their sketch (``sketches.DISTINCT_ERROR``,
three standard errors).

New rows: ``Cube.extended`` merges the partials of the new rows alone with the stored ones and leaves the old cube as it is.

A table has at most as many rows as there are rows, and as combinations of its columns; one that would hold more than
``MOST_CELLS`` combinations is refused, because a cube as large as its rows saves nothing. NULL is a value of a slicer column like
any other; a filter never keeps it. An empty table gives the measures of no rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.columns import READING, ratio, units
from holdfast.operators.sketches import LOG_BUCKETS
from holdfast.plans.measures import slice_by
from holdfast.sources.versioned import Files

MOST_CELLS = 50_000_000
PREFIX = "_p_"  # of the partials' columns


@dataclass(frozen=True)
class Part:
    """A partial: how it is taken from rows and how partials are merged."""

    kind: str  # count, sum, min, max, distinct
    value: Column | str

    def taken(self) -> Column:
        if self.kind == "distinct":
            return F.hll_sketch_agg(self.value, LOG_BUCKETS)
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.value)

    def merged(self, name: str) -> Column:
        if self.kind == "distinct":
            return F.hll_union_agg(name)
        if self.kind == "count":
            return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](name)


@dataclass(frozen=True)
class Layer:
    """Partials of a kind of rows, and the measures that follow from them."""

    parts: dict[str, Part]
    measures: dict[str, Callable[[Callable[[str], Column]], Column]]


def _units(total: Column, places: int) -> Column:
    return total.cast("double") / float(10 ** places)


def _mean(total: Column, n: Column, places: int = 0) -> Column:
    return total.cast("double") / F.nullif((n * 10 ** places).cast("double"), F.lit(0.0))


def customer_layer() -> Layer:
    """The measures of ``measures.customer_measures`` and ``tenure_measures`` over customer rows."""
    left = F.col("churn_flag") == 1
    cents, odds, score = units("monthly_charges", 2), units("churn_probability", 4), units("network_quality_score", 1)
    return Layer({
        "n": Part("count", F.lit(1)), "lost": Part("count", F.when(left, 1)),
        "high": Part("count", F.when(F.col("risk_band") == "High", 1)),
        "mrr": Part("sum", cents), "mrr_lost": Part("sum", F.when(left, cents)),
        "total": Part("sum", units("total_charges", 2)), "risk": Part("sum", cents * odds),
        "odds": Part("sum", odds), "scored": Part("count", odds), "score": Part("sum", score), "rated": Part("count", score),
        "tenure": Part("sum", units("tenure_months", 0)), "tenured": Part("count", "tenure_months"),
        "cheapest": Part("min", "monthly_charges"), "dearest": Part("max", "monthly_charges"),
    }, {
        "customers": lambda p: p("n"),
        "churned_customers": lambda p: p("lost"),
        "retained_customers": lambda p: p("n") - p("lost"),
        "churn_rate": lambda p: ratio(p("lost"), p("n")),
        "retention_rate": lambda p: 1 - ratio(p("lost"), p("n")),
        "monthly_recurring_revenue": lambda p: _units(p("mrr"), 2),
        "mrr_lost_to_churn": lambda p: _units(p("mrr_lost"), 2),
        "mrr_lost_share": lambda p: ratio(_units(p("mrr_lost"), 2), _units(p("mrr"), 2)),
        "arpu": lambda p: ratio(_units(p("mrr"), 2), p("n")),
        "arpu_churned": lambda p: ratio(_units(p("mrr_lost"), 2), p("lost")),
        "lifetime_revenue": lambda p: _units(p("total"), 2),
        "avg_churn_probability": lambda p: _mean(p("odds"), p("scored"), 4),
        "expected_mrr_at_risk": lambda p: _units(p("risk"), 6),
        "high_risk_customers": lambda p: p("high"),
        "high_risk_share": lambda p: ratio(p("high"), p("n")),
        "avg_network_quality_score": lambda p: _mean(p("score"), p("rated"), 1),
        "avg_tenure_months": lambda p: _mean(p("tenure"), p("tenured")),
        "lowest_monthly_charges": lambda p: p("cheapest"),
        "highest_monthly_charges": lambda p: p("dearest"),
    })


def monthly_layer() -> Layer:
    """The measures of ``measures.monthly_measures`` and ``labelled_monthly_measures`` over labelled monthly rows."""
    def read(c: str) -> dict[str, Part]:
        return {f"s_{c}": Part("sum", F.col(c).cast(READING)), f"n_{c}": Part("count", c)}

    gone, stays = F.col("churn_flag") == 1, F.col("churn_flag") == 0
    late = F.col("avg_latency_ms")
    return Layer({
        "n": Part("count", F.lit(1)), **read("dropped_call_pct"), **read("avg_latency_ms"), **read("avg_download_mbps"),
        "s_gone": Part("sum", F.when(gone, late).cast(READING)), "n_gone": Part("count", F.when(gone, late)),
        "s_stays": Part("sum", F.when(stays, late).cast(READING)), "n_stays": Part("count", F.when(stays, late)),
        "outage": Part("sum", "outage_minutes"), "complaints": Part("sum", "complaints"),
        "customers": Part("distinct", "customer_key"),
    }, {
        "customer_months": lambda p: p("n"),
        **{c if c.startswith("avg_") else f"avg_{c}": (lambda p, c=c: _mean(p(f"s_{c}"), p(f"n_{c}")))
           for c in ("dropped_call_pct", "avg_latency_ms", "avg_download_mbps")},
        "avg_latency_churned": lambda p: _mean(p("s_gone"), p("n_gone")),
        "avg_latency_retained": lambda p: _mean(p("s_stays"), p("n_stays")),
        "outage_minutes": lambda p: p("outage"),
        "complaints": lambda p: p("complaints"),
        "complaints_per_1k_customer_months": lambda p: ratio(p("complaints"), p("n")) * 1000,
        "customers_seen": lambda p: F.hll_sketch_estimate(p("customers")),
    })


class Cube:
    """Stored tables of one layer below ``root``."""

    def __init__(self, spark: SparkSession, root: str, layer: Layer):
        self.spark, self.root, self.layer, self.files = spark, root.rstrip("/"), layer, Files(spark, root)
        held = json.loads(self.files.read("cube.json")) if "cube.json" in self.files.names("") else []
        self.tables = [(tuple(t["by"]), t["path"], t["rows"]) for t in held]

    @classmethod
    def build(cls, rows: DataFrame, by: list[str], root: str, layer: Layer,
              coarser: list[list[str]] | None = None) -> Cube:
        """The cube by all columns of ``by``, and tables by the subsets ``coarser``."""
        cube = cls(rows.sparkSession, root, layer)
        return cube._store(rows.groupBy(*by).agg(*[
            p.taken().alias(PREFIX + n) for n, p in layer.parts.items()]), by, coarser or [])

    def _store(self, finest: DataFrame, by: list[str], coarser: list[list[str]]) -> Cube:
        if self.tables:
            raise FileExistsError(f"{self.root} holds a cube already")
        for columns in coarser:
            if not set(columns) <= set(by):
                raise ValueError(f"{columns} are not among {by}")
        self._keep(finest, by)
        for columns in sorted(coarser, key=len, reverse=True):
            self._keep(self._merged(self._read(self._smallest(set(columns))), columns), columns)
        self.files.put("cube.json", json.dumps([{"by": list(b), "path": p, "rows": n} for b, p, n in self.tables]))
        return self

    def _keep(self, table: DataFrame, by: list[str]) -> None:
        path = f"t{len(self.tables)}"
        table.write.mode("overwrite").parquet(f"{self.root}/{path}")
        rows = self.spark.read.parquet(f"{self.root}/{path}").count()
        if rows > MOST_CELLS:
            raise ValueError(f"{rows} combinations of {', '.join(by)}; a cube holds {MOST_CELLS} at most")
        self.tables.append((tuple(by), path, rows))

    def _read(self, table: tuple) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table[1]}")

    def _smallest(self, columns: set[str]) -> tuple:
        able = [t for t in self.tables if columns <= set(t[0])]
        if not able:
            raise KeyError(f"no table of the cube holds {', '.join(sorted(columns))}")
        return min(able, key=lambda t: (t[2], len(t[0])))

    def _merged(self, table: DataFrame, by: list[str], names: set[str] | None = None) -> DataFrame:
        return table.groupBy(*by).agg(*[p.merged(PREFIX + n).alias(PREFIX + n) for n, p in self.layer.parts.items()
                                        if names is None or n in names])

    def _needed(self, names: list[str]) -> set[str]:
        seen: set[str] = set()
        for name in names:
            self.layer.measures[name](lambda part: (seen.add(part), F.col(PREFIX + part))[1])
        return seen

    def source(self, by: list[str] | None = None, filters: dict | None = None) -> tuple[str, ...]:
        """Columns of the table that a question is answered from."""
        return self._smallest({*(by or []), *[c for c, v in (filters or {}).items() if v is not None]})[0]

    def answer(self, names: list[str] | None = None, by: list[str] | None = None,
               filters: dict | None = None) -> DataFrame:
        """Chosen measures per group of the (optionally sliced) rows, as ``measures.evaluate`` gives them."""
        names, by = list(names or self.layer.measures), list(by or [])
        kept = {c: v for c, v in (filters or {}).items() if v is not None}
        table = self._read(self._smallest({*by, *kept}))
        merged = self._merged(slice_by(table, **kept), by, self._needed(names))
        return merged.select(*by, *[self.layer.measures[n](lambda part: F.col(PREFIX + part)).alias(n) for n in names])

    def extended(self, rows: DataFrame, root: str) -> Cube:
        """A new cube below ``root`` that holds the stored rows and the new ones; only the new ones are read as rows."""
        finest = max(self.tables, key=lambda t: len(t[0]))
        by = list(finest[0])
        new = rows.groupBy(*by).agg(*[p.taken().alias(PREFIX + n) for n, p in self.layer.parts.items()])
        both = self._merged(self._read(finest).unionByName(new), by)
        return Cube(self.spark, root, self.layer)._store(both, by, [list(t[0]) for t in self.tables if t is not finest])
