"""Window aggregates of telemetry that are kept up to date load by load.

The state holds one row per customer with one entry per month, each the sums and counts of that month's rows, in the hash
buckets of a versioned table. A load of new rows is aggregated per customer and month and replaces those entries; buckets
without one of its customers are not read, and a load that changes nothing writes nothing. Entries that no window of the
customer can hold any more go when the customer is next touched, and are passed over by every read until then.

A read adds up at most ``window`` entries inside each row: no shuffle, and the figures of ``telemetry.raw_aggregates`` over
all rows of the window, digit by digit, because sums are kept as decimals.

Rows without customer or month belong to no entry and are left out. A month that is sent again replaces the earlier rows of
the customers it holds. Months may come late and in any order. An empty load changes nothing; a state without customers reads
as an empty table. Only the telemetry columns are read; further ones, of any name, do no harm. At most ``MOST_MONTHS`` months fit a
state, so a row is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import READING, text_ordinal
from holdfast.session import cut
from holdfast.sources.versioned import Versioned

KEY = "customer_id"
MOST_MONTHS = 120
READINGS = ("dropped_call_pct", "avg_download_mbps", "avg_latency_ms", "data_usage_gb")
TOTALS = ("outage_minutes", "complaints")
ADDED = "decimal(36,9)"


def month_entries(kpis: DataFrame) -> DataFrame:
    """One row per customer with its months' sums and counts, as a list by month."""
    cells = [F.col("_at").alias("at"), F.col("_rows").alias("rows")]
    sums = [F.count(F.lit(1)).alias("_rows")]
    for c in READINGS + TOTALS:
        sums += [F.sum(F.col(c).cast(READING)).cast(READING).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
        cells += [F.col(f"_s_{c}").alias(f"s_{c}"), F.col(f"_n_{c}").alias(f"n_{c}")]
    monthly = (kpis.select(KEY, text_ordinal("month").alias("_at"), *READINGS, *TOTALS)
               .where(F.col(KEY).isNotNull() & F.col("_at").isNotNull()).groupBy(KEY, "_at").agg(*sums))
    return monthly.groupBy(KEY).agg(F.array_sort(F.collect_list(F.struct(*cells))).alias("months"))


def _replaced(window: int):
    """The change of a merge: entries of the load take the place of stored ones."""
    def change(rows: DataFrame, load: DataFrame) -> DataFrame:
        new = load.select(F.col(KEY), F.col("months").alias("_new"))
        joined = rows.join(new, KEY, "full")
        old, new = F.coalesce("months", F.array()), F.coalesce("_new", F.array())
        kept = F.filter(old, lambda e: ~F.exists(new, lambda n: n["at"] == e["at"]))
        merged = F.array_sort(F.concat(kept, new))
        last = F.element_at(merged, -1)["at"]
        return joined.select(KEY, "months", merged.alias("_merged"), last.alias("_last")).select(
            KEY, F.filter("_merged", lambda e: e["at"] > F.col("_last") - window).alias("_left"), "months").select(
            KEY, F.col("_left").alias("months"), (~F.col("_left").eqNullSafe(F.col("months"))).alias("changed"))
    return change


class RollingTelemetry:
    """The state below ``root``, for windows of at most ``window`` months."""

    def __init__(self, spark: SparkSession, root: str, window: int = K.WINDOW_MONTHS):
        if not 0 < window <= MOST_MONTHS:
            raise ValueError(f"a state holds 1 to {MOST_MONTHS} months")
        self.spark, self.window, self.table = spark, window, Versioned(spark, root)

    @classmethod
    def create(cls, kpis: DataFrame, root: str, window: int = K.WINDOW_MONTHS,
               buckets: int | None = None) -> RollingTelemetry:
        """The state after a first load, which may hold any number of months and customers."""
        state = cls(kpis.sparkSession, root, window)
        first = month_entries(kpis)
        last = F.element_at("months", -1)["at"]
        rows = first.select(KEY, F.filter("months", lambda e: e["at"] > last - window).alias("months"))
        Versioned.create(cut(rows), root, KEY, buckets)
        return state

    def load(self, kpis: DataFrame, source: str | None = None, batch: int | None = None) -> list[str]:
        """Take new rows in; returns the buckets that were written."""
        return self.table.merge(cut(month_entries(kpis)), _replaced(self.window), source, batch, inserts=True)

    def read(self, recent: int = K.RECENT_MONTHS, last: int | None = None, whole: bool = True) -> DataFrame:
        """``telemetry.raw_aggregates`` of the window that ends with month ``last`` (year * 12 + month), or with the latest
        month of any customer. ``whole`` says that the feed counts minutes and complaints in whole numbers. Customers
        without a row in the window are left out. Of a customer who was touched since, an earlier ``last`` finds only the months
        that later loads have left."""
        rows = self.table.read()
        newest = F.lit(last) if last is not None else rows.agg(F.max(F.element_at("months", -1)["at"])).scalar()
        held = rows.withColumn("_last", newest).select(KEY, "_last", F.filter(
            "months", lambda e: (e["at"] > F.col("_last") - self.window) & (e["at"] <= F.col("_last"))).alias("months"))
        held = held.where(F.size("months") > 0).select(KEY, "months", F.filter(
            "months", lambda e: e["at"] > F.col("_last") - recent).alias("late"))
        return held.select(
            KEY, _count("months", "rows").alias("kpi_months"),
            *[_mean("months", c).alias(c if c.startswith("avg_") else f"avg_{c}") for c in READINGS[:3]],
            _total("months", "outage_minutes", whole).alias("total_outage_minutes"),
            _mean("months", "data_usage_gb").alias("avg_data_usage_gb"),
            _total("months", "complaints", whole).alias("network_complaints"),
            *[_mean("late", c).alias(f"l3m_{c.removeprefix('avg_')}") for c in READINGS[:3]],
            *[F.when(F.size("late") > 0, _total("late", c, whole)).alias(f"l3m_{c}") for c in TOTALS])


def _count(entries: str, field: str) -> Column:
    return F.aggregate(entries, F.lit(0).cast("bigint"), lambda acc, e: acc + e[field])


def _sum(entries: str, c: str) -> Column:
    return F.aggregate(entries, F.lit(0).cast(ADDED),
                       lambda acc, e: (acc + F.coalesce(e[f"s_{c}"], F.lit(0).cast(READING))).cast(ADDED))


def _mean(entries: str, c: str) -> Column:
    n = _count(entries, f"n_{c}").cast("double")
    return _sum(entries, c).cast("double") / F.nullif(n, F.lit(0.0))


def _total(entries: str, c: str, whole: bool) -> Column:
    return _sum(entries, c).cast("bigint" if whole else "double")
