"""Data-quality gate: rules compiled into a handful of fused jobs.

Row count, null, range, reconciliation and rate rules of one table share a single
aggregate; all domain rules of a table share one scan that only emits offending
cells; each key rule is one pre-aggregated group-by; each foreign key is one
anti-join over distinct keys. Results are rows, never driver-side loops over data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast import contract as K
from holdfast.functions.columns import flag, percent_text, to_number
from holdfast.operators import membership
from holdfast.operators.cleaning import unknown_values
from holdfast.operators.joins import orphan_count
from holdfast.session import cut, literal_rows

# Statuses and texts of the results table
PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
LISTED_VALUES = 10
NO_EXPECTED_COUNT = "no expected count configured"
COUNT_DIFFERS = "row count differs from the published dataset size"
TOTALS_NOTE = "large deviations usually mean plan changes, not bad data"
ORPHAN_NOTE = "every KPI row must belong to a known customer"
RESULT_COLUMNS = ["check_name", "table", "status", "observed", "expectation", "details"]


class DataQualityError(RuntimeError):
    """At least one FAIL-severity check did not pass."""


@dataclass(frozen=True)
class Check:
    """A rule that needs only aggregates of its own table."""

    table: str

    def check_name(self) -> str:
        raise NotImplementedError

    def metric(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def verdict(self, m: Column) -> tuple[Column, Column, str, Column]:
        """status, observed, expectation, details"""
        raise NotImplementedError


def _status(ok: Column, severity: str) -> Column:
    return F.when(ok, PASS).otherwise(severity)


def _numeric(df: DataFrame, column: str) -> Column:
    text = dict(df.dtypes)[column] == "string"
    return to_number(column) if text else F.col(column).cast("double")


@dataclass(frozen=True)
class RowCount(Check):
    expected: int | None = None

    def check_name(self):
        return "row_count"

    def metric(self, df):
        return F.count("*")

    def verdict(self, m):
        if self.expected is None:
            return F.lit(PASS), m.cast("string"), "> 0", F.lit(NO_EXPECTED_COUNT)
        ok = m == self.expected
        note = F.when(ok, "").otherwise(COUNT_DIFFERS)
        return _status(ok, WARN), m.cast("string"), f"== {self.expected}", note


@dataclass(frozen=True)
class NotNull(Check):
    """An absent column counts as null on every row."""

    column: str = ""

    def check_name(self):
        return f"not_null_{self.column}"

    def metric(self, df):
        if self.column not in df.columns:
            return F.count("*")
        return F.count_if(F.col(self.column).isNull())

    def verdict(self, m):
        return _status(m == 0, FAIL), F.format_string("%d nulls", m), "0 nulls", F.lit("")


@dataclass(frozen=True)
class InRange(Check):
    column: str = ""
    lo: float = 0
    hi: float = 0
    severity: str = FAIL

    def check_name(self):
        return f"range_{self.column}"

    def metric(self, df):
        return F.count_if(~_numeric(df, self.column).between(float(self.lo), float(self.hi)))

    def verdict(self, m):
        return (_status(m == 0, self.severity), F.format_string("%d outside", m),
                f"[{self.lo}, {self.hi}]", F.lit(""))


@dataclass(frozen=True)
class TotalsReconcile(Check):
    """Share of billed rows whose total strays from monthly x tenure. A zero
    expectation is no deviation but stays in the denominator."""

    tolerance: float = 0.5
    max_share: float = 0.05

    def check_name(self):
        return "reconcile_total_vs_monthly_x_tenure"

    def metric(self, df):
        expected = F.col("monthly_charges") * F.col("tenure_months")
        off = F.abs(F.col("total_charges") - expected) / F.nullif(expected, F.lit(0.0))
        billed = F.col("tenure_months") > 0
        return F.coalesce(F.avg(F.when(billed, flag(off > self.tolerance))), F.lit(0.0))

    def verdict(self, m):
        observed = F.concat(percent_text(m), F.lit(f" rows deviate > {self.tolerance:.0%}"))
        return (_status(m <= self.max_share, WARN), observed, f"<= {self.max_share:.0%} rows",
                F.lit(TOTALS_NOTE))


@dataclass(frozen=True)
class ChurnRatePlausible(Check):
    lo: float = 0.10
    hi: float = 0.45

    def check_name(self):
        return "churn_rate_plausible"

    def metric(self, df):
        return F.coalesce(F.avg("churn_flag"), F.lit(0.0))

    def verdict(self, m):
        return (_status(m.between(self.lo, self.hi), WARN), percent_text(m),
                f"between {self.lo:.0%} and {self.hi:.0%}", F.lit(""))


@dataclass(frozen=True)
class OneOf:
    """Values of a column must lie in a set; NULLs are ignored."""

    table: str
    column: str
    allowed: tuple[str, ...]

    def check_name(self):
        return f"domain_{self.column}"


@dataclass(frozen=True)
class UniqueKey:
    """No two rows share the key; NULLs are equal."""

    table: str
    key: tuple[str, ...]

    def check_name(self):
        return "unique_" + "_".join(self.key)


@dataclass(frozen=True)
class ForeignKey:
    """Every row's key must exist in the parent table."""

    table: str
    key: str
    parent: str
    note: str = ORPHAN_NOTE

    def check_name(self):
        return f"fk_{self.key}_exists"


def _row(rule, seq: int, status, observed, expectation, details) -> Column:
    return F.struct(F.lit(seq).alias("seq"), F.lit(rule.check_name()).alias("check_name"),
                    F.lit(rule.table).alias("table"), status.alias("status"),
                    observed.alias("observed"), F.lit(expectation).alias("expectation"),
                    details.alias("details"))


def fused_checks(df: DataFrame, rules: list[tuple[int, Check]]) -> DataFrame:
    """Every aggregate rule of one table from one scan."""
    wide = df.agg(*[rule.metric(df).alias(f"m{seq}") for seq, rule in rules])
    rows = [_row(rule, seq, *rule.verdict(F.col(f"m{seq}"))) for seq, rule in rules]
    return wide.select(F.inline(F.array(*rows)))


def domain_checks(df: DataFrame, rules: list[tuple[int, OneOf]]) -> DataFrame:
    """Count of unknown values per column and the first few of them, in order.

    A corrupt column may have any number of unknown values: they are counted and
    ranked per column in the shuffle, and only the listed few are gathered.
    """
    bad = unknown_values(df, {r.column: r.allowed for _, r in rules})
    counts = bad.groupBy("column").agg(F.count("*").alias("n"))
    first = (bad.withColumn("_nth", F.row_number().over(
                W.partitionBy("column").orderBy("value"))).where(f"_nth <= {LISTED_VALUES}")
             .groupBy("column").agg(F.array_sort(F.collect_list("value")).alias("listed")))
    spec = literal_rows(df.sparkSession, [
        {"seq": F.lit(seq), "check_name": F.lit(r.check_name()), "table": F.lit(r.table),
         "column": F.lit(r.column), "expectation": F.lit(f"subset of {sorted(r.allowed)}")}
        for seq, r in rules])
    parts = (spec.unionByName(counts, allowMissingColumns=True)
             .unionByName(first, allowMissingColumns=True))
    n = F.coalesce(F.max("n"), F.lit(0))
    return (parts.groupBy("column").agg(
        F.max("seq").alias("seq"), F.max("check_name").alias("check_name"),
        F.max("table").alias("table"), _status(n == 0, FAIL).alias("status"),
        F.format_string("%d unknown values", n).alias("observed"),
        F.max("expectation").alias("expectation"),
        F.coalesce(F.array_join(F.max("listed"), ", "), F.lit("")).alias("details"))
        .drop("column"))


def duplicate_rows(df: DataFrame, key: list[str], name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key; keys of whole numbers are counted as bit sets."""
    if membership.whole_key(df, key):
        return membership.duplicate_rows(df, key, name)
    return (df.groupBy(*key).agg((F.count("*") - 1).alias("_extra"))
            .agg(F.coalesce(F.sum("_extra"), F.lit(0)).cast("bigint").alias(name)))


def unique_check(df: DataFrame, seq: int, rule: UniqueKey) -> DataFrame:
    n = F.col("n")
    return duplicate_rows(df, list(rule.key), "n").select(F.inline(F.array(_row(
        rule, seq, _status(n == 0, FAIL), F.format_string("%d duplicates", n), "0 duplicates",
        F.lit("")))))


def foreign_key_check(df: DataFrame, parent: DataFrame, seq: int, rule: ForeignKey) -> DataFrame:
    n, key = F.col("n"), [rule.key]
    whole = membership.whole_key(df, key) and membership.whole_key(parent, key)
    orphans = membership.orphan_rows(df, parent, key, "n") if whole else orphan_count(df, parent, rule.key, "n")
    return orphans.select(F.inline(F.array(_row(
        rule, seq, _status(n == 0, FAIL), F.format_string("%d orphan rows", n), "0 orphans",
        F.lit(rule.note)))))


def run_checks(frames: dict[str, DataFrame], rules: list, run_ts: str) -> DataFrame:
    """One row per rule, in rule order (``seq``)."""
    numbered = list(enumerate(rules, start=1))
    parts: list[DataFrame] = []
    for table, df in frames.items():
        mine = [(s, r) for s, r in numbered if r.table == table]
        fused = [(s, r) for s, r in mine if isinstance(r, Check)]
        domains = [(s, r) for s, r in mine if isinstance(r, OneOf)]
        if fused:
            parts.append(fused_checks(df, fused))
        if domains:
            parts.append(domain_checks(df, domains))
        for s, r in mine:
            if isinstance(r, UniqueKey):
                parts.append(unique_check(df, s, r))
            elif isinstance(r, ForeignKey):
                parts.append(foreign_key_check(df, frames[r.parent], s, r))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("seq", F.lit(run_ts).alias("run_ts"), *RESULT_COLUMNS)


def customer_rules(expected_rows: int | None = None, table: str = "customers",
                   domains: dict[str, tuple[str, ...]] = K.DOMAINS) -> list:
    required = ["customer_id", "tenure_months", "monthly_charges", "total_charges",
                "churn_flag", "contract"]
    return [
        RowCount(table, expected_rows),
        UniqueKey(table, ("customer_id",)),
        *[NotNull(table, c) for c in required],
        *[OneOf(table, c, allowed) for c, allowed in domains.items()],
        *[InRange(table, c, *rng) for c, rng in K.CUSTOMER_FEED.ranges.items()],
        InRange(table, "churn_flag", 0, 1),
        TotalsReconcile(table),
        ChurnRatePlausible(table),
    ]


def telemetry_rules(window: int = K.WINDOW_MONTHS, table: str = "network_kpis_monthly",
                    parent: str = "customers") -> list:
    return [
        UniqueKey(table, ("customer_id", "month")),
        *[NotNull(table, c) for c in ("customer_id", "month", "month_index")],
        ForeignKey(table, "customer_id", parent),
        InRange(table, "month_index", 1, window),
        *[InRange(table, c, *rng, WARN) for c, rng in K.TELEMETRY_FEED.ranges.items()],
    ]


def utc_stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def quality_results(customers: DataFrame, kpis: DataFrame | None = None,
                    expected_rows: int | None = None, run_ts: str | None = None) -> DataFrame:
    frames, rules = {"customers": customers}, customer_rules(expected_rows)
    if kpis is not None and not kpis.isEmpty():
        frames["network_kpis_monthly"] = kpis
        rules = rules + telemetry_rules()
    return run_checks(frames, rules, run_ts or utc_stamp())


def raise_on_fail(results: DataFrame) -> None:
    failed = results.where(F.col("status") == FAIL).orderBy("seq").collect()  # one row per rule
    if failed:
        listed = "; ".join(f"{r.check_name} ({r.observed})" for r in failed)
        raise DataQualityError(f"{len(failed)} check(s) FAILED: {listed}")


def quality_gate(customers: DataFrame, kpis: DataFrame | None = None,
                 expected_rows: int | None = None, fail_on_error: bool = True,
                 run_ts: str | None = None) -> DataFrame:
    """Run every rule under one time stamp; raise if a FAIL rule did not pass."""
    results = cut(quality_results(customers, kpis, expected_rows, run_ts))
    if fail_on_error:
        raise_on_fail(results)
    return results


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("checks"))


def not_passed(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != PASS).select(
        "check_name", "table", "status", "observed", "expectation")


def latest_run(results: DataFrame) -> DataFrame:
    return results.where(F.col("run_ts") == results.select(F.max("run_ts")).scalar())


def load_reconciliation(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts after a load plus monthly rows without a customer."""
    parts = [tables[n].agg(F.lit(n).alias("tbl"), F.count("*").alias("rows_"))
             for n in ("dim_customer", "fact_customer", "fact_network_monthly")]
    parts.append(orphan_count(tables["fact_network_monthly"], tables["dim_customer"],
                              "customer_key", "rows_")
                 .select(F.lit("orphan_network_rows").alias("tbl"), "rows_"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
