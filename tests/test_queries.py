"""Registered queries against an independent engine, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, compare  # noqa: E402

from holdfast.catalog import registry  # noqa: E402

CHECKED = sorted(registry.oracle_sql())


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """The registered queries boost 300 rounds; here four are enough to follow their paths."""
    from holdfast.plans import propensity
    whole = propensity.boosted_model
    propensity.boosted_model = lambda rounds=300, seed=42: whole(min(rounds, 4), seed)
    yield
    propensity.boosted_model = whole


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, con, sf, name):
    verdict, _ = compare(con, entry.queries()[name](spark, sf), entry.oracle_sql()[name])
    assert verdict == "ok"


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_oracle_binds(con):
    for sql in entry.oracle_sql().values():
        con.execute(f"EXPLAIN {sql}")


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["contract", "customers"]
