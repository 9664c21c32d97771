import duckdb
import pytest

from holdfast.llm import registry
from tools.check_oracles import TABLES, compare


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    verdict, _ = compare(con, registry.queries()[name](spark, sf), registry.oracle_sql()[name])
    assert verdict == "ok"


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))
