"""Every query with oracle SQL gives the DuckDB answer at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001
from oracle_check import compare

from heldout.plans import ORACLE_SQL, QUERIES

ORACLES = ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck001, name):
    res = compare(spark, SF001, name, QUERIES[name], ORACLES[name], duck001)
    assert res["columns_match"], res
    assert res["types_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(QUERIES) <= set(entry_mod.queries())


def test_entry_runs_on_smallest_tables(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["actual", "predicted", "n"]
    rows = df.collect()
    assert rows and sum(r["n"] for r in rows) > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_schema_is_the_same_at_every_scale(spark, name):
    from conftest import SF0001

    query = QUERIES[name]
    small = query(spark, SF0001).schema.simpleString()
    larger = query(spark, SF001).schema.simpleString()
    assert small == larger
