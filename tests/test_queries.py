"""Every registered query against its SQL in DuckDB, and the entry point."""

import pytest

import __spark_entry__ as contract
from compare import differences

SQL = contract.oracle_sql()
QUERIES = contract.queries()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(df, duck, SQL[name]) is None
    types = {d[0]: str(d[1]) for d in duck.execute(SQL[name]).description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types


@pytest.mark.parametrize("name", ["replay_reports", "predict_stream"])
def test_queries_without_sql_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and {r.cycle_period for r in rows} <= {7.0, 14.0, 30.5, 61.0, 91.5}
