"""Named queries against their SQL run by DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from eventguard.operators import rules
from eventguard.plans import oracle, queries as plans

QUERIES, SQL = plans.queries(), oracle.oracle_sql()
# Rows per reason of the test stream at the smallest scale.
EXPECTED = {
    None: 700, rules.USER_MISSING: 20, rules.AMOUNT_MISSING: 20, rules.TIMESTAMP_MISSING: 10,
    rules.TIMESTAMP_TYPE: 10, rules.AMOUNT_RANGE: 40, rules.SOURCE_UNKNOWN: 20,
    rules.REPEAT_IN_BATCH: 64, rules.REPEAT_ACROSS: 16, rules.LATE: 100,
}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{small}/events.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in found), key=repr)


def test_register():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, small, name):
    df = QUERIES[name](spark, small)
    done = duck.execute(SQL[name])
    expected = rows([d[0] for d in done.description], done.fetchall())
    assert rows(df.columns, df.collect()) == expected


def test_entry(spark):
    counts = contract.entry(spark).groupBy("error_reason").count().collect()
    assert {r["error_reason"]: r["count"] for r in counts} == EXPECTED


def test_skewed_fixture_has_every_reason(spark, small):
    found = QUERIES["error_reason_skew"](spark, small).select("error_reason").distinct().collect()
    assert {r["error_reason"] for r in found} == {
        *EXPECTED, rules.SOURCE_MISSING, rules.AMOUNT_NAN,
    }
