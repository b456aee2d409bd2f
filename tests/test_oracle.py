"""Every registered query against its SQL, run by another engine."""

import pytest

import __spark_entry__ as contract
from bronzeflow.registry.oracle import ORACLE_SQL
from bronzeflow.registry.queries import QUERIES
from tests.compare import duck, duck_rows, duck_types, same_types, spark_rows

SF_DIR = "/root/testdata/sf0.01"
# They write one folder per date; fewer dates will do.
SMALL_SF_DIR = "/root/testdata/sf0.001"
WRITES_DATES = {
    "bronze_roundtrip_orders",
    "bronze_run",
    "bronze_run_reports",
    "bronze_run_resumed",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, con, name):
    folder = SF_DIR
    if name in WRITES_DATES:
        folder, con = SMALL_SF_DIR, duck(SMALL_SF_DIR)
    sql = contract.oracle_sql()[name]
    df = contract.queries()[name](spark, folder)
    assert same_types(df, duck_types(con, sql)) == {}
    columns, rows = spark_rows(df)
    wanted_columns, wanted = duck_rows(con, sql)
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert rows == wanted


def test_sorted_summary_is_in_order(spark, con):
    name = "customer_order_summary_sorted"
    rows = contract.queries()[name](spark, SF_DIR).collect()
    wanted = con.execute(contract.oracle_sql()[name]).fetchall()
    assert [tuple(r) for r in rows] == [tuple(w) for w in wanted]


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
