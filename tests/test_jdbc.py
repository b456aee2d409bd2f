"""What is asked of the JDBC reader. No database is started for it."""

import inspect
from datetime import datetime

from pyspark.sql import DataFrameReader

from bronzeflow.config import PipelineConfig
from bronzeflow.sources import jdbc
from bronzeflow.specs import SPECS


class Reader:
    """Stands in for ``spark.read``: records the calls, answers min/max queries."""

    def __init__(self, bounds=(1, 1000, 5_000_000), columns=()):
        self.bounds = bounds
        self.columns = columns
        self.calls = []
        self.current = {}

    @property
    def read(self):
        self.current = {}
        return self

    def format(self, name):
        self.current["format"] = name
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def options(self, **kwargs):
        self.current |= kwargs
        return self

    def load(self):
        self.calls.append(self.current)
        return self

    def jdbc(self, url, table, **kwargs):
        inspect.signature(DataFrameReader.jdbc).bind(self, url, table, **kwargs)
        self.calls.append({"url": url, "dbtable": table} | kwargs)
        return self

    def first(self):
        return self.bounds


CFG = PipelineConfig.from_mapping(
    {
        "sql_server_host": "db.example",
        "sql_database_name": "shop",
        "sql_username": "reader",
        "sql_password": "secret",
    }
)


def test_url_and_options():
    source = jdbc.JdbcSource.from_config(CFG)
    assert source.jdbc_url == (
        "jdbc:sqlserver://db.example:1433;database=shop;encrypt=true;trustServerCertificate=true"
    )
    assert source.connection_options == {
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "fetchsize": "10000",
        "user": "reader",
        "password": "secret",
    }


def test_password_is_never_shown():
    assert "secret" not in repr(CFG)
    assert "secret" not in repr(jdbc.JdbcSource.from_config(CFG))


def test_query_read():
    reader = Reader()
    jdbc.read_jdbc_query(reader, jdbc.JdbcSource.from_config(CFG), "SELECT 1 AS x")
    (call,) = reader.calls
    assert (call["format"], call["query"], call["user"]) == ("jdbc", "SELECT 1 AS x", "reader")
    assert "dbtable" not in call and "partitionColumn" not in call


def test_subquery_read_without_split():
    reader = Reader()
    source = jdbc.JdbcSource.from_config(CFG)
    jdbc.read_jdbc_table(reader, source, SPECS["customers"].select_sql, alias="customers")
    (call,) = reader.calls
    assert call["dbtable"].startswith("(SELECT CustomerID, CustomerName, ")
    assert call["dbtable"].endswith("FROM Sales.Customers) customers")
    assert call["properties"] == source.connection_options
    assert "column" not in call


def test_table_read_is_split_over_its_key():
    reader = Reader(bounds=(5, 900, 10))
    source = jdbc.JdbcSource.from_config(CFG, partitions=16)
    source.read(reader, SPECS["orders"])
    bounds, read = reader.calls
    assert bounds["query"] == (
        "SELECT MIN(OrderID) AS lo, MAX(OrderID) AS hi, COUNT(*) AS n FROM Sales.Orders"
    )
    assert (read["column"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == (
        "OrderID",
        5,
        900,
        16,
    )


def test_small_or_empty_tables_are_read_at_once():
    for bounds in ((None, None, 0), (7, 7, 9), (1, 900, 1_000_000)):
        reader = Reader(bounds)
        jdbc.JdbcSource.from_config(CFG).read(reader, SPECS["orders"])
        assert "column" not in reader.calls[-1]
    reader = Reader()
    jdbc.JdbcSource.from_config(CFG, partitions=1).read(reader, SPECS["orders"])
    assert len(reader.calls) == 1



def test_split_follows_the_number_of_rows():
    reader = Reader(bounds=(5, 900, 4_500_000))
    jdbc.JdbcSource.from_config(CFG).read(reader, SPECS["orders"])
    assert reader.calls[-1]["numPartitions"] == 5


def test_increment_is_bounded_by_its_own_rows():
    reader = Reader()
    jdbc.JdbcSource.from_config(CFG).read_since(
        reader, SPECS["orders"], datetime(2024, 1, 2, 3, 4, 5, 6)
    )
    bounds, read = reader.calls
    where = (
        "FROM Sales.Orders WHERE LastEditedWhen >= '2024-01-02T03:04:05.000006'"
        " OR LastEditedWhen IS NULL"
    )
    assert bounds["query"].endswith(where)
    assert read["dbtable"].endswith(where + ") orders")


def test_missing_optional_column_is_not_asked_for():
    columns = [c for c in SPECS["stock_items"].columns if c != "Photo"]
    for have, asked in ((columns, False), ([*columns, "photo"], True)):
        reader = Reader(columns=have)
        jdbc.JdbcSource.from_config(CFG).read(reader, SPECS["stock_items"])
        assert ("Photo" in reader.calls[-1]["dbtable"]) == asked


def test_tuning_comes_from_the_parameters():
    cfg = PipelineConfig.from_mapping(
        {
            "jdbc_partitions": 3,
            "jdbc_fetch_size": "50",
            "jdbc_encrypt": False,
            "jdbc_options": {"queryTimeout": "9"},
        }
    )
    source = jdbc.JdbcSource.from_config(cfg)
    assert (source.partitions, "encrypt=false" in source.jdbc_url) == (3, True)
    assert source.connection_options["fetchsize"] == "50"
    assert source.connection_options["queryTimeout"] == "9"


class Uneven(Reader):
    """Answers the query for quantiles, too: keys are dense at the low end."""

    def collect(self):
        return [(2, 10), (1, -5), (4, 10), (3, 10), (5, 900)]


def test_uneven_keys_are_split_at_quantiles():
    spark = Uneven()
    source = jdbc.JdbcSource(url="jdbc:test", partitions=5, even_rows=True)
    source.read(spark, SPECS["orders"])
    bounds, quantiles, rows = spark.calls
    assert "NTILE(5) OVER (ORDER BY OrderID)" in quantiles["query"]
    assert rows["predicates"] == [
        "OrderID < 10 OR OrderID IS NULL",
        "OrderID >= 10 AND OrderID < 900",
        "OrderID >= 900",
    ]
    assert "column" not in rows and rows["dbtable"].endswith(") orders")


def test_predicates_hold_every_row_once():
    """Ends, boundaries and a missing key, against each part."""
    import duckdb

    for at in ((5,), (1, 2, 9), (-3, 0, 4, 100)):
        parts = jdbc.Boundaries("k", at).predicates
        assert len(parts) == len(at) + 1
        total = " + ".join(f"coalesce(CAST(({p}) AS INT), 0)" for p in parts)
        keys = "(VALUES (NULL), (-9999), (9999), " + ", ".join(f"({b + d})" for b in at for d in (-1, 0, 1)) + ") t(k)"
        assert duckdb.sql(f"SELECT DISTINCT {total} FROM {keys}").fetchall() == [(1,)]


def test_one_value_of_a_key_needs_no_split():
    class Same(Reader):
        def collect(self):
            return [(1, 7), (2, 7), (3, None)]

    spark = Same()
    source = jdbc.JdbcSource(url="jdbc:test", partitions=3, even_rows=True)
    source.read(spark, SPECS["orders"])
    assert "predicates" not in spark.calls[-1] and "column" not in spark.calls[-1]
