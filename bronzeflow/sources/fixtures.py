"""Parquet stand-ins for the relational source.

The given star-schema tables hold no NULLs, zeros or duplicates, so the
adapters put some in by fixed key arithmetic. Every expression is valid in
Spark and in DuckDB: the same text gives the bronze-shaped input on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.specs import TableSpec


@dataclass(frozen=True)
class Adapter:
    table: str
    columns: dict[str, str]
    copies: dict[str, str] | None = None  # column overrides of a second UNION ALL branch
    copies_where: str = ""


# The adapter expressions of FIXTURES.md.
ADAPTERS = {
    "customers": Adapter(
        "customer",
        {
            "CustomerID": "c_custkey",
            "CustomerName": "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END",
            "DeliveryCityID": "c_nationkey",
            "CustomerCategory": "c_mktsegment",
        },
        copies={"CustomerName": "c_name"},
        copies_where="c_custkey % 211 = 0",
    ),
    "orders": Adapter(
        "orders",
        {
            "OrderID": "o_orderkey",
            "CustomerID": "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END",
            "OrderDate": "CASE WHEN o_orderkey % 113 = 0 THEN NULL"
            " ELSE CAST(o_orderdate AS DATE) END",
        },
    ),
    "order_lines": Adapter(
        "lineitem",
        {
            "OrderLineID": "l_orderkey * 10 + l_linenumber",
            "OrderID": "l_orderkey",
            "StockItemID": "CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE l_partkey END",
            "Quantity": "CASE WHEN l_partkey % 71 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END",
            "UnitPrice": "CAST(l_extendedprice AS DECIMAL(18,2))",
        },
    ),
    "stock_items": Adapter(
        "part",
        {
            "StockItemID": "p_partkey",
            "StockItemName": "CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE p_name END",
            "Brand": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END",
            "Size": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size AS STRING) END",
            "IsChillerStock": "p_type = 'PROMO'",
            "UnitPrice": "CASE WHEN p_partkey % 101 = 0 THEN CAST(0 AS DECIMAL(18,2))"
            " ELSE CAST(p_retailprice AS DECIMAL(18,2)) END",
        },
    ),
    "stock_item_holdings": Adapter(
        "part",
        {
            "StockItemID": "p_partkey",
            "QuantityOnHand": "CAST((p_partkey * 37) % 211 - 5 AS INT)",
            "LastCostPrice": "CAST(p_retailprice AS DECIMAL(18,2))",
            "ReorderLevel": "p_size",
        },
    ),
    "stock_groups": Adapter(
        "supplier", {"StockGroupID": "s_suppkey", "StockGroupName": "s_name"}
    ),
    "stock_item_stock_groups": Adapter(
        "lineitem", {"StockItemID": "l_partkey", "StockGroupID": "l_suppkey"}
    ),
    "suppliers": Adapter("supplier", {"SupplierID": "s_suppkey", "SupplierName": "s_name"}),
}


def read_fixture(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bronze_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table in the shape of bronze table ``name``."""
    adapter = ADAPTERS[name]
    base = read_fixture(spark, sf_dir, adapter.table)
    shaped = base.selectExpr(*[f"{e} AS {c}" for c, e in adapter.columns.items()])
    if adapter.copies is None:
        return shaped
    columns = adapter.columns | adapter.copies
    copies = base.where(adapter.copies_where).selectExpr(
        *[f"{e} AS {c}" for c, e in columns.items()]
    )
    return shaped.unionByName(copies)


def bronze_input_sql(name: str) -> str:
    """The same input as a SQL query over the given tables."""
    adapter = ADAPTERS[name]

    def branch(columns: dict[str, str], where: str = "") -> str:
        items = ", ".join(f"{e} AS {c}" for c, e in columns.items())
        return f"SELECT {items} FROM {adapter.table}{where}"

    sql = branch(adapter.columns)
    if adapter.copies is not None:
        sql += " UNION ALL " + branch(
            adapter.columns | adapter.copies, f" WHERE {adapter.copies_where}"
        )
    return sql


_EDITED = (
    "CASE WHEN v = 2 THEN TIMESTAMP '2024-02-01 00:00:00'"
    " ELSE TIMESTAMP '2024-01-01 00:00:00' END"
)


def _valid_to(key: str) -> str:
    return (
        f"CASE WHEN {key} % 5 = 0 THEN TIMESTAMP '2024-03-01 00:00:00'"
        f" WHEN {key} % 2 = 0 THEN NULL ELSE TIMESTAMP '9999-12-31 23:59:59.999999' END"
    )


def _padded(column: str, key: str) -> str:
    return (
        f"CASE WHEN v = 2 AND {key} % 7 = 0 THEN '   '"
        f" WHEN v = 2 THEN '  ' || {column} || ' ' ELSE {column} END"
    )


# Bronze inputs with edits. Version 1 of every row, version 2 of
# each third key: padded and blank texts, later edit times, ended validity.
VERSIONED = {
    "customers": {
        "CustomerID": "CustomerID",
        "CustomerName": _padded("CustomerName", "CustomerID"),
        "DeliveryCityID": "DeliveryCityID",
        "CustomerCategory": "CustomerCategory",
        "ValidFrom": _EDITED,
        "ValidTo": _valid_to("CustomerID"),
    },
    "orders": {
        "OrderID": "OrderID",
        "CustomerID": "CASE WHEN v = 2 THEN CustomerID + 1 ELSE CustomerID END",
        "OrderDate": "OrderDate",
        "LastEditedWhen": _EDITED,
    },
    "stock_items": {
        "StockItemID": "StockItemID",
        "StockItemName": _padded("StockItemName", "StockItemID"),
        "Brand": _padded("Brand", "StockItemID"),
        "Size": "Size",
        "IsChillerStock": "IsChillerStock",
        "UnitPrice": "UnitPrice",
        "ValidFrom": _EDITED,
        "ValidTo": _valid_to("StockItemID"),
    },
}


def versioned_input(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A bronze input with the edits of ``VERSIONED``."""
    versions = f"explode(CASE WHEN {key} % 3 = 0 THEN array(1, 2) ELSE array(1) END) AS v"
    rows = bronze_input(spark, sf_dir, name).selectExpr("*", versions)
    return rows.selectExpr(*[f"{e} AS {c}" for c, e in VERSIONED[name].items()])


#: Orders as a source shows them at two times, for loads by high-water mark.
LOADED_UNTIL = "TIMESTAMP '1999-06-30 00:00:00'"
FIRST_EDIT = "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END"
SECOND_EDIT = (
    "CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '2001-01-01 00:00:00'"
    " WHEN o_orderkey % 11 = 0 THEN TIMESTAMP '1990-01-01 00:00:00'"
    " WHEN o_orderkey % 13 = 0 OR o_orderkey % 50 = 0 THEN NULL"
    f" WHEN o_orderkey % 17 = 0 THEN {LOADED_UNTIL}"
    " ELSE CAST(o_orderdate AS TIMESTAMP) END"
)


@dataclass(frozen=True)
class OrderEdits:
    """A source of orders with edit times; the second look moves each seventh to the next year."""

    sf_dir: str
    second: bool

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        edited, moved = (SECOND_EDIT, "1") if self.second else (FIRST_EDIT, "0")
        rows = read_fixture(spark, self.sf_dir, "orders").selectExpr(
            "CAST(o_orderkey AS INT) AS OrderID",
            f"CAST(o_custkey + {moved} AS INT) AS CustomerID",
            f"{edited} AS LastEditedWhen",
            f"year(o_orderdate) + CASE WHEN o_orderkey % 7 = 0 THEN {moved} ELSE 0 END AS OrderYear",
        )
        return rows if self.second else rows.where(f"LastEditedWhen <= {LOADED_UNTIL}")


#: Orders and lines as two increments change them, for gold tables. Each is a
#: query over ``{orders}`` or ``{lines}``, valid in Spark and in DuckDB. Orders move
#: to other dates, lose or get one, and some are new; lines move to other orders.
DATED = "CAST(OrderDate AS DATE)"
SALES_CHANGES = {
    "orders_0": f"""SELECT OrderID, CustomerID, {DATED} AS OrderDate,
        TIMESTAMP '2024-01-01 00:00:00' AS LastEditedWhen, CAST(OrderID % 8 AS INT) AS OrderPart
        FROM {{orders}} WHERE OrderID % 10 <> 3""",
    "orders_1": f"""SELECT OrderID, CustomerID, CASE WHEN OrderID % 21 = 0 THEN NULL
        ELSE {DATED} + INTERVAL 40 DAY END AS OrderDate,
        TIMESTAMP '2024-02-01 00:00:00' AS LastEditedWhen, CAST(OrderID % 8 AS INT) AS OrderPart
        FROM {{orders}} WHERE OrderID % 7 = 0 OR OrderID % 10 = 3""",
    "orders_2": f"""SELECT OrderID, CustomerID, coalesce({DATED}, DATE '1996-05-05') AS OrderDate,
        TIMESTAMP '2024-03-01 00:00:00' AS LastEditedWhen, CAST(OrderID % 5 AS INT) AS OrderPart
        FROM {{orders}} WHERE OrderID % 14 = 0 OR OrderDate IS NULL""",
    "lines_0": """SELECT OrderLineID, OrderID, StockItemID, Quantity, UnitPrice,
        TIMESTAMP '2024-01-01 00:00:00' AS LastEditedWhen FROM {lines}""",
    "lines_2": """SELECT OrderLineID, min(OrderID) + 1 AS OrderID, min(StockItemID) AS StockItemID,
        CAST(min(Quantity) + 1 AS INT) AS Quantity, min(UnitPrice) AS UnitPrice,
        TIMESTAMP '2024-03-01 00:00:00' AS LastEditedWhen FROM {lines}
        WHERE OrderLineID % 9 = 0 GROUP BY OrderLineID""",
}


def sales_change(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SALES_CHANGES[name].format(orders="{rows}", lines="{rows}")
    table = "orders" if name.startswith("orders") else "order_lines"
    rows = spark.sql(text, rows=bronze_input(spark, sf_dir, table))
    dates = {"OrderDate": F.col("OrderDate").cast("date")} if table == "orders" else {}
    return rows.withColumns(dates)


@dataclass(frozen=True)
class FixtureSource:
    """Source of the whole bronze run over the given parquet tables."""

    sf_dir: str

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        return bronze_input(spark, self.sf_dir, spec.name)


@dataclass
class StoppingSource:
    """The same source, but reading ``stops_at`` fails once; ``reads`` counts per table."""

    sf_dir: str
    stops_at: str
    reads: dict[str, int] = field(default_factory=dict)

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        self.reads[spec.name] = self.reads.get(spec.name, 0) + 1
        if spec.name == self.stops_at and self.reads[spec.name] == 1:
            raise ConnectionError(f"{spec.name}: connection lost")
        return bronze_input(spark, self.sf_dir, spec.name)
