"""A handful of rows with answers worked out by hand."""

from datetime import date, datetime
from decimal import Decimal

from bronzeflow.specs import SPECS

# Ids, dates, quantities and prices that the golden answers follow from.
ORDERS = [
    (1, 1, date(2024, 1, 15)),
    (2, 2, date(2024, 1, 16)),
    (3, 3, date(2024, 1, 17)),
    (4, 7, date(2024, 1, 18)),
    (5, 8, date(2024, 1, 19)),
]
LINES = [
    (1, 1, 10, "3.70"),
    (1, 3, 5, "4.70"),
    (1, 5, 1, "15.00"),
    (2, 2, 3, "32.00"),
    (2, 4, 2, "41.00"),
    (3, 8, 50, "12.50"),
    (3, 9, 25, "15.75"),
    (3, 10, 100, "8.25"),
    (4, 1, 20, "3.70"),
    (4, 6, 2, "25.00"),
    (5, 7, 3, "18.00"),
    (5, 8, 75, "12.50"),
]
PRICES = [
    "3.70", "32.00", "4.70", "41.00", "15.00",
    "25.00", "18.00", "12.50", "15.75", "8.25",
]
EDITED = datetime(2024, 1, 20)


def table(spark, name, rows):
    """Rows given as dicts, in the full schema of a bronze table."""
    schema = SPECS[name].schema
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def customers(spark):
    return table(
        spark,
        "customers",
        [
            {"CustomerID": i, "CustomerName": f"Customer {i}", "ValidFrom": EDITED}
            for i in range(1, 9)
        ],
    )


def orders(spark):
    return table(
        spark,
        "orders",
        [
            {"OrderID": i, "CustomerID": c, "OrderDate": d, "LastEditedWhen": EDITED}
            for i, c, d in ORDERS
        ],
    )


def order_lines(spark):
    return table(
        spark,
        "order_lines",
        [
            {
                "OrderLineID": i,
                "OrderID": o,
                "StockItemID": s,
                "Quantity": q,
                "UnitPrice": Decimal(p),
                "LastEditedWhen": EDITED,
            }
            for i, (o, s, q, p) in enumerate(LINES, start=1)
        ],
    )


def stock_items(spark):
    return table(
        spark,
        "stock_items",
        [
            {
                "StockItemID": i,
                "StockItemName": f"Item {i}",
                "Brand": "Generic",
                "Size": "ea",
                "IsChillerStock": False,
                "UnitPrice": Decimal(p),
            }
            for i, p in enumerate(PRICES, start=1)
        ],
    )


def stock_item_holdings(spark):
    return table(
        spark,
        "stock_item_holdings",
        [
            {"StockItemID": i, "QuantityOnHand": q, "ReorderLevel": 5, "LastCostPrice": Decimal(p)}
            for i, q, p in ((1, 10, "2.50"), (2, 0, "3.00"), (3, -2, "1.00"), (4, 4, "10.00"))
        ],
    )


def stock_groups(spark):
    return table(
        spark,
        "stock_groups",
        [{"StockGroupID": i, "StockGroupName": n} for i, n in ((1, "Wrap"), (2, "Freight"))],
    )


def stock_item_stock_groups(spark):
    pairs = [(1, 1), (2, 1), (3, 1), (3, 1), (5, 2), (6, 2), (None, 2), (9, None)]
    return table(
        spark,
        "stock_item_stock_groups",
        [
            {"StockItemStockGroupID": i, "StockItemID": s, "StockGroupID": g}
            for i, (s, g) in enumerate(pairs, start=1)
        ],
    )


BUILDERS = {
    "customers": customers,
    "orders": orders,
    "order_lines": order_lines,
    "stock_items": stock_items,
    "stock_item_holdings": stock_item_holdings,
    "stock_groups": stock_groups,
    "stock_item_stock_groups": stock_item_stock_groups,
}


class SeedSource:
    """The seed rows as the source of a bronze run; counts its reads."""

    def __init__(self, broken=()):
        self.reads = []
        self.broken = set(broken)

    def read(self, spark, spec):
        self.reads.append(spec.name)
        if spec.name in self.broken:
            raise ConnectionError(f"no {spec.name}")
        return BUILDERS[spec.name](spark)
