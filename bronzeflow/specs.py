"""Contracts of the seven bronze tables: columns, keys, layout, lineage."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import types as T

_SIMPLE_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
}


def spark_type(name: str) -> T.DataType:
    decimal = re.fullmatch(r"decimal\((\d+),(\d+)\)", name)
    if decimal:
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    return _SIMPLE_TYPES[name]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    name: str
    source_table: str
    ddl: str
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...]
    batch_prefix: str
    partition_by: tuple[str, ...] = ()
    lineage: str = "standard"
    foreign_keys: tuple[ForeignKey, ...] = ()
    edited_column: str | None = None
    optional: tuple[str, ...] = ()  # columns that a source may lack
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def fields(self) -> list[tuple[str, str]]:
        """(column, type name) in contract order."""
        return [tuple(line.split()) for line in self.ddl.strip().splitlines()]

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, spark_type(t), c not in self.not_null) for c, t in self.fields]
        )

    @property
    def select_sql(self) -> str:
        return f"SELECT {', '.join(self.columns)} FROM {self.source_table}"

    def with_layout(self, *partition_by: str) -> TableSpec:
        """The same table, partitioned by other columns."""
        return replace(self, partition_by=partition_by)

    def bucketed(self, buckets: int, *columns: str) -> TableSpec:
        """The same table without partitions, its rows dealt into files by the hash of columns.

        Tables dealt into equally many buckets by one key meet by it without a shuffle.
        """
        return replace(self, partition_by=(), bucket_by=columns, buckets=buckets)


# Source tables, column names, order and types of the bronze contract.
CUSTOMERS = TableSpec(
    name="customers",
    source_table="Sales.Customers",
    ddl="""
        CustomerID int
        CustomerName string
        BillToCustomerID int
        CustomerCategoryID int
        PrimaryContactPersonID int
        DeliveryMethodID int
        DeliveryCityID int
        PostalCityID int
        AccountOpenedDate date
        StandardDiscountPercentage decimal(18,3)
        IsStatementSent boolean
        IsOnCreditHold boolean
        PaymentDays int
        PhoneNumber string
        FaxNumber string
        WebsiteURL string
        DeliveryAddressLine1 string
        DeliveryPostalCode string
        PostalAddressLine1 string
        PostalPostalCode string
        LastEditedBy int
        ValidFrom timestamp
        ValidTo timestamp
    """,
    primary_key=("CustomerID",),
    not_null=("CustomerID", "CustomerName"),
    batch_prefix="customers",
    lineage="customers",
    edited_column="ValidFrom",
)

ORDERS = TableSpec(
    name="orders",
    source_table="Sales.Orders",
    ddl="""
        OrderID int
        CustomerID int
        SalespersonPersonID int
        PickedByPersonID int
        ContactPersonID int
        BackorderOrderID int
        OrderDate date
        ExpectedDeliveryDate date
        CustomerPurchaseOrderNumber string
        IsUndersupplyBackordered boolean
        Comments string
        DeliveryInstructions string
        InternalComments string
        PickingCompletedWhen timestamp
        LastEditedBy int
        LastEditedWhen timestamp
    """,
    primary_key=("OrderID",),
    not_null=("OrderID", "CustomerID"),
    batch_prefix="orders",
    partition_by=("OrderDate",),
    foreign_keys=(ForeignKey("CustomerID", "customers", "CustomerID"),),
    edited_column="LastEditedWhen",
)

ORDER_LINES = TableSpec(
    name="order_lines",
    source_table="Sales.OrderLines",
    ddl="""
        OrderLineID int
        OrderID int
        StockItemID int
        Description string
        PackageTypeID int
        Quantity int
        UnitPrice decimal(18,2)
        TaxRate decimal(18,3)
        PickedQuantity int
        PickingCompletedWhen timestamp
        LastEditedBy int
        LastEditedWhen timestamp
    """,
    primary_key=("OrderLineID",),
    not_null=("OrderLineID", "OrderID", "StockItemID"),
    batch_prefix="order_lines",
    foreign_keys=(ForeignKey("OrderID", "orders", "OrderID"),),
    edited_column="LastEditedWhen",
)

STOCK_ITEMS = TableSpec(
    name="stock_items",
    source_table="Warehouse.StockItems",
    ddl="""
        StockItemID int
        StockItemName string
        SupplierID int
        ColorID int
        UnitPackageID int
        OuterPackageID int
        Brand string
        Size string
        LeadTimeDays int
        QuantityPerOuter int
        IsChillerStock boolean
        Barcode string
        TaxRate decimal(18,3)
        UnitPrice decimal(18,2)
        RecommendedRetailPrice decimal(18,2)
        TypicalWeightPerUnit decimal(18,3)
        MarketingComments string
        InternalComments string
        Photo binary
        CustomFields string
        Tags string
        SearchDetails string
        LastEditedBy int
        ValidFrom timestamp
        ValidTo timestamp
    """,
    primary_key=("StockItemID",),
    not_null=("StockItemID", "StockItemName"),
    batch_prefix="stock_items",
    optional=("Photo",),
    edited_column="ValidFrom",
)

STOCK_ITEM_HOLDINGS = TableSpec(
    name="stock_item_holdings",
    source_table="Warehouse.StockItemHoldings",
    ddl="""
        StockItemID int
        QuantityOnHand int
        BinLocation string
        LastStocktakeQuantity int
        LastCostPrice decimal(18,2)
        ReorderLevel int
        TargetStockLevel int
        LastEditedBy int
        LastEditedWhen timestamp
    """,
    primary_key=("StockItemID",),
    not_null=("StockItemID",),
    batch_prefix="stock_holdings",
    edited_column="LastEditedWhen",
)

STOCK_GROUPS = TableSpec(
    name="stock_groups",
    source_table="Warehouse.StockGroups",
    ddl="""
        StockGroupID int
        StockGroupName string
        LastEditedBy int
        ValidFrom timestamp
        ValidTo timestamp
    """,
    primary_key=("StockGroupID",),
    not_null=("StockGroupID",),
    batch_prefix="stock_groups",
    edited_column="ValidFrom",
)

STOCK_ITEM_STOCK_GROUPS = TableSpec(
    name="stock_item_stock_groups",
    source_table="Warehouse.StockItemStockGroups",
    ddl="""
        StockItemStockGroupID int
        StockItemID int
        StockGroupID int
        LastEditedBy int
        LastEditedWhen timestamp
    """,
    primary_key=("StockItemStockGroupID",),
    not_null=("StockItemStockGroupID",),
    batch_prefix="stock_item_groups",
    edited_column="LastEditedWhen",
)

SPECS = {
    spec.name: spec
    for spec in (
        CUSTOMERS,
        ORDERS,
        ORDER_LINES,
        STOCK_ITEMS,
        STOCK_ITEM_HOLDINGS,
        STOCK_GROUPS,
        STOCK_ITEM_STOCK_GROUPS,
    )
}
