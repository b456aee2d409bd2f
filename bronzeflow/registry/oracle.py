"""The registered queries in SQL, written from the wanted results.

Inputs are CTEs ``b_<bronze table>`` over the given tables. Sums and counts are
cast, since engines differ in the types of aggregates.
"""

from __future__ import annotations

from bronzeflow.registry.queries import ROW_COUNT_TABLES, RUN, STOCK_COUNT_TABLES
from bronzeflow.sources.fixtures import (
    ADAPTERS,
    FIRST_EDIT,
    LOADED_UNTIL,
    SALES_CHANGES,
    SECOND_EDIT,
    VERSIONED,
    bronze_input_sql,
)
from bronzeflow.specs import SPECS


def over(inputs: str, body: str, ctes: str = "") -> str:
    """``body`` with the named bronze inputs, and further CTEs after them."""
    parts = [f"b_{name} AS ({bronze_input_sql(name)})" for name in inputs.split()]
    if ctes:
        parts.append(ctes)
    return f"WITH {', '.join(parts)} {body}"


def pct(part: str, total: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100 / nullif(CAST({total} AS DOUBLE), 0), 1)"


def count_if(predicate: str) -> str:
    return f"CAST(count(CASE WHEN {predicate} THEN 1 END) AS BIGINT)"


def avg(column: str, digits: int) -> str:
    return f"round(CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0), {digits})"


def projection(name: str) -> str:
    return over(name, f"SELECT {', '.join(ADAPTERS[name].columns)} FROM b_{name}")


def inventory(*names: str) -> str:
    return over(
        " ".join(names),
        " UNION ALL ".join(
            f"SELECT '{n}' AS TableName, count(*) AS RecordCount FROM b_{n}" for n in names
        ),
    )


def nulls(table: str, columns: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{c}' AS "column", {count_if(f"{c} IS NULL")} AS n
        FROM b_{table}"""
        for c in columns.split()
    )


def loaded(name: str) -> str:
    return f"""SELECT '{name}' AS "table", count(*) AS written, count(*) AS read_back,
        true AS ok FROM b_{name}"""


def conformance(column: str, expected: str, actual: str | None, matches: str) -> str:
    if actual is None:
        return f"""SELECT '{column}' AS "column", '{expected}' AS expected,
            CAST(NULL AS VARCHAR) AS actual, {matches} AS matches,
            CAST(NULL AS BIGINT) AS cast_failures"""
    bad = f"{column} IS NOT NULL AND TRY_CAST({column} AS {expected}) IS NULL"
    return f"""SELECT '{column}' AS "column", '{expected}' AS expected, '{actual}' AS actual,
        {matches} AS matches, {count_if(bad)} AS cast_failures FROM b_stock_items"""


def rule(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS "rule", {count_if(condition)} AS passed,
        {count_if(f"NOT ({condition})")} AS failed,
        {count_if(f"({condition}) IS NULL")} AS unknown FROM b_order_lines"""


def profiled(column: str, numeric: bool) -> str:
    mean = f"round(avg(CAST({column} AS DOUBLE)), 4)" if numeric else "CAST(NULL AS DOUBLE)"
    deviation = (
        f"round(stddev_samp(CAST({column} AS DOUBLE)), 4)" if numeric else "CAST(NULL AS DOUBLE)"
    )
    return f"""SELECT '{column}' AS "column", count(*) AS "rows",
        count(*) - count({column}) AS "nulls", count(DISTINCT {column}) AS "distinct",
        CAST(min({column}) AS VARCHAR) AS "min", CAST(max({column}) AS VARCHAR) AS "max",
        {mean} AS "mean", {deviation} AS "stddev" FROM b_stock_items"""


def complete(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS non_null,
        {pct(f"count({column})", "count(*)")} AS pct FROM b_stock_items"""


def report_row(metric: str, value: str, total: str, table: str) -> str:
    share = pct(value, total) if total else "CAST(NULL AS DOUBLE)"
    text = f"format('{{:,}}', {value})"
    if total:
        text += f" || ' (' || printf('%.1f', {share}) || '%)'"
    return f"""SELECT '{metric}' AS metric, {value} AS "value", {share} AS pct, {text} AS "text"
        FROM {table}"""


def check_row(check: str, severity: str, predicate: str) -> str:
    return f"""SELECT 'stock_items' AS "table", '{check}' AS "check", '{severity}' AS severity,
        {count_if(predicate)} AS failed, count(*) AS total FROM b_stock_items"""


def union(*branches: str) -> str:
    return " UNION ALL ".join(branches)


STANDARD_LINEAGE = f"""TIMESTAMP '{RUN.ts:%Y-%m-%d %H:%M:%S}' AS _extract_timestamp,
    '{RUN.source_system}' AS _source_system, '{RUN.batch_id("orders")}' AS _batch_id"""

SUMMARY = """SELECT c.CustomerID, c.CustomerName, count(o.OrderID) AS TotalOrders,
    CAST(coalesce(sum(ol.Quantity * ol.UnitPrice), 0) AS DECIMAL(38,2)) AS TotalValue,
    max(o.OrderDate) AS LastOrderDate
    FROM b_customers c LEFT JOIN b_orders o ON c.CustomerID = o.CustomerID
    LEFT JOIN b_order_lines ol ON o.OrderID = ol.OrderID
    GROUP BY c.CustomerID, c.CustomerName"""

INVENTORY_VALUE = "CAST(sum(QuantityOnHand * LastCostPrice) AS DECIMAL(38,2)) AS inventory_value"

PRICED = """CAST(CAST(o_totalprice AS DECIMAL(18,2)) + {markup} AS DECIMAL(18,2)) AS TotalPrice"""

# Metrics of the whole run, per bronze table.
METRICS = {
    "customers": {"null_names": count_if("CustomerName IS NULL")},
    "orders": {"null_order_id": count_if("OrderID IS NULL")},
    "order_lines": {
        "null_order_line_id": count_if("OrderLineID IS NULL"),
        "null_order_id": count_if("OrderID IS NULL"),
        "total_quantity": "sum(Quantity)",
        "avg_unit_price": avg("UnitPrice", 2),
    },
    "stock_items": {
        "null_stock_item_id": count_if("StockItemID IS NULL"),
        "null_name": count_if("StockItemName IS NULL"),
        "price_not_positive": count_if("UnitPrice <= 0"),
        "avg_unit_price": avg("UnitPrice", 4),
        "max_unit_price": "max(UnitPrice)",
        "chiller_items": count_if("IsChillerStock"),
    },
    "stock_item_holdings": {
        "negative_stock": count_if("QuantityOnHand < 0"),
        "zero_stock": count_if("QuantityOnHand = 0"),
        "below_reorder": count_if("QuantityOnHand < ReorderLevel"),
        "inventory_value": "CAST(sum(QuantityOnHand * LastCostPrice) AS DECIMAL(38,2))",
    },
    "stock_groups": {},
    "stock_item_stock_groups": {},
}
METRICS = {
    t: {"total": "count(*)", "read_back": "count(*)"} | own for t, own in METRICS.items()
}


def metric(table: str, name: str, expression: str) -> str:
    return f"""SELECT '{table}' AS "table", '{name}' AS metric,
        CAST({expression} AS DOUBLE) AS value FROM b_{table}"""


# Texts among the columns of the versioned inputs.
TEXTS = {"CustomerName", "CustomerCategory", "StockItemName", "Brand", "Size"}


def silver(name: str) -> str:
    """Latest row per key of the versioned input, ended rows aside, texts trimmed."""
    spec, columns = SPECS[name], VERSIONED[name]
    (key,) = spec.primary_key
    made = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    clean = ", ".join(f"nullif(trim({c}), '') AS {c}" if c in TEXTS else c for c in columns)
    current = (
        "ValidTo IS NULL OR ValidTo >= TIMESTAMP '9999-12-31 23:59:59.999999'"
        if "ValidTo" in columns
        else "true"
    )
    edited = spec.edited_column
    order = [edited, *[c for c in columns if c not in (key, edited)]]
    best = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return over(
        name,
        f"""SELECT {", ".join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {key}
        ORDER BY {best}) AS nth FROM (SELECT {clean} FROM (SELECT {made} FROM b_{name},
        (VALUES (1), (2)) versions(v) WHERE v = 1 OR {key} % 3 = 0) WHERE {current})
        WHERE {key} IS NOT NULL) WHERE nth = 1""",
    )


INCREMENTAL_LOAD = f"""WITH first AS (SELECT CAST(o_orderkey AS INT) AS OrderID,
    CAST(o_custkey AS INT) AS CustomerID, {FIRST_EDIT} AS LastEditedWhen,
    CAST(year(o_orderdate) AS INT) AS OrderYear FROM orders),
    base AS (SELECT * FROM first WHERE LastEditedWhen <= {LOADED_UNTIL}),
    offered AS (SELECT CAST(o_orderkey AS INT) AS OrderID,
    CAST(o_custkey + 1 AS INT) AS CustomerID, {SECOND_EDIT} AS LastEditedWhen,
    CAST(year(o_orderdate) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INT) AS OrderYear
    FROM orders),
    since AS (SELECT * FROM offered WHERE LastEditedWhen IS NULL
    OR LastEditedWhen >= (SELECT max(LastEditedWhen) FROM base))
    SELECT * FROM since s WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.OrderID = s.OrderID
    AND (s.LastEditedWhen IS NULL OR b.LastEditedWhen > s.LastEditedWhen))
    UNION ALL SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM since s
    WHERE b.OrderID = s.OrderID AND s.LastEditedWhen >= b.LastEditedWhen)"""

STREAM_UPSERT = f"""WITH first AS (SELECT CAST(o_orderkey AS INT) AS OrderID,
    CAST(o_custkey AS INT) AS CustomerID, {FIRST_EDIT} AS LastEditedWhen,
    CAST(year(o_orderdate) AS INT) AS OrderYear FROM orders),
    looks AS (SELECT *, 1 AS look FROM first WHERE LastEditedWhen <= {LOADED_UNTIL}
    UNION ALL SELECT CAST(o_orderkey AS INT), CAST(o_custkey + 1 AS INT), {SECOND_EDIT},
    CAST(year(o_orderdate) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INT), 2 FROM orders)
    SELECT OrderID, CustomerID, LastEditedWhen, OrderYear,
    (SELECT count(*) FROM looks) AS streamed_rows FROM (SELECT *, row_number() OVER
    (PARTITION BY OrderID ORDER BY LastEditedWhen DESC NULLS LAST, look DESC) AS n FROM looks)
    WHERE n = 1"""


def newest(name: str, key: str, *changes: str) -> str:
    """CTE of the newest version of each changed row, the rows of the base that none has replaced with it."""
    every = " UNION ALL ".join(
        f"SELECT *, {n} AS look FROM ({SALES_CHANGES[c].format(orders='b_orders', lines='b_order_lines')})"
        for n, c in enumerate(changes)
    )
    return (
        f"{name} AS (SELECT * FROM (SELECT *, max(look) OVER (PARTITION BY {key}) AS newest"
        f" FROM ({every})) WHERE look = newest)"
    )


def report(name: str, row: str, key: str, columns: str, numbers: str = "") -> str:
    """Figures of a report, one row each, over the SQL of a registered query."""
    branches = [
        f"""SELECT '{name}' AS report, {row} AS "row", '{c}' AS metric, CAST("{c}" AS VARCHAR) AS "value"
        FROM ({key})"""
        for c in columns.split()
    ]
    branches += [
        f"""SELECT '{name}', {row}, '{c}', printf('%.4f', CAST("{c}" AS DOUBLE)) FROM ({key})"""
        for c in numbers.split()
    ]
    return " UNION ALL ".join(branches)


def changed_profile(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS "rows", count(*) - count({column}) AS "nulls",
        CAST(min({column}) AS VARCHAR) AS "min", CAST(max({column}) AS VARCHAR) AS "max",
        round(avg(CAST({column} AS DOUBLE)), 4) AS "mean",
        round(stddev_samp(CAST({column} AS DOUBLE)), 4) AS "stddev", true AS distinct_is_near,
        (SELECT count(DISTINCT OrderYear) FROM t WHERE recent) AS partitions_read FROM t"""


ORACLE_SQL: dict[str, str] = {
    **{f"project_{name}": projection(name) for name in ADAPTERS if name != "suppliers"},
    "lineage_standard": over("orders", f"SELECT OrderID, {STANDARD_LINEAGE} FROM b_orders"),
    "lineage_customers": over(
        "customers",
        f"""SELECT CustomerID, TIMESTAMP '{RUN.ts:%Y-%m-%d %H:%M:%S}' AS extraction_timestamp,
        '{RUN.source_system}' AS source_system, 'Sales.Customers' AS source_table,
        '1.0' AS bronze_layer_version FROM b_customers""",
    ),
    "bronze_roundtrip_orders": over(
        "orders", f"SELECT OrderID, CustomerID, OrderDate, {STANDARD_LINEAGE} FROM b_orders"
    ),
    "schema_evolution": """SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
        CAST(NULL AS DATE) AS OrderDate, o_orderpriority AS Priority FROM orders""",
    "verify_load": over("order_lines", loaded("order_lines")),
    "append_if_empty": over("customers", loaded("customers")),
    "bronze_run": over(
        " ".join(METRICS),
        union(*[metric(t, m, e) for t, own in METRICS.items() for m, e in own.items()]),
    ),
    "dup_customer_ids": over(
        "customers",
        "SELECT CustomerID, count(*) AS n FROM b_customers GROUP BY CustomerID HAVING count(*) > 1",
    ),
    "duplicate_order_lines": over(
        "order_lines",
        """SELECT OrderLineID, count(*) AS n FROM b_order_lines GROUP BY OrderLineID
        HAVING count(*) > 1""",
    ),
    "dq_customers": over(
        "customers",
        f"""SELECT count(*) AS total, {count_if("CustomerName IS NULL")} AS null_names,
        (SELECT count(*) FROM (SELECT CustomerID FROM b_customers GROUP BY CustomerID
         HAVING count(*) > 1)) AS duplicate_ids FROM b_customers""",
    ),
    "dq_orders": over(
        "orders",
        f"""SELECT count(*) AS total, {count_if("OrderID IS NULL")} AS null_order_id
        FROM b_orders""",
    ),
    "dq_order_lines": over(
        "order_lines",
        f"""SELECT count(*) AS total, {count_if("OrderLineID IS NULL")} AS null_order_line_id,
        {count_if("OrderID IS NULL")} AS null_order_id FROM b_order_lines""",
    ),
    "check_report_stock_items": over(
        "stock_items",
        union(
            check_row("null_stock_item_id", "warning", "StockItemID IS NULL"),
            check_row("null_name", "warning", "StockItemName IS NULL"),
            check_row("price_not_positive", "info", "UnitPrice <= 0"),
        ),
    ),
    "orders_quality": over(
        "orders",
        f"""SELECT count(*) AS orders, count(CustomerID) AS with_customer,
        count(OrderDate) AS with_date, {pct("count(CustomerID)", "count(*)")} AS pct_customer,
        {pct("count(OrderDate)", "count(*)")} AS pct_date FROM b_orders""",
    ),
    "lines_quality": over(
        "order_lines",
        f"""SELECT count(*) AS lines, count(StockItemID) AS with_stock,
        {count_if("Quantity > 0")} AS positive,
        {pct("count(StockItemID)", "count(*)")} AS pct_stock,
        {pct(count_if("Quantity > 0"), "count(*)")} AS pct_positive FROM b_order_lines""",
    ),
    "orders_quality_report": over(
        "orders order_lines",
        union(
            report_row("orders", "count(*)", "", "b_orders"),
            report_row("orders_with_customer", "count(CustomerID)", "count(*)", "b_orders"),
            report_row("orders_with_date", "count(OrderDate)", "count(*)", "b_orders"),
            report_row("order_lines", "count(*)", "", "b_order_lines"),
            report_row("lines_with_stock_item", "count(StockItemID)", "count(*)", "b_order_lines"),
            report_row(
                "lines_with_positive_quantity", count_if("Quantity > 0"), "count(*)", "b_order_lines"
            ),
        ),
    ),
    "stock_report": over(
        "stock_items stock_item_holdings",
        f"""SELECT unnest(['average_unit_price', 'price_range', 'price_deviation']) AS metric,
        unnest(['$' || printf('%.2f', a), '$' || printf('%.2f', lo) || ' - $' || printf('%.2f', hi),
        '$' || printf('%.2f', d)]) AS "text" FROM (SELECT {avg("UnitPrice", 4)} AS a,
        CAST(min(UnitPrice) AS DOUBLE) AS lo, CAST(max(UnitPrice) AS DOUBLE) AS hi,
        stddev_samp(CAST(UnitPrice AS DOUBLE)) AS d FROM b_stock_items WHERE UnitPrice > 0)
        UNION ALL SELECT unnest(['total_quantity', 'average_quantity', 'out_of_stock',
        'below_reorder', 'inventory_value']), unnest([format('{{:,}}', q), printf('%.1f', a),
        format('{{:,}}', z), format('{{:,}}', b), '$' || printf('%.2f', v)]) FROM
        (SELECT CAST(sum(QuantityOnHand) AS BIGINT) AS q, avg(QuantityOnHand) AS a,
        {count_if("QuantityOnHand = 0")} AS z, {count_if("QuantityOnHand < ReorderLevel")} AS b,
        CAST(sum(QuantityOnHand * LastCostPrice) AS DOUBLE) AS v FROM b_stock_item_holdings)
        UNION ALL SELECT unnest(['items_with_name', 'items_with_price', 'items_with_brand',
        'items_with_size']), unnest([{", ".join(
            f"format('{{:,}}', {n}) || ' (' || printf('%.1f', {pct(n, 't')}) || '%)'"
            for n in ("n1", "n2", "n3", "n4"))}]) FROM (SELECT count(*) AS t,
        count(StockItemName) AS n1, {count_if("UnitPrice > 0")} AS n2, count(Brand) AS n3,
        count(Size) AS n4 FROM b_stock_items)""",
    ),
    "lines_stats": over(
        "order_lines",
        f"""SELECT CAST(sum(Quantity) AS BIGINT) AS total_quantity,
        {avg("UnitPrice", 2)} AS avg_unit_price FROM b_order_lines""",
    ),
    "dq_stock_items": over(
        "stock_items",
        f"""SELECT count(*) AS total, {count_if("StockItemID IS NULL")} AS null_stock_item_id,
        {count_if("StockItemName IS NULL")} AS null_name,
        {count_if("UnitPrice <= 0")} AS price_not_positive FROM b_stock_items""",
    ),
    "stats_stock_items": over(
        "stock_items",
        f"""SELECT {avg("UnitPrice", 4)} AS avg_unit_price, max(UnitPrice) AS max_unit_price,
        {count_if("IsChillerStock")} AS chiller_items FROM b_stock_items""",
    ),
    "price_statistics": over(
        "stock_items",
        f"""SELECT {avg("UnitPrice", 4)} AS avg_price, min(UnitPrice) AS min_price,
        max(UnitPrice) AS max_price,
        round(stddev_samp(CAST(UnitPrice AS DOUBLE)), 4) AS price_stddev
        FROM b_stock_items WHERE UnitPrice > 0""",
    ),
    "inventory_statistics": over(
        "stock_item_holdings",
        f"""SELECT CAST(sum(QuantityOnHand) AS BIGINT) AS total_quantity,
        round(avg(QuantityOnHand), 4) AS avg_quantity,
        {count_if("QuantityOnHand = 0")} AS zero_stock_items,
        {count_if("QuantityOnHand < ReorderLevel")} AS below_reorder_items,
        {INVENTORY_VALUE} FROM b_stock_item_holdings""",
    ),
    "dq_holdings": over(
        "stock_item_holdings",
        f"""SELECT count(*) AS total, {count_if("QuantityOnHand < 0")} AS negative_stock,
        {count_if("QuantityOnHand = 0")} AS zero_stock,
        {count_if("QuantityOnHand < ReorderLevel")} AS below_reorder,
        {INVENTORY_VALUE} FROM b_stock_item_holdings""",
    ),
    "stock_completeness": over(
        "stock_items",
        f"""SELECT count(*) AS total_items, count(StockItemName) AS items_with_name,
        {count_if("UnitPrice > 0")} AS items_with_price, count(Brand) AS items_with_brand,
        count(Size) AS items_with_size, {pct("count(StockItemName)", "count(*)")} AS pct_name,
        {pct(count_if("UnitPrice > 0"), "count(*)")} AS pct_price,
        {pct("count(Brand)", "count(*)")} AS pct_brand,
        {pct("count(Size)", "count(*)")} AS pct_size FROM b_stock_items""",
    ),
    "category_distribution": over(
        "stock_groups stock_item_stock_groups",
        """SELECT g.StockGroupName, count(DISTINCT j.StockItemID) AS item_count
        FROM b_stock_groups g JOIN b_stock_item_stock_groups j
        ON g.StockGroupID = j.StockGroupID GROUP BY g.StockGroupName
        ORDER BY item_count DESC, g.StockGroupName ASC NULLS FIRST LIMIT 5""",
    ),
    "group_names": over("stock_groups", "SELECT DISTINCT StockGroupName FROM b_stock_groups"),
    "item_group_stats": over(
        "stock_item_stock_groups",
        """SELECT (SELECT count(*) FROM (SELECT DISTINCT StockItemID
        FROM b_stock_item_stock_groups)) AS "items", (SELECT count(*) FROM
        (SELECT DISTINCT StockGroupID FROM b_stock_item_stock_groups)) AS "groups" """,
    ),
    "distinct_with_null": over(
        "order_lines",
        "SELECT count(*) AS n FROM (SELECT DISTINCT StockItemID FROM b_order_lines)",
    ),
    "distinct_non_null": over(
        "order_lines", "SELECT count(DISTINCT StockItemID) AS n FROM b_order_lines"
    ),
    "customer_order_summary": over("customers orders order_lines", SUMMARY),
    "customer_order_summary_sorted": over(
        "customers orders order_lines",
        f"""SELECT * FROM ({SUMMARY}) ORDER BY TotalValue DESC,
        CustomerID ASC NULLS FIRST, CustomerName ASC NULLS FIRST""",
    ),
    "table_inventory": inventory(*ROW_COUNT_TABLES),
    "stock_table_inventory": inventory(*STOCK_COUNT_TABLES),
    "orphan_orders": over(
        "customers orders",
        """SELECT OrderID FROM (SELECT OrderID, CASE WHEN CustomerID % 10 = 0
        THEN -1 - CustomerID ELSE CustomerID END AS CustomerID FROM b_orders) o
        WHERE CustomerID IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM b_customers c WHERE c.CustomerID = o.CustomerID)""",
    ),
    "orphan_lines": over(
        "orders order_lines",
        """SELECT DISTINCT OrderLineID FROM (SELECT OrderLineID, CASE WHEN OrderID % 10 = 0
        THEN -1 - OrderID ELSE OrderID END AS OrderID FROM b_order_lines) ol
        WHERE OrderID IS NOT NULL AND NOT EXISTS
        (SELECT 1 FROM b_orders o WHERE o.OrderID = ol.OrderID)""",
    ),
    "sample_rows": over(
        "customers",
        """SELECT * FROM b_customers ORDER BY CustomerID ASC NULLS FIRST,
        CustomerName ASC NULLS FIRST LIMIT 5""",
    ),
    "null_violations": over(
        "customers orders order_lines stock_items",
        union(
            nulls("customers", "CustomerID CustomerName"),
            nulls("orders", "OrderID CustomerID"),
            nulls("order_lines", "OrderLineID OrderID StockItemID"),
            nulls("stock_items", "StockItemID StockItemName"),
        ),
    ),
    "type_conformance": over(
        "stock_items",
        union(
            conformance("StockItemID", "bigint", "bigint", "true"),
            conformance("StockItemName", "string", "string", "true"),
            conformance("Brand", "int", "string", "false"),
            conformance("Size", "int", "string", "false"),
            conformance("UnitPrice", "decimal(18,2)", "decimal(18,2)", "true"),
            conformance("IsChillerStock", "boolean", "boolean", "true"),
            conformance("Barcode", "string", None, "false"),
        ),
    ),
    "business_rules": over(
        "order_lines",
        union(
            rule("has_stock_item", "StockItemID IS NOT NULL"),
            rule("positive_quantity", "Quantity > 0"),
            rule("known_item_sold", "StockItemID > 0 AND Quantity > 0"),
            rule("price_at_least_quantity", "UnitPrice >= Quantity"),
        ),
    ),
    "column_profile": over(
        "stock_items",
        union(
            profiled("StockItemID", True),
            profiled("StockItemName", False),
            profiled("Brand", False),
            profiled("Size", False),
            profiled("UnitPrice", True),
            profiled("IsChillerStock", False),
        ),
    ),
    "column_completeness": over(
        "stock_items", union(*[complete(c) for c in ADAPTERS["stock_items"].columns])
    ),
    "append_if_empty_orders": f"""SELECT o_orderkey AS OrderID, {PRICED.format(markup=0)},
        CAST(year(o_orderdate) AS INT) AS OrderYear FROM orders""",
    "incremental_load": INCREMENTAL_LOAD,
    "incremental_upsert": f"""WITH incoming AS (SELECT o_orderkey AS OrderID,
        {PRICED.format(markup=1)} FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')
        SELECT OrderID, TotalPrice, 'incoming' AS version FROM incoming UNION ALL
        SELECT o_orderkey, {PRICED.format(markup=0)}, 'base' FROM orders
        WHERE o_orderdate < TIMESTAMP '2000-01-01'
        AND o_orderkey NOT IN (SELECT OrderID FROM incoming)""",
    "upsert_partitioned_table": f"""WITH incoming AS (SELECT o_orderkey AS OrderID,
        {PRICED.format(markup=1)}, CAST(year(o_orderdate) + 1 AS INT) AS OrderYear
        FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01')
        SELECT OrderID, TotalPrice, OrderYear FROM incoming UNION ALL
        SELECT o_orderkey, {PRICED.format(markup=0)}, CAST(year(o_orderdate) AS INT)
        FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
        AND o_orderkey NOT IN (SELECT OrderID FROM incoming)""",
    **{f"silver_{name}": silver(name) for name in VERSIONED},
    "gold_daily_sales": over(
        "orders order_lines",
        """SELECT o.OrderDate, count(*) AS orders, CAST(coalesce(sum(ol.n), 0) AS BIGINT) AS lines,
        CAST(coalesce(sum(ol.v), 0) AS DECIMAL(38,2)) AS revenue FROM b_orders o
        LEFT JOIN (SELECT OrderID, count(*) AS n, sum(Quantity * UnitPrice) AS v
        FROM b_order_lines GROUP BY OrderID) ol ON o.OrderID = ol.OrderID
        WHERE o.OrderDate IS NOT NULL GROUP BY o.OrderDate""",
    ),
    "gold_category_revenue": over(
        "order_lines stock_groups stock_item_stock_groups",
        """SELECT g.StockGroupName, CAST(sum(ol.Quantity) AS BIGINT) AS quantity,
        CAST(sum(ol.Quantity * ol.UnitPrice) AS DECIMAL(38,2)) AS revenue
        FROM b_stock_groups g JOIN (SELECT DISTINCT StockItemID, StockGroupID
        FROM b_stock_item_stock_groups) j ON g.StockGroupID = j.StockGroupID
        JOIN b_order_lines ol ON ol.StockItemID = j.StockItemID GROUP BY g.StockGroupName""",
    ),
    "stream_events": f"""SELECT event_id, ts, user_id, event_type, "value", props,
        TIMESTAMP '{RUN.ts:%Y-%m-%d %H:%M:%S}' AS _extract_timestamp,
        '{RUN.source_system}' AS _source_system, '{RUN.batch_id("events")}' AS _batch_id
        FROM events""",
}

LINE_RULE_SQL = {
    "has_stock_item": "StockItemID IS NOT NULL",
    "positive_quantity": "Quantity > 0",
    "known_item_sold": "StockItemID > 0 AND Quantity > 0",
    "price_at_least_quantity": "UnitPrice >= Quantity",
}

ORACLE_SQL |= {
    "bronze_run_resumed": ORACLE_SQL["bronze_run"]
    + "".join(
        f""" UNION ALL SELECT '{name}', 'source_reads', CAST({2 if name == "orders" else 1} AS DOUBLE)"""
        for name in SPECS
    ),
    "bronze_run_reports": union(
        report(
            "customers_sample",
            "n",
            f"""SELECT CAST(row_number() OVER (ORDER BY CustomerID ASC NULLS FIRST,
            CustomerName ASC NULLS FIRST) AS VARCHAR) AS n, * FROM ({ORACLE_SQL["sample_rows"]})""",
            "CustomerID CustomerName DeliveryCityID",
        ),
        report("customers", "'1'", ORACLE_SQL["dq_customers"], "total null_names duplicate_ids"),
        report("orders", "metric", ORACLE_SQL["orders_quality_report"], "value text", "pct"),
        report("stock_counts", "TableName", ORACLE_SQL["stock_table_inventory"], "RecordCount"),
        report(
            "price_statistics",
            "'1'",
            ORACLE_SQL["price_statistics"],
            "",
            "avg_price min_price max_price price_stddev",
        ),
        report(
            "inventory_statistics",
            "'1'",
            ORACLE_SQL["inventory_statistics"],
            "total_quantity zero_stock_items below_reorder_items",
            "avg_quantity inventory_value",
        ),
        report("category_distribution", "StockGroupName", ORACLE_SQL["category_distribution"], "item_count"),
        report("group_names", "'1'", f"SELECT count(*) AS names FROM ({ORACLE_SQL['group_names']})", "names"),
        report("item_groups", "'1'", ORACLE_SQL["item_group_stats"], "items groups"),
        report(
            "stock_completeness",
            "'1'",
            ORACLE_SQL["stock_completeness"],
            "total_items items_with_name items_with_price items_with_brand items_with_size",
            "pct_name pct_price pct_brand pct_size",
        ),
    ),
    "summary_of_bucketed_tables": ORACLE_SQL["customer_order_summary"],
    "overwrite_by_pointer": f"""SELECT o_orderkey AS OrderID, {PRICED.format(markup=1)}, 'later' AS Kind,
        CAST(year(o_orderdate) + 1 AS INT) AS OrderYear FROM orders WHERE o_orderkey % 3 <> 0""",
    "gold_daily_sales_incremental": over(
        "orders order_lines",
        """SELECT CAST(o.OrderDate AS DATE) AS OrderDate, count(*) AS orders,
        CAST(coalesce(sum(ol.n), 0) AS BIGINT) AS lines,
        CAST(coalesce(sum(ol.v), 0) AS DECIMAL(38,2)) AS revenue FROM o
        LEFT JOIN (SELECT OrderID, count(*) AS n, sum(Quantity * UnitPrice) AS v
        FROM ol GROUP BY OrderID) ol ON o.OrderID = ol.OrderID
        WHERE o.OrderDate IS NOT NULL GROUP BY CAST(o.OrderDate AS DATE)""",
        f"""{newest("o", "OrderID", "orders_0", "orders_1", "orders_2")},
        {newest("ol", "OrderLineID", "lines_0", "lines_2")}""",
    ),
    "stream_upsert_orders": STREAM_UPSERT,
    "profile_of_growing_table": f"""WITH t AS (SELECT o_orderkey AS OrderID, {PRICED.format(markup=0)},
        year(o_orderdate) AS OrderYear, o_orderdate >= TIMESTAMP '1998-07-01' AS recent FROM orders)
        {union(changed_profile("OrderID"), changed_profile("TotalPrice"))}""",
    "quarantined_order_lines": over(
        "order_lines",
        f"""SELECT *, concat_ws(',', {", ".join(
            f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END"
            for name, rule in LINE_RULE_SQL.items())}) AS broken FROM b_order_lines""",
    ),
}
