"""Column expressions shared by checks and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct(part: Column, total: Column) -> Column:
    """Percent of total with one decimal; NULL on a zero total."""
    return F.round(F.try_divide(part.cast("double") * 100, total.cast("double")), 1)


def exact_avg(column: str, digits: int) -> Column:
    """Mean of a decimal column: exact sum, one division, one rounding.

    ``avg(decimal)`` rounds to six digits first, so rounding it again can be off
    by one in the last place; summing doubles depends on the order of the rows.
    """
    c = F.col(column)
    return F.round(F.try_divide(F.sum(c).cast("double"), F.count(c)), digits)


def inventory_value() -> Column:
    return F.sum(F.col("QuantityOnHand") * F.col("LastCostPrice")).cast("decimal(38,2)")


def thousands(c: Column) -> Column:
    """Integer text with thousands separators: ``15,000``."""
    return F.format_number(c, 0)


def fixed(c: Column, digits: int) -> Column:
    """Number text with so many decimals and no separators: ``1234.50``.

    ``format_number`` rounds the exact value of a double, halves to even, as
    ``printf`` does; ``format_string`` rounds its shortest decimal form up.
    """
    return F.call_function("format_number", c, F.lit("0." + "0" * digits))


def money(c: Column) -> Column:
    """Amount text: ``$17.59``; NULL for no amount."""
    return F.when(c.isNotNull(), F.concat(F.lit("$"), fixed(c, 2)))


def count_with_pct(count: Column, percent: Column) -> Column:
    """Report text such as ``14,831 (98.9%)``; plain count without a percent."""
    return F.when(percent.isNull(), thousands(count)).otherwise(
        F.concat(thousands(count), F.lit(" ("), fixed(percent, 1), F.lit("%)"))
    )
