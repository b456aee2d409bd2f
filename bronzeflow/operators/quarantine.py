"""Rows that break a rule set apart from the rest, in one write.

Business rules are a documented feature without a given implementation, so the
semantics here are our own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.config import Target
from bronzeflow.operators.sinks import write_bronze
from bronzeflow.specs import TableSpec

PASSED, BROKEN = "_passed", "_broken_rules"


def broken_rules(rules: Mapping[str, str], unknown_passes: bool = False) -> Column:
    """Names of the rules that a row does not meet, in the order of ``rules``.

    A rule whose condition is NULL is broken, unless ``unknown_passes``.
    """
    names = [
        F.when(~F.coalesce(F.expr(rule), F.lit(unknown_passes)), F.lit(name))
        for name, rule in rules.items()
    ]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def checked_spec(spec: TableSpec) -> TableSpec:
    """The table of both kinds of rows, parted by a column first of all."""
    return replace(spec, name=f"{spec.name}__checked", partition_by=(PASSED, *spec.partition_by))


def write_checked(
    df: DataFrame,
    target: Target,
    spec: TableSpec,
    rules: Mapping[str, str],
    unknown_passes: bool = False,
) -> dict[str, Any]:
    """Write all rows once, passing and failing ones in folders of their own.

    Returns what was counted in the stage that wrote them: ``total``, ``passed``,
    and of each rule the rows that break it. An overwrite; an empty input gives an
    empty table and counts of zero. Columns of ``df`` must not have the names of
    the two that are added.
    """
    clash = {PASSED, BROKEN} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns are there already: {sorted(clash)}")
    marked = df.withColumn(BROKEN, broken_rules(rules, unknown_passes))
    marked = marked.withColumn(PASSED, F.size(BROKEN) == 0)
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(F.col(PASSED)).alias("passed")]
    counts += [
        F.count_if(F.array_contains(BROKEN, name)).alias(f"broken_{name}") for name in rules
    ]
    return write_bronze(marked, target, checked_spec(spec), counts, evolve=False)


def passing(spark: SparkSession, target: Target, spec: TableSpec) -> DataFrame:
    """Rows that meet every rule; the others' folder is not read."""
    rows = spark.table(target.name(checked_spec(spec).name))
    return rows.where(F.col(PASSED)).drop(PASSED, BROKEN)


def quarantined(spark: SparkSession, target: Target, spec: TableSpec) -> DataFrame:
    """Rows that break a rule, with the names of all rules they break."""
    rows = spark.table(target.name(checked_spec(spec).name))
    return rows.where(~F.col(PASSED)).drop(PASSED)
