"""Checks for any table: types, rules, profile, completeness.

Documented features of which only single instances are given, so the general
semantics are our own. One pass over the table each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.functions.expressions import pct
from bronzeflow.operators.quality import total_rows, unpivot_row
from bronzeflow.specs import spark_type


def type_conformance(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``(column, expected, actual, matches, cast_failures)`` per expected column.

    ``cast_failures`` counts set values that do not fit the expected type; it is
    NULL for a missing column.
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    failures = df.agg(
        total_rows(),
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"bad_{i}")
            for i, (c, t) in enumerate(expected.items())
            if c in actual
        ],
    )
    rows = []
    for i, (c, t) in enumerate(expected.items()):
        present = c in actual
        rows.append(
            {
                "column": F.lit(c),
                "expected": F.lit(t),
                "actual": F.lit(actual[c].simpleString() if present else None).cast("string"),
                "matches": F.lit(present and actual[c] == spark_type(t)),
                "cast_failures": F.col(f"bad_{i}") if present else F.lit(None).cast("bigint"),
            }
        )
    return unpivot_row(failures, rows)


def business_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``(rule, passed, failed, unknown)``: rows where the condition holds, does not, is NULL."""
    counts = df.agg(
        *[
            F.count_if(wanted).alias(f"{outcome}_{i}")
            for i, rule in enumerate(rules.values())
            for outcome, wanted in (
                ("passed", F.expr(rule)),
                ("failed", ~F.expr(rule)),
                ("unknown", F.expr(rule).isNull()),
            )
        ]
    )
    return unpivot_row(
        counts,
        [
            {"rule": F.lit(name)}
            | {outcome: F.col(f"{outcome}_{i}") for outcome in ("passed", "failed", "unknown")}
            for i, name in enumerate(rules)
        ],
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, distinct: str = "approx"
) -> DataFrame:
    """``(column, rows, nulls, distinct, min, max, mean, stddev)`` per column.

    ``distinct="approx"`` keeps a fixed-size sketch per column and is the choice
    for large tables. ``"exact"`` makes the planner expand each row once per
    column and shuffle the distinct values; a task sorts what it expands, so rows
    are dealt out first, since a file may be one task however large it is.
    ``mean`` and ``stddev`` are NULL for columns that are not numbers; ``min`` and
    ``max`` are shown as text.
    """
    if distinct not in ("approx", "exact"):
        raise ValueError("distinct is 'approx' or 'exact'")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = list(columns or [c for c, t in types.items() if not isinstance(t, T.BinaryType)])
    count_distinct = F.count_distinct if distinct == "exact" else F.approx_count_distinct
    measures = []
    for i, c in enumerate(columns):
        measures += [
            F.count(c).alias(f"set_{i}"),
            count_distinct(c).alias(f"distinct_{i}"),
            F.min(c).cast("string").alias(f"min_{i}"),
            F.max(c).cast("string").alias(f"max_{i}"),
        ]
        if isinstance(types[c], T.NumericType):
            number = F.col(c).cast("double")
            measures += [
                F.round(F.avg(number), 4).alias(f"mean_{i}"),
                F.round(F.stddev_samp(number), 4).alias(f"stddev_{i}"),
            ]
    unknown = F.lit(None).cast("double")
    rows = []
    for i, c in enumerate(columns):
        numeric = isinstance(types[c], T.NumericType)
        rows.append(
            {
                "column": F.lit(c),
                "rows": F.col("total"),
                "nulls": F.col("total") - F.col(f"set_{i}"),
                "distinct": F.col(f"distinct_{i}"),
                "min": F.col(f"min_{i}"),
                "max": F.col(f"max_{i}"),
                "mean": F.col(f"mean_{i}") if numeric else unknown,
                "stddev": F.col(f"stddev_{i}") if numeric else unknown,
            }
        )
    rows_of = dealt_out(df) if distinct == "exact" else df
    return unpivot_row(rows_of.agg(total_rows(), *measures), rows)


def dealt_out(df: DataFrame) -> DataFrame:
    """The rows shared out evenly over the shuffle partitions, equal ones too.

    By a number of the row: its hash needs no sort of the rows before it, as dealing
    them in turn does.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, F.monotonically_increasing_id())


def column_completeness(df: DataFrame) -> DataFrame:
    """``(column, non_null, pct)``: share of set values of every column."""
    counts = df.agg(total_rows(), *[F.count(c).alias(f"set_{i}") for i, c in enumerate(df.columns)])
    return unpivot_row(
        counts,
        [
            {
                "column": F.lit(c),
                "non_null": F.col(f"set_{i}"),
                "pct": pct(F.col(f"set_{i}"), F.col("total")),
            }
            for i, c in enumerate(df.columns)
        ],
    )
