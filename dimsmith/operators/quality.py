"""Data-quality checks that stand in for database constraints, and cardinality profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, or are NULL in part."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("num_rows"))
    return counts.filter((F.col("num_rows") > 1) | missing)


def reference_violations(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows. NULL refers to nothing and passes.

    Child rows are counted per value first, so the join sees one row per value.
    """
    used = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count(F.lit(1)).alias("num_rows"))
    known = parent.select(F.col(parent_key).alias(foreign_key))
    return used.join(known, foreign_key, "left_anti")


def domain_violations(
    df: DataFrame, column: str, allowed: Sequence[object] | None = None, low: object = None, high: object = None
) -> DataFrame:
    """Values outside the allowed list or range, with the number of rows. NULL passes."""
    bad: Column = F.lit(False)
    if allowed is not None:
        bad = bad | ~F.col(column).isin(list(allowed))
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return df.filter(bad).groupBy(F.col(column).alias("bad_value")).agg(F.count(F.lit(1)).alias("num_rows"))


def check_keys(checks: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per named key check: how many key values are broken."""
    counted = [
        key_violations(df, key)
        .agg(F.count(F.lit(1)).alias("num_violations"))
        .select(F.lit(name).alias("check_name"), "num_violations")
        for name, (df, key) in checks.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def check_references(checks: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per named reference check: broken values and the child rows that hold them."""
    counted = [
        reference_violations(*check)
        .agg(
            F.count(F.lit(1)).alias("num_values"),
            F.coalesce(F.sum("num_rows"), F.lit(0)).cast("long").alias("num_rows"),
        )
        .select(F.lit(name).alias("check_name"), "num_values", "num_rows")
        for name, check in checks.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


def cardinality_profile(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Rows, distinct values and their ratio per column.

    The estimate takes one pass with constant state per column.  ``exact`` counts each column by
    a grouping of its own, so state grows with one column's distinct values at a time and is
    spread over all tasks.
    """
    if exact:
        rows = [
            df.groupBy(c)
            .agg(F.count(F.lit(1)).alias("__rows"))
            .agg(F.sum("__rows").alias("num_rows"), F.count(c).alias("num_distinct"))
            .select(F.lit(c).alias("column_name"), "num_rows", "num_distinct")
            for c in columns
        ]
        profile = reduce(lambda a, b: a.unionByName(b), rows)
    else:
        wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.approx_count_distinct(c).alias(c) for c in columns])
        pairs = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("num_distinct")) for c in columns])
        )
        profile = wide.select(F.col("n").alias("num_rows"), pairs.alias("p")).select(
            "p.column_name", "num_rows", "p.num_distinct"
        )
    return profile.withColumn("distinct_ratio", F.col("num_distinct") / F.col("num_rows"))
