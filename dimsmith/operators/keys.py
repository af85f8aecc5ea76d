"""Surrogate keys: dense, repeatable, numbered in natural-key order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.operators import ordering


def assign_surrogate_keys(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    offset: int = 0,
    ranges: int | None = None,
    size_of: DataFrame | None = None,
    stored: bool = False,
) -> DataFrame:
    """Put a key ``offset + 1, offset + 2, ...`` in front, in ``order_by`` order.

    ``size_of`` and ``stored`` are explained at :func:`dimsmith.operators.ordering.ordered`.
    """
    numbered = ordering.ordered(
        df, order_by, {name: ordering.row_number()}, ranges=ranges, size_of=size_of, stored=stored
    )
    return numbered.select((F.col(name) + F.lit(offset)).cast("long").alias(name), *df.columns)


def next_key(stored: DataFrame, key: str) -> DataFrame:
    """One row: the first key not yet given out."""
    return stored.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("long").alias("next_key"))


def continue_keys(
    new_rows: DataFrame,
    stored: DataFrame,
    key: str,
    order_by: Sequence[str],
    ranges: int | None = None,
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Number ``new_rows`` from the largest key of ``stored`` on. The maximum stays in the plan."""
    numbered = assign_surrogate_keys(new_rows, order_by, key, ranges=ranges, size_of=size_of)
    largest = stored.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    return numbered.withColumn(key, F.col(key) + largest)
