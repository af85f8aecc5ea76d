"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimsmith.operators.ordering import OrderTerm


def first_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of every key in ``order_by`` order.

    Spark limits each key to one row inside every input task before the shuffle, so a key that
    holds a large part of the rows sends one row per task, not all of them.
    """
    return top_per_group(df, key, order_by, 1)


def latest_per_key(df: DataFrame, key: Sequence[str], load_date: str, ties: Sequence[str] = ()) -> DataFrame:
    """The most recently loaded row of every key."""
    return first_per_key(df, key, [f"{load_date} desc", *ties])


def top_per_group(df: DataFrame, group: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of every group, limited before and after the shuffle."""
    window = Window.partitionBy(*group).orderBy(*[OrderTerm.parse(t).sort() for t in order_by])
    return df.withColumn("__place", F.row_number().over(window)).filter(F.col("__place") <= n).drop("__place")
