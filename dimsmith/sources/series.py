"""Generated series: numbers, days and minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def numbers(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """Integers ``first..last``, both included, generated in parallel."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def days(spark: SparkSession, first: str, count: int, name: str = "day") -> DataFrame:
    return spark.range(count).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias(name))


def days_spanned(df: DataFrame, column: str, name: str = "day") -> DataFrame:
    """Every day from the earliest to the latest value of ``column``, gaps included.

    One aggregate row is exploded, so the result has as many rows as the span has days.
    """
    day = F.to_date(column)
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo is not null")
    return span.select(F.explode(F.sequence("lo", "hi")).alias(name))


def minutes_of_day(spark: SparkSession, name: str = "minute") -> DataFrame:
    return spark.range(24 * 60).select(F.col("id").cast("int").alias(name))
