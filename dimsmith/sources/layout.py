"""Partitioned table layouts and the questions to ask before choosing one.

Every writer passes a REBALANCE hint: rows of one partition value are brought together to
avoid many small files, but adaptive execution splits a value that holds too much data over
several tasks, so one hot value never becomes one long-running writer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.sources import paths

DEFAULT_PARTITION = "other"


def _write(df: DataFrame, path: str, column: str, mode: str) -> None:
    df.hint("rebalance", F.col(column)).write.mode(mode).partitionBy(column).parquet(path)


def write_by_year(
    df: DataFrame, path: str, date_column: str, years: Sequence[int] | None = None, mode: str = "overwrite"
) -> None:
    """Range layout: one folder per whole calendar year; years outside ``years`` share a default folder."""
    year = F.year(date_column)
    label = year.cast("string")
    if years is not None:
        label = F.when(year.isin(list(years)), label)
    _write(df.withColumn("part_year", F.coalesce(label, F.lit(DEFAULT_PARTITION))), path, "part_year", mode)


def write_by_list(
    df: DataFrame, path: str, column: str, values: Sequence[str], mode: str = "overwrite"
) -> None:
    """List layout: one folder per listed value and a default folder for all others."""
    label = F.when(F.col(column).isin(list(values)), F.col(column)).otherwise(F.lit(DEFAULT_PARTITION))
    _write(df.withColumn("part_value", label), path, "part_value", mode)


def hash_bucket(key: str | Column, buckets: int) -> Column:
    """Bucket number of a key. Hash the real key: two members never share it by accident."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_by_hash(df: DataFrame, path: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    _write(df.withColumn("part_bucket", hash_bucket(key, buckets)), path, "part_bucket", mode)


def write_bucketed_table(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalogue table bucketed and sorted by ``key``: joins and groupings on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def read_partition(spark: SparkSession, path: str, column: str, value: object) -> DataFrame:
    """One partition of a table; the filter prunes all other folders before any file is opened."""
    return read_all(spark, path, column).filter(F.col(column) == F.lit(str(value)))


def read_all(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The whole table; partition values stay the text they were written as (``01`` is not 1)."""
    guessed = spark.read.option("basePath", path).parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == column else f for f in guessed]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(path)


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> bool:
    """Bulk delete: remove one partition folder instead of rewriting the rows that stay."""
    return paths.drop_folder(spark, f"{path.rstrip('/')}/{column}={value}")


def data_spread(df: DataFrame, key: str | Column, name: str = "key_value") -> DataFrame:
    """Rows per value of a partition-key candidate, its share, and its size relative to the mean.

    ``skew`` far above 1 means the candidate would give one oversized partition.
    """
    column = F.col(key) if isinstance(key, str) else key
    counts = df.groupBy(column.alias(name)).agg(F.count(F.lit(1)).alias("num_rows"))
    total = counts.agg(F.sum("num_rows").alias("n"), F.count(F.lit(1)).alias("k"))
    rows, values = total.select("n").scalar(), total.select("k").scalar()
    return counts.select(
        name,
        "num_rows",
        (F.col("num_rows") / rows).alias("share"),
        (F.col("num_rows") * values / rows).alias("skew"),
    )
