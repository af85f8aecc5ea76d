"""Registration of queries and the SQL text each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.sources.readers import Tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Results in types every SQL client reads alike: decimals as doubles, dates and timestamps as ISO text."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema])


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under ``name``, with its equivalent SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(build(Tables(spark, folder)))

        run.__name__, run.__doc__ = name, build.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql.strip()
        return build

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
