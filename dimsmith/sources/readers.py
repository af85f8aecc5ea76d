"""Table scans: parquet folders, JDBC, CSV, tab-separated database dumps, rows in memory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.functions.text import text_array

TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


class Tables:
    """The tables of one folder, opened when first asked for: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = load_table(self.spark, self.folder, name)
        return self._opened[name]

    def register_views(self, names: Sequence[str] = TABLE_NAMES) -> None:
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    split_on: str | None = None,
    lower: object = None,
    upper: object = None,
    splits: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan. Credentials come from the caller's ``properties``.

    With ``split_on`` the scan runs as ``splits`` range queries in parallel; without it the
    whole table arrives over one connection in one task.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetch_rows), **(properties or {})}
    options.update({"dbtable": table} if table else {"query": query})
    if split_on is not None:
        if query is not None:
            raise ValueError("a split scan needs a table; wrap the query as '(...) AS t'")
        if lower is None or upper is None or not splits:
            raise ValueError("a split scan needs lower, upper and splits")
        options.update(
            partitionColumn=split_on, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(splits)
        )
    return options


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV file with a header line. Without ``schema`` every column is text."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header line and guessed types. Costs one more pass than a schema."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    r"""A tab-separated database dump: ``\N`` is NULL, ``\t``, ``\n``, ``\\`` and the like are decoded,
    octal and hexadecimal bytes (``\101``, ``\x41``) too, and a line ``\.`` ends the data of its file.

    Empty text stays empty text. In a table of one column an empty line is a row with empty text,
    up to the end mark; in others empty lines are no rows. A line with fewer fields than ``schema``
    fails the job.
    """
    lines = spark.read.text(path)
    if len(schema) == 1:
        lines = _before_end_mark(lines)
    else:
        lines = lines.filter((F.col("value") != "\\.") & (F.col("value") != ""))
    fields = lines.select(F.split("value", "\t", -1).alias("f"))
    texts = fields.select(*[_unescaped(F.element_at("f", i + 1)).alias(x.name) for i, x in enumerate(schema)])
    return texts.select(*[_from_text(x) for x in schema])


def _before_end_mark(lines: DataFrame) -> DataFrame:
    """The lines of each file up to its end mark, by their places in the file."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))
    # One row per file at most.
    marks = placed.filter(F.col("value") == "\\.").groupBy(F.col("file").alias("its")).agg(F.min("place").alias("end"))
    joined = placed.join(F.broadcast(marks), F.col("file") == F.col("its"), "left")
    return joined.filter(F.col("end").isNull() | (F.col("place") < F.col("end"))).select("value")


#: What stands after a backslash for a control character in a dump; any other character stands for itself.
ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
#: A byte as one or two hexadecimal digits, or as one to three octal ones.
BYTE = r"\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}"


def _unescaped(field: Column) -> Column:
    def characters(part: Column) -> Column:
        for letter, character in ESCAPES.items():
            part = F.replace(part, F.lit(f"\\{letter}"), F.lit(character))
        return F.replace(part, F.lit("\\"), F.lit(""))

    def one_byte(found: Column) -> Column:
        octal = F.hex(F.conv(F.substring(found, F.lit(2), F.length(found)), 8, 10).cast("int") % 256)
        digits = F.when(F.substring(found, 2, 1) == "x", F.substring(found, F.lit(3), F.length(found))).otherwise(octal)
        return F.lpad(digits, 2, "0")

    def decoded(part: Column) -> Column:
        # Bytes may be parts of one character, so they meet as bytes.
        texts = F.transform(F.split(part, BYTE, -1), lambda x: F.hex(F.encode(characters(x), "UTF-8")))
        found = F.transform(F.regexp_extract_all(part, F.lit(BYTE), F.lit(0)), one_byte)
        pairs = F.transform(F.arrays_zip(texts.alias("t"), found.alias("b")), lambda x: F.concat(x["t"], F.coalesce(x["b"], F.lit(""))))
        return F.when(part.rlike(BYTE), F.decode(F.unhex(F.array_join(pairs, "")), "UTF-8")).otherwise(characters(part))

    # What lies between pairs of backslashes has single ones only.
    plain = F.array_join(F.transform(F.split(field, r"\\\\", -1), decoded), "\\")
    return F.when(field == "\\N", None).when(field.contains("\\"), plain).otherwise(field)


def _from_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.ArrayType):
        return text_array(field.name).cast(field.dataType).alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.unhex(F.regexp_replace(field.name, r"^\\x", "")).alias(field.name)
    return F.col(field.name).cast(field.dataType).alias(field.name)


def in_memory(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str | Sequence[str]) -> DataFrame:
    """Rows given in the program, with a schema or with column names only."""
    return spark.createDataFrame(list(rows), schema if isinstance(schema, (str, T.StructType)) else list(schema))
