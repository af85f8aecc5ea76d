"""Writers: append, overwrite, versioned tables, staging history, materialized views, text."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimsmith.functions.compare import any_changed
from dimsmith.sources import layout, paths


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the contents of ``path``. Never hand in a frame that reads ``path`` itself;
    use :class:`VersionedTable` for a table that is rebuilt from its own last state."""
    df.write.mode("overwrite").parquet(path)


def create_table_as(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """A catalogue table from a query; ``path`` keeps its files in a folder of the caller's choice."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def jdbc_write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, truncate: bool = False, batch_rows: int = 1000
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "truncate": str(truncate).lower(),
        **(properties or {}),
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **kwargs) -> None:
    """``mode='overwrite', truncate=True`` empties the table and keeps its definition."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **kwargs)).save()


def text_rows(df: DataFrame) -> DataFrame:
    """Every column as text, blanks trimmed from both sides, as the text output writes it; bytes as ``\\x`` and hex."""
    as_text = {
        f.name: F.concat(F.lit("\\x"), F.lower(F.hex(f.name))) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast("string")
        for f in df.schema
    }
    return df.select(*[F.trim(text).alias(name) for name, text in as_text.items()])


def write_text(df: DataFrame, path: str, separator: str = "\t", null_text: str = "") -> None:
    r"""Delimited text without a header, one line a row.

    Backslashes, line ends and separators inside values are written as a database dump has them
    (``\\``, ``\n``, ``\t``), so that :func:`readers.read_dump` reads them back. With ``null_text``
    ``\N`` NULL and empty text stay apart.
    """

    def escaped(text: Column) -> Column:
        marks = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", separator: "\\t" if separator == "\t" else f"\\{separator}"}
        for plain, written in marks.items():
            text = F.replace(text, F.lit(plain), F.lit(written))
        return F.coalesce(text, F.lit(null_text))

    rows = text_rows(df)
    rows.select(F.concat_ws(separator, *[escaped(F.col(c)) for c in rows.columns]).alias("value")).write.mode("overwrite").text(path)


class VersionedTable:
    """A table whose every state is a folder ``version=N``; readers see the last complete one.

    A new state may be computed from the current one, because the current folder is never
    written to.  A version counts once its ``_SUCCESS`` marker exists, so a job that died
    half way leaves no visible trace and can simply run again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        names = [n for n in paths.child_names(self.spark, self.path) if n.startswith("version=")]
        done = [n for n in names if paths.exists(self.spark, f"{self.path}/{n}/_SUCCESS")]
        return sorted(int(n.split("=", 1)[1]) for n in done)

    def current(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no complete version below {self.path}")
        return self.spark.read.parquet(f"{self.path}/version={version}")

    def _claim(self, version: int) -> bool:
        return paths.claim(self.spark, f"{self.path}/_claims/version={version}")

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Publish ``df`` as the next version that no other writer has claimed, or as ``version`` (overwriting a broken attempt).

        A state computed from the current one belongs in :meth:`update`.
        """
        if version is None:
            version = (self.current() or 0) + 1
            while not self._claim(version):
                version += 1
        elif version in self.versions():
            raise FileExistsError(f"version {version} of {self.path} is already published")
        df.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        return version

    def update(self, build: Callable[[DataFrame | None], DataFrame], patience: float = 600.0) -> int:
        """Publish what ``build`` makes of the current state (None at first), and never lose another writer's state.

        A writer claims the number after the state it read. Who finds it claimed waits for that
        version and starts again from it. A claim without a version after ``patience`` seconds counts as that of
        a writer that died, and its number is passed over.
        """
        dead: set[int] = set()
        while True:
            base = self.current()
            version = next(v for v in itertools.count((base or 0) + 1) if v not in dead)
            if self._claim(version):
                if self.current() != base:
                    dead.add(version)  # claimed too late; the number stays empty
                    continue
                build(None if base is None else self.read(base)).write.mode("overwrite").parquet(f"{self.path}/version={version}")
                return version
            waited = time.monotonic()
            while self.current() == base and time.monotonic() - waited < patience:
                time.sleep(0.2)
            if self.current() == base:
                dead.add(version)

    def prune(self, keep: int = 2) -> list[int]:
        """Drop all but the last ``keep`` versions and return what was dropped."""
        if keep < 1:
            raise ValueError("keep at least one version")
        dropped = self.versions()[:-keep]
        for version in dropped:
            paths.drop_folder(self.spark, f"{self.path}/version={version}")
        return dropped


class MaterializedView:
    """A stored query result that changes only on :meth:`refresh`."""

    def __init__(self, spark: SparkSession, path: str, build: Callable[[], DataFrame]):
        self._table, self._build = VersionedTable(spark, path), build

    def refresh(self) -> int:
        return self._table.write(self._build())

    def read(self) -> DataFrame:
        return self._table.read()


class StagingTable:
    """Append-only load history: each load adds the whole snapshot, stamped with its load time.

    Loads are partition folders, so picking one or dropping one touches no other data.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def load(self, snapshot: DataFrame, load_date: str) -> None:
        """Add one load. Loading the same ``load_date`` again replaces that load."""
        writer = stamped(snapshot, load_date).write.mode("overwrite").partitionBy("load_date")
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def read(self) -> DataFrame:
        """All loads; load times stay the text they were given as."""
        return layout.read_all(self.spark, self.path, "load_date")


def stamped(snapshot: DataFrame, load_date: str, column: str = "load_date") -> DataFrame:
    """The snapshot with its load time; the time is a parameter, so a re-run repeats it."""
    return snapshot.withColumn(column, F.lit(load_date))


def change_set(base: DataFrame, key: str, updates: DataFrame, inserts: DataFrame | None = None) -> DataFrame:
    """``base`` with the non-NULL values of ``updates`` put in by key, plus ``inserts``.

    ``updates`` carries the key and any of the other columns, one row per key.
    """
    touched = [c for c in updates.columns if c != key]
    fresh = updates.select(key, *[F.col(c).alias(f"__new_{c}") for c in touched])
    joined = base.join(fresh, key, "left")
    merged = joined.select(
        *[F.coalesce(f"__new_{c}", c).alias(c) if c in touched else F.col(c) for c in base.columns]
    )
    return merged if inserts is None else merged.unionByName(inserts.select(*base.columns))


def stamp_changes(
    old: DataFrame, new: DataFrame, key: str, tracked: list[str], changed_at: str, column: str = "last_update"
) -> DataFrame:
    """``new`` with ``column`` set to ``changed_at`` on rows that are new or differ from ``old``.

    Unchanged rows keep the stamp they had.
    """
    pair = new.alias("n").join(old.alias("o"), F.col(f"n.{key}") == F.col(f"o.{key}"), "left")
    touched = F.col(f"o.{key}").isNull() | any_changed("o", "n", tracked, new.schema)
    kind = old.schema[column].dataType
    stamp = F.when(touched, F.lit(changed_at).cast(kind)).otherwise(F.col(f"o.{column}"))
    keep = [F.col(f"n.{c}") for c in new.columns if c != column]
    return pair.select(*keep, stamp.alias(column))
