"""Storage of a type 2 dimension whose history is never rewritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.operators.scd import VersionColumns
from dimsmith.operators.timeline import numbered, splice
from dimsmith.session import settle
from dimsmith.sources import paths
from dimsmith.sources.sinks import VersionedTable


class HistoryTable:
    """A type 2 dimension in parts, so that a batch touches what it is about.

    * ``open``: the open versions, published anew with every batch
    * ``closed``: a folder for each batch with the versions it closed
    * ``replaced``: a folder for each batch with rows of the past: the surrogate keys of closed versions that
      it closed elsewhere or merged away
    * ``retired``: members that have closed versions only; known from the start, as a batch
      leaves them alone
    * ``state``: one row for each batch with the highest surrogate key given out

    A batch without rows of the past reads the open part alone, however long the histories have
    grown and however many dates it holds. Rows before a member's open version read the closed
    versions of such members. Batch N is visible once its open part is complete; other parts
    without it (left by a job that died) are not read, and are overwritten when the batch runs again.
    """

    def __init__(self, spark: SparkSession, path: str, columns: VersionColumns):
        self.spark, self.columns = spark, columns
        self.path = path.rstrip("/")
        self._open = VersionedTable(spark, f"{self.path}/open")

    def versions(self) -> list[int]:
        return self._open.versions()

    def start(self, dimension: DataFrame, key: str | None = None) -> None:
        """Store a whole dimension as version 1. ``key`` names the natural key, needed where members without an open version are stored."""
        c = self.columns
        is_open = F.col(c.active) == 1
        if key:
            members = dimension.groupBy(key).agg(F.max(is_open).alias("__open"))
            members.filter(~F.col("__open")).select(key).write.mode("overwrite").parquet(f"{self.path}/retired")
        self._write_state(1, dimension)
        dimension.filter(~is_open).write.mode("overwrite").parquet(f"{self.path}/closed/version=1")
        self._open.write(dimension.filter(is_open), 1)

    def read(self) -> DataFrame:
        return self.closed_rows().unionByName(self.open_rows())

    def open_rows(self) -> DataFrame:
        return self._open.read()

    def _folders(self, part: str) -> list[str]:
        published = {f"version={v}" for v in self.versions()}
        return [f"{self.path}/{part}/{n}" for n in paths.child_names(self.spark, f"{self.path}/{part}") if n in published]

    def closed_rows(self) -> DataFrame:
        schema = self.open_rows().schema
        folders = self._folders("closed")
        if not folders:
            return self.spark.createDataFrame([], schema)
        replaced = self._folders("replaced")
        if not replaced:
            return self.spark.read.schema(schema).parquet(*folders)
        # A batch replaces what earlier ones closed; what it closed itself stands.
        c = self.columns
        kind = schema[c.surrogate].dataType.simpleString()
        rows = self.spark.read.schema(schema).parquet(*folders).withColumn("__batch", _batch_number())
        gone = self.spark.read.schema(f"__gone {kind}").parquet(*replaced).withColumn("__by", _batch_number())
        gone = gone.groupBy("__gone").agg(F.max("__by").alias("__by"))
        return rows.join(gone, (F.col(c.surrogate) == F.col("__gone")) & (F.col("__batch") < F.col("__by")), "left_anti").select(*schema.names)

    def highest_key(self) -> int:
        """The highest surrogate key given out so far, merged ones included."""
        folders = self._folders("state")
        if len(folders) < len(self.versions()):  # written before the state was kept
            rows = self.closed_rows().select(self.columns.surrogate).unionByName(self.open_rows().select(self.columns.surrogate))
            return rows.agg(F.coalesce(F.max(self.columns.surrogate), F.lit(0)).cast("long")).first()[0]
        return self.spark.read.schema("highest long").parquet(*folders).agg(F.coalesce(F.max("highest"), F.lit(0))).first()[0]

    def _retired(self, key: str) -> DataFrame | None:
        if paths.exists(self.spark, f"{self.path}/retired/_SUCCESS"):
            return self.spark.read.parquet(f"{self.path}/retired").select(F.col(key).alias("__key"))
        return None

    def apply(
        self, snapshots: Sequence[tuple[str, DataFrame]], key: str, tracked: Sequence[str], version: int | None = None
    ) -> bool:
        """Apply snapshots, given with their effective dates, as one version.

        Snapshots whose dates ascend are one batch of arrivals; one that is not later than the one
        before starts another. Returns False, and does nothing, when ``version`` is already published.
        """
        lots: list[list[tuple[str, DataFrame]]] = []
        for date, members in snapshots:
            if lots and lots[-1][-1][0] < date:
                lots[-1].append((date, members))
            else:
                lots.append([(date, members)])
        dated = []
        for lot in lots:
            frames = [members.withColumn("__effective", F.lit(date).cast("date")) for date, members in lot]
            arrivals = frames[0]
            for more in frames[1:]:
                arrivals = arrivals.unionByName(more)
            dated.append(arrivals)
        return self._publish(dated, key, tracked, "__effective", version)

    def apply_dated(self, arrivals: DataFrame, key: str, tracked: Sequence[str], effective: str, version: int | None = None) -> bool:
        """Apply a batch of rows that each take effect on their own date ``effective``, as one version.

        ``arrivals`` holds at most one row per member and date. The jobs are the same however many
        dates there are; see :func:`dimsmith.operators.timeline.scd2_splice` for what a row does.
        """
        return self._publish([arrivals], key, tracked, effective, version)

    def _publish(self, lots: list[DataFrame], key: str, tracked: Sequence[str], effective: str, version: int | None) -> bool:
        version = (self._open.current() or 0) + 1 if version is None else version
        if version in self.versions():
            return False
        c = self.columns
        open_now, highest = self.open_rows(), self.highest_key()
        added: DataFrame | None = None
        replaced: DataFrame | None = None
        for arrivals in lots:
            arrivals = settle(self._living(arrivals, key))
            touched = arrivals.groupBy(F.col(key).alias("__key")).agg(F.min(F.col(effective).cast("date")).alias("__first"))
            concerned = open_now.join(touched, F.col(key) == F.col("__key"), "inner")
            late = settle(concerned.filter(F.col("__first") < F.col(c.valid_from)).select("__key"))
            concerned = concerned.select(*open_now.columns)
            if not late.isEmpty():
                past = self.closed_rows() if added is None else self._still_closed(self.closed_rows(), replaced, c.surrogate).unionByName(added)
                past = settle(past.join(late, F.col(key) == F.col("__key"), "left_semi"))
                concerned = concerned.unionByName(past)
                gone = past.select(F.col(c.surrogate).alias("__gone"))
                added = None if added is None else self._still_closed(added, gone, c.surrogate)
                replaced = gone if replaced is None else replaced.unionByName(gone)
            known = self.spark.createDataFrame([(highest,)], f"`{c.surrogate}` long")
            out = settle(splice(concerned, arrivals, key, tracked, effective, c))
            out = settle(numbered(out, known, key, c).select(*open_now.columns))
            highest = out.agg(F.greatest(F.lit(highest), F.coalesce(F.max(c.surrogate), F.lit(0)).cast("long"))).first()[0]
            ended = out.filter(F.col(c.active) != 1)
            added = ended if added is None else added.unionByName(ended)
            others = open_now.join(touched, F.col(key) == F.col("__key"), "left_anti")
            open_now = settle(others.unionByName(out.filter(F.col(c.active) == 1))) if len(lots) > 1 else others.unionByName(out.filter(F.col(c.active) == 1))
        if replaced is not None:
            replaced.distinct().write.mode("overwrite").parquet(f"{self.path}/replaced/version={version}")
        else:
            paths.drop_folder(self.spark, f"{self.path}/replaced/version={version}")  # of an attempt that died
        if added is not None:
            added.write.mode("overwrite").parquet(f"{self.path}/closed/version={version}")
        self._write_state(version, highest)
        self._open.write(open_now, version)
        return True

    def _living(self, arrivals: DataFrame, key: str) -> DataFrame:
        """The arrivals without those of retired members."""
        retired = self._retired(key)
        return arrivals if retired is None else arrivals.join(retired, F.col(key) == F.col("__key"), "left_anti")

    @staticmethod
    def _still_closed(rows: DataFrame, gone: DataFrame | None, surrogate: str) -> DataFrame:
        return rows if gone is None else rows.join(gone, F.col(surrogate) == F.col("__gone"), "left_anti")

    def _write_state(self, version: int, rows: DataFrame | int) -> None:
        """The highest key of ``rows``, or the number itself."""
        if isinstance(rows, int):
            state = self.spark.createDataFrame([(rows,)], "highest long")
        else:
            state = rows.agg(F.coalesce(F.max(self.columns.surrogate), F.lit(0)).cast("long").alias("highest"))
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/state/version={version}")


def _batch_number():
    return F.regexp_extract(F.col("_metadata.file_path"), r"/version=(\d+)/[^/]*$", 1).cast("int")
