"""Weekly counts of a stream that loses no row: weeks are closed once, late rows get a table of their own.

A batch is summed to (week, kind) inside its tasks before anything is shuffled or kept, so the
state is one row for each open week and kind, however many events there are; a stateful operator
over the rows themselves would send the running week's events through a few tasks. The state is a
table of versions, like everything the flow publishes, and a version counts once its open part is
complete: a batch that runs again after a failure writes the same folders or finds its work done.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dimsmith.session import settle
from dimsmith.sources import paths
from dimsmith.sources.sinks import VersionedTable


class WeeklyLedger:
    """Events per Monday-to-Sunday week and kind, from batches of events in any order.

    The mark is the latest event time of all batches so far, less ``patience``. A batch first counts its rows:
    those of weeks that ended by the mark of the batches before are late, and go whole to the
    late table; the others count. Then the mark moves on, and weeks that ended by it are closed:
    published once, and never changed. Rows without an event time are of no week, and late.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, event_time: str, by: Sequence[str], patience: datetime.timedelta):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.event_time, self.by, self.patience = event_time, list(by), patience
        self._open = VersionedTable(spark, f"{self.path}/open")

    def _week(self) -> Column:
        return F.date_trunc("week", F.col(self.event_time)).cast("date").alias("week_start")

    def _ended(self, week: str | Column, mark: datetime.datetime | None) -> Column:
        """Whether a week ended by the mark; NULL weeks did not."""
        if mark is None:
            return F.lit(False)
        last = (mark - datetime.timedelta(days=7)).date()
        return F.coalesce((F.col(week) if isinstance(week, str) else week) <= F.lit(last), F.lit(False))

    def _state(self) -> tuple[datetime.datetime | None, int]:
        version = self._open.current()
        if version is None:
            return None, -1
        row = self.spark.read.parquet(f"{self.path}/mark/version={version}").first()
        return row["mark"], row["batch"]

    def _published(self, part: str, schema: T.StructType) -> DataFrame:
        done = {f"version={v}" for v in self._open.versions()}
        folders = [f"{self.path}/{part}/{n}" for n in paths.child_names(self.spark, f"{self.path}/{part}") if n in done]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _counted(self) -> T.StructType:
        fields = [T.StructField("week_start", T.DateType()), *[self.schema[c] for c in self.by], T.StructField("num_events", T.LongType())]
        return T.StructType(fields)

    def weeks(self) -> DataFrame:
        """(week_start, kinds, num_events) of the closed weeks."""
        return self._published("closed", self._counted())

    def open_weeks(self) -> DataFrame:
        """The same of the weeks that still take rows."""
        return self._open.read() if self._open.current() else self.spark.createDataFrame([], self._counted())

    def late(self) -> DataFrame:
        """The rows that came after their week was closed, whole."""
        return self._published("late", self.schema)

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Take in one batch; False, and nothing done, if it has been taken in before."""
        mark, last = self._state()
        if batch_id <= last:
            return False
        counts = batch.groupBy(self._week(), *self.by).agg(F.count(F.lit(1)).alias("num_events"), F.max(self.event_time).alias("__latest"))
        counts = settle(counts)
        latest = counts.agg(F.max("__latest")).first()[0]
        late = F.col("week_start").isNull() | self._ended("week_start", mark)
        dropped = batch.select(*self.schema.names).where(F.col(self.event_time).isNull() | self._ended(self._week(), mark))
        ahead = mark if latest is None else max(x for x in (mark, latest - self.patience) if x is not None)
        self._publish(counts.where(~late).select(*self._counted().names), dropped, ahead, batch_id)
        return True

    def flush(self) -> int:
        """Close the weeks still open, as at the end of a stream; the number of rows published."""
        _, last = self._state()
        rows = self.open_weeks()
        final = rows.agg(F.max("week_start"), F.count(F.lit(1))).first()
        if not final[1]:
            return 0
        end = datetime.datetime.combine(final[0], datetime.time()) + datetime.timedelta(days=7)
        self._publish(rows.limit(0), None, end, last)
        return final[1]

    def _publish(self, counts: DataFrame, late: DataFrame | None, mark: datetime.datetime | None, batch_id: int) -> None:
        version = (self._open.current() or 0) + 1
        both = settle(self.open_weeks().unionByName(counts).groupBy("week_start", *self.by).agg(F.sum("num_events").alias("num_events")))
        done = self._ended("week_start", mark)
        both.where(done).write.mode("overwrite").parquet(f"{self.path}/closed/version={version}")
        if late is None:
            paths.drop_folder(self.spark, f"{self.path}/late/version={version}")  # of an attempt that died
        else:
            late.write.mode("overwrite").parquet(f"{self.path}/late/version={version}")
        row = self.spark.createDataFrame([(mark, batch_id)], "mark timestamp_ntz, batch long")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/mark/version={version}")
        self._open.write(both.where(~done), version)


def keep_weekly(arrivals: DataFrame, ledger: WeeklyLedger, checkpoint: str) -> StreamingQuery:
    """Take every micro-batch of events into the ledger."""
    return arrivals.writeStream.foreachBatch(lambda batch, batch_id: ledger.apply(batch, batch_id) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
