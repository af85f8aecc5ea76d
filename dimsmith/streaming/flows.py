"""Three flows: staging history, type 2 maintenance, weekly snapshot.

All run with ``availableNow`` by default: they take in what has arrived, then stop; a scheduler
may just as well keep them running.  Progress lives in the checkpoint folder of each flow.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dimsmith.operators.dedup import first_per_key
from dimsmith.sources.history import HistoryTable
from dimsmith.sources.sinks import VersionedTable


def arriving(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None, glob: str | None = None
) -> DataFrame:
    """Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def stage(arrivals: DataFrame, path: str, checkpoint: str, load_date: str) -> StreamingQuery:
    """Append every arriving file to the staging history, stamped; exactly once through the file sink."""
    return (
        arrivals.withColumn("load_date", F.lit(load_date))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("load_date")
        .trigger(availableNow=True)
        .start()
    )


def maintain_scd2(
    arrivals: DataFrame,
    table: HistoryTable,
    checkpoint: str,
    key: str,
    tracked: Sequence[str],
    effective: str,
    first: DataFrame,
) -> StreamingQuery:
    """Apply every micro-batch of snapshots to a type 2 dimension.

    ``effective`` names the arrival column with the date a row takes effect. A batch may hold any
    dates, those before a member's open version included, and takes the same jobs however many
    they are; of several rows of a member and date the one greatest by its values counts. Version 1
    of ``table`` is ``first``, batch N becomes version N + 2, so a batch that is run again after a
    failure either finds its version published or publishes the same rows.
    """
    if not table.versions():
        table.start(first, key)

    def apply(batch: DataFrame, batch_id: int) -> None:
        if batch_id + 2 in table.versions():
            return
        ties = [f"{c} desc" for c in batch.columns if c not in (key, effective)]
        once = first_per_key(batch, [key, effective], ties)
        table.apply_dated(once, key, tracked, effective, version=batch_id + 2)

    return arrivals.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()


def weekly_counts(events: DataFrame, event_time: str, by: Sequence[str], late: str = "7 days") -> DataFrame:
    """Events per Monday-to-Sunday week on a stream; rows later than ``late`` may be dropped.

    Weeks are windows of seven days shifted by four, as the epoch fell on a Thursday.  Event times
    are wall-clock timestamps without a zone; a watermark needs instants, so they are counted from
    the epoch as if in UTC, whatever zone the session is in.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(event_time))
    timed = events.withColumn("__at", F.timestamp_micros(micros)).withWatermark("__at", late)
    week = F.window("__at", "7 days", startTime="4 days")
    counts = timed.groupBy(week.alias("w"), *by).agg(F.count(F.lit(1)).alias("num_events"))
    epoch_day = F.floor(F.unix_seconds("w.start") / 86_400).cast("int")
    return counts.select(F.date_from_unix_date(epoch_day).alias("week_start"), *by, "num_events")


def write_weekly(counts: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Append finished weeks to a parquet folder (``append``), or publish all counts so far as the next version of a
    :class:`VersionedTable` at ``path`` (``complete``)."""
    writer = counts.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").option("path", path).start()

    def publish(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, path)
        if batch_id + 1 not in table.versions():
            table.write(batch, batch_id + 1)

    return writer.foreachBatch(publish).start()


def run(start: Callable[[], StreamingQuery]) -> None:
    """Run a flow until it has taken in everything that has arrived."""
    query = start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
