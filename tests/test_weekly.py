"""The weekly ledger: nothing is lost, a week is closed once, batches run again change nothing."""

import datetime

from pyspark.sql import functions as F

from dimsmith.session import fresh_path
from dimsmith.sources import sinks
from dimsmith.streaming import flows
from dimsmith.streaming.weekly import WeeklyLedger, keep_weekly
from tests.conftest import tuples

AT = datetime.datetime.fromisoformat
SCHEMA = "ts timestamp_ntz, kind string, n int"
LOTS = [
    [("2024-01-03 10:00:00", "a"), ("2024-01-07 23:59:59", "a"), ("2024-01-08 00:00:00", "b")],
    [("2024-01-30 12:00:00", "a")],
    [("2024-01-02 12:00:00", "a"), ("2024-01-29 12:00:00", "a"), (None, "a")],  # the first and the last are late
    [],
    [("2024-03-01 12:00:00", None), ("2024-01-21 00:00:00", "b")],  # the second is late
]


def frame(spark, rows):
    return spark.createDataFrame([(t and AT(t), k, i) for i, (t, k) in enumerate(rows)], SCHEMA)


def ledger_of(spark, path=None):
    return WeeklyLedger(spark, path or fresh_path(spark, "ledger"), frame(spark, []).schema, "ts", ["kind"], datetime.timedelta(days=7))


def shown(df):
    return tuples(df, F.col("week_start").cast("string"), "kind", "num_events")


def test_on_time_and_late_rows_are_all_rows(spark):
    ledger = ledger_of(spark)
    for batch_id, rows in enumerate(LOTS):
        assert ledger.apply(frame(spark, rows), batch_id)
    assert shown(ledger.weeks()) == sorted([("2024-01-01", "a", 2), ("2024-01-08", "b", 1), ("2024-01-29", "a", 2)], key=repr)
    assert shown(ledger.open_weeks()) == [("2024-02-26", None, 1)]
    assert tuples(ledger.late(), F.col("ts").cast("string"), "kind") == sorted([("2024-01-02 12:00:00", "a"), (None, "a"), ("2024-01-21 00:00:00", "b")], key=repr)
    assert ledger.flush() == 1 and ledger.flush() == 0
    assert sum(r.num_events for r in ledger.weeks().collect()) + ledger.late().count() == sum(map(len, LOTS))
    assert ledger.apply(frame(spark, [("2024-02-27 00:00:00", "a"), ("2024-03-04 00:00:00", "a")]), 9)  # one week is closed, one is not
    assert ledger.late().count() == 4 and shown(ledger.open_weeks()) == [("2024-03-04", "a", 1)]


def test_a_batch_counts_once(spark):
    ledger = ledger_of(spark)
    assert ledger.apply(frame(spark, LOTS[0]), 0) and ledger.apply(frame(spark, LOTS[1]), 1)
    before = shown(ledger.weeks()), shown(ledger.open_weeks())
    assert not ledger.apply(frame(spark, LOTS[1]), 1)
    again = ledger_of(spark, ledger.path)  # another process
    assert not again.apply(frame(spark, LOTS[0]), 0)
    frame(spark, LOTS[2]).write.parquet(f"{ledger.path}/late/version=3")  # of a batch that died
    assert (shown(again.weeks()), shown(again.open_weeks())) == before and again.late().count() == 0
    again.flush()
    assert again.late().count() == 0


def test_flow_over_files_with_restarts(spark):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    path = fresh_path(spark, "ledger")
    for rows in LOTS:
        if rows:
            sinks.append(frame(spark, rows).coalesce(1), inbox)
        flows.run(lambda: keep_weekly(flows.arriving(spark, inbox, frame(spark, []).schema), ledger_of(spark, path), progress))
    ledger = ledger_of(spark, path)
    assert len(shown(ledger.weeks())) == 3 and ledger.late().count() == 3
