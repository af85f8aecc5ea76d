"""Flows over files that arrive one after the other, restarts included."""

import datetime

import pytest
from pyspark.sql import functions as F

from dimsmith.operators.scd import VersionColumns, scd2_initial, scd2_upsert, scd2_violations
from dimsmith.session import fresh_path
from dimsmith.sources import paths, sinks
from dimsmith.sources.history import HistoryTable
from dimsmith.streaming import flows
from tests.conftest import tuples

COLUMNS = VersionColumns("dim_id")
SCHEMA = "k long, v string, as_of date"


def snapshot(spark, day, **values):
    rows = [(int(k[1:]), v, datetime.date.fromisoformat(day)) for k, v in values.items()]
    return spark.createDataFrame(rows, SCHEMA)


def test_staging_takes_each_file_once(spark):
    inbox, path, progress = (fresh_path(spark, n) for n in ("inbox", "staged", "progress"))
    df = spark.range(10)
    sinks.append(df, inbox)
    start = lambda: flows.stage(flows.arriving(spark, inbox, df.schema), path, progress, "2024-01-01")
    flows.run(start)
    flows.run(start)
    assert spark.read.parquet(path).count() == 10
    sinks.append(df, inbox)
    flows.run(start)
    assert spark.read.parquet(path).count() == 20


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_scd2_flow_equals_the_batch_upserts(spark, files_per_batch):
    inbox, progress = fresh_path(spark, "inbox"), fresh_path(spark, "progress")
    first = snapshot(spark, "2020-01-01", k1="a", k2="b")
    later = [snapshot(spark, "2020-02-01", k1="A", k2="b", k3="c"), snapshot(spark, "2020-03-01", k1="A", k2="B", k3="c")]
    start = scd2_initial(first.drop("as_of"), "k", COLUMNS, F.lit("2020-01-01"))
    table = HistoryTable(spark, fresh_path(spark, "dim"), COLUMNS)

    def flow():
        arrivals = flows.arriving(spark, inbox, first.schema, files_per_batch)
        return flows.maintain_scd2(arrivals, table, progress, "k", ["v"], "as_of", start)

    for batch in later:
        sinks.append(batch.coalesce(1), inbox)
        flows.run(flow)
    flows.run(flow)
    expected = start
    for batch, day in zip(later, ("2020-02-01", "2020-03-01")):
        expected = scd2_upsert(expected, batch.drop("as_of"), "k", ["v"], day, COLUMNS)
    assert tuples(table.read()) == tuples(expected)
    assert all(r.num_violations == 0 for r in scd2_violations(table.read(), "k", COLUMNS).collect())


def test_scd2_batch_run_again_publishes_nothing_new(spark):
    inbox = fresh_path(spark, "inbox")
    first = snapshot(spark, "2020-01-01", k1="a")
    sinks.append(snapshot(spark, "2020-02-01", k1="b"), inbox)
    table = HistoryTable(spark, fresh_path(spark, "dim"), COLUMNS)
    start = scd2_initial(first.drop("as_of"), "k", COLUMNS, F.lit("2020-01-01"))
    for _ in range(2):  # the second run has lost its progress and sees batch 0 again
        arrivals = flows.arriving(spark, inbox, first.schema)
        flows.run(lambda: flows.maintain_scd2(arrivals, table, fresh_path(spark, "progress"), "k", ["v"], "as_of", start))
    assert table.versions() == [1, 2]


def test_history_table_ignores_a_batch_that_died(spark):
    table = HistoryTable(spark, fresh_path(spark, "dim"), COLUMNS)
    table.start(scd2_initial(snapshot(spark, "2020-01-01", k1="a", k2="b").drop("as_of"), "k", COLUMNS, F.lit("2020-01-01")))
    before = tuples(table.read())
    table.open_rows().write.parquet(f"{table.path}/closed/version=2")  # the open part never followed
    assert tuples(table.read()) == before
    changed = snapshot(spark, "2020-02-01", k1="A").drop("as_of")
    assert table.apply([("2020-02-01", changed)], "k", ["v"], version=2)
    assert not table.apply([("2020-02-01", changed)], "k", ["v"], version=2)
    assert tuples(table.read(), "dim_id", "k", "v", "dim_active") == [(1, 1, "a", 0), (2, 2, "b", 1), (3, 1, "A", 1)]
    assert paths.child_names(spark, f"{table.path}/closed") == ["version=1", "version=2"]


def test_weekly_counts_drop_only_rows_later_than_allowed(spark):
    inbox, path, progress = (fresh_path(spark, n) for n in ("inbox", "weekly", "progress"))
    at = datetime.datetime.fromisoformat
    schema = "ts timestamp_ntz, kind string"
    lots = [
        [(at("2024-01-03 10:00:00"), "a"), (at("2024-01-07 23:59:59"), "a"), (at("2024-01-08 00:00:00"), "a")],
        [(at("2024-01-30 12:00:00"), "a")],
        [(at("2024-01-02 12:00:00"), "a"), (at("2024-01-29 12:00:00"), "a")],  # the first one is too late
        [(at("2024-03-01 12:00:00"), "a")],
    ]

    def flow():
        arrivals = flows.arriving(spark, inbox, spark.createDataFrame([], schema).schema)
        return flows.write_weekly(flows.weekly_counts(arrivals, "ts", ["kind"]), path, progress)

    for rows in lots:
        sinks.append(spark.createDataFrame(rows, schema).coalesce(1), inbox)
        flows.run(flow)
    got = tuples(spark.read.parquet(path), F.col("week_start").cast("string"), "num_events")
    assert got == [("2024-01-01", 2), ("2024-01-08", 1), ("2024-01-29", 2)]
