"""The worked type 2 example, its further cases, and types 1 and 3."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import scd
from dimsmith.operators.dedup import latest_per_key
from dimsmith.session import fresh_path, settle
from dimsmith.sources.history import HistoryTable
from tests.conftest import tuples

COLUMNS = scd.VersionColumns("key", "start", "end", "active")
OPEN = datetime.date(9999, 12, 31)
D = datetime.date(2020, 3, 1)
BEFORE = datetime.date(2020, 2, 29)


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture(scope="module")
def stored(spark):
    rows = [
        (1, 4001, "Ann", "Hill Road 1", day("2014-01-01"), OPEN, 1),
        (2, 4002, "Sue", "Lake View 9", day("2015-03-23"), day("2018-11-17"), 0),
        (3, 4002, "Sue", "Park Lane 4", day("2018-11-18"), OPEN, 1),
        (4, 4003, "Will", "Sharp Way 7", day("2018-12-07"), OPEN, 1),
    ]
    return spark.createDataFrame(rows, "key long, number long, name string, address string, start date, end date, active int")


@pytest.fixture(scope="module")
def incoming(spark):
    rows = [
        (4001, "Ann", "Derry Court 45"),
        (4004, "Lisa", "Mason Road 6"),
        (4002, "Sue", "Park Lane 4"),
        (4003, "Will", "Sharp Way 7"),
    ]
    return spark.createDataFrame(rows, "number long, name string, address string")


def upsert(stored, incoming, date="2020-03-01", **kwargs):
    return scd.scd2_upsert(stored, incoming, "number", ["name", "address"], date, COLUMNS, **kwargs)


def violations(dim):
    return {r.rule_name: r.num_violations for r in scd.scd2_violations(dim, "number", COLUMNS).collect()}


@pytest.mark.parametrize("ranges", [None, 2])
def test_worked_example(stored, incoming, ranges):
    result = upsert(stored, incoming, ranges=ranges)
    assert result.columns == stored.columns
    assert tuples(result, "key", "number", "address", "start", "end", "active") == [
        (1, 4001, "Hill Road 1", day("2014-01-01"), BEFORE, 0),
        (2, 4002, "Lake View 9", day("2015-03-23"), day("2018-11-17"), 0),
        (3, 4002, "Park Lane 4", day("2018-11-18"), OPEN, 1),
        (4, 4003, "Sharp Way 7", day("2018-12-07"), OPEN, 1),
        (5, 4001, "Derry Court 45", D, OPEN, 1),
        (6, 4004, "Mason Road 6", D, OPEN, 1),
    ]
    assert set(violations(result).values()) == {0}


def test_same_batch_twice_changes_nothing(stored, incoming):
    once = upsert(stored, incoming)
    assert tuples(upsert(once, incoming)) == tuples(once)


def test_blank_and_null(spark, stored):
    base = stored.withColumn("address", F.when(F.col("key") == 1, None).when(F.col("key") == 4, "").otherwise(F.col("address")))
    batch = spark.createDataFrame([(4001, "Ann", ""), (4003, "Will", None), (4002, "Sue", None)], "number long, name string, address string")
    result = upsert(base, batch)
    assert [r.number for r in result.filter("key > 4").collect()] == [4002]


def test_missing_member_stays_open(stored, incoming):
    result = upsert(stored, incoming.filter("number = 4004"))
    assert result.filter("active = 1").count() == 4


def test_closed_only_member(spark, stored):
    closed = stored.withColumn("active", F.when(F.col("number") == 4003, 0).otherwise(F.col("active")))
    batch = spark.createDataFrame([(4003, "Will", "Sharp Way 7")], "number long, name string, address string")
    assert tuples(upsert(closed, batch)) == tuples(closed)
    again = upsert(closed, batch, reactivate=True)
    assert tuples(again.filter("key = 5"), "number", "start", "active") == [(4003, D, 1)]


def test_latest_load_wins(spark, stored):
    loads = spark.createDataFrame(
        [(4001, "Ann", "old", "2020-01-01"), (4001, "Ann", "new", "2020-02-01"), (4001, "Ann", "older", "2019-01-01")],
        "number long, name string, address string, load_date string",
    )
    batch = latest_per_key(loads, ["number"], "load_date").drop("load_date")
    assert [r.address for r in upsert(stored, batch).filter("key = 5").collect()] == ["new"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_against_a_plain_model(spark, seed):
    """Five batches over forty members, applied row by row in Python as well."""
    dice = random.Random(seed)
    table = HistoryTable(spark, fresh_path(spark, "random"), COLUMNS)
    empty = spark.createDataFrame([], "key long, number long, name string, address string, start date, end date, active int")
    table.start(empty)
    model, by_upsert = [], empty
    for month in range(1, 6):
        date = datetime.date(2020, month, 1)
        arriving = {n: (dice.choice("xy"), dice.choice(["p", "q", "", None])) for n in dice.sample(range(40), 25)}
        batch = spark.createDataFrame([(n, *v) for n, v in arriving.items()], "number long, name string, address string")
        next_key = len(model) + 1
        for number in sorted(arriving):
            name, address = arriving[number]
            current = next((v for v in model if v[1] == number and v[6] == 1), None)
            if current and (current[2], current[3] or "") == (name, address or ""):
                continue
            if current:
                current[5], current[6] = date - datetime.timedelta(days=1), 0
            model.append([next_key, number, name, address, date, OPEN, 1])
            next_key += 1
        table.apply([(date.isoformat(), batch)], "number", ["name", "address"])
        by_upsert = settle(upsert(by_upsert, batch, date.isoformat(), ranges=1 if month % 2 else 3))
    expected = sorted((tuple(v) for v in model), key=repr)
    assert tuples(table.read()) == expected
    assert tuples(by_upsert) == expected
    assert set(violations(table.read()).values()) == {0}


def test_violations_are_found(spark):
    rows = [
        (1, 7, "a", "x", day("2000-01-01"), OPEN, 1),
        (1, 7, "a", "x", day("2001-01-01"), OPEN, 1),
        (2, 8, "a", "x", day("2001-01-01"), day("2000-01-01"), 0),
        (3, 9, "a", "x", day("2001-01-01"), day("2002-01-01"), 1),
    ]
    dim = spark.createDataFrame(rows, "key long, number long, name string, address string, start date, end date, active int")
    assert violations(dim) == {
        "repeated_surrogate_key": 1,
        "several_open_versions": 1,
        "open_flag_and_end_disagree": 1,
        "start_after_end": 1,
        "overlapping_versions": 1,
    }


def test_initial_load(spark):
    members = spark.createDataFrame([(30, "c"), (10, "a"), (20, "b")], "number long, name string")
    dim = scd.scd2_initial(members, "number", COLUMNS, F.lit("2001-01-01"))
    assert tuples(dim) == [
        (1, 10, "a", day("2001-01-01"), OPEN, 1),
        (2, 20, "b", day("2001-01-01"), OPEN, 1),
        (3, 30, "c", day("2001-01-01"), OPEN, 1),
    ]


def test_type_1(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, v string, kept string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert tuples(scd.scd1_upsert(stored, batch, "k")) == sorted(
        [(1, "a", "x"), (2, "B", "y"), (3, "C", None)], key=repr
    )


def test_type_3(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", "b0"), (3, "c", "c0"), (4, None, None)], "k long, v string, previous_v string")
    batch = spark.createDataFrame([(1, "A"), (2, "b"), (4, "D"), (5, "E")], "k long, v string")
    assert tuples(scd.scd3_upsert(stored, batch, "k", "v")) == [
        (1, "A", "a"),
        (2, "b", "b0"),
        (3, "c", "c0"),
        (4, "D", None),
        (5, "E", None),
    ]


def test_change_on_the_day_a_version_started(stored, incoming):
    """The version of that day takes the new values and keeps its key; the batch again changes nothing."""
    first = upsert(stored, incoming)
    second = incoming.withColumn("address", F.when(F.col("number") == 4001, "Elm Row 2").otherwise(F.col("address")))
    result = upsert(first, second)
    expected = [(r[0], r[1], r[2], "Elm Row 2" if r[0] == 5 else r[3], *r[4:]) for r in tuples(first, *stored.columns)]
    assert tuples(result, *stored.columns) == sorted(expected)
    assert set(violations(result).values()) == {0}
    assert tuples(upsert(result, second)) == tuples(result)


def test_batch_before_the_open_version_is_refused(stored, incoming):
    with pytest.raises(Exception, match="open version of number 4001"):
        upsert(stored, incoming, date="2013-06-01").collect()
    late = scd.scd2_back_dated(stored, incoming, "number", ["name", "address"], "2013-06-01", COLUMNS)
    assert tuples(late, "number") == [(4001,)]


def test_history_table_on_one_day(spark, stored, incoming):
    """Two snapshots of one day, as one version and as two, equal the upsert."""
    second = incoming.withColumn("address", F.lit("Elm Row 2"))
    want = tuples(upsert(upsert(stored, incoming), second), *stored.columns)
    for lots in ([[incoming, second]], [[incoming], [second]]):
        table = HistoryTable(spark, fresh_path(spark, "one-day"), COLUMNS)
        table.start(stored)
        for lot in lots:
            table.apply([("2020-03-01", members) for members in lot], "number", ["name", "address"])
        assert tuples(table.read(), *stored.columns) == want
