"""Batches of any dates against a plain model, in one piece and cut into ranges."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import ordering, scd, timeline
from dimsmith.session import fresh_path, settle
from dimsmith.sources import paths
from dimsmith.sources.history import HistoryTable
from tests.conftest import tuples

COLUMNS = scd.VersionColumns("key", "start", "end", "active")
SCHEMA = "key long, number long, name string, address string, start date, end date, active int"
BATCH = "number long, name string, address string, since date"
OPEN = datetime.date(9999, 12, 31)
TRACKED = ["name", "address"]


def day(text):
    return datetime.date.fromisoformat(text)


def row(key, number, address, start, end=None, active=None):
    return (key, number, "n", address, day(start), day(end) if end else OPEN, int(end is None) if active is None else active)


def violations(dim):
    return {r.rule_name: r.num_violations for r in scd.scd2_violations(dim, "number", COLUMNS).collect()}


def spliced(spark, stored, batch, **kwargs):
    return timeline.scd2_splice(spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(batch, BATCH), "number", TRACKED, "since", COLUMNS, **kwargs)


#: Address and date of one row for a member with versions a (January), c (March) and d (May on), and what becomes of them;
#: 0 stands for a new key.
CASES = [
    ("b", "2020-02-10", [(1, "a", "2020-01-01", "2020-02-09"), (0, "b", "2020-02-10", "2020-02-29"), (2, "c", "2020-03-01", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("a", "2020-02-10", [(1, "a", "2020-01-01", "2020-02-29"), (2, "c", "2020-03-01", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("c", "2020-02-10", [(1, "a", "2020-01-01", "2020-02-09"), (2, "c", "2020-02-10", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("b", "2019-06-01", [(0, "b", "2019-06-01", "2019-12-31"), (1, "a", "2020-01-01", "2020-02-29"), (2, "c", "2020-03-01", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("x", "2020-03-01", [(1, "a", "2020-01-01", "2020-02-29"), (2, "x", "2020-03-01", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("a", "2020-03-01", [(1, "a", "2020-01-01", "2020-04-30"), (3, "d", "2020-05-01", None)]),
    ("d", "2020-03-01", [(1, "a", "2020-01-01", "2020-02-29"), (2, "d", "2020-03-01", None)]),
    ("e", "2020-06-01", [(1, "a", "2020-01-01", "2020-02-29"), (2, "c", "2020-03-01", "2020-04-30"), (3, "d", "2020-05-01", "2020-05-31"), (0, "e", "2020-06-01", None)]),
]


@pytest.mark.parametrize("ranges", [None, 3])
def test_one_row_among_three_versions(spark, ranges):
    stored, batch, want = [], [], []
    for n, (address, since, expected) in enumerate(CASES):
        base = 10 * n
        stored += [row(base + 1, n, "a", "2020-01-01", "2020-02-29"), row(base + 2, n, "c", "2020-03-01", "2020-04-30"), row(base + 3, n, "d", "2020-05-01")]
        batch.append((n, "n", address, day(since)))
        want += [(base + k if k else None, n, a, day(s), day(e) if e else OPEN) for k, a, s, e in expected]
    fresh = iter(range(74, 80))
    new = {(n, s): next(fresh) for s, n in sorted((w[3], w[1]) for w in want if w[0] is None)}
    want = [(w[0] or new[w[1], w[3]], *w[1:]) for w in want]
    out = settle(spliced(spark, stored, batch, ranges=ranges))
    assert tuples(out, "key", "number", "address", "start", "end") == sorted(want, key=repr)
    assert set(violations(out).values()) == {0}


def test_gaps_closed_members_and_others(spark):
    stored = [row(1, 7, "a", "2020-01-01", "2020-01-31"), row(2, 7, "b", "2020-03-01"), row(3, 8, "a", "2020-01-01", "2020-05-05"), row(4, 9, "z", "2020-01-01")]
    batch = [(7, "n", "c", day("2020-01-10")), (8, "n", "q", day("2020-02-02")), (10, "n", "new", day("2020-02-02"))]
    got = tuples(spliced(spark, stored, batch), "key", "number", "address", "start", "end")
    # the days of member 7 that no version covered stay so; member 8 has no open version
    assert got == [
        (1, 7, "a", day("2020-01-01"), day("2020-01-09")),
        (2, 7, "b", day("2020-03-01"), OPEN),
        (3, 8, "a", day("2020-01-01"), day("2020-05-05")),
        (4, 9, "z", day("2020-01-01"), OPEN),
        (5, 7, "c", day("2020-01-10"), day("2020-01-31")),
        (6, 10, "new", day("2020-02-02"), OPEN),
    ]
    inside = tuples(spliced(spark, stored, [(7, "n", "c", day("2020-02-10"))]).filter("number = 7"), "key", "address", "start", "end")
    assert inside == [(1, "a", day("2020-01-01"), day("2020-01-31")), (2, "b", day("2020-03-01"), OPEN), (5, "c", day("2020-02-10"), day("2020-02-29"))]


def same(point, values):
    return point is not None and [x or "" for x in point["values"]] == [x or "" for x in values]


class Model:
    """Points of each member in plain Python."""

    def __init__(self):
        self.members, self.next_key = {}, 1

    def apply(self, batch):
        fresh = []
        for number in {r[0] for r in batch}:
            points = {p["start"]: p for p in self.members.get(number, [])}
            for n, name, address, since in batch:
                if n == number and not same(points.get(since), (name, address)):
                    points[since] = {"start": since, "values": (name, address), "key": points.get(since, {}).get("key")}
            runs = []
            for _, point in sorted(points.items()):
                if runs and same(runs[-1][0], point["values"]):
                    runs[-1].append(point)
                else:
                    runs.append([point])
            kept = []
            for run in runs:
                one = next((p for p in run if p["key"]), run[0])
                kept.append({"start": run[0]["start"], "values": one["values"], "key": one["key"]})
            self.members[number] = kept
            fresh += [(p["start"], number, p) for p in kept if not p["key"]]
        for _, _, point in sorted(fresh, key=lambda f: f[:2]):
            point["key"] = self.next_key
            self.next_key = self.next_key + 1

    def rows(self):
        out = []
        for number, points in self.members.items():
            for point, following in zip(points, [*points[1:], None]):
                end = following["start"] - datetime.timedelta(days=1) if following else OPEN
                out.append((point["key"], number, *point["values"], point["start"], end, int(following is None)))
        return sorted(out, key=repr)


def random_batch(dice, dates):
    picked = {}
    for _ in range(60):
        picked[dice.randrange(25), dice.choice(dates)] = (dice.choice("xy"), dice.choice(["p", "q", "", None]))
    return [(n, *v, d) for (n, d), v in picked.items()]


@pytest.mark.parametrize("seed, ranges", [(1, None), (3, 4)])
def test_random_dates_in_any_order(spark, seed, ranges):
    dice, model = random.Random(seed), Model()
    dates = [datetime.date(2020, 1, 1) + datetime.timedelta(days=dice.randrange(90)) for _ in range(30)]
    stored = spark.createDataFrame([], SCHEMA)
    for _ in range(3):
        batch = random_batch(dice, dates)
        model.apply(batch)
        stored = settle(timeline.scd2_splice(stored, spark.createDataFrame(batch, BATCH), "number", TRACKED, "since", COLUMNS, ranges=ranges))
        highest = max(r.key for r in stored.collect())
        model.next_key = highest + 1  # merged keys at the end are given out again by both
        assert tuples(stored) == model.rows()
    assert set(violations(stored).values()) == {0}
    again = timeline.scd2_splice(stored, spark.createDataFrame(batch, BATCH), "number", TRACKED, "since", COLUMNS)
    assert tuples(again) == tuples(stored)


def test_dates_of_one_batch_equal_batches_in_order(spark):
    dice = random.Random(9)
    start = spark.createDataFrame([row(i + 1, i, "p", "2020-01-01") for i in range(25)], SCHEMA)
    dates = [datetime.date(2020, m, 1) for m in range(2, 7)]
    batch = [r for r in random_batch(dice, dates)]
    whole = timeline.scd2_splice(start, spark.createDataFrame(batch, BATCH), "number", TRACKED, "since", COLUMNS)
    one_by_one = start
    for date in dates:
        lot = spark.createDataFrame([r[:3] for r in batch if r[3] == date], "number long, name string, address string")
        one_by_one = settle(scd.scd2_upsert(one_by_one, lot, "number", TRACKED, date.isoformat(), COLUMNS))
    assert tuples(whole) == tuples(one_by_one)


def test_merged_keys(spark):
    before = spark.createDataFrame([row(1, 7, "a", "2020-01-01", "2020-02-29"), row(2, 7, "c", "2020-03-01", "2020-04-30"), row(3, 7, "d", "2020-05-01")], SCHEMA)
    after = settle(spliced(spark, [tuple(r) for r in before.collect()], [(7, "n", "a", day("2020-03-01"))]))
    assert tuples(timeline.merged_keys(before, after, "number", COLUMNS)) == [(2, 1)]


@pytest.mark.parametrize("ranges", [1, 7])
def test_previous_rows(spark, ranges):
    df = spark.range(200).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"), F.col("id").alias("at"), (F.col("id") * 2).alias("v"))
    got = {(r.g, r.at): r.before for r in ordering.with_previous(df, ["at"], {"before": "v"}, ["g"], ranges).collect()}
    for g in ("hot", None):
        ats = sorted(a for gg, a in got if gg == g)
        assert [got[g, a] for a in ats] == [None, *(2 * a for a in ats[:-1])]


def table_of(spark, rows):
    table = HistoryTable(spark, fresh_path(spark, "timeline"), COLUMNS)
    table.start(spark.createDataFrame(rows, SCHEMA), "number")
    return table


def test_history_table_equals_the_splice(spark):
    """Batches with rows of the past, one after the other; closed versions that moved are read once."""
    dice = random.Random(5)
    dates = [datetime.date(2020, 1, 1) + datetime.timedelta(days=dice.randrange(60)) for _ in range(15)]
    stored = [row(i + 1, i, "p", "2020-01-10") for i in range(10)] + [row(11, 30, "p", "2020-01-01", "2020-01-20")]
    table, whole = table_of(spark, stored), spark.createDataFrame(stored, SCHEMA)
    for _ in range(3):
        batch = spark.createDataFrame([*random_batch(dice, dates), (30, "x", "p", dates[0])], BATCH)
        whole = settle(timeline.scd2_splice(whole, batch, "number", TRACKED, "since", COLUMNS))
        assert table.apply_dated(batch, "number", TRACKED, "since")
        named = lambda df: tuples(df, *[c for c in whole.columns if c != "key"])
        assert named(table.read()) == named(whole)
        assert set(violations(table.read()).values()) == {0}
    keys = [r.key for r in table.read().collect()]
    assert len(keys) == len(set(keys)) and max(keys) <= table.highest_key()


def test_batch_without_past_rows_reads_no_history(spark):
    table = table_of(spark, [row(1, 7, "a", "2020-01-01", "2020-01-31"), row(2, 7, "b", "2020-02-01"), row(3, 8, "a", "2020-01-01")])
    paths.drop_folder(spark, f"{table.path}/closed/version=1")  # reading it would lose the version
    dates = [day("2020-03-01"), day("2020-04-01"), day("2020-05-01")]
    batch = spark.createDataFrame([(7, "n", "abc"[i], d) for i, d in enumerate(dates)], BATCH)
    table.apply_dated(batch, "number", TRACKED, "since")
    assert tuples(table.read(), "key", "number", "address", "start") == [
        (2, 7, "b", day("2020-02-01")), (3, 8, "a", day("2020-01-01")), (4, 7, "a", dates[0]), (5, 7, "b", dates[1]), (6, 7, "c", dates[2]),
    ]


def test_jobs_of_a_batch_do_not_depend_on_its_dates(spark):
    def jobs(count):
        table = table_of(spark, [row(1, 7, "a", "2020-01-01")])
        batch = spark.createDataFrame([(7, "n", f"v{i}", datetime.date(2021, 1, 1) + datetime.timedelta(days=i)) for i in range(count)], BATCH)
        group = f"jobs-{count}"
        spark.sparkContext.setJobGroup(group, group)
        table.apply_dated(batch, "number", TRACKED, "since")
        spark.sparkContext.setJobGroup("", "")
        assert table.read().count() == count + 1
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(2) == jobs(40)


def test_a_batch_that_died_leaves_nothing(spark):
    table = table_of(spark, [row(1, 7, "a", "2020-01-01", "2020-01-31"), row(2, 7, "b", "2020-02-01")])
    before = tuples(table.read())
    table.open_rows().select(F.col("key").alias("__gone")).write.parquet(f"{table.path}/replaced/version=2")
    table.read().write.parquet(f"{table.path}/closed/version=2")
    assert tuples(table.read()) == before
    table.apply_dated(spark.createDataFrame([(7, "n", "c", day("2020-03-01"))], BATCH), "number", TRACKED, "since")
    assert tuples(table.read(), "key", "address", "end") == [(1, "a", day("2020-01-31")), (2, "b", day("2020-02-29")), (3, "c", OPEN)]
