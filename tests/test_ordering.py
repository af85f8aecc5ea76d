"""Numbers, ranks and running totals cut into ranges must equal the plain window."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.operators import ordering
from dimsmith.operators.keys import assign_surrogate_keys, continue_keys, next_key
from tests.conftest import tuples


@pytest.fixture(scope="module")
def rows(spark):
    """Group 'hot' holds a third of the rows; NULLs occur as group and as order value."""
    dice = random.Random(5)
    data = []
    for i in range(900):
        group = "hot" if i % 3 == 0 else dice.choice([None, "a", "b", "c", "d"])
        day = None if i % 40 == 1 else datetime.date(2000, 1, 1) + datetime.timedelta(days=dice.randrange(60))
        data.append((i, group, day, dice.choice([None, "x", "y", "zé"]), dice.randrange(100) / 4))
    return spark.createDataFrame(data, "id int, g string, d date, s string, v double").repartition(7)


ORDERS = [["d", "id"], ["d desc", "id desc"], ["s desc", "d", "id"], ["v", "s", "id desc"]]


@pytest.mark.parametrize("order", ORDERS)
@pytest.mark.parametrize("by", [[], ["g"], ["g", "s"]])
def test_row_number_and_running_sum(rows, order, by):
    measures = {"n": ordering.row_number(), "total": ordering.running_sum("v")}
    plain = ordering.ordered(rows, order, measures, by, ranges=1)
    cut = ordering.ordered(rows, order, measures, by, ranges=9)
    assert tuples(cut, "id", "n", "total") == tuples(plain, "id", "n", "total")


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_with_ties(rows, by):
    measures = {"r": ordering.rank(), "dr": ordering.dense_rank(["d desc"])}
    plain = ordering.ordered(rows, ["d desc"], measures, by, ranges=1)
    cut = ordering.ordered(rows, ["d desc"], measures, by, ranges=6)
    assert tuples(cut, "id", "r", "dr") == tuples(plain, "id", "r", "dr")


def test_plain_path_is_the_spark_window(rows):
    window = Window.partitionBy("g").orderBy("d", "id")
    expected = rows.withColumn("n", F.row_number().over(window))
    got = ordering.ordered(rows, ["d", "id"], {"n": ordering.row_number()}, ["g"])
    assert tuples(got, "id", "n") == tuples(expected, "id", "n")


@pytest.mark.parametrize("is_null", [lambda i: i < 6, lambda i: i > 5, lambda i: i % 5 < 3])
def test_running_sum_of_nulls(spark, is_null):
    df = spark.createDataFrame([(i, None if is_null(i) else i) for i in range(24)], "id int, v int")
    measures = {"total": ordering.running_sum("v")}
    assert tuples(ordering.ordered(df, ["id"], measures, ranges=4)) == tuples(ordering.ordered(df, ["id"], measures, ranges=1))


@pytest.mark.parametrize("ranges", [None, 5])
def test_rank_with_heavy_ties(rows, ranges):
    values = rows.withColumn("k", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 11))
    got = ordering.rank_with_heavy_ties(values, "k", ["g"], ranges=ranges)
    window = Window.partitionBy("g").orderBy(F.desc("k"))
    expected = values.select("id", F.rank().over(window).alias("r"), F.dense_rank().over(window).alias("dr"))
    assert tuples(got, "id", "value_rank", "value_dense_rank") == tuples(expected)


def test_same_values_everywhere(spark):
    df = spark.range(50).select("id", F.lit("same").alias("k"))
    cut = ordering.ordered(df, ["k"], {"r": ordering.rank()}, ranges=8)
    assert {r.r for r in cut.collect()} == {1}


def test_empty_input(spark):
    df = spark.createDataFrame([], "k long")
    assert ordering.ordered(df, ["k"], {"n": ordering.row_number()}, ranges=4).count() == 0
    assert assign_surrogate_keys(df, ["k"], "dim_id").count() == 0


def test_no_range_holds_most_of_a_hot_group(spark):
    """The cuts split one group that holds everything into even ranges."""
    df = spark.range(20_000).select(F.lit("hot").alias("g"), "id")
    keys = [ordering.OrderTerm("g"), ordering.OrderTerm("id")]
    sizes = ordering.in_ranges(df, keys, 10).groupBy(ordering.RANGE).count().collect()
    assert len(sizes) == 10
    assert max(r["count"] for r in sizes) < 20_000 / 10 * 2


@pytest.mark.parametrize("by", [[], ["g"]])
def test_number_of_ranges_changes_nothing(rows, by):
    measures = {"n": ordering.row_number(), "total": ordering.running_sum("v"), "seen": ordering.last_known("s", ["d", "id"])}
    one, four, many = (ordering.ordered(rows, ["d", "id"], measures, by, ranges=k) for k in (1, 4, 5000))
    assert one.dtypes == four.dtypes == many.dtypes
    assert tuples(one, "id", *measures) == tuples(four, "id", *measures) == tuples(many, "id", *measures)


def test_bad_direction():
    with pytest.raises(ValueError):
        ordering.OrderTerm.parse("a upwards")


def test_surrogate_keys_continue(spark):
    stored = spark.createDataFrame([(1, 10), (2, 20)], "dim_id long, k long")
    new = spark.createDataFrame([(50,), (30,), (40,)], "k long")
    assert next_key(stored, "dim_id").collect()[0].next_key == 3
    assert tuples(continue_keys(new, stored, "dim_id", ["k"]), "k", "dim_id") == [(30, 3), (40, 4), (50, 5)]
    empty = stored.filter("false")
    assert next_key(empty, "dim_id").collect()[0].next_key == 1
    assert tuples(continue_keys(new, empty, "dim_id", ["k"], ranges=2), "k", "dim_id") == [(30, 1), (40, 2), (50, 3)]


def test_types_do_not_depend_on_the_ranges(rows):
    measures = {"n": ordering.row_number(), "r": ordering.rank(), "dr": ordering.dense_rank(["d", "id"]), "total": ordering.running_sum("a"), "ids": ordering.running_sum("id")}
    amounts = rows.withColumn("a", F.col("v").cast("decimal(18,2)"))
    plain, cut = (ordering.ordered(amounts, ["d", "id"], measures, ranges=k) for k in (1, 4))
    assert plain.dtypes == cut.dtypes and plain.dtypes[-5:-1] == [("n", "bigint"), ("r", "bigint"), ("dr", "bigint"), ("total", "decimal(28,2)")]
    assert tuples(plain, "id", *measures) == tuples(cut, "id", *measures)
