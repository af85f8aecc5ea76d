"""Summaries kept by changes must equal a rebuild; merged sketches must estimate within their error."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from dimsmith.operators.summaries import SummaryView, distinct_sketches, merged_distinct
from dimsmith.session import fresh_path
from tests.conftest import tuples

SCHEMA = "g string, v decimal(12,2), n long"


def test_random_changes_equal_a_rebuild(spark):
    dice = random.Random(3)
    new = lambda: (dice.choice(["a", "b", None]), dice.choice([None, Decimal(dice.randrange(1000)) / 4]), dice.randrange(9))
    rows = [new() for _ in range(30)]
    view = SummaryView(spark, fresh_path(spark, "summary"), ["g"], ["v", "n"])
    view.rebuild(spark.createDataFrame(rows, SCHEMA))
    for step in range(4):
        gone = dice.sample(range(len(rows)), 8) if step < 3 else [i for i, r in enumerate(rows) if r[0] == "b"]
        fresh = [new() for _ in range(6)] if step < 3 else []
        view.apply(spark.createDataFrame(fresh, SCHEMA), spark.createDataFrame([rows[i] for i in gone], SCHEMA))
        rows = [r for i, r in enumerate(rows) if i not in gone] + fresh
        again = SummaryView(spark, fresh_path(spark, "summary"), ["g"], ["v", "n"])
        again.rebuild(spark.createDataFrame(rows, SCHEMA))
        assert tuples(view.read()) == tuples(again.read())
    assert "b" not in {r.g for r in view.read().collect()}


def test_a_measure_without_values_is_null(spark):
    view = SummaryView(spark, fresh_path(spark, "summary"), ["g"], ["v"])
    view.apply(inserted=spark.createDataFrame([("a", Decimal(1), 1), ("a", None, 1)], SCHEMA))
    view.apply(deleted=spark.createDataFrame([("a", Decimal(1), 1)], SCHEMA))
    assert tuples(view.read()) == [("a", 1, None)]


def test_sketches_merge_upwards(spark):
    df = spark.range(60_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 20_011).alias("v"))
    stored = distinct_sketches(df, ["day"], "v")
    (total,) = [r.num_distinct for r in merged_distinct(stored, []).collect()]
    assert abs(total - 20_011) <= 4 * 0.0065 * 20_011
