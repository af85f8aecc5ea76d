"""The carry-forward lookup against the join on the validity range."""

import datetime

import pytest
from pyspark.sql import functions as F

from dimsmith.operators.asof import carry_forward_lookup
from dimsmith.operators.joins import point_in_time_lookup
from tests.conftest import tuples

DAY0 = "1700-01-01"


def version_rows(spark, members, per_member, length):
    """Each member's versions last ``length`` days; member 0 has its last one closed."""
    ids = spark.range(members * per_member)
    member, place = (F.col("id") % members).alias("k"), F.floor(F.col("id") / members).cast("int")
    start = F.date_add(F.lit(DAY0).cast("date"), place * length)
    end = F.when((place == per_member - 1) & (F.col("id") % members > 0), F.lit("9999-12-31").cast("date")).otherwise(F.date_add(start, length - 1))
    return ids.select(member, (F.col("id") + 1).alias("dim_id"), start.alias("valid_from"), end.alias("valid_to"))


def facts_of(spark, rows, members, days):
    member = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % (members + 1))
    day = F.when(F.col("id") % 70 != 5, F.date_add(F.lit(DAY0).cast("date"), F.pmod(F.xxhash64("id"), F.lit(days)).cast("int") - 20))
    return spark.range(rows).select(F.col("id").alias("fact"), member.cast("long").alias("k"), day.alias("d"))


@pytest.mark.parametrize("ranges", [1, 6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_equals_the_range_join(spark, ranges, how):
    versions, facts = version_rows(spark, 7, 30, 10), facts_of(spark, 3000, 7, 340)
    got = tuples(carry_forward_lookup(facts, versions, "k", "d", ["dim_id"], how=how, ranges=ranges), "fact", "k", "d", "dim_id")
    want = tuples(point_in_time_lookup(facts, versions, "k", "d", ["dim_id"]), "fact", "k", "d", "dim_id")
    if how == "inner":
        assert got == want
    else:
        assert [r for r in got if r[3] is not None] == want and len(got) == 3000


def test_hot_member_with_a_hundred_thousand_versions(spark):
    versions = version_rows(spark, 1, 100_000, 1)
    facts = spark.range(60_000).select(F.lit(0).cast("long").alias("k"), (F.col("id") * 7 % 100_000).alias("wanted"))
    facts = facts.withColumn("d", F.date_add(F.lit(DAY0).cast("date"), F.col("wanted").cast("int")))
    out = carry_forward_lookup(facts, versions, "k", "d", ["dim_id"], ranges=8)
    assert out.where(F.col("dim_id") != F.col("wanted") + 1).count() == 0 and out.count() == 60_000
    # the only joins are with what ranges carry over, never of facts with versions
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "valid_from" not in plan and plan.count("Join") == 1


def test_repeated_facts_and_times_of_day(spark):
    versions = spark.createDataFrame([(1, 10, datetime.date(2020, 1, 1), datetime.date(2020, 1, 31))], "k long, dim_id long, valid_from date, valid_to date")
    at = datetime.datetime(2020, 1, 31, 23, 59)
    facts = spark.createDataFrame([(1, at), (1, at), (1, datetime.datetime(2020, 2, 1))], "k long, d timestamp_ntz")
    assert tuples(carry_forward_lookup(facts, versions, "k", "d", ["dim_id"], ranges=3)) == [(1, at, 10)] * 2
    assert carry_forward_lookup(facts.limit(0), versions, "k", "d", ["dim_id"]).count() == 0
