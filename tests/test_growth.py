"""What a task holds and what moves does not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import hierarchy, joins, ordering, stock
from dimsmith.plans import facts, standin
from tests.conftest import tuples


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_repeats_neither_side_on_the_way(spark):
    left, right = spark.range(300).withColumnRenamed("id", "a"), spark.range(70).withColumnRenamed("id", "b")
    every = joins.product(left, right, block_rows=8)
    assert "CartesianProduct" in plan(every) and every.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
    assert every.count() == every.distinct().count() == 300 * 70


def test_product_makes_more_tasks_of_more_values(spark, monkeypatch):
    """A task's part of the result is bounded, however many values there are."""
    left, right = spark.range(600).withColumnRenamed("id", "a"), spark.range(900).withColumnRenamed("id", "b")
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 2_000, raising=False)
    every = joins.product(left, right, block_rows=8)
    made = [r["n"] for r in every.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(made) == every.distinct().count() == 600 * 900
    # 38 rows in a tile, and one block of 8 more or less
    assert max(made) <= 3_000


def test_contracted_chain_moves_fewer_links_than_doubling(spark, monkeypatch):
    written = []

    def counted(df, own=hierarchy.settle):
        kept = own(df)
        written.append(kept.count())
        return kept

    monkeypatch.setattr(hierarchy, "settle", counted)
    monkeypatch.setattr(hierarchy, "DOUBLED", 40)
    edges = spark.range(600).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("before"))
    assert tuples(hierarchy.descend(edges, "id", "before"), "member", "level", "root") == sorted(((i, i, 0) for i in range(600)), key=repr)
    # doubling writes nearly all 600 in each of ten rounds
    assert sum(written) < 600 * 10


def test_contraction_of_trees_rings_and_missing_parents(spark, monkeypatch):
    up = {i: i // 3 if i > 4 else None for i in range(200)}
    up |= {1000 + i: 1000 + (i + 1) % 10 + i // 10 * 10 for i in range(60)} | {2000 + i: 1000 + i for i in range(60)} | {3000 + i: 9000 + i for i in range(60)}

    def walked(member):
        level = 0
        while up[member] is not None:
            member, level = up[member], level + 1
        return level, member

    monkeypatch.setattr(hierarchy, "DOUBLED", 5)
    edges = spark.createDataFrame(list(up.items()), "id long, above int")
    want = sorted(((m, *walked(m)) for m in up if m < 200), key=repr)
    assert tuples(hierarchy.descend(edges, "id", "above"), "member", "level", "root") == want


def test_unrooted_sends_no_table_through_the_driver(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 9), (5, None)], "id long, above long")
    found = hierarchy.unrooted(edges, "id", "above")
    assert "Broadcast" not in plan(found)
    assert tuples(found) == [(1, True), (2, True), (3, False), (4, False)]


@pytest.mark.parametrize("rows_per_range", [3, 500_000])
def test_stock_of_many_items_is_spread_by_rows(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", rows_per_range)
    inventory = spark.createDataFrame([(i, i % 3, 1) for i in range(30)], "inventory_id long, film_id int, store_id int")
    rental = spark.createDataFrame([(i, None if i % 2 else "2005-01-01") for i in range(20)] * 2 + [(None, None)], "inventory_id long, return_date string")
    counts = stock.stock_counts(inventory, rental)
    assert tuples(counts) == [(0, 1, 7, 3), (1, 1, 6, 4), (2, 1, 7, 3)]
    spread = ordering.spread(rental, ["inventory_id"])
    assert ("REPARTITION_BY_NUM" in plan(spread)) == (rows_per_range == 3)


def test_lines_move_without_text_and_supplier_keys(spark):
    class Tables:
        lineitem = spark.sql("SELECT 1L l_orderkey, 2 l_linenumber, 3L l_partkey, 4L l_suppkey, timestamp_ntz'1995-01-01' l_shipdate, 'F' l_linestatus, 10.5D l_extendedprice, 0.1D l_discount")
        orders = spark.sql("SELECT 1L o_orderkey, 5L o_custkey, timestamp_ntz'1994-01-01' o_orderdate")

    key = lambda name, value: spark.createDataFrame([(value, 10 * value)], f"{name}_id long, {name}_dim_id long")
    dims = facts.Dimensions(key("customer", 5), key("staff", 4), key("film", 3), key("store", 4))
    lines = standin.rental_lines(Tables, amount_as_text=True, dims=dims)
    assert tuples(lines, "amount", "inventory_id", "customer_dim_id", "staff_dim_id", "film_dim_id", "store_dim_id") == [("$9.45", "3-4", 50, 40, 30, 40)]
    optimized = lines._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("$") < optimized.index("Join")
