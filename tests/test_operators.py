"""Joins, lookups, measures, quality, hierarchy on small hand-made rows."""

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import joins, measures, quality
from dimsmith.operators.dedup import top_per_group
from dimsmith.operators.hierarchy import descend, unrooted
from tests.conftest import tuples


@pytest.fixture(scope="module")
def facts(spark):
    """Key 1 holds most rows, and some rows have no key; many are exact copies."""
    rows = [(1, "a")] * 60 + [(k, "b") for k in range(2, 12)] + [(None, "n")] * 5
    return spark.createDataFrame(rows, "k int, v string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(k, f"name{k}") for k in range(1, 9)] + [(99, "unused")], "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(facts, dim, how):
    assert tuples(joins.salted_join(facts, dim, ["k"], how, share=0.2, salts=4)) == tuples(facts.join(dim, "k", how))


def test_salted_join_keeps_duplicates_of_both_sides(facts, dim):
    twice = dim.unionByName(dim)
    assert joins.salted_join(facts, twice, ["k"], share=0.1, salts=3).count() == facts.join(twice, "k").count()


def test_salts_spread_exact_copies(spark):
    """Copies that come from several input tasks get several salts."""
    copies = spark.range(0, 800, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    other = spark.createDataFrame([(1, "x")], "k int, w string").repartition(2)
    plan = joins.salted_join(copies, other, ["k"], share=0.5, salts=8)
    assert plan.count() == 800
    salts = copies.select(F.pmod(F.xxhash64("k", "v") + F.spark_partition_id(), F.lit(8)).alias("s")).distinct()
    assert salts.count() == 8


def test_salted_join_refuses_full(facts, dim):
    with pytest.raises(ValueError):
        joins.salted_join(facts, dim, ["k"], "full")


def test_hot_keys(facts):
    assert tuples(joins.hot_keys(facts, ["k"], 0.2)) == [(1,)]


def test_adaptive_execution_splits_a_hot_key(spark):
    """The plain lookup join needs no hint: a hot partition is split while the query runs."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
        dim = spark.range(60_000).select(F.col("id").alias("natural"), (F.col("id") + 1).alias("dim_id"))
        found = joins.lookup(rows, dim, {"k": "natural"}, "dim_id")
        found.write.format("noop").mode("overwrite").save()
        kept = found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(kept) == 60_000
    assert "SortMergeJoin(skew=true)" in plan


def test_lookup(spark, facts):
    dim = spark.createDataFrame(
        [(5, 1, 1), (6, 1, 1), (7, 2, 0), (8, 3, 1)], "dim_id long, natural int, dim_active int"
    )
    active = F.col("dim_active") == 1
    for salts in (None, 4):
        found = joins.lookup(facts, dim, {"k": "natural"}, "dim_id", active, hot_key_salts=salts)
        assert tuples(found.groupBy("k", "dim_id").count()) == [(1, 5, 60), (3, 8, 1)]
    kept = joins.lookup(facts, dim, {"k": "natural"}, "dim_id", active, keep_misses=True)
    assert kept.count() == facts.count()
    rejects = joins.lookup_rejects(facts, dim, {"k": "natural"}, active)
    assert rejects.count() == facts.count() - 61
    assert rejects.filter("k is null").count() == 5


def test_lookup_on_descriptive_columns(spark):
    facts = spark.createDataFrame([(1, "a@x", 5), (1, None, 6)], "id int, email string, v int")
    dim = spark.createDataFrame([(9, 1, "a@x")], "dim_id long, cid int, mail string")
    assert tuples(joins.lookup(facts, dim, {"id": "cid", "email": "mail"}, "dim_id")) == [(1, "a@x", 5, 9)]


@pytest.mark.parametrize("sliced", [False, True])
def test_point_in_time(spark, sliced):
    day = datetime.date.fromisoformat
    dim = spark.createDataFrame(
        [(1, 7, day("2000-01-01"), day("2001-06-30")), (2, 7, day("2001-07-01"), day("9999-12-31")), (3, 8, day("2001-01-01"), day("9999-12-31"))],
        "dim_id long, cust int, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame(
        [(1, 7, day("1999-12-31")), (2, 7, day("2001-06-30")), (3, 7, day("2001-07-01")), (4, 8, day("2005-01-01"))],
        "id int, cust int, at date",
    )
    joined = joins.point_in_time_lookup(facts, dim, "cust", "at", ["dim_id"], slice_by_year=sliced)
    assert tuples(joined, "id", "dim_id") == [(2, 1), (3, 2), (4, 3)]


def test_product_with_list(spark, dim):
    values = spark.createDataFrame([("x", 1), ("y", 2)], "a string, b int")
    assert joins.product_with_list(dim, values).count() == 18
    with pytest.raises(Exception, match="more than 1 rows"):
        joins.product_with_list(dim, values, max_values=1).collect()


def test_join_sizes_equal_the_join(spark):
    left = spark.createDataFrame([(i, i % 3, i % 2) for i in range(30)], "id int, a int, b int")
    right = spark.createDataFrame([(i % 3, i % 2) for i in range(20)] + [(None, 1)], "a int, b int")
    for on in (["a"], ["a", "b"]):
        real = left.join(right, on)
        size = joins.join_sizes(left, right, on, "id").collect()[0]
        fan_out = real.groupBy("id").count().agg(F.max("count")).collect()[0][0]
        assert tuple(size) == (real.count(), real.select("id").distinct().count(), fan_out)


@pytest.mark.parametrize("values", [[], [1, 2], [1, None]])
def test_not_in_follows_sql(spark, values):
    df = spark.createDataFrame([(1,), (3,), (None,)], "k int")
    listed = spark.createDataFrame([(v,) for v in values], "v int")
    expected = spark.sql("SELECT * FROM {df} WHERE k NOT IN (SELECT v FROM {listed})", df=df, listed=listed)
    assert tuples(joins.not_in(df, "k", listed, "v")) == tuples(expected)


def test_top_per_group_limits_before_the_shuffle(spark, facts):
    top = top_per_group(facts, ["k"], ["v", "k"], 2)
    assert tuples(top.groupBy("k").count().filter("k = 1")) == [(1, 2)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ratio_and_share(spark):
    df = spark.createDataFrame([("a", 1, 4), ("a", 3, 4), ("b", 1, 0)], "g string, n int, d int")
    assert tuples(measures.ratio(df, ["g"], F.col("n"), F.col("d"), "r"), "g", "r") == [("a", 0.5), ("b", None)]
    assert tuples(measures.share_of_total(df, "n"), "n", "share") == [(1, 0.2), (1, 0.2), (3, 0.6)]


def test_closing_balance(spark):
    df = spark.createDataFrame([(1, 1, "a", 10), (1, 2, "a", 4), (1, 1, "b", 5), (2, 9, "a", 7)], "p int, at int, m string, v int")
    got = measures.closing_balance(df, F.col("p"), ["m"], ["at"], "v")
    assert tuples(got) == [(1, 9, 2), (2, 7, 1)]


@pytest.mark.parametrize("ranges", [None, 5])
def test_exact_percentiles(spark, ranges):
    rows = [("a", float(v)) for v in [5, 1, 4, 4, 4, 2, 9]] + [("b", 3.0), ("c", None)] + [(None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = measures.exact_percentiles(df, "v", [0, 0.1, 0.5, 0.9, 1], ["g"], ranges=ranges)
    expected = df.filter("v is not null").groupBy("g").agg(
        F.count("v"), *[F.expr(f"percentile(v, {p})") for p in (0, 0.1, 0.5, 0.9, 1)]
    )
    rounded = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows]
    assert rounded(tuples(got)) == rounded(tuples(expected))
    whole = measures.exact_percentiles(df, "v", [0.5], ranges=ranges).collect()[0]
    assert whole.p50 == df.agg(F.median("v")).collect()[0][0]


@pytest.mark.parametrize("ranges", [None, 4])
def test_nest_children_keeps_every_row(spark, ranges):
    df = spark.createDataFrame([(i % 3 if i < 20 else 7, i) for i in range(60)], "p int, c int")
    nested = measures.nest_children(df, ["p"], ["c"], ["c"], chunk_rows=8, ranges=ranges)
    assert nested.filter("size(children) > 8").isEmpty()
    flat = nested.select("p", F.explode("children").alias("x")).select("p", "x.c")
    assert tuples(flat) == tuples(df)
    assert nested.filter("p = 7").count() == 5


@pytest.mark.parametrize("ranges", [None, 4])
def test_list_chunks_join_to_the_whole_list(spark, ranges):
    df = spark.createDataFrame([("a" if i % 3 else "b", f"v{i % 40:02d}") for i in range(200)] + [("a", None)], "g string, v string")
    chunks = measures.list_chunks(df, ["g"], "v", "; ", chunk_rows=7, ranges=ranges)
    assert chunks.agg(F.max("num_values")).collect()[0][0] == 7
    whole = {g: "; ".join(r.listed for r in sorted(chunks.filter(F.col("g") == g).collect(), key=lambda r: r.chunk)) for g in "ab"}
    assert whole == {g: "; ".join(f"v{i:02d}" for i in range(40)) for g in "ab"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 9.9, 10.0, 20.0)], "v double")
    assert tuples(measures.histogram(df, "v", 0, 20, 2)) == [(0, 1), (1, 2), (2, 1), (3, 1)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "G"), (1, "X"), (None, "PG"), (3, None)], "k int, rating string")
    parents = spark.createDataFrame([(1,)], "pk int")
    assert tuples(quality.key_violations(df, ["k"])) == [(1, 2), (None, 1)]
    assert tuples(quality.reference_violations(df, "k", parents, "pk")) == [(3, 1)]
    assert tuples(quality.domain_violations(df, "rating", allowed=["G", "PG", "PG-13", "R", "NC-17"])) == [("X", 1)]
    assert tuples(quality.domain_violations(df, "k", low=2, high=9)) == [(1, 2)]
    exact = quality.cardinality_profile(df, ["k", "rating"], exact=True)
    assert tuples(exact, "column_name", "num_rows", "num_distinct") == [("k", 4, 2), ("rating", 4, 3)]
    assert tuples(quality.cardinality_profile(df, ["k"]), "num_distinct") == [(2,)]


def test_descend_deep_and_cyclic(spark):
    """A chain of 30 below a root, a ring with members below it, a missing parent, two paths to one member."""
    chain = [(i, i - 1 if i else None) for i in range(30)]
    ring = [(100, 102), (101, 100), (102, 101), (103, 102), (104, 103), (105, 105), (106, 999)]
    edges = spark.createDataFrame(chain + ring, "c int, p int")
    got = descend(edges, "c", "p")
    assert tuples(got) == [(i, i, 0) for i in sorted(range(30), key=lambda i: repr((i, i, 0)))]
    assert list(itertools.islice(got.columns, 3)) == ["member", "level", "root"]
    with pytest.raises(ValueError):
        descend(edges, "c", "p", max_levels=5)
    assert tuples(unrooted(edges, "c", "p")) == [(100, True), (101, True), (102, True), (103, False), (104, False), (105, True), (106, False)]
    paths = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 2), (4, 3)], "c int, p int")
    assert tuples(descend(paths, "c", "p")) == [(1, 0, 1), (2, 1, 1), (3, 1, 1), (4, 2, 1), (4, 2, 1)]
    assert descend(edges.limit(0), "c", "p").count() == 0


def test_descend_a_chain_of_a_hundred_thousand(spark):
    """Rounds grow with the logarithm of the depth; three joins of each are no more than twenty rounds."""
    chain = spark.range(100_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("p"))
    spark.sparkContext.setJobGroup("chain", "chain")
    got = descend(chain, "id", "p")
    assert got.where(F.col("level") != F.col("member")).count() == 0 and got.count() == 100_000
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) < 20 * 12


@pytest.mark.parametrize("block_rows", [1, 4, 100])
def test_product_in_blocks(spark, block_rows):
    left, right = spark.range(7).withColumnRenamed("id", "a"), spark.createDataFrame([(i % 4, None if i == 3 else str(i)) for i in range(9)], "b int, c string")
    want = sorted(((a, *r) for a in range(7) for r in right.collect()), key=repr)
    assert tuples(joins.product(left, right, block_rows), "a", "b", "c") == want
    assert joins.product(left, right.limit(0)).count() == 0 and joins.product(left.limit(0), right).count() == 0
