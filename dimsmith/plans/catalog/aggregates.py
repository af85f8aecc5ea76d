"""Groupings, grouping sets, list aggregates, conditional sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.functions import overdue_days
from dimsmith.operators.joins import union_all
from dimsmith.operators.keys import next_key
from dimsmith.operators.lists import ordered_array, ordered_text
from dimsmith.operators.measures import list_chunks
from dimsmith.plans import standin
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.dimensions import film_actors
from dimsmith.plans.facts import standard_price_totals
from dimsmith.plans.standin import MONEY
from dimsmith.sources.layout import data_spread
from dimsmith.sources.readers import Tables

PRICE_SUM = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"


def price():
    return F.col("o_totalprice").cast(MONEY)


def num_rows(name: str = "num_rows"):
    return F.count(F.lit(1)).alias(name)


@query("group_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows FROM orders GROUP BY 1, 2")
def group_counts(t: Tables):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(num_rows())


@query(
    "group_sums",
    f"SELECT o_custkey, o_orderpriority, CAST({PRICE_SUM} AS DOUBLE) AS amount FROM orders "
    "WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2",
)
def group_sums(t: Tables):
    chosen = t.orders.filter(F.col("o_orderstatus").isin("F", "O"))
    return chosen.groupBy("o_custkey", "o_orderpriority").agg(F.sum(price()).alias("amount"))


@query(
    "global_agg",
    f"SELECT count(*) AS num_rows, CAST({PRICE_SUM} AS DOUBLE) AS amount, min(o_totalprice) AS lowest, "
    "max(o_totalprice) AS highest FROM orders",
)
def global_agg(t: Tables):
    return t.orders.agg(
        num_rows(), F.sum(price()).alias("amount"), F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest")
    )


@query(
    "count_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS num_orders, count(DISTINCT l_partkey) AS num_parts "
    "FROM lineitem GROUP BY 1",
)
def count_distinct(t: Tables):
    """Two distinct counts per group: duplicates go in each task, and the distinct keys spread over all tasks."""
    by = "l_returnflag"
    orders = t.lineitem.select(by, "l_orderkey").distinct().groupBy(by).agg(num_rows("num_orders"))
    parts = t.lineitem.select(by, "l_partkey").distinct().groupBy(by).agg(num_rows("num_parts"))
    return orders.join(parts, by)


@query(
    "avg_days",
    """
SELECT year(o_orderdate) AS order_year, count(*) AS num_lines,
       avg(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS avg_days
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def avg_days(t: Tables):
    lines = standin.rental_lines(t)
    days = F.datediff(F.to_date("return_date"), F.to_date("rental_date"))
    return lines.groupBy(F.year("rental_date").alias("order_year")).agg(num_rows("num_lines"), F.avg(days).alias("avg_days"))


@query(
    "having_thresholds",
    f"SELECT o_custkey, count(*) AS num_orders, CAST({PRICE_SUM} AS DOUBLE) AS amount FROM orders "
    "GROUP BY 1 HAVING count(*) > 10 AND sum(CAST(o_totalprice AS DECIMAL(18,2))) > 2500000",
)
def having_thresholds(t: Tables):
    totals = t.orders.groupBy("o_custkey").agg(num_rows("num_orders"), F.sum(price()).alias("amount"))
    return totals.filter((F.col("num_orders") > 10) & (F.col("amount") > 2_500_000))


@query(
    "group_by_year",
    """
WITH counted AS (SELECT year(o_orderdate) AS order_year, count(*) AS num_rows FROM orders GROUP BY 1)
SELECT order_year, num_rows, num_rows / (SELECT sum(num_rows) FROM counted) AS share,
       CAST(num_rows * (SELECT count(*) FROM counted) AS DOUBLE) / (SELECT sum(num_rows) FROM counted) AS skew
FROM counted""",
)
def group_by_year(t: Tables):
    """How evenly a partition key would spread the rows."""
    return data_spread(t.orders, F.year("o_orderdate"), "order_year")


CAST_LINES = "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"


@query(
    "string_agg_ordered",
    f"""
SELECT p_partkey, p_name, string_agg(s_name, '; ' ORDER BY s_name) AS suppliers
FROM {CAST_LINES} JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""",
)
def string_agg_ordered(t: Tables):
    """Suppliers of every part as one ordered text; titles are attached after the grouping."""
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    names = pairs.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    lists = ordered_text(names, ["l_partkey"], "s_name", "; ", "suppliers", size_of=t.lineitem)
    return lists.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_partkey", "p_name", "suppliers")


@query(
    "group_concat_distinct",
    """
SELECT l_partkey, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
)
def group_concat_distinct(t: Tables):
    """Nations a part comes from, each once; duplicates are removed before names are gathered."""
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    named = pairs.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return ordered_text(named, ["l_partkey"], "n_name", name="nations", distinct=True, size_of=t.lineitem)


@query(
    "string_agg_ranges",
    """
SELECT n_name, string_agg(DISTINCT c_name, '; ' ORDER BY c_name) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def string_agg_ranges(t: Tables):
    """Customers of every nation as one text, listed in ranges and put together in their order."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return ordered_text(named, ["n_name"], "c_name", "; ", "customers", distinct=True, ranges=6)


@query(
    "array_agg_ranges",
    """
SELECT o_orderstatus, count(*) AS num_orders, md5(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey)) AS orders_md5
FROM orders GROUP BY 1""",
)
def array_agg_ranges(t: Tables):
    """All orders of a status, three hot groups, as one sorted array each, shown by its digest."""
    arrays = ordered_array(t.orders, ["o_orderstatus"], "o_orderkey", "orders", ranges=9)
    return arrays.select("o_orderstatus", F.size("orders").cast("long").alias("num_orders"), F.md5(F.array_join(F.col("orders").cast("array<string>"), "|")).alias("orders_md5"))


@query(
    "string_agg_chunked",
    """
WITH named AS (SELECT DISTINCT n_name, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
     numbered AS (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY c_name) AS n FROM named)
SELECT n_name, CAST((n - 1) // 25 AS INTEGER) AS chunk, count(*) AS num_values, string_agg(c_name, '; ' ORDER BY c_name) AS customers
FROM numbered GROUP BY 1, 2""",
)
def string_agg_chunked(t: Tables):
    """Customers of every nation: far too many for one text, so each row lists a bounded number of them."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return list_chunks(named, ["n_name"], "c_name", "; ", "customers", chunk_rows=25, size_of=t.customer)


@query(
    "array_agg_suppliers",
    f"""
SELECT l_partkey AS film_id, count(*) AS num_actors,
       string_agg(replace(s_name, '#', ' '), '|' ORDER BY replace(s_name, '#', ' ')) AS actors
FROM {CAST_LINES} JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def array_agg_suppliers(t: Tables):
    """A sorted array per part, shown as text."""
    arrays = film_actors(standin.film_actor(t), standin.actor(t), size_of=t.lineitem)
    return arrays.select("film_id", F.size("actors").cast("long").alias("num_actors"), F.array_join("actors", "|").alias("actors"))


GROUPING_SETS = f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows, CAST({PRICE_SUM} AS DOUBLE) AS amount
FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), (o_orderpriority), ())"""


@query("grouping_sets", GROUPING_SETS)
def grouping_sets(t: Tables):
    """All four grouping sets, rolled up from the finest one instead of expanding every input row four times."""
    finest = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(num_rows("n"), F.sum(price()).alias("s"))
    sets = [[F.col("o_orderstatus"), F.col("o_orderpriority")], [F.col("o_orderstatus")], [F.col("o_orderpriority")], []]
    return finest.groupingSets(sets, "o_orderstatus", "o_orderpriority").agg(
        F.sum("n").alias("num_rows"), F.sum("s").alias("amount")
    )


@query("grouping_sets_sql", GROUPING_SETS)
def grouping_sets_sql(t: Tables):
    """The same as SQL text."""
    return t.spark.sql(
        """
        SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
        FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), (o_orderpriority), ())
        """,
        orders=t.orders,
    )


@query("grouping_sets_union", GROUPING_SETS)
def grouping_sets_union(t: Tables):
    """The emulation by four groupings and UNION ALL, kept as a cross-check."""
    keys = ("o_orderstatus", "o_orderpriority")

    def branch(*by):
        grouped = t.orders.groupBy(*by).agg(num_rows(), F.sum(price()).alias("amount"))
        shown = [F.col(k) if k in by else F.lit(None).cast("string").alias(k) for k in keys]
        return grouped.select(*shown, "num_rows", "amount")

    return union_all(branch(*keys), branch(keys[0]), branch(keys[1]), branch())


@query(
    "rollup_region",
    """
SELECT r_name, n_name, c_mktsegment, grouping_id(r_name, n_name, c_mktsegment) AS level_id, count(*) AS num_customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, c_mktsegment)""",
)
def rollup_region(t: Tables):
    """Totals by level; customers are summed per nation and segment before names are joined."""
    finest = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(num_rows("n"), F.sum(F.col("c_acctbal").cast(MONEY)).alias("s"))
    named = finest.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return named.rollup("r_name", "n_name", "c_mktsegment").agg(
        F.grouping_id().alias("level_id"), F.sum("n").alias("num_customers"), F.sum("s").alias("balance")
    )


@query(
    "cube_status",
    f"SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS level_id, count(*) AS num_rows, "
    f"CAST({PRICE_SUM} AS DOUBLE) AS amount FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
)
def cube_status(t: Tables):
    finest = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(num_rows("n"), F.sum(price()).alias("s"))
    return finest.cube("o_orderstatus", "o_orderpriority").agg(
        F.grouping_id().alias("level_id"), F.sum("n").alias("num_rows"), F.sum("s").alias("amount")
    )


LATE = "greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 30, 0)"


@query(
    "conditional_sum",
    f"""
SELECT o_custkey, CAST(COALESCE(sum({LATE}), 0) AS BIGINT) AS late_days, count(l_orderkey) AS num_lines,
       CAST(sum(CASE WHEN {LATE} > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_late
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def conditional_sum(t: Tables):
    """Late days per customer, zero where nothing is late."""
    lines = t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        t.lineitem.select("l_orderkey", "l_shipdate"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    late = overdue_days("o_orderdate", "l_shipdate", F.lit(30))
    return lines.groupBy("o_custkey").agg(
        F.coalesce(F.sum(late), F.lit(0)).alias("late_days"),
        F.count("l_orderkey").alias("num_lines"),
        F.sum(F.when(late > 0, 1).otherwise(0)).alias("num_late"),
    )


@query("max_key", "SELECT max(o_orderkey) + 1 AS next_key FROM orders")
def max_key(t: Tables):
    """The next surrogate key."""
    return next_key(t.orders, "o_orderkey")


@query(
    "standard_price",
    """
WITH returned AS (SELECT l_orderkey, max(l_shipdate) AS return_date, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey AS rental_id, CAST(CAST(return_date AS DATE) AS VARCHAR) AS return_date,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS payment_date, n AS rentals, n * 30 AS total
FROM returned JOIN orders ON l_orderkey = o_orderkey""",
)
def standard_price(t: Tables):
    """Several items per rental, all at one price."""
    items = t.lineitem.select(F.col("l_orderkey").alias("rental_id"))
    rental = t.lineitem.groupBy(F.col("l_orderkey").alias("rental_id")).agg(F.to_date(F.max("l_shipdate")).alias("return_date"))
    payment = t.orders.select(F.col("o_orderkey").alias("rental_id"), F.to_date("o_orderdate").alias("payment_date"))
    return standard_price_totals(items, rental, payment)
