"""Ranking, numbering, keys, shares, frames."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.operators import ordering
from dimsmith.operators.dedup import latest_per_key as latest
from dimsmith.operators.dedup import top_per_group
from dimsmith.operators.keys import assign_surrogate_keys, continue_keys
from dimsmith.operators.measures import share_of_total as add_share
from dimsmith.plans import standin
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY
from dimsmith.sources.readers import Tables

SPEND = """
spend AS (SELECT c_nationkey, c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def spend(t: Tables):
    """Spending per customer, summed before the join, with the customer's nation."""
    totals = t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("amount"))
    return t.customer.select("c_custkey", "c_nationkey").join(totals, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")


RANKED = f"""
WITH {SPEND}
SELECT c_nationkey, c_custkey, CAST(amount AS DOUBLE) AS amount, rank() OVER (PARTITION BY c_nationkey ORDER BY amount DESC) AS place
FROM spend"""


@query("rank_by_spend", RANKED)
def rank_by_spend(t: Tables):
    """Customers ranked by spending within their nation. A nation of any size is ranked in parallel."""
    return ordering.ordered(spend(t), ["amount desc"], {"place": ordering.rank()}, ["c_nationkey"], size_of=t.customer)


@query("rank_by_spend_derived", RANKED)
def rank_by_spend_derived(t: Tables):
    """The same as SQL over a derived table."""
    return t.spark.sql(
        """
        SELECT c_nationkey, c_custkey, amount, rank() OVER (PARTITION BY c_nationkey ORDER BY amount DESC) AS place
        FROM (SELECT c_nationkey, c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
              FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY 1, 2)
        ORDER BY 1, 4, 2
        """,
        orders=t.orders,
        customer=t.customer,
    )


@query(
    "dense_rank_spend",
    """
SELECT c_nationkey, c_custkey, num_orders, rank() OVER w AS value_rank, dense_rank() OVER w AS value_dense_rank
FROM (SELECT c_nationkey, c_custkey, count(*) AS num_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
WINDOW w AS (PARTITION BY c_nationkey ORDER BY num_orders DESC)""",
)
def dense_rank_spend(t: Tables):
    """Customers ranked by number of orders, where very many tie: the distinct values are ranked once."""
    totals = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("num_orders"))
    counted = t.customer.select("c_custkey", "c_nationkey").join(totals, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
    return ordering.rank_with_heavy_ties(counted, "num_orders", ["c_nationkey"], size_of=t.customer)


@query(
    "row_number_items",
    """
SELECT film_id, store_id, row_number() OVER (PARTITION BY film_id ORDER BY store_id) AS place
FROM (SELECT DISTINCT l_partkey AS film_id, l_suppkey AS store_id FROM lineitem)""",
)
def row_number_items(t: Tables):
    """Copies of each film numbered by store."""
    return ordering.ordered(
        standin.inventory(t), ["store_id"], {"place": ordering.row_number()}, ["film_id"], size_of=t.lineitem
    )


@query(
    "latest_per_key",
    """
SELECT user_id, event_id, event_type, value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""",
)
def latest_per_key(t: Tables):
    """The last event of every user."""
    return latest(t.events, ["user_id"], "ts", ["event_id desc"]).select("user_id", "event_id", "event_type", "value")


@query("surrogate_keys", "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_dim_id, o_orderkey, o_custkey FROM orders")
def surrogate_keys(t: Tables):
    """Orders numbered by date and key."""
    keyed = assign_surrogate_keys(t.orders, ["o_orderdate", "o_orderkey"], "order_dim_id", stored=True)
    return keyed.select("order_dim_id", "o_orderkey", "o_custkey")


@query(
    "surrogate_keys_ranged",
    "SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey, l_extendedprice) AS line_dim_id, "
    "l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM (SELECT DISTINCT l_shipdate, l_orderkey, l_partkey, l_suppkey, "
    "l_extendedprice FROM lineitem)",
)
def surrogate_keys_ranged(t: Tables):
    """Distinct lines numbered over eight ranges, the way large inputs are."""
    columns = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"]
    keyed = assign_surrogate_keys(t.lineitem.select(*columns).distinct(), columns, "line_dim_id", ranges=8)
    return keyed.drop("l_shipdate")


@query("surrogate_keys_offset", "SELECT row_number() OVER (ORDER BY p_partkey) + 1000 AS film_dim_id, p_partkey, p_name FROM part")
def surrogate_keys_offset(t: Tables):
    return assign_surrogate_keys(t.part, ["p_partkey"], "film_dim_id", offset=1000, stored=True).select("film_dim_id", "p_partkey", "p_name")


FIRST_ORDER = "(SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1)"


@query(
    "key_continuation",
    f"""
WITH stored AS (SELECT row_number() OVER (ORDER BY o_custkey) + 500 AS customer_dim_id, o_custkey
                FROM {FIRST_ORDER} WHERE first_order < TIMESTAMP '1996-01-01')
SELECT (SELECT max(customer_dim_id) FROM stored) + row_number() OVER (ORDER BY o_custkey) AS customer_dim_id, o_custkey
FROM {FIRST_ORDER} WHERE first_order >= TIMESTAMP '1996-01-01'""",
)
def key_continuation(t: Tables):
    """Customers who first ordered later get the keys after those of the earlier ones."""
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    earlier, later = first.filter(F.col("first_order") < cut), first.filter(F.col("first_order") >= cut)
    stored = assign_surrogate_keys(earlier, ["o_custkey"], "customer_dim_id", offset=500, size_of=t.customer)
    keyed = continue_keys(later, stored, "customer_dim_id", ["o_custkey"], size_of=t.customer)
    return keyed.select("customer_dim_id", "o_custkey")


@query(
    "share_of_total",
    """
SELECT o_custkey, count(*) AS num_orders, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share,
       row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS place
FROM orders GROUP BY 1""",
)
def share_of_total(t: Tables):
    """Each customer's part of all orders, and their place by number of orders."""
    counted = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("num_orders"))
    shared = add_share(counted, "num_orders")
    order = ["num_orders desc", "o_custkey"]
    return ordering.ordered(shared, order, {"place": ordering.row_number()}, size_of=t.customer)


@query(
    "moving_average",
    """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS amount FROM events GROUP BY 1, 2)
SELECT event_type, CAST(day AS VARCHAR) AS day, CAST(sum(amount) OVER run AS DOUBLE) AS running,
       CAST(sum(amount) OVER week AS DOUBLE) / count(*) OVER week AS weekly_average
FROM daily WINDOW run AS (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING),
                  week AS (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING)""",
)
def moving_average(t: Tables):
    """Running sum and seven-day average of daily totals; a group has as many rows as there are days."""
    daily = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(F.col("value").cast(MONEY)).alias("amount"))
    days = Window.partitionBy("event_type").orderBy("day")
    week = days.rowsBetween(-6, 0)
    return daily.select(
        "event_type",
        "day",
        F.sum("amount").over(days.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
        (F.sum("amount").over(week).cast("double") / F.count(F.lit(1)).over(week)).alias("weekly_average"),
    )


@query(
    "running_total_ranged",
    """
SELECT o_orderkey, o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus
       ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running
FROM orders""",
)
def running_total_ranged(t: Tables):
    """A running total over three groups that hold all rows, each cut into ranges."""
    orders = t.orders.withColumn("price", F.col("o_totalprice").cast(MONEY))
    totals = ordering.ordered(
        orders, ["o_orderdate", "o_orderkey"], {"running": ordering.running_sum("price")}, ["o_orderstatus"], ranges=8
    )
    return totals.select("o_orderkey", "o_custkey", "running")


@query(
    "first_last",
    """
SELECT DISTINCT o_custkey, first_value(o_totalprice) OVER w AS first_price, last_value(o_totalprice) OVER w AS last_price
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_last(t: Tables):
    """First and last order price per customer, as aggregates that combine inside each task."""
    at = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_totalprice", at).alias("first_price"), F.max_by("o_totalprice", at).alias("last_price")
    )


@query(
    "top_n_per_group",
    """
SELECT c_mktsegment, c_custkey, c_acctbal FROM
  (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 10""",
)
def top_n_per_group(t: Tables):
    """The ten largest balances per segment; every task passes on ten rows per segment at most."""
    return top_per_group(t.customer.select("c_mktsegment", "c_custkey", "c_acctbal"), ["c_mktsegment"], ["c_acctbal desc", "c_custkey"], 10)
