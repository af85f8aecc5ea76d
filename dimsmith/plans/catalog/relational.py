"""Filters, joins, set operations, subqueries, sorting."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.functions.text import clean_key
from dimsmith.operators import joins
from dimsmith.operators.hierarchy import descend, unrooted
from dimsmith.operators.keys import assign_surrogate_keys
from dimsmith.operators.ordering import with_previous
from dimsmith.plans.calendars import date_attributes, weekday_name
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY
from dimsmith.sources.readers import Tables
from dimsmith.sources.series import days_spanned


def iso(column: str):
    return F.to_date(column)


PREDICATES = {
    "equal": "o_orderstatus = 'F'",
    "in_list": "o_orderpriority IN ('1-URGENT', '2-HIGH')",
    "between_dates": "o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
    "between_numbers": "o_totalprice BETWEEN 100000 AND 200000",
    "between_texts": "o_orderpriority BETWEEN '2' AND '4'",
    "like_prefix": "o_orderpriority LIKE '1%'",
    "is_null": "NULLIF(o_orderstatus, 'P') IS NULL",
    "is_not_null": "NULLIF(o_orderstatus, 'P') IS NOT NULL",
    "as_of": "o_orderdate <= TIMESTAMP '1998-06-30 00:00:00'",
    "and_or_not": "(o_orderstatus = 'F' OR o_totalprice > 300000) AND NOT o_orderpriority = '5-LOW'",
    "searched_case": "CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' "
    "ELSE 'small' END = 'medium'",
    "coalesced": "COALESCE(NULLIF(o_orderstatus, 'P'), 'none') = 'none'",
}


@query(
    "predicates",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS predicate, count(*) AS num_rows, "
        f"CAST(COALESCE(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS amount FROM orders WHERE {text}"
        for name, text in PREDICATES.items()
    ),
)
def predicates(t: Tables):
    """Rows and amounts per predicate form; all forms are judged in one scan."""
    price = F.col("o_totalprice").cast(MONEY)
    one_pass = t.orders.agg(
        *[
            F.struct(
                F.count_if(F.expr(text)).alias("num_rows"),
                F.coalesce(F.sum(F.when(F.expr(text), price)), F.lit(0)).cast("decimal(38,2)").alias("amount"),
            ).alias(name)
            for name, text in PREDICATES.items()
        ]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("predicate"), F.col(n).alias("v")) for n in PREDICATES]))
    return one_pass.select(rows.alias("r")).select("r.predicate", "r.v.num_rows", "r.v.amount")


ORDER_LINES = """
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day, l_partkey, l_suppkey,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
FROM orders {how} JOIN lineitem ON o_orderkey = l_orderkey
"""


def _order_lines(t: Tables, how: str):
    orders = t.orders.select("o_orderkey", "o_custkey", iso("o_orderdate").alias("order_day"))
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", iso("l_shipdate").alias("ship_day"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), how).drop("l_orderkey")


@query("join_inner", ORDER_LINES.format(how="INNER"))
def join_inner(t: Tables):
    return _order_lines(t, "inner")


@query("join_left", ORDER_LINES.format(how="LEFT"))
def join_left(t: Tables):
    return _order_lines(t, "left")


@query(
    "join_right",
    """
SELECT l_partkey, l_suppkey, o_orderkey, o_custkey
FROM lineitem RIGHT JOIN orders ON l_orderkey = o_orderkey""",
)
def join_right(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    orders = t.orders.select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "right").drop("l_orderkey")


@query(
    "join_full",
    """
WITH ordered AS (SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS num_orders FROM orders GROUP BY 1),
     shipped AS (SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS num_lines FROM lineitem GROUP BY 1)
SELECT CAST(order_day AS VARCHAR) AS order_day, CAST(ship_day AS VARCHAR) AS ship_day,
       COALESCE(num_orders, 0) AS num_orders, COALESCE(num_lines, 0) AS num_lines
FROM ordered FULL JOIN shipped ON order_day = ship_day""",
)
def join_full(t: Tables):
    """Days with orders against days with shipments; either side may have days of its own."""
    placed = t.orders.groupBy(iso("o_orderdate").alias("order_day")).agg(F.count(F.lit(1)).alias("num_orders"))
    shipped = t.lineitem.groupBy(iso("l_shipdate").alias("ship_day")).agg(F.count(F.lit(1)).alias("num_lines"))
    both = placed.join(shipped, F.col("order_day") == F.col("ship_day"), "full")
    return both.na.fill(0, ["num_orders", "num_lines"])


@query(
    "join_cross_small",
    """
WITH grid AS (SELECT r_regionkey, r_name, segment FROM region CROSS JOIN (SELECT DISTINCT c_mktsegment AS segment FROM customer)),
     counted AS (SELECT n_regionkey, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT r_name, segment, COALESCE(n, 0) AS num_customers
FROM grid LEFT JOIN counted ON r_regionkey = n_regionkey AND segment = c_mktsegment""",
)
def join_cross_small(t: Tables):
    """Every region with every market segment, filled with customer counts."""
    segments = t.customer.select(F.col("c_mktsegment").alias("segment")).distinct()
    grid = joins.product_with_list(t.region, segments)
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    counted = located.groupBy(F.col("n_regionkey").alias("r_regionkey"), F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("num_customers")
    )
    return grid.join(counted, ["r_regionkey", "segment"], "left").na.fill(0, ["num_customers"]).drop("r_regionkey")


ANTI = """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


@query("join_anti_orders", ANTI)
def join_anti_orders(t: Tables):
    """Orders without any line."""
    return t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    )


@query("join_anti_outer", ANTI)
def join_anti_outer(t: Tables):
    """The same through an outer join and IS NULL; Spark turns this into an anti-join as well."""
    lines = t.lineitem.select("l_orderkey").distinct()
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.filter(F.col("l_orderkey").isNull()).select("o_orderkey", "o_custkey")


@query(
    "semi_exists",
    "SELECT c_custkey, c_name FROM customer c WHERE EXISTS "
    "(SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)",
)
def semi_exists(t: Tables):
    """Customers with a large order, as a correlated EXISTS."""
    return t.spark.sql(
        """
        SELECT c_custkey, c_name FROM {customer} c
        WHERE EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
        """,
        customer=t.customer,
        orders=t.orders,
    )


@query(
    "semi_in",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM lineitem "
    "WHERE l_shipdate BETWEEN TIMESTAMP '1996-05-24' AND TIMESTAMP '1996-06-24')",
)
def semi_in(t: Tables):
    """Parts shipped in a period, as an uncorrelated IN."""
    return t.spark.sql(
        """
        SELECT p_partkey, p_name FROM {part}
        WHERE p_partkey IN (SELECT DISTINCT l_partkey FROM {lineitem}
                            WHERE l_shipdate BETWEEN TIMESTAMP_NTZ '1996-05-24' AND TIMESTAMP_NTZ '1996-06-24')
        """,
        part=t.part,
        lineitem=t.lineitem,
    )


@query(
    "not_in_with_nulls",
    """
WITH buyers AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id FROM events),
     named AS (SELECT user_id FROM events WHERE event_type = 'purchase')
SELECT 'list_with_nulls' AS form, count(*) AS num_customers FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM buyers)
UNION ALL
SELECT 'list_without_nulls', count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM named)
UNION ALL
SELECT 'not_exists', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM buyers WHERE user_id = c_custkey)""",
)
def not_in_with_nulls(t: Tables):
    """NOT IN against a list with and without NULLs, and NOT EXISTS, which ignores NULLs."""
    buyers = t.events.select(F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    named = t.events.filter(F.col("event_type") == "purchase").select("user_id")
    forms = {
        "list_with_nulls": joins.not_in(t.customer, "c_custkey", buyers, "user_id"),
        "list_without_nulls": joins.not_in(t.customer, "c_custkey", named, "user_id"),
        "not_exists": t.customer.join(buyers, F.col("c_custkey") == F.col("user_id"), "left_anti"),
    }
    counted = [df.agg(F.count(F.lit(1)).alias("num_customers")).select(F.lit(n).alias("form"), "num_customers") for n, df in forms.items()]
    return joins.union_all(*counted)


@query(
    "join_composite_fanout",
    """
WITH lines AS (SELECT o_orderkey AS k, o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
     fit AS (SELECT o_orderkey AS k, count(*) AS f FROM orders JOIN lines ON o_orderkey = k AND o_custkey = c GROUP BY 1),
     loose AS (SELECT o_orderkey AS k, count(*) AS f FROM orders JOIN lines ON o_custkey = c GROUP BY 1)
SELECT 'order_and_customer' AS join_key, CAST(sum(f) AS BIGINT) AS joined_rows, count(*) AS distinct_left, max(f) AS max_fan_out FROM fit
UNION ALL
SELECT 'customer_only', CAST(sum(f) AS BIGINT), count(*), max(f) FROM loose""",
)
def join_composite_fanout(t: Tables):
    """What the full key and a wrong partial key would join, from counts per key."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    counted = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("num_lines"))
    lines = counted.join(orders, "o_orderkey")
    keys = {"order_and_customer": ["o_orderkey", "o_custkey"], "customer_only": ["o_custkey"]}
    sizes = [
        joins.join_sizes(orders, lines, on, "o_orderkey", "num_lines").select(F.lit(name).alias("join_key"), "*")
        for name, on in keys.items()
    ]
    return joins.union_all(*sizes)


@query(
    "join_expr_keys",
    """
SELECT c_custkey, c_name, event_type, count(*) AS num_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
FROM events JOIN customer ON trim(CAST(user_id AS VARCHAR)) = trim(CAST(c_custkey AS VARCHAR))
GROUP BY 1, 2, 3""",
)
def join_expr_keys(t: Tables):
    """Join on cleaned text keys; events are counted per user before they move."""
    counted = t.events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("num_events"), F.sum(F.col("value").cast(MONEY)).alias("total_value")
    )
    joined = counted.join(t.customer, clean_key("user_id") == clean_key("c_custkey"))
    return joined.select("c_custkey", "c_name", "event_type", "num_events", "total_value")


@query(
    "agg_self_join",
    """
WITH counted AS (SELECT l_orderkey, count(*) AS num_lines FROM lineitem GROUP BY 1)
SELECT a.l_orderkey AS order_a, a.num_lines AS lines_a, b.l_orderkey AS order_b, b.num_lines AS lines_b
FROM counted a LEFT JOIN counted b ON a.l_orderkey = b.l_orderkey""",
)
def agg_self_join(t: Tables):
    """One aggregate used twice: both sides share the grouped exchange."""
    return t.spark.sql(
        """
        WITH counted AS (SELECT l_orderkey, count(*) AS num_lines FROM {lineitem} GROUP BY 1)
        SELECT a.l_orderkey AS order_a, a.num_lines AS lines_a, b.l_orderkey AS order_b, b.num_lines AS lines_b
        FROM counted a LEFT JOIN counted b ON a.l_orderkey = b.l_orderkey
        """,
        lineitem=t.lineitem,
    )


ORDER_CUSTOMER = "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"


@query("join_using", ORDER_CUSTOMER)
def join_using(t: Tables):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    return orders.join(t.customer.withColumnRenamed("c_custkey", "custkey"), "custkey").select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query("join_comma", ORDER_CUSTOMER)
def join_comma(t: Tables):
    return t.spark.sql(
        "SELECT o_orderkey, c_name, c_mktsegment FROM {orders}, {customer} WHERE o_custkey = c_custkey",
        orders=t.orders,
        customer=t.customer,
    )


@query(
    "join_salted",
    "SELECT event_id, event_type, o_status FROM events JOIN "
    "(SELECT o_custkey, max(o_orderstatus) AS o_status FROM orders GROUP BY 1) ON user_id = o_custkey",
)
def join_salted(t: Tables):
    """Events with their user's highest order status, hot users spread over salts."""
    status = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.max("o_orderstatus").alias("o_status"))
    events = t.events.select("event_id", "user_id", "event_type")
    return joins.salted_join(events, status, ["user_id"], share=0.005, salts=8).drop("user_id")


@query(
    "cross_join_blocks",
    "SELECT c_custkey, s_suppkey, s_name FROM customer CROSS JOIN supplier WHERE c_mktsegment = 'BUILDING'",
)
def cross_join_blocks(t: Tables):
    """Customers of a segment with every supplier, the suppliers in blocks."""
    some = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return joins.product(some, t.supplier.select("s_suppkey", "s_name"), block_rows=64)


def _customer_keys(t: Tables):
    return assign_surrogate_keys(t.customer, ["c_custkey"], "customer_dim_id", offset=100, stored=True)


CUSTOMER_KEYS = "(SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) + 100 AS customer_dim_id FROM customer)"


@query(
    "lookup_surrogate",
    f"SELECT o_orderkey, customer_dim_id FROM orders JOIN {CUSTOMER_KEYS} ON o_custkey = c_custkey "
    "WHERE c_mktsegment <> 'BUILDING'",
)
def lookup_surrogate(t: Tables):
    """Natural to surrogate key among the customers that count as active."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    active = F.col("c_mktsegment") != "BUILDING"
    return joins.lookup(orders, _customer_keys(t), {"o_custkey": "c_custkey"}, "customer_dim_id", active).drop("o_custkey")


@query(
    "lookup_rejects",
    "SELECT o_orderkey, o_custkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def lookup_rejects(t: Tables):
    """The orders that lookup drops."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    return joins.lookup_rejects(orders, t.customer, {"o_custkey": "c_custkey"}, F.col("c_mktsegment") != "BUILDING")


@query(
    "role_playing_dates",
    """
SELECT year(o_orderdate) AS order_year, CASE WHEN isodow(o_orderdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS order_weekend,
       year(l_shipdate) AS ship_year, CASE WHEN isodow(l_shipdate) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS ship_weekend,
       count(*) AS num_lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def role_playing_dates(t: Tables):
    """One date dimension in two roles: order date and ship date.

    The dimension covers the days of both facts, some thousands of rows whatever the facts' size.
    """
    all_days = t.orders.select(iso("o_orderdate").alias("d")).unionByName(t.lineitem.select(iso("l_shipdate").alias("d")))
    dim = date_attributes(days_spanned(all_days, "d")).select("date_id", "year", "weekend")
    roles = {r: dim.select(*[F.col(c).alias(f"{r}_{c}") for c in dim.columns]) for r in ("order", "ship")}
    key = lambda c: F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)
    facts = t.orders.select("o_orderkey", key("o_orderdate").alias("order_date_id")).join(
        t.lineitem.select("l_orderkey", key("l_shipdate").alias("ship_date_id")), F.col("o_orderkey") == F.col("l_orderkey")
    )
    # Two integers decide the groups, so lines are counted per pair of days before the joins.
    counted = facts.groupBy("order_date_id", "ship_date_id").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(roles["order"], "order_date_id").join(roles["ship"], "ship_date_id")
    return joined.groupBy("order_year", "order_weekend", "ship_year", "ship_weekend").agg(F.sum("n").alias("num_lines"))


PLACES = """
SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal < 2000
{op}
SELECT s_nationkey AS nationkey FROM supplier WHERE s_acctbal > 5000"""


def _places(t: Tables):
    return (
        t.customer.filter("c_acctbal < 2000").select(F.col("c_nationkey").alias("nationkey")),
        t.supplier.filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nationkey")),
    )


@query("union_all", PLACES.format(op="UNION ALL"))
def union_all(t: Tables):
    return joins.union_all(*_places(t))


@query("union_distinct", PLACES.format(op="UNION"))
def union_distinct(t: Tables):
    customers, suppliers = _places(t)
    return customers.union(suppliers).distinct()


EARLY_LATE = """
SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1995
{op}
SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1998"""


def _year_customers(t: Tables, year: int):
    return t.orders.filter(F.year("o_orderdate") == year).select("o_custkey")


@query("intersect_keys", EARLY_LATE.format(op="INTERSECT"))
def intersect_keys(t: Tables):
    return _year_customers(t, 1995).intersect(_year_customers(t, 1998))


@query("except_keys", EARLY_LATE.format(op="EXCEPT"))
def except_keys(t: Tables):
    return _year_customers(t, 1995).subtract(_year_customers(t, 1998))


@query(
    "hierarchy_levels",
    """
WITH RECURSIVE edges AS (
  SELECT 'R' || r_regionkey AS member, NULL AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey FROM supplier),
walk AS (
  SELECT member, 0 AS level, member AS root FROM edges WHERE parent IS NULL
  UNION ALL SELECT e.member, w.level + 1, w.root FROM edges e JOIN walk w ON e.parent = w.member)
SELECT member, level, root FROM walk""",
)
def hierarchy_levels(t: Tables):
    """Regions, their nations, and the nations' customers and suppliers, walked from the top."""

    def edges(df, letter, key, parent_letter=None, parent=None):
        above = F.concat(F.lit(parent_letter), F.col(parent).cast("string")) if parent else F.lit(None).cast("string")
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("member"), above.alias("parent"))

    table = joins.union_all(
        edges(t.region, "R", "r_regionkey"),
        edges(t.nation, "N", "n_nationkey", "R", "n_regionkey"),
        edges(t.customer, "C", "c_custkey", "N", "c_nationkey"),
        edges(t.supplier, "S", "s_suppkey", "N", "s_nationkey"),
    )
    return descend(table, "member", "parent")


@query("hierarchy_chain", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS level FROM orders")
def hierarchy_chain(t: Tables):
    """Every order below the one before it: one chain as deep as the table is long."""
    chain = with_previous(t.orders.select("o_orderkey"), ["o_orderkey"], {"before": "o_orderkey"}, [])
    return descend(chain, "o_orderkey", "before").select(F.col("member").alias("o_orderkey"), F.col("level").cast("long").alias("level"))


@query(
    "hierarchy_cycles",
    """
WITH edges AS (
  SELECT 'S' || s_suppkey AS member, 'S' || coalesce(lead(s_suppkey) OVER (PARTITION BY s_nationkey ORDER BY s_suppkey), min(s_suppkey) OVER (PARTITION BY s_nationkey)) AS parent, true AS on_cycle FROM supplier
  UNION ALL SELECT 'C' || c_custkey, 'S' || (SELECT min(s_suppkey) FROM supplier WHERE s_nationkey = c_nationkey), false FROM customer)
SELECT member, on_cycle FROM edges WHERE parent IS NOT NULL""",
)
def hierarchy_cycles(t: Tables):
    """Suppliers in a ring per nation with the nation's customers below: none has a root, and the rings are told apart."""
    in_nation = Window.partitionBy("s_nationkey")
    first = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.min("s_suppkey").alias("first"))
    following = F.coalesce(F.lead("s_suppkey").over(in_nation.orderBy("s_suppkey")), F.min("s_suppkey").over(in_nation))
    name = lambda letter, key: F.concat(F.lit(letter), F.col(key).cast("string"))
    ring = t.supplier.select("s_suppkey", following.alias("next")).select(name("S", "s_suppkey").alias("member"), name("S", "next").alias("parent"))
    below = t.customer.join(first, F.col("c_nationkey") == F.col("nation"), "left").select(name("C", "c_custkey").alias("member"), name("S", "first").alias("parent"))
    return unrooted(ring.unionByName(below), "member", "parent")


@query("top_k_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k_orders(t: Tables):
    """Sort and first rows: every task keeps its own top 25."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 20"
)
def limit_offset(t: Tables):
    """The third page of ten."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").offset(20).limit(10)


@query(
    "domain_order",
    """
SELECT isodow(o_orderdate) AS position, dayname(o_orderdate) AS weekday, o_orderpriority, count(*) AS num_orders
FROM orders GROUP BY ALL ORDER BY 1, 3""",
)
def domain_order(t: Tables):
    """Counts in the order of the week and of urgency, not of the alphabet."""
    day = iso("o_orderdate")
    counted = t.orders.groupBy(
        (F.weekday(day) + 1).alias("position"), weekday_name(day).alias("weekday"), "o_orderpriority"
    ).agg(F.count(F.lit(1)).alias("num_orders"))
    return counted.orderBy("position", "o_orderpriority")
