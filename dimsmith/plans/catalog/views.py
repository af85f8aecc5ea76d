"""Named views, stock, balances, rewards."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.operators import stock
from dimsmith.plans import standin, views
from dimsmith.plans.catalog.facts import LINES
from dimsmith.plans.catalog.registry import query
from dimsmith.sources.readers import Tables

PLACE = (
    "n_nationkey || ' Main Street' AS address, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip_code, "
    "'555-' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS phone, n_name AS city, r_name AS country"
)


def places(t: Tables):
    return standin.address(t), standin.city(t), standin.country(t)


def films(t: Tables):
    return standin.film(t), standin.film_category(t), standin.category(t), standin.film_actor(t), standin.actor(t)


@query(
    "customer_list",
    f"""
SELECT c_custkey AS id, replace(c_name, '#', ' ') AS name, {PLACE}, CASE WHEN c_acctbal >= 5000 THEN 'active' ELSE '' END AS notes,
       c_nationkey AS sid
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def customer_list(t: Tables):
    return views.customer_list(standin.customer(t), *places(t))


@query(
    "staff_list",
    f"""
SELECT s_suppkey AS id, replace(s_name, '#', ' ') AS name, {PLACE}, s_suppkey AS sid
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def staff_list(t: Tables):
    return views.staff_list(standin.staff(t), *places(t))


FILM_LIST = """
WITH casts AS (SELECT l_partkey, string_agg({name}, ', ' ORDER BY {name}) AS actors
               FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT p_partkey AS fid, p_name AS title, p_type || ' ' || p_brand AS description, p_type || '  ' AS category, p_retailprice AS price,
       p_size AS length, 'PG' AS rating, actors
FROM part JOIN casts ON p_partkey = l_partkey"""


@query("film_list", FILM_LIST.format(name="replace(s_name, '#', ' ')"))
def film_list(t: Tables):
    return views.film_list(*films(t), size_of=t.lineitem)


@query("cased_film_list", FILM_LIST.format(name="replace(s_name, '#', '')"))
def cased_film_list(t: Tables):
    """Names in name casing without a blank between the parts."""
    return views.cased_film_list(*films(t), size_of=t.lineitem)


@query(
    "actor_info",
    """
WITH played AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
     per_category AS (SELECT l_suppkey, p_type || '  : ' || string_agg(p_name, ', ' ORDER BY p_name) AS entry
                      FROM played JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_type),
     info AS (SELECT l_suppkey, string_agg(entry, ', ' ORDER BY entry) AS film_info FROM per_category GROUP BY 1)
SELECT s_suppkey AS actor_id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name, film_info
FROM supplier LEFT JOIN info ON s_suppkey = l_suppkey""",
)
def actor_info(t: Tables):
    """Titles per category of every actor, in two levels of lists."""
    film, film_category, category, film_actor, actor = films(t)
    return views.actor_info(actor, film_actor, film, film_category, category, size_of=t.lineitem)


@query(
    "sales_by_category",
    f"WITH {LINES} SELECT p_type || '  ' AS category, CAST(sum(amount) AS DOUBLE) AS total_sales "
    "FROM lines JOIN part ON film_id = p_partkey GROUP BY 1",
)
def sales_by_category(t: Tables):
    return views.sales_by_category(_payments(t), standin.film_category(t), standin.category(t))


def _payments(t: Tables):
    """Film, store and amount of every line that has an order."""
    lines = t.lineitem.join(t.orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("store_id"), standin.line_amount().alias("amount")
    )


@query(
    "sales_by_store",
    f"""
WITH {LINES}
SELECT n_name || ',' || r_name AS store, replace(s_name, '#', ' ') AS manager, CAST(sum(amount) AS DOUBLE) AS total_sales
FROM lines JOIN supplier ON store_id = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name, n_name, s_suppkey, s_name""",
)
def sales_by_store(t: Tables):
    return views.sales_by_store(_payments(t), standin.store(t), *places(t), standin.staff(t))


@query(
    "sales_by_region",
    """
SELECT r_name AS region, c_mktsegment AS segment, count(*) AS num_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2""",
)
def sales_by_region(t: Tables):
    """Income by region and segment; orders are summed per customer before the joins."""
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(standin.MONEY)).alias("s")
    )
    places_of = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        places_of, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment")).agg(
        F.sum("n").alias("num_orders"), F.sum("s").alias("total_sales")
    )


# --- stock: a copy is a (film, store) pair; a line that is still open has no return date ------

ITEM = ("film_id", "store_id")
OPEN = "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O')"
COPIES = "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"


def open_state(t: Tables):
    return t.lineitem.select(
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("return_date"),
    )


@query("in_stock", f"SELECT l_partkey AS film_id, l_suppkey AS store_id FROM {COPIES} EXCEPT SELECT l_partkey, l_suppkey FROM {OPEN}")
def in_stock(t: Tables):
    return stock.in_stock(standin.inventory(t), open_state(t), ITEM)


@query("not_in_stock", f"SELECT l_partkey AS film_id, l_suppkey AS store_id FROM {OPEN}")
def not_in_stock(t: Tables):
    return stock.not_in_stock(standin.inventory(t), open_state(t), ITEM)


@query(
    "stock_counts",
    f"""
SELECT film_id, count(*) FILTER (o.l_partkey IS NULL) AS num_in, count(*) FILTER (o.l_partkey IS NOT NULL) AS num_out FROM
  (SELECT l_partkey AS film_id, l_suppkey AS store_id FROM {COPIES}) c LEFT JOIN {OPEN} o ON film_id = l_partkey AND store_id = l_suppkey
GROUP BY 1""",
)
def stock_counts(t: Tables):
    """Copies of every film on the shelf and out, over all stores."""
    per_store = stock.stock_counts(standin.inventory(t), open_state(t), ITEM)
    return per_store.groupBy("film_id").agg(F.sum("num_in").alias("num_in"), F.sum("num_out").alias("num_out"))


@query(
    "held_by_customer",
    "SELECT l_partkey AS film_id, l_suppkey AS store_id, o_custkey AS customer_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "WHERE l_linestatus = 'O'",
)
def held_by_customer(t: Tables):
    rental = standin.rental_lines(t).withColumn("return_date", F.col("returned_if_closed"))
    return stock.held_by_customer(rental, ITEM)


BALANCE = """
WITH charged AS (
  SELECT o_custkey AS customer_id, sum(CAST(p_retailprice AS DECIMAL(18,2))) AS fees,
         sum(COALESCE(greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - p_size, 0), 0)) AS late_days,
         sum(CASE WHEN {replace} AND COALESCE(greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - p_size, 0), 0) > p_size * 2
                  THEN CAST(p_retailprice * 2 AS DECIMAL(18,2)) ELSE 0 END) AS replacements
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE o_orderdate <= TIMESTAMP '1998-06-30' GROUP BY 1),
paid AS (SELECT o_custkey AS customer_id, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS payments FROM orders
         WHERE o_orderdate <= TIMESTAMP '1998-06-30' GROUP BY 1)
SELECT customer_id, CAST(COALESCE(fees, 0) AS DOUBLE) AS fees, CAST(COALESCE(late_days, 0) AS BIGINT) AS late_days,
       CAST(COALESCE(replacements, 0) AS DOUBLE) AS replacements, CAST(COALESCE(payments, 0) AS DOUBLE) AS payments,
       CAST(COALESCE(fees, 0) + COALESCE(late_days, 0) + COALESCE(replacements, 0) - COALESCE(payments, 0) AS DOUBLE) AS balance
FROM charged FULL JOIN paid USING (customer_id)"""


@query("customer_balance", BALANCE.format(replace="false"))
def customer_balance(t: Tables):
    """Fees plus late days minus payments of every customer on a given date."""
    return stock.customer_balance(standin.rental_lines(t), standin.film(t), standin.payment(t), "1998-06-30")


@query("customer_balance_replacement", BALANCE.format(replace="true"))
def customer_balance_replacement(t: Tables):
    """The same, charging the replacement price for copies kept far too long."""
    return stock.customer_balance(
        standin.rental_lines(t), standin.film(t), standin.payment(t), "1998-06-30", charge_replacement=True
    )


@query(
    "rewards",
    """
SELECT c_custkey AS customer_id, split_part(c_name, '#', 2) AS last_name FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'
  GROUP BY 1 HAVING count(*) > 1 AND sum(CAST(o_totalprice AS DECIMAL(18,2))) > 300000)""",
)
def rewards(t: Tables):
    """Customers above both thresholds in the month three months back."""
    report = stock.rewards_report(standin.customer(t), standin.payment(t), 1, "300000.00", as_of="1997-06-14")
    return report.select("customer_id", "last_name")
