"""Facts at every grain, and their measures."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from dimsmith import functions as fn
from dimsmith.operators import measures
from dimsmith.operators.keys import assign_surrogate_keys
from dimsmith.plans import facts, standin
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY
from dimsmith.session import fresh_path
from dimsmith.sources import layout
from dimsmith.sources.readers import Tables


def star(t: Tables) -> facts.Dimensions:
    """Natural and surrogate keys of the four dimensions, numbered like the full ones."""

    def keyed(table, natural: str, name: str, offset: int = 0):
        keys = table.select(F.col(natural).alias(f"{name}_id"))
        return assign_surrogate_keys(keys, [f"{name}_id"], f"{name}_dim_id", offset, stored=True)

    return facts.Dimensions(
        customer=keyed(t.customer, "c_custkey", "customer"),
        staff=keyed(t.supplier, "s_suppkey", "staff"),
        film=keyed(t.part, "p_partkey", "film", 1000),
        store=keyed(t.supplier, "s_suppkey", "store", 100),
    )


LINES = """
lines AS (SELECT l_orderkey AS rental_id, l_linenumber AS payment_id, l_partkey AS film_id, l_suppkey AS store_id, o_custkey AS customer_id,
                 o_orderdate AS rental_date, l_shipdate AS return_date,
                 CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS returned_if_closed,
                 round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS amount
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
KEYS = """
c AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_dim_id FROM customer),
s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS supplier_no FROM supplier),
p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) + 1000 AS film_dim_id FROM part)"""


@query(
    "fact_transaction",
    f"""
WITH {LINES}, {KEYS}
SELECT rental_id, payment_id, film_id || '-' || store_id AS inventory_id,
  CAST(strftime(rental_date, '%Y%m%d') AS INTEGER) AS payment_date_id, strftime(rental_date, '%H:%M') AS payment_hour_id,
  CAST(strftime(rental_date, '%Y%m%d') AS INTEGER) AS rental_date_id, strftime(rental_date, '%H:%M') AS rental_hour_id,
  CAST(strftime(return_date, '%Y%m%d') AS INTEGER) AS return_date_id, strftime(return_date, '%H:%M') AS return_hour_id,
  customer_dim_id, supplier_no AS staff_dim_id, film_dim_id, supplier_no + 100 AS store_dim_id, CAST(amount AS DOUBLE) AS amount,
  strftime(return_date, '%Y-%m-%d %H:%M:%S') AS last_update
FROM lines JOIN c ON customer_id = c_custkey JOIN s ON store_id = s_suppkey JOIN p ON film_id = p_partkey""",
)
def fact_transaction(t: Tables):
    """One row per order line, money cleaned from text, four lookups, date and time keys."""
    dims = star(t)
    lines = standin.rental_lines(t, amount_as_text=True, dims=dims).withColumn("amount", fn.money("amount"))
    return facts.transaction_fact(lines, dims)


@query(
    "fact_rejects",
    """
SELECT l_orderkey AS rental_id, l_partkey AS film_id, l_suppkey AS store_id, 'customer' AS missing_in
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'
UNION ALL
SELECT l_orderkey, l_partkey, l_suppkey, 'film' FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO'""",
)
def fact_rejects(t: Tables):
    """Lines whose customer or film has no active version, with the dimension that lacks them."""

    dims = star(t)
    building = t.customer.select(F.col("c_custkey").alias("customer_id"), (F.col("c_mktsegment") != "BUILDING").alias("dim_active"))
    promo = t.part.select(F.col("p_partkey").alias("film_id"), (F.col("p_type") != "PROMO").alias("dim_active"))
    dims = replace(dims, customer=dims.customer.join(building, "customer_id"), film=dims.film.join(promo, "film_id"))
    rejects = facts.rejected_lines(standin.rental_lines(t), dims)
    return rejects.select("rental_id", "film_id", "store_id", "missing_in")


@query(
    "fact_amount_rejects",
    """
SELECT l_orderkey AS rental_id, l_linenumber AS payment_id, 'waived' AS amount, 'amount' AS missing_in
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_linenumber = 7
UNION ALL
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'waived' ELSE
  '$' || CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DECIMAL(18,2)) END, 'film'
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO'""",
)
def fact_amount_rejects(t: Tables):
    """Lines whose amount is no number, which a sum would leave out unseen, beside those without a film."""
    dims = star(t)
    promo = t.part.select(F.col("p_partkey").alias("film_id"), (F.col("p_type") != "PROMO").alias("dim_active"))
    dims = replace(dims, film=dims.film.join(promo, "film_id"))
    waived = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    lines = standin.rental_lines(t, amount_as_text=True, waived=waived)
    rejects = facts.rejected_lines(lines, dims, ("film",), amount_text="amount")
    return rejects.select("rental_id", "payment_id", "amount", "missing_in")


@query(
    "fact_lookup_descriptive",
    """
SELECT l_orderkey AS rental_id, l_linenumber AS payment_id, customer_dim_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS customer_dim_id FROM customer) ON o_custkey = c_custkey
WHERE NOT (c_mktsegment = 'MACHINERY' AND o_orderstatus = 'F')""",
)
def fact_lookup_descriptive(t: Tables):
    """Customers matched on id, names and address together: orders that carry an earlier name find nobody."""
    people = standin.customer(t)
    dims = replace(star(t), customer=star(t).customer.join(people, "customer_id"))
    names = people.select("customer_id", F.col("first_name").alias("customer_first_name"), F.col("last_name").alias("customer_last_name"), F.col("email").alias("customer_email"))
    stale = (F.col("c_mktsegment") == "MACHINERY") & (F.col("o_orderstatus") == "F")
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("rental_id"), F.col("o_custkey").alias("customer_id"), stale.alias("stale"))
    named = orders.join(names, "customer_id").withColumn("customer_last_name", F.when(F.col("stale"), F.lit("FORMER")).otherwise(F.col("customer_last_name")))
    match = {"customer": {"customer_id": "customer_id", "customer_first_name": "first_name", "customer_last_name": "last_name", "customer_email": "email"}}
    # Per order, before the lines multiply it.
    found = facts.resolve(named, dims, ("customer",), match=match)
    lines = t.lineitem.select(F.col("l_orderkey").alias("rental_id"), F.col("l_linenumber").alias("payment_id"))
    return lines.join(found.select("rental_id", "customer_dim_id"), "rental_id").select("rental_id", "payment_id", "customer_dim_id")


WEEK = "CAST(isoyear(rental_date) * 100 + week(rental_date) AS INTEGER)"


@query(
    "fact_weekly",
    f"""
WITH {LINES}, {KEYS}
SELECT {WEEK} AS year_week, film_dim_id, supplier_no + 100 AS store_dim_id, count(*) AS num_rentals, CAST(sum(amount) AS DOUBLE) AS sum_amount
FROM lines JOIN s ON store_id = s_suppkey JOIN p ON film_id = p_partkey WHERE {WEEK} BETWEEN 199621 AND 199740 GROUP BY ALL""",
)
def fact_weekly(t: Tables):
    """The periodic snapshot for a range of weeks."""
    return facts.periodic_fact(standin.rental_lines(t), star(t), 199621, 199740)


@query(
    "fact_weekly_mixed",
    f"""
WITH {LINES}, {KEYS}
SELECT CAST(year(rental_date) * 100 + week(rental_date) AS INTEGER) AS year_week, film_dim_id, supplier_no + 100 AS store_dim_id,
       count(*) AS num_rentals, CAST(sum(amount) AS DOUBLE) AS sum_amount
FROM lines JOIN s ON store_id = s_suppkey JOIN p ON film_id = p_partkey GROUP BY ALL""",
)
def fact_weekly_mixed(t: Tables):
    """All weeks, keyed the older way by calendar year and ISO week."""
    return facts.periodic_fact(standin.rental_lines(t), star(t), calendar_year=True)


@query(
    "fact_monthly_avg",
    f"""
WITH {LINES}, {KEYS}, timed AS (SELECT *, date_diff('day', CAST(rental_date AS DATE), CAST(returned_if_closed AS DATE)) AS days FROM lines)
SELECT CAST(strftime(date_trunc('month', rental_date), '%Y%m%d') AS INTEGER) AS year_month, film_id || '-' || store_id AS inventory_id,
  film_dim_id, supplier_no + 100 AS store_dim_id, avg(days) AS rental_days_avg, CAST(sum(days) AS BIGINT) AS sum_days, count(days) AS num_returned
FROM timed JOIN s ON store_id = s_suppkey JOIN p ON film_id = p_partkey GROUP BY ALL""",
)
def fact_monthly_avg(t: Tables):
    """Average days out per month and copy, with the parts to average again."""
    rentals = standin.rental_lines(t).withColumn("return_date", F.col("returned_if_closed"))
    return facts.average_time_fact(rentals, star(t))


@query(
    "fact_accumulating",
    """
WITH steps AS (SELECT l_orderkey, min(l_shipdate) AS f, max(l_shipdate) AS l, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey AS rental_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS rental_date, CAST(CAST(f AS DATE) AS VARCHAR) AS first_step_date,
  CAST(CAST(l AS DATE) AS VARCHAR) AS last_step_date, COALESCE(n, 0) AS num_steps,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(f AS DATE)) AS days_to_first,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(l AS DATE)) AS days_to_last, CASE WHEN f IS NULL THEN 1 ELSE 0 END AS is_open
FROM orders LEFT JOIN steps ON o_orderkey = l_orderkey""",
)
def fact_accumulating(t: Tables):
    """Order, first and last shipment with the days between, open while nothing shipped."""
    processes = t.orders.select(F.col("o_orderkey").alias("rental_id"), F.to_date("o_orderdate").alias("rental_date"))
    steps = t.lineitem.select(F.col("l_orderkey").alias("rental_id"), "l_shipdate")
    return facts.accumulating_fact(processes, steps, "rental_id", "rental_date", "l_shipdate")


@query(
    "weekly_type_region",
    """
SELECT CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS year_week, p_type AS category, r_name AS region,
  count(*) AS num_lines, CAST(sum(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)) AS DOUBLE) AS income
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3""",
)
def weekly_type_region(t: Tables):
    """Lines and income per ISO week, part type and customer region."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    customers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "region")
    orders = t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "region", fn.iso_week_key("o_orderdate").alias("year_week")
    )
    lines = t.lineitem.join(t.part.select("p_partkey", F.col("p_type").alias("category")), F.col("l_partkey") == F.col("p_partkey"))
    priced = lines.select("l_orderkey", "category", standin.line_amount().alias("amount"))
    joined = priced.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("year_week", "category", "region").agg(
        F.count(F.lit(1)).alias("num_lines"), F.sum("amount").alias("income")
    )


@query(
    "additive_measure",
    f"WITH {LINES} SELECT year(rental_date) AS rental_year, store_id, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS num_rows "
    "FROM lines GROUP BY 1, 2",
)
def additive_measure(t: Tables):
    """Income is additive over every dimension: here year and store."""
    return facts.regrain(standin.rental_lines(t), [F.year("rental_date").alias("rental_year"), F.col("store_id")], ["amount"])


@query(
    "regrain_fact",
    f"WITH {LINES} SELECT CAST(strftime(date_trunc('month', rental_date), '%Y%m%d') AS INTEGER) AS month_id, film_id, "
    "CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS num_rows FROM lines GROUP BY 1, 2",
)
def regrain_fact(t: Tables):
    """The transaction grain rolled up to month and film."""
    return facts.regrain(standin.rental_lines(t), [fn.month_key("rental_date").alias("month_id"), F.col("film_id")], ["amount"])


@query(
    "semi_additive_balance",
    """
WITH last AS (SELECT CAST(ts AS DATE) AS period, user_id, arg_max(CAST(value AS DECIMAL(18,2)), event_id) AS v FROM events GROUP BY 1, 2)
SELECT CAST(period AS VARCHAR) AS period, CAST(sum(v) AS DOUBLE) AS total_balance, count(*) AS num_members FROM last GROUP BY 1""",
)
def semi_additive_balance(t: Tables):
    """Each user's last reading of a day, summed over users but never over days."""
    readings = t.events.withColumn("reading", F.col("value").cast(MONEY))
    return measures.closing_balance(readings, F.to_date("ts"), ["user_id"], ["event_id"], "reading")


@query(
    "ratio_recomputed",
    """
SELECT p_type, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS discount_rate_num,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS discount_rate_den,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE)
    / CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS discount_rate
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def ratio_recomputed(t: Tables):
    """Average discount per part type: a ratio of sums, never an average of ratios.

    Both parts of the ratio are additive, so they are summed per part before the join.
    """
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = gross * F.col("l_discount").cast("decimal(4,2)")
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum(discount).alias("num"), F.sum(gross).alias("den"))
    typed = per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return measures.ratio(typed, ["p_type"], F.col("num"), F.col("den"), "discount_rate")


@query(
    "fact_pruned_by_dimension",
    """
SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INTEGER) AS rental_month, count(*) AS num_rentals,
  CAST(sum(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)) AS DOUBLE) AS sum_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = 1996 AND quarter(o_orderdate) = 2 GROUP BY 1""",
)
def fact_pruned_by_dimension(t: Tables):
    """Income by month of a quarter, the quarter being a filter on the date dimension: only its months are read."""
    path = fresh_path(t.spark, "lines-by-month")
    facts.write_by_month(standin.rental_lines(t).select("rental_date", "amount"), path)
    days = t.orders.select(fn.month_key("o_orderdate").alias("rental_month"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).distinct()
    months = days.where((F.col("y") == 1996) & (F.col("q") == 2))
    lines = facts.in_months(t.spark.read.parquet(path), months)
    return lines.groupBy("rental_month").agg(F.count(F.lit(1)).alias("num_rentals"), F.sum("amount").alias("sum_amount"))


@query(
    "fact_bucketed_lookup",
    """
WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) + 1000 AS film_dim_id FROM part)
SELECT film_dim_id, count(*) AS num_lines FROM lineitem JOIN p ON l_partkey = p_partkey GROUP BY 1""",
)
def fact_bucketed_lookup(t: Tables):
    """Lines per film from a fact and a dimension bucketed alike: no shuffle of the lines for the lookup or the count."""
    run = uuid.uuid4().hex
    lines, films = f"lines_{run}", f"films_{run}"
    layout.write_bucketed_table(t.lineitem.select(F.col("l_partkey").alias("film_id"), "l_orderkey", "l_linenumber"), lines, "film_id", 8)
    layout.write_bucketed_table(star(t).film, films, "film_id", 8)
    found = facts.bucketed_lookup(t.spark, lines, films, "film_id", "film_dim_id")
    return found.groupBy("film_id", "film_dim_id").agg(F.count(F.lit(1)).alias("num_lines")).select("film_dim_id", "num_lines")
