"""Data behind charts: comparisons, distributions, shares, trends, nested rows, tokens."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from dimsmith.functions import month_key, search_tokens
from dimsmith.operators import measures
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY, line_amount
from dimsmith.sources.readers import Tables
from dimsmith.sources.series import days_spanned

PRICE_SUM = "sum(CAST(o_totalprice AS DECIMAL(18,2)))"


def price():
    return F.col("o_totalprice").cast(MONEY)


@query("feed_category_totals", f"SELECT o_orderpriority, count(*) AS num_orders, CAST({PRICE_SUM} AS DOUBLE) AS amount FROM orders GROUP BY 1")
def feed_category_totals(t: Tables):
    """Totals per category, largest first."""
    totals = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("num_orders"), F.sum(price()).alias("amount"))
    return totals.orderBy(F.desc("amount"), "o_orderpriority")


@query(
    "feed_histogram",
    "SELECT CAST(CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 51 ELSE floor(o_totalprice / 10000) + 1 END AS INTEGER) AS bin, "
    "count(*) AS num_rows FROM orders GROUP BY 1",
)
def feed_histogram(t: Tables):
    return measures.histogram(t.orders, "o_totalprice", 0, 500_000, 50)


@query(
    "feed_box",
    """
SELECT o_orderpriority, count(*) AS num_values, quantile_cont(o_totalprice, 0.0) AS p0, quantile_cont(o_totalprice, 0.25) AS p25,
       quantile_cont(o_totalprice, 0.5) AS p50, quantile_cont(o_totalprice, 0.75) AS p75, quantile_cont(o_totalprice, 1.0) AS p100
FROM orders GROUP BY 1""",
)
def feed_box(t: Tables):
    """Exact five-number summaries without gathering a group anywhere."""
    boxes = measures.exact_percentiles(t.orders.select("o_orderpriority", "o_totalprice"), "o_totalprice", [0, 0.25, 0.5, 0.75, 1], ["o_orderpriority"])
    return boxes


@query(
    "feed_heatmap",
    f"""
SELECT c_mktsegment, {", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS p{p[0]}" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))}
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def feed_heatmap(t: Tables):
    """Segments against priorities; the pivot's columns are given, so no pass looks for them."""
    digit = F.concat(F.lit("p"), F.substring("o_orderpriority", 1, 1))
    per_customer = t.orders.groupBy("o_custkey", digit.alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    matrix = joined.groupBy("c_mktsegment").pivot("priority", ["p1", "p2", "p3", "p4", "p5"]).agg(F.sum("n"))
    return matrix.na.fill(0)


@query(
    "feed_waterfall",
    f"""
WITH monthly AS (SELECT CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS month_id, {PRICE_SUM} AS amount FROM orders GROUP BY 1)
SELECT month_id, CAST(amount AS DOUBLE) AS amount, CAST(amount - COALESCE(lag(amount) OVER w, 0) AS DOUBLE) AS step,
       CAST(sum(amount) OVER w AS DOUBLE) AS running FROM monthly WINDOW w AS (ORDER BY month_id)""",
)
def feed_waterfall(t: Tables):
    """Monthly totals, steps and running totals; the window sees one row per month."""
    monthly = t.orders.groupBy(month_key("o_orderdate").alias("month_id")).agg(F.sum(price()).alias("amount"))
    months = Window.orderBy("month_id")
    return monthly.select(
        "month_id",
        "amount",
        (F.col("amount") - F.coalesce(F.lag("amount").over(months), F.lit(0))).alias("step"),
        F.sum("amount").over(months).alias("running"),
    )


@query(
    "feed_corr",
    """
SELECT l_returnflag, count(*) AS num_rows, round(corr(l_quantity, l_extendedprice), 6) AS correlation,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
FROM lineitem GROUP BY 1""",
)
def feed_corr(t: Tables):
    """Correlation and straight line between quantity and price."""
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"),
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 2).alias("intercept"),
    )


@query(
    "feed_trend",
    """
WITH days AS (SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM lineitem),
     daily AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, COALESCE(n, 0) AS num_orders, COALESCE(n, 0) - lag(COALESCE(n, 0)) OVER (ORDER BY day) AS change
FROM days LEFT JOIN daily USING (day)""",
)
def feed_trend(t: Tables):
    """Orders per day with empty days filled and the change from the day before; one row per calendar day."""
    spine = days_spanned(t.lineitem, "l_shipdate")
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("num_orders"))
    filled = spine.join(daily, "day", "left").na.fill(0, ["num_orders"])
    before = F.lag("num_orders").over(Window.orderBy("day"))
    return filled.withColumn("change", F.col("num_orders") - before)


@query(
    "feed_income",
    """
SELECT l_suppkey AS store_id, p_type AS category, CAST(sum(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)) AS DOUBLE) AS income
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def feed_income(t: Tables):
    """Income by store and category. Lines go straight into the join: store and part together
    repeat too rarely for summing them first to pay for its own shuffle."""
    lines = t.lineitem.select("l_partkey", F.col("l_suppkey").alias("store_id"), line_amount().alias("amount"))
    typed = lines.join(t.part.select("p_partkey", F.col("p_type").alias("category")), F.col("l_partkey") == F.col("p_partkey"))
    return typed.groupBy("store_id", "category").agg(F.sum("amount").alias("income"))


@query(
    "feed_stacked_share",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS num_orders,
       CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share_of_status FROM orders GROUP BY 1, 2""",
)
def feed_stacked_share(t: Tables):
    """Each priority's part of its status; the window sees one row per combination."""
    counted = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("num_orders"))
    whole = F.sum("num_orders").over(Window.partitionBy("o_orderstatus"))
    return counted.withColumn("share_of_status", F.col("num_orders").cast("double") / whole)


WORDS = "list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')))"


@query("tokens", f"SELECT doc_id, CAST(len({WORDS}) AS INTEGER) AS num_tokens, md5(array_to_string({WORDS}, ' ')) AS token_hash FROM documents")
def tokens(t: Tables):
    """The search words of every document: their number, and a digest of the sorted list."""
    words = t.documents.select("doc_id", search_tokens("text").alias("words"))
    return words.select("doc_id", F.size("words").alias("num_tokens"), F.md5(F.array_join("words", " ")).alias("token_hash"))


@query("token_counts", f"SELECT word, count(*) AS num_documents FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY 1")
def token_counts(t: Tables):
    """In how many documents each word occurs."""
    words = t.documents.select(F.explode(search_tokens("text")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("num_documents"))


@query(
    "nested_orders",
    """
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity) AS n FROM lineitem)
SELECT l_orderkey, CAST((n - 1) // 4 AS INTEGER) AS chunk, count(*) AS num_children,
       string_agg(l_partkey || ':' || l_suppkey, ',' ORDER BY n) AS children
FROM numbered GROUP BY 1, 2""",
)
def nested_orders(t: Tables):
    """Lines nested in their order, at most four to an array here, shown as text."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    order = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]
    nested = measures.nest_children(lines, ["l_orderkey"], order, ["l_partkey", "l_suppkey"], chunk_rows=4)
    text = F.transform("children", lambda c: F.concat_ws(":", c.l_partkey, c.l_suppkey))
    return nested.select("l_orderkey", "chunk", F.size("children").cast("long").alias("num_children"), F.array_join(text, ",").alias("children"))


@query(
    "unnested_totals",
    "SELECT l_partkey, count(*) AS num_lines, CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1",
)
def unnested_totals(t: Tables):
    """Lines nested in orders and exploded back: the totals per part are those of the flat table."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    nested = measures.nest_children(lines, ["l_orderkey"], ["l_partkey", "l_quantity"], ["l_partkey", "l_quantity"])
    flat = nested.select(F.explode("children").alias("c")).select("c.*")
    return flat.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("num_lines"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("quantity")
    )
