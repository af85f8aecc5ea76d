"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith import functions as fn
from dimsmith.functions.text import name_case as cased
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY
from dimsmith.sources.readers import Tables


@query(
    "money_text_clean",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount
FROM orders""",
)
def money_text_clean(t: Tables):
    """Money kept as text with a currency sign; text that is no amount becomes NULL."""
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(
        F.concat(F.lit("$"), F.col("o_totalprice").cast(MONEY).cast("string"))
    )
    return t.orders.select("o_orderkey", text.alias("amount_text")).select("o_orderkey", fn.money("amount_text").alias("amount"))


@query(
    "date_keys",
    """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id, strftime(o_orderdate, '%H:%M') AS minute_id,
       CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS iso_week,
       CAST(year(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS mixed_week,
       CAST(strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS INTEGER) AS month_id,
       'Q' || quarter(o_orderdate) AS quarter_name, strftime(o_orderdate, '%Y/%m') AS year_month,
       CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
       CAST(last_day(o_orderdate) AS VARCHAR) AS month_end,
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start,
       CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS week_end,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year, CAST(isodow(o_orderdate) AS INTEGER) AS weekday
FROM orders""",
)
def date_keys(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        fn.date_key(d).alias("date_id"),
        fn.minute_label(d).alias("minute_id"),
        fn.iso_week_key(d).alias("iso_week"),
        fn.iso_week_key(d, calendar_year=True).alias("mixed_week"),
        fn.month_key(d).alias("month_id"),
        fn.quarter_label(d).alias("quarter_name"),
        fn.year_month(d).alias("year_month"),
        fn.month_start(d).alias("month_start"),
        fn.month_end(d).alias("month_end"),
        fn.week_start(d).alias("week_start"),
        fn.week_end(d).alias("week_end"),
        F.dayofyear(d).alias("day_of_year"),
        (F.weekday(F.to_date(d)) + 1).alias("weekday"),
    )


@query(
    "name_case",
    "SELECT c_custkey, upper(substring(c_mktsegment, 1, 1)) || lower(substring(c_mktsegment, 2)) AS segment, "
    "lower(c_name) AS lower_name, c_name || ' / ' || c_mktsegment AS label FROM customer",
)
def name_case(t: Tables):
    return t.customer.select(
        "c_custkey",
        cased("c_mktsegment").alias("segment"),
        F.lower("c_name").alias("lower_name"),
        F.concat_ws(" / ", "c_name", "c_mktsegment").alias("label"),
    )


@query("md5_key", "SELECT c_custkey, md5(c_name || '|' || c_mktsegment) AS row_key FROM customer")
def md5_key(t: Tables):
    return t.customer.select("c_custkey", F.md5(F.concat_ws("|", "c_name", "c_mktsegment")).alias("row_key"))


@query(
    "timezone_shift",
    """
SELECT CAST(CAST(ts - INTERVAL 5 HOURS AS DATE) AS VARCHAR) AS eastern_day, count(*) AS num_events,
       CAST(count(*) FILTER (CAST(ts AS DATE) <> CAST(ts - INTERVAL 5 HOURS AS DATE)) AS BIGINT) AS num_moved
FROM events GROUP BY 1""",
)
def timezone_shift(t: Tables):
    """Events by their date in the zone five hours behind UTC."""
    return t.events.groupBy(fn.eastern_date("ts").alias("eastern_day")).agg(
        F.count(F.lit(1)).alias("num_events"), F.count_if(F.to_date("ts") != fn.eastern_date("ts")).alias("num_moved")
    )


@query(
    "role_keys_cast",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, CAST(floor(value) AS INTEGER) AS whole, "
    "TRY_CAST(event_type AS INTEGER) AS no_number, value > 50 AS is_large FROM events",
)
def role_keys_cast(t: Tables):
    return t.events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_text"),
        F.floor("value").cast("int").alias("whole"),
        F.col("event_type").try_cast("int").alias("no_number"),
        (F.col("value") > 50).alias("is_large"),
    )


MINUTE = "CAST(hour(ts) * 60 + minute(ts) AS INTEGER)"


@query(
    "day_parts",
    f"""
WITH timed AS (SELECT {MINUTE} AS m, event_type FROM events)
SELECT CASE WHEN m BETWEEN 360 AND 509 THEN 'Morning' WHEN m BETWEEN 510 AND 719 THEN 'AM' WHEN m BETWEEN 720 AND 1079 THEN 'PM'
            WHEN m BETWEEN 1080 AND 1349 THEN 'Evening' ELSE 'Night' END AS day_part,
       CASE WHEN m BETWEEN 420 AND 1199 THEN 'Day' ELSE 'Night' END AS day_night,
       printf('%02d:%02d – %02d:%02d', m // 60, (m % 60) // 15 * 15, m // 60, (m % 60) // 15 * 15 + 14) AS band,
       event_type, count(*) AS num_events
FROM timed GROUP BY ALL""",
)
def day_parts(t: Tables):
    minute = fn.minute_of_day("ts")
    return t.events.groupBy(
        fn.day_part(minute).alias("day_part"),
        fn.day_night(minute).alias("day_night"),
        fn.quarter_hour_band(minute).alias("band"),
        "event_type",
    ).agg(F.count(F.lit(1)).alias("num_events"))


@query(
    "late_days",
    """
SELECT l_orderkey, l_partkey, l_suppkey,
       CAST(greatest(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) - 30, 0) AS INTEGER) AS late_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def late_days(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate").join(orders, "l_orderkey")
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", fn.overdue_days("o_orderdate", "l_shipdate", F.lit(30)).alias("late_days"))


@query(
    "repeatable_draw",
    "SELECT o_orderkey, CAST('0x' || substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT) % 4581 + 1 AS drawn_item FROM orders",
)
def repeatable_draw(t: Tables):
    """A pseudo-random item for every order, the same on every run because it hashes the key."""
    drawn = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    return t.orders.select("o_orderkey", (F.pmod(drawn, F.lit(4581)) + 1).alias("drawn_item"))


@query("json_props", "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS num_events FROM events GROUP BY 1")
def json_props(t: Tables):
    return t.events.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("num_events"))


@query(
    "changed_predicate",
    """
WITH pairs AS (SELECT a.c_custkey,
  CASE WHEN a.c_acctbal < 1000 THEN NULL WHEN a.c_acctbal < 2000 THEN '' ELSE a.c_mktsegment END AS old_text,
  CASE WHEN a.c_acctbal < 500 THEN '' WHEN a.c_acctbal < 1500 THEN NULL WHEN a.c_acctbal > 9000 THEN 'MOVED' ELSE a.c_mktsegment END AS new_text,
  NULLIF(a.c_nationkey, 3) AS old_number, NULLIF(a.c_nationkey, 4) AS new_number FROM customer a)
SELECT c_custkey, COALESCE(old_text, '') <> COALESCE(new_text, '') OR old_number IS DISTINCT FROM new_number AS is_changed FROM pairs""",
)
def changed_predicate(t: Tables):
    """Whether text (NULL equal to blank) or a number (NULL-safe) differs between two versions of a customer."""
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    old = t.customer.select(
        "c_custkey",
        F.when(balance < 1000, None).when(balance < 2000, "").otherwise(segment).alias("text"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("number"),
    )
    new = t.customer.select(
        "c_custkey",
        F.when(balance < 500, "").when(balance < 1500, None).when(balance > 9000, "MOVED").otherwise(segment).alias("text"),
        F.nullif(F.col("c_nationkey"), F.lit(4)).alias("number"),
    )
    pair = old.alias("o").join(new.alias("n"), F.col("o.c_custkey") == F.col("n.c_custkey"))
    return pair.select("o.c_custkey", fn.any_changed("o", "n", ["text", "number"], old.schema).alias("is_changed"))
