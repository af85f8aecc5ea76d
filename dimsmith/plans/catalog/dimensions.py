"""Calendars, slowly changing dimensions, entity, junk and conformed dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimsmith.functions import minute_of_day
from dimsmith.operators import scd, timeline
from dimsmith.operators.asof import carry_forward_lookup
from dimsmith.operators.joins import point_in_time_lookup, union_all
from dimsmith.plans import calendars, dimensions, standin
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import tier_snapshot
from dimsmith.session import settle
from dimsmith.sources.readers import Tables
from dimsmith.sources.series import days_spanned
from dimsmith.sources.sinks import stamped

ORDER_DAYS = (
    "(SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d "
    "FROM orders)"
)


MMDD = "month(d) * 100 + day(d)"


def holiday(name: str) -> str:
    listed = ", ".join(str(day) for day in calendars.HOLIDAYS[name])
    return f"if({MMDD} IN ({listed}), 'Holiday', 'No holiday') AS {name}"


def period() -> str:
    after, until = calendars.WINTER_BREAK
    text = f"if({MMDD} > {after} OR {MMDD} <= {until}, 'Winter break', 'Normal')"
    for name, first, last in calendars.PERIODS:
        text = f"if({MMDD} >= {first} AND {MMDD} <= {last}, '{name}', {text})"
    return text


@query(
    "dim_date",
    f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, year(d) AS year, month(d) AS month, monthname(d) AS monthname, day(d) AS day,
  dayofyear(d) AS dayofyear, dayname(d) AS weekdayname, week(d) AS calendarweek, strftime(d, '%d. %m. %Y') AS formatteddate,
  'Q' || quarter(d) AS quartal, year(d) || '/Q' || quarter(d) AS yearquartal, strftime(d, '%Y/%m') AS yearmonth,
  strftime(d, '%G/%V') AS yearcalendarweek, if(isodow(d) > 5, 'Weekend', 'Weekday') AS weekend,
  {holiday("americanholiday")}, {holiday("austrianholiday")}, {holiday("canadianholiday")}, {period()} AS period,
  CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS cwstart, CAST(CAST(date_trunc('week', d) AS DATE) + 6 AS VARCHAR) AS cwend,
  CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS monthstart, CAST(last_day(d) AS VARCHAR) AS monthend
FROM {ORDER_DAYS}""",
)
def dim_date(t: Tables):
    """The date dimension over all days that orders span."""
    return calendars.date_attributes(days_spanned(t.orders, "o_orderdate"))


@query(
    "dim_week",
    f"""
WITH w AS (SELECT DISTINCT CAST(date_trunc('week', d) AS DATE) AS s FROM {ORDER_DAYS}), x AS (SELECT s, s + 3 AS h FROM w)
SELECT CAST(isoyear(s) * 100 + week(s) AS INTEGER) AS week_id, year(h) AS year, month(h) AS month, monthname(h) AS monthname,
  week(s) AS calendarweek, 'Q' || quarter(h) AS quartal, year(h) || '/Q' || quarter(h) AS yearquartal,
  strftime(h, '%Y/%m') AS yearmonth, strftime(s, '%G/%V') AS yearcalendarweek, CAST(s AS VARCHAR) AS cwstart,
  CAST(s + 6 AS VARCHAR) AS cwend, CAST(CAST(date_trunc('month', h) AS DATE) AS VARCHAR) AS monthstart,
  CAST(last_day(h) AS VARCHAR) AS monthend FROM x""",
)
def dim_week(t: Tables):
    """One row per ISO week of the days that orders span."""
    return calendars.week_attributes(days_spanned(t.orders, "o_orderdate"))


@query(
    "dim_week_by_month",
    f"""
SELECT DISTINCT CAST(year(d) * 100 + week(d) AS INTEGER) AS week_id, year(d) AS year, month(d) AS month, monthname(d) AS monthname,
  week(d) AS calendarweek, 'Q' || quarter(d) AS quartal, year(d) || '/Q' || quarter(d) AS yearquartal,
  strftime(d, '%Y/%m') AS yearmonth, strftime(d, '%G/%V') AS yearcalendarweek,
  CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS cwstart, CAST(CAST(date_trunc('week', d) AS DATE) + 6 AS VARCHAR) AS cwend,
  CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS monthstart, CAST(last_day(d) AS VARCHAR) AS monthend
FROM {ORDER_DAYS}""",
)
def dim_week_by_month(t: Tables):
    """The older week dimension with a row per week and month."""
    return calendars.week_month_attributes(days_spanned(t.orders, "o_orderdate"))


@query(
    "dim_time",
    """
WITH minutes AS (SELECT CAST(range AS INTEGER) AS m FROM range(1440)),
     counted AS (SELECT CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS m, count(*) AS n FROM events GROUP BY 1)
SELECT printf('%02d:%02d', m // 60, m % 60) AS timeofday, CAST(m // 60 AS INTEGER) AS hour,
  printf('%02d:%02d – %02d:%02d', m // 60, (m % 60) // 15 * 15, m // 60, (m % 60) // 15 * 15 + 14) AS quarterhour, m AS minute,
  CASE WHEN m BETWEEN 360 AND 509 THEN 'Morning' WHEN m BETWEEN 510 AND 719 THEN 'AM' WHEN m BETWEEN 720 AND 1079 THEN 'PM'
       WHEN m BETWEEN 1080 AND 1349 THEN 'Evening' ELSE 'Night' END AS daytimename,
  CASE WHEN m BETWEEN 420 AND 1199 THEN 'Day' ELSE 'Night' END AS daynight, COALESCE(n, 0) AS num_events
FROM minutes LEFT JOIN counted USING (m)""",
)
def dim_time(t: Tables):
    """Every minute of the day with the number of events in it."""
    counted = t.events.groupBy(minute_of_day("ts").alias("minute")).agg(F.count(F.lit(1)).alias("num_events"))
    return calendars.time_dimension(t.spark).join(counted, "minute", "left").na.fill(0, ["num_events"])


# --- slowly changing dimensions: customers with the tier their spending gave them -------------

FIRST, SECOND = "1996-01-01", "1998-01-01"
COLUMNS = scd.VersionColumns("customer_dim_id")
TRACKED = ["name", "segment", "tier"]


def tier_sql(until: str) -> str:
    return f"""
(SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
        CASE WHEN s >= 1000000 THEN 'GOLD' WHEN s >= 300000 THEN 'SILVER' ELSE 'BRONZE' END AS tier
 FROM customer JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders
                     WHERE o_orderdate < TIMESTAMP '{until}' GROUP BY 1) ON c_custkey = o_custkey)"""


SCD2_CTES = f"""
stored AS (SELECT row_number() OVER (ORDER BY customer_id) AS customer_dim_id, *, DATE '{FIRST}' AS valid_from,
                  DATE '9999-12-31' AS valid_to, 1 AS dim_active FROM {tier_sql(FIRST)}),
incoming AS {tier_sql(SECOND)},
delta AS (SELECT i.*, s.customer_id IS NOT NULL AS changed FROM incoming i LEFT JOIN stored s USING (customer_id)
          WHERE s.customer_id IS NULL OR s.name <> i.name OR s.segment <> i.segment OR s.tier <> i.tier),
versions AS (
  SELECT s.customer_dim_id, s.customer_id, s.name, s.segment, s.tier, s.valid_from,
         CASE WHEN d.changed THEN DATE '{SECOND}' - 1 ELSE s.valid_to END AS valid_to,
         CASE WHEN d.changed THEN 0 ELSE 1 END AS dim_active
  FROM stored s LEFT JOIN delta d ON d.customer_id = s.customer_id AND d.changed
  UNION ALL
  SELECT (SELECT max(customer_dim_id) FROM stored) + row_number() OVER (ORDER BY customer_id), customer_id, name, segment, tier,
         DATE '{SECOND}', DATE '9999-12-31', 1 FROM delta)"""

SHOWN = (
    "customer_dim_id, customer_id, name, segment, tier, CAST(CAST(valid_from AS DATE) AS VARCHAR) AS valid_from, "
    "CAST(CAST(valid_to AS DATE) AS VARCHAR) AS valid_to, dim_active"
)


def stored_tiers(t: Tables):
    start = F.lit(FIRST).cast("date")
    return scd.scd2_initial(tier_snapshot(t, FIRST), "customer_id", COLUMNS, start, size_of=t.customer)


def tier_versions(t: Tables):
    return scd.scd2_upsert(stored_tiers(t), tier_snapshot(t, SECOND), "customer_id", TRACKED, SECOND, COLUMNS)


@query("scd2_initial", f"WITH {SCD2_CTES} SELECT {SHOWN} FROM stored")
def scd2_initial(t: Tables):
    """First load of the customer tiers."""
    return stored_tiers(t)


@query("scd2_upsert", f"WITH {SCD2_CTES} SELECT {SHOWN} FROM versions")
def scd2_upsert(t: Tables):
    """The tiers two years later: changed versions closed and opened, new customers added."""
    return tier_versions(t)


@query("scd2_same_batch_twice", f"WITH {SCD2_CTES} SELECT {SHOWN} FROM versions")
def scd2_same_batch_twice(t: Tables):
    """Applying the batch again changes nothing."""
    return scd.scd2_upsert(tier_versions(t), tier_snapshot(t, SECOND), "customer_id", TRACKED, SECOND, COLUMNS)


@query(
    "scd2_same_day_change",
    f"""WITH {SCD2_CTES}
SELECT {SHOWN} FROM (
  SELECT s.customer_dim_id, s.customer_id, coalesce(d.name, s.name) AS name, coalesce(d.segment, s.segment) AS segment,
         coalesce(d.tier, s.tier) AS tier, s.valid_from, s.valid_to, s.dim_active
  FROM stored s LEFT JOIN delta d ON d.customer_id = s.customer_id AND d.changed
  UNION ALL
  SELECT (SELECT max(customer_dim_id) FROM stored) + row_number() OVER (ORDER BY customer_id), customer_id, name, segment, tier,
         DATE '{FIRST}', DATE '9999-12-31', 1 FROM delta WHERE NOT changed)""",
)
def scd2_same_day_change(t: Tables):
    """A second batch on the day of the first load: versions of that day take its values, new customers are added."""
    return scd.scd2_upsert(stored_tiers(t), tier_snapshot(t, SECOND), "customer_id", TRACKED, FIRST, COLUMNS)


BETWEEN = "1997-01-01"

LATE_BATCH_SQL = f"""
WITH {SCD2_CTES},
points AS (
  SELECT customer_dim_id, customer_id, name, segment, tier, valid_from FROM versions
  UNION ALL SELECT NULL, customer_id, name, segment, tier, DATE '{BETWEEN}' FROM {tier_sql(BETWEEN)}),
marked AS (
  SELECT *, (lag(tier) OVER w IS DISTINCT FROM tier OR lag(name) OVER w IS DISTINCT FROM name OR lag(segment) OVER w IS DISTINCT FROM segment)::INT AS fresh
  FROM points WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY valid_from) AS run FROM marked),
kept AS (
  SELECT customer_id, run, min(customer_dim_id) AS customer_dim_id, any_value(name) AS name, any_value(segment) AS segment, any_value(tier) AS tier,
    min(valid_from) AS valid_from FROM runs GROUP BY customer_id, run),
spliced AS (
  SELECT coalesce(customer_dim_id, (SELECT max(customer_dim_id) FROM versions) + row_number() OVER (PARTITION BY customer_dim_id IS NULL ORDER BY valid_from, customer_id)) AS customer_dim_id,
    customer_id, name, segment, tier, valid_from, coalesce(lead(valid_from) OVER w - 1, DATE '9999-12-31') AS valid_to,
    CASE WHEN lead(valid_from) OVER w IS NULL THEN 1 ELSE 0 END AS dim_active
  FROM kept WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))"""


def late_batch(t: Tables):
    batch = tier_snapshot(t, BETWEEN).withColumn("as_of", F.lit(BETWEEN).cast("date"))
    return timeline.scd2_splice(settle(tier_versions(t)), batch, "customer_id", TRACKED, "as_of", COLUMNS)


@query("scd2_late_batch", f"{LATE_BATCH_SQL} SELECT {SHOWN} FROM spliced")
def scd2_late_batch(t: Tables):
    """The snapshot of a year that comes after the next one: its versions are placed between the stored ones."""
    return late_batch(t)


@query(
    "scd2_late_invariants",
    "SELECT unnest(['repeated_surrogate_key', 'several_open_versions', 'open_flag_and_end_disagree', 'start_after_end', "
    "'overlapping_versions']) AS rule_name, 0 AS num_violations",
)
def scd2_late_invariants(t: Tables):
    """Violations of each rule after the late batch."""
    return scd.scd2_violations(settle(late_batch(t)), "customer_id", COLUMNS)


@query(
    "scd2_invariants",
    "SELECT unnest(['repeated_surrogate_key', 'several_open_versions', 'open_flag_and_end_disagree', 'start_after_end', "
    "'overlapping_versions']) AS rule_name, 0 AS num_violations",
)
def scd2_invariants(t: Tables):
    """Violations of each rule of a type 2 dimension."""
    return scd.scd2_violations(settle(tier_versions(t)), "customer_id", COLUMNS)


@query(
    "scd1_upsert",
    f"""
SELECT customer_id, COALESCE(i.name, s.name) AS name, COALESCE(i.segment, s.segment) AS segment, COALESCE(i.tier, s.tier) AS tier
FROM {tier_sql(FIRST)} s FULL JOIN {tier_sql(SECOND)} i USING (customer_id)""",
)
def scd1_upsert(t: Tables):
    """Overwrite with the later snapshot."""
    return scd.scd1_upsert(tier_snapshot(t, FIRST), tier_snapshot(t, SECOND), "customer_id")


@query(
    "scd3_upsert",
    f"""
SELECT customer_id, COALESCE(n.name, o.name) AS name, COALESCE(n.segment, o.segment) AS segment,
       COALESCE(n.tier, o.tier) AS tier, CASE WHEN o.tier <> n.tier THEN o.tier END AS previous_tier
FROM {tier_sql(FIRST)} o FULL JOIN {tier_sql(SECOND)} n USING (customer_id)""",
)
def scd3_upsert(t: Tables):
    """Current and previous tier side by side."""
    stored = tier_snapshot(t, FIRST).withColumn("previous_tier", F.lit(None).cast("string"))
    return scd.scd3_upsert(stored, tier_snapshot(t, SECOND), "customer_id", "tier")


ASOF = f"""
WITH {SCD2_CTES}
SELECT o_orderkey, o_custkey, customer_dim_id, tier FROM orders
JOIN versions ON o_custkey = customer_id AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to"""


def _orders_as_of(t: Tables, **kwargs):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderdate")
    take = ["customer_dim_id", "tier"]
    joined = point_in_time_lookup(orders, tier_versions(t), "customer_id", "o_orderdate", take, **kwargs)
    return joined.select("o_orderkey", F.col("customer_id").alias("o_custkey"), *take)


@query("asof_dim_join", ASOF)
def asof_dim_join(t: Tables):
    """Orders with the customer version valid on the order date."""
    return _orders_as_of(t)


@query("asof_dim_join_sliced", ASOF)
def asof_dim_join_sliced(t: Tables):
    """The same, with long histories cut by calendar year."""
    return _orders_as_of(t, slice_by_year=True)


@query("asof_dim_join_ordered", ASOF)
def asof_dim_join_ordered(t: Tables):
    """The same without comparing facts and versions: both in one order, cut into ranges, the last version carried on."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    versions = tier_versions(t).withColumnRenamed("customer_id", "o_custkey")
    return carry_forward_lookup(orders, versions, "o_custkey", "o_orderdate", ["customer_dim_id", "tier"], ranges=12).drop("o_orderdate")


# --- entity, junk and conformed dimensions ---------------------------------------------------

ADDRESS_SQL = (
    "n_nationkey || ' Main Street' AS address, CAST(NULL AS VARCHAR) AS address2, n_name AS district, "
    "lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS postal_code, '555-' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS phone"
)


def staged_customers(t: Tables):
    """Two loads of the customers: the earlier one still had other last names."""
    now = standin.customer(t)
    before = now.withColumn("last_name", F.lit("UNKNOWN"))
    return union_all(stamped(before, "2006-02-14 00:00:00"), stamped(now, "2006-02-15 00:00:00"))


@query(
    "dim_customer",
    f"""
SELECT row_number() OVER (ORDER BY c_custkey) AS customer_dim_id, c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
  split_part(c_name, '#', 2) AS last_name, lower(split_part(c_name, '#', 1)) || split_part(c_name, '#', 2) || '@example.org' AS email,
  c_acctbal >= 5000 AS activebool, {ADDRESS_SQL}, '1995-01-01' AS create_date, CAST(NULL AS VARCHAR) AS last_update, 1 AS active,
  '1995-01-01' AS valid_from, '9999-12-31' AS valid_to, 1 AS dim_active
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def dim_customer(t: Tables):
    """The customer dimension from two staged loads of customers and addresses."""
    addresses = standin.address(t)
    staged_addresses = union_all(stamped(addresses, "2006-02-14 00:00:00"), stamped(addresses, "2006-02-15 00:00:00"))
    members = dimensions.customer_members(staged_customers(t), staged_addresses)
    return dimensions.customer_dimension(members, size_of=t.customer)


@query(
    "dim_staff",
    f"""
SELECT row_number() OVER (ORDER BY s_suppkey) AS staff_dim_id, s_suppkey AS staff_id, split_part(s_name, '#', 1) AS first_name,
  split_part(s_name, '#', 2) AS last_name, {ADDRESS_SQL},
  lower(split_part(s_name, '#', 1)) || split_part(s_name, '#', 2) || '@example.org' AS email,
  CASE WHEN s_acctbal >= 5000 THEN 1 ELSE 0 END AS active, lower(split_part(s_name, '#', 1)) || split_part(s_name, '#', 2) AS username,
  '2006-02-15 09:57:12' AS last_update, '2006-02-15' AS valid_from, '9999-12-31' AS valid_to, 1 AS dim_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def dim_staff(t: Tables):
    return dimensions.staff_dimension(standin.staff(t), standin.address(t))


@query(
    "dim_film",
    """
WITH casts AS (SELECT l_partkey, string_agg(replace(s_name, '#', ' '), '|' ORDER BY s_name) AS actors
               FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT row_number() OVER (ORDER BY p_partkey) + 1000 AS film_dim_id, p_partkey AS film_id, p_name AS title,
  p_type || ' ' || p_brand AS description, p_type AS category_name, 2006 AS release_year, p_brand AS language_name,
  p_size AS rental_duration, p_retailprice AS rental_rate, p_size AS length, p_retailprice * 2 AS replacement_cost, 'PG' AS rating,
  '2006-02-15 09:57:12' AS last_update, actors, '2006-02-15' AS valid_from, '9999-12-31' AS valid_to, 1 AS dim_active
FROM part JOIN casts ON p_partkey = l_partkey""",
)
def dim_film(t: Tables):
    """Films with category, language and cast; keys start after 1000."""
    dim = dimensions.film_dimension(
        standin.film(t), standin.film_category(t), standin.category(t), standin.language(t), standin.film_actor(t), standin.actor(t), size_of=t.lineitem
    )
    return dim.withColumn("actors", F.array_join("actors", "|"))


@query(
    "dim_store",
    """
SELECT row_number() OVER (ORDER BY s_suppkey) + 100 AS store_dim_id, s_suppkey AS store_id, replace(s_name, '#', ' ') AS manager_staff_name,
  n_nationkey || ' Main Street' AS store_address, CAST(NULL AS VARCHAR) AS store_address2,
  '2006-02-15' AS valid_from, '9999-12-31' AS valid_to, 1 AS dim_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def dim_store(t: Tables):
    return dimensions.store_dimension(standin.store(t), standin.address(t), standin.staff(t))


@query(
    "junk_film",
    """
SELECT p_partkey AS film_id, p_name AS title, p_type || ' ' || p_brand AS description, p_type || '  ' AS category_name,
  p_brand AS language_name, p_size AS rental_duration, p_retailprice AS rental_rate, p_size AS length,
  p_retailprice * 2 AS replacement_cost, 'PG' AS rating, 2006 AS release_year, '2006-02-15 00:00:00' AS load_date FROM part""",
)
def junk_film(t: Tables):
    return dimensions.junk_film(
        standin.film(t), standin.language(t), standin.film_category(t), standin.category(t), "2006-02-15 00:00:00"
    )


@query(
    "junk_dimension",
    """
SELECT row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, l_returnflag, l_linestatus) AS junk_dim_id, *
FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, l_returnflag, l_linestatus FROM orders JOIN lineitem ON o_orderkey = l_orderkey)""",
)
def junk_dimension(t: Tables):
    """The combinations of four flags that occur; each task of the join passes on its distinct ones only."""
    flags = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus")
    joined = t.orders.join(flags, F.col("o_orderkey") == F.col("l_orderkey"))
    return dimensions.junk_dimension(joined, ["o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus"])


@query(
    "conformed_customer",
    "SELECT DISTINCT 'C' || c_custkey AS conformed_id, CAST(c_custkey AS VARCHAR) AS rental_id, c_name AS crm_id FROM customer",
)
def conformed_customer(t: Tables):
    """The id bridge of three systems."""
    return dimensions.conformed_customer(
        _bridge(t), {"conformed_id": "customer_conformed_id", "rental_id": "rental_customer_id", "crm_id": "salesforce_id"}
    )


def _bridge(t: Tables):
    key = F.col("c_custkey").cast("string")
    return t.customer.select(
        F.concat(F.lit("C"), key).alias("customer_conformed_id"),
        key.alias("rental_customer_id"),
        F.concat(F.lit(" user"), key, F.lit(" ")).alias("twitter_id"),
        F.col("c_name").alias("salesforce_id"),
    )


@query(
    "conformed_drill_across",
    """
SELECT 'C' || c_custkey AS customer_conformed_id, CAST(c_custkey AS VARCHAR) AS rental_customer_id, 'user' || c_custkey AS twitter_id,
  split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name, event_type AS sentiment, count(*) AS num_tweets
FROM customer JOIN events ON user_id = c_custkey GROUP BY ALL""",
)
def conformed_drill_across(t: Tables):
    """Messages per kind of every customer, across two stars through the conformed ids."""
    tweets = t.events.select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit(" ")).alias("name"), F.col("event_type").alias("sentiment"))
    return dimensions.drill_across(_bridge(t), staged_customers(t), tweets)
