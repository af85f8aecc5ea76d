"""Round trips through sinks and layouts, data-quality checks, and streaming flows.

Everything is written below the session's shared folder, to a path no other run uses.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from dimsmith.operators import quality
from dimsmith.operators.joins import union_all
from dimsmith.operators.scd import VersionColumns, scd2_initial
from dimsmith.operators.summaries import SummaryView, distinct_sketches, merged_distinct
from dimsmith.plans.catalog.registry import query
from dimsmith.plans.standin import MONEY, tier_snapshot
from dimsmith.session import fresh_path
from dimsmith.sources import layout, readers, sinks
from dimsmith.sources.history import HistoryTable
from dimsmith.sources.readers import Tables
from dimsmith.streaming import flows
from dimsmith.streaming.weekly import WeeklyLedger, keep_weekly

# --- layouts -----------------------------------------------------------------------------------


@query(
    "pruned_year",
    "SELECT CAST(year(o_orderdate) AS VARCHAR) AS part_year, o_orderstatus, count(*) AS num_orders FROM orders "
    "WHERE year(o_orderdate) = 1997 GROUP BY 1, 2",
)
def pruned_year(t: Tables):
    """One year of a table laid out by year: only that folder is read."""
    path = fresh_path(t.spark, "orders-by-year")
    layout.write_by_year(t.orders, path, "o_orderdate")
    year = layout.read_partition(t.spark, path, "part_year", "1997")
    return year.groupBy("part_year", "o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"))


@query(
    "range_partitions",
    """
SELECT CASE WHEN year(o_orderdate) IN (1995, 1996, 1997) THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'other' END AS part_year,
       count(*) AS num_orders, min(o_orderkey) AS lowest FROM orders GROUP BY 1""",
)
def range_partitions(t: Tables):
    """Three years with folders of their own and a default folder for the rest."""
    path = fresh_path(t.spark, "orders-by-range")
    layout.write_by_year(t.orders, path, "o_orderdate", years=[1995, 1996, 1997])
    return layout.read_all(t.spark, path, "part_year").groupBy("part_year").agg(
        F.count(F.lit(1)).alias("num_orders"), F.min("o_orderkey").alias("lowest")
    )


@query(
    "list_partition",
    """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE 'other' END AS part_value, count(*) AS num_orders
FROM orders GROUP BY 1""",
)
def list_partition(t: Tables):
    path = fresh_path(t.spark, "orders-by-priority")
    layout.write_by_list(t.orders, path, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    return layout.read_all(t.spark, path, "part_value").groupBy("part_value").agg(F.count(F.lit(1)).alias("num_orders"))


@query(
    "hash_buckets",
    "SELECT count(*) AS num_rows, count(DISTINCT c_custkey) AS num_keys, 0 AS keys_in_two_buckets, 3 AS num_buckets, true AS is_balanced FROM customer",
)
def hash_buckets(t: Tables):
    """Three hash partitions: no key in two of them, and none below half of a third."""
    path = fresh_path(t.spark, "customer-by-hash")
    layout.write_by_hash(t.customer, path, "c_custkey", 3)
    stored = layout.read_all(t.spark, path, "part_bucket")
    keys = stored.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part_bucket").alias("b"))
    per_bucket = stored.groupBy("part_bucket").agg(F.count(F.lit(1)).alias("n"))
    balance = per_bucket.agg((F.min("n") > F.sum("n") / 3 * 0.5).alias("is_balanced"), F.count(F.lit(1)).cast("int").alias("num_buckets"))
    return keys.agg(
        F.sum("n").alias("num_rows"),
        F.count(F.lit(1)).alias("num_keys"),
        F.count_if(F.col("b") > 1).cast("int").alias("keys_in_two_buckets"),
        F.first(balance.select("num_buckets").scalar()).alias("num_buckets"),
        F.first(balance.select("is_balanced").scalar()).alias("is_balanced"),
    )


@query(
    "partition_drop",
    "SELECT CAST(year(o_orderdate) AS VARCHAR) AS part_year, count(*) AS num_orders FROM orders WHERE year(o_orderdate) <> 1995 GROUP BY 1",
)
def partition_drop(t: Tables):
    """Bulk delete of one year by dropping its folder."""
    path = fresh_path(t.spark, "orders-dropped")
    layout.write_by_year(t.orders, path, "o_orderdate")
    layout.drop_partition(t.spark, path, "part_year", "1995")
    return layout.read_all(t.spark, path, "part_year").groupBy("part_year").agg(F.count(F.lit(1)).alias("num_orders"))


# --- quality -----------------------------------------------------------------------------------


@query(
    "pk_check",
    """
SELECT 'orders' AS check_name, count(*) AS num_violations FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'customer', count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""",
)
def pk_check(t: Tables):
    return quality.check_keys(
        {
            "orders": (t.orders, ["o_orderkey"]),
            "customer": (t.customer, ["c_custkey"]),
            "lineitem": (t.lineitem, ["l_orderkey", "l_linenumber"]),
        }
    )


@query(
    "fk_check",
    """
SELECT 'orders_customer' AS check_name, count(DISTINCT o_custkey) AS num_values, count(*) AS num_rows FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem_orders', count(DISTINCT l_orderkey), count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'documents_labels', count(DISTINCT doc_id), count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def fk_check(t: Tables):
    return quality.check_references(
        {
            "orders_customer": (t.orders, "o_custkey", t.customer, "c_custkey"),
            "lineitem_orders": (t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
            "documents_labels": (t.documents, "doc_id", t.labels, "doc_id"),
        }
    )


@query(
    "domain_check",
    """
SELECT 'status' AS check_name, o_orderstatus AS bad_value, count(*) AS num_rows FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
UNION ALL SELECT 'size', CAST(p_size AS VARCHAR), count(*) FROM part WHERE p_size < 5 OR p_size > 45 GROUP BY 2""",
)
def domain_check(t: Tables):
    """Values outside an allowed list and outside a range."""
    checks = {
        "status": quality.domain_violations(t.orders, "o_orderstatus", allowed=["F", "O"]),
        "size": quality.domain_violations(t.part, "p_size", low=5, high=45),
    }
    rows = [
        df.select(F.lit(name).alias("check_name"), F.col("bad_value").cast("string").alias("bad_value"), "num_rows")
        for name, df in checks.items()
    ]
    return union_all(*rows)


PROFILED = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")


@query(
    "cardinality_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS num_rows, count(DISTINCT {c}) AS num_distinct, "
        f"CAST(count(DISTINCT {c}) AS DOUBLE) / count(*) AS distinct_ratio FROM orders"
        for c in PROFILED
    ),
)
def cardinality_profile(t: Tables):
    return quality.cardinality_profile(t.orders, PROFILED, exact=True)


# --- sinks -------------------------------------------------------------------------------------

BY_STATUS = "SELECT o_orderstatus, count(*) AS num_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1"


def by_status(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"), F.sum(F.col("o_totalprice").cast(MONEY)).alias("amount"))


@query(
    "materialized_view_refresh",
    "SELECT 'before' AS state, o_orderstatus, count(*) AS num_orders FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 2 "
    "UNION ALL SELECT 'after', o_orderstatus, count(*) FROM orders GROUP BY 2",
)
def materialized_view_refresh(t: Tables):
    """A stored result stays as it is while its source grows, until it is refreshed."""
    source, path = fresh_path(t.spark, "mv-source"), fresh_path(t.spark, "mv")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    sinks.append(t.orders.filter(F.col("o_orderdate") < cut), source)
    view = sinks.MaterializedView(
        t.spark, path, lambda: t.spark.read.parquet(source).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"))
    )
    view.refresh()
    sinks.append(t.orders.filter(F.col("o_orderdate") >= cut), source)
    before = view.read()
    view.refresh()
    shown = [df.select(F.lit(state).alias("state"), "*") for state, df in (("before", before), ("after", view.read()))]
    return union_all(*shown)


@query(
    "staging_append",
    "SELECT unnest(['2024-01-01 00:00:00', '2024-01-02 00:00:00', '2024-01-03 00:00:00']) AS load_date, count(*) AS num_rows, "
    "count(DISTINCT c_custkey) AS num_keys FROM customer",
)
def staging_append(t: Tables):
    """Three loads of the whole table; the second one is loaded twice and counts once."""
    staging = sinks.StagingTable(t.spark, fresh_path(t.spark, "stg-customer"))
    for day in ("01", "02", "02", "03"):
        staging.load(t.customer, f"2024-01-{day} 00:00:00")
    return staging.read().groupBy("load_date").agg(F.count(F.lit(1)).alias("num_rows"), F.count_distinct("c_custkey").alias("num_keys"))


@query("append_twice", "SELECT c_custkey, count(*) * 2 AS num_rows FROM customer GROUP BY 1")
def append_twice(t: Tables):
    path = fresh_path(t.spark, "appended")
    sinks.append(t.customer, path)
    sinks.append(t.customer, path)
    return t.spark.read.parquet(path).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("num_rows"))


@query(
    "versioned_overwrite",
    "SELECT c_custkey, c_nationkey, c_acctbal + 100 AS c_acctbal FROM customer",
)
def versioned_overwrite(t: Tables):
    """A table rebuilt from its own last state, without ever overwriting what it reads."""
    table = sinks.VersionedTable(t.spark, fresh_path(t.spark, "versioned"))
    table.write(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"))
    table.write(table.read().withColumn("c_acctbal", F.col("c_acctbal") + 100))
    return table.read()


@query(
    "tsv_roundtrip",
    "SELECT c_custkey, trim(c_name) AS c_name, NULLIF(c_nationkey, 7) AS c_nationkey, c_acctbal FROM customer",
)
def tsv_roundtrip(t: Tables):
    r"""Delimited text with trimmed columns and ``\N`` for NULL, read back by the dump reader."""
    path = fresh_path(t.spark, "dump")
    source = t.customer.select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.nullif(F.col("c_nationkey"), F.lit(7)).alias("c_nationkey"),
        "c_acctbal",
    )
    sinks.write_text(source, path, null_text="\\N")
    return readers.read_dump(t.spark, path, source.schema)


@query(
    "dump_escapes",
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN c_name || chr(9) || c_mktsegment
  WHEN 3 THEN c_name || chr(10) || chr(92) || 't' ELSE chr(92) || chr(92) || 'N' || chr(13) END AS note FROM customer""",
)
def dump_escapes(t: Tables):
    """Empty text, NULL, tabs, line ends and backslashes through a dump and back."""
    path = fresh_path(t.spark, "escapes")
    kind = F.col("c_custkey") % 5
    tabbed, broken = F.concat_ws("\t", "c_name", "c_mktsegment"), F.concat("c_name", F.lit("\n\\t"))
    note = F.when(kind == 0, "").when(kind == 2, tabbed).when(kind == 3, broken).when(kind == 4, "\\\\N\r")
    source = t.customer.select("c_custkey", note.alias("note"))
    sinks.write_text(source, path, null_text="\\N")
    return readers.read_dump(t.spark, path, source.schema)


def _csv(t: Tables) -> str:
    path = fresh_path(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return path


CUSTOMER_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query("csv_header", f"SELECT {CUSTOMER_COLUMNS.replace('c_custkey', 'CAST(c_custkey AS VARCHAR) AS c_custkey')} FROM customer")
def csv_header(t: Tables):
    """CSV with a header, once as plain text columns and typed by the reader of the column."""
    raw = readers.read_csv(t.spark, _csv(t))
    return raw.withColumn("c_nationkey", F.col("c_nationkey").cast("int")).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("csv_schema", f"SELECT {CUSTOMER_COLUMNS} FROM customer")
def csv_schema(t: Tables):
    return readers.read_csv(t.spark, _csv(t), t.customer.schema)


@query("csv_inferred", f"SELECT {CUSTOMER_COLUMNS} FROM customer")
def csv_inferred(t: Tables):
    return readers.read_csv_inferred(t.spark, _csv(t))


@query("ctas", BY_STATUS)
def ctas(t: Tables):
    """A catalogue table made from a query, read back by name."""
    path = fresh_path(t.spark, "ctas")
    name = "orders_by_status_" + path.rsplit("-", 1)[1]
    return sinks.create_table_as(by_status(t.orders), name, path)


@query("view_query", BY_STATUS)
def view_query(t: Tables):
    """A named view and a query on it."""
    name = "orders_by_status_view"
    sinks.create_view(by_status(t.orders), name)
    return t.spark.sql(f"SELECT * FROM {name}")


@query(
    "partitioned_insert",
    "SELECT o_orderstatus, count(*) AS num_orders, sum(o_orderkey) % 1000003 AS key_check FROM orders GROUP BY 1",
)
def partitioned_insert(t: Tables):
    """Rows inserted into a partitioned table in two lots."""
    path = fresh_path(t.spark, "orders-inserted")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    large = F.col("o_totalprice") > 250_000
    for part in (rows.filter(large), rows.filter(~large)):
        sinks.append(part, path, partition_by="o_orderstatus")
    stored = t.spark.read.parquet(path)
    return stored.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num_orders"), (F.sum("o_orderkey") % 1000003).alias("key_check"))


@query(
    "change_set",
    """
SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_acctbal > 9500 THEN c_name || ' (reviewed)' ELSE c_name END AS c_name, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey + (SELECT max(c_custkey) + 1 FROM customer), s_name, 'SUPPLIER' FROM supplier""",
)
def change_set(t: Tables):
    """Some rows updated by key, and new ones inserted."""
    base = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    reviewed = F.concat("c_name", F.lit(" (reviewed)")).alias("c_name")
    updates = t.customer.filter("c_acctbal < 0 OR c_acctbal > 9500").select("c_custkey", reviewed)
    next_key = t.customer.agg((F.max("c_custkey") + 1).alias("k")).scalar()
    inserts = t.supplier.select(
        (F.col("s_suppkey") + next_key).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("SUPPLIER").alias("c_mktsegment")
    )
    return sinks.change_set(base, "c_custkey", updates, inserts)


@query(
    "trigger_stamp",
    """
WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderdate < TIMESTAMP '1996-01-01') AS a,
                      sum(CAST(o_totalprice AS DECIMAL(18,2))) AS b FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
     tiers AS (SELECT o_custkey, CASE WHEN a >= 1000000 THEN 'GOLD' WHEN a >= 300000 THEN 'SILVER' WHEN a IS NOT NULL THEN 'BRONZE' END AS t1,
                      CASE WHEN b >= 1000000 THEN 'GOLD' WHEN b >= 300000 THEN 'SILVER' ELSE 'BRONZE' END AS t2 FROM spent)
SELECT o_custkey AS customer_id, t2 AS tier, CASE WHEN t1 = t2 THEN '1996-01-01' ELSE '1998-01-01' END AS last_update FROM tiers""",
)
def trigger_stamp(t: Tables):
    """Rows that changed or are new get the time of the change; all others keep theirs."""
    old = tier_snapshot(t, "1996-01-01").withColumn("last_update", F.lit("1996-01-01").cast("date"))
    new = tier_snapshot(t, "1998-01-01").withColumn("last_update", F.lit(None).cast("date"))
    stamped = sinks.stamp_changes(old, new, "customer_id", ["name", "segment", "tier"], "1998-01-01")
    return stamped.select("customer_id", "tier", "last_update")


# --- streaming ---------------------------------------------------------------------------------


@query("stream_staging", "SELECT event_id, user_id, event_type, value, '2024-02-01' AS load_date FROM events")
def stream_staging(t: Tables):
    """Arriving files appended to the staging history, stamped."""
    path = fresh_path(t.spark, "stream-staging")
    arrivals = flows.arriving(t.spark, t.folder, t.events.schema, glob="events.parquet")
    flows.run(lambda: flows.stage(arrivals, path, fresh_path(t.spark, "progress"), "2024-02-01"))
    stored = t.spark.read.parquet(path)
    return stored.select("event_id", "user_id", "event_type", "value", F.col("load_date").cast("string").alias("load_date"))


YEARS = ("1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01")


def tiers_over_time_sql() -> str:
    snapshots = " UNION ALL ".join(
        f"SELECT o_custkey AS customer_id, DATE '{y}' AS d, CASE WHEN s >= 1000000 THEN 'GOLD' WHEN s >= 300000 THEN 'SILVER' ELSE 'BRONZE' END AS tier "
        f"FROM (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders WHERE o_orderdate < TIMESTAMP '{y}' GROUP BY 1)"
        for y in YEARS
    )
    return f"""
WITH snapshots AS ({snapshots}),
starts AS (SELECT * FROM (SELECT *, lag(tier) OVER (PARTITION BY customer_id ORDER BY d) AS before FROM snapshots) WHERE before IS NULL OR before <> tier)
SELECT row_number() OVER (ORDER BY d, customer_id) AS customer_dim_id, customer_id, tier, CAST(d AS VARCHAR) AS valid_from,
  CAST(COALESCE(lead(d) OVER w - 1, DATE '9999-12-31') AS VARCHAR) AS valid_to, CASE WHEN lead(d) OVER w IS NULL THEN 1 ELSE 0 END AS dim_active
FROM starts WINDOW w AS (PARTITION BY customer_id ORDER BY d)"""


@query("stream_scd2", tiers_over_time_sql())
def stream_scd2(t: Tables):
    """Yearly snapshots arriving as files, each applied to the dimension as one micro-batch."""
    columns = VersionColumns("customer_dim_id")
    inbox = fresh_path(t.spark, "tier-inbox")
    first, *later = [tier_snapshot(t, y).withColumn("as_of", F.lit(y).cast("date")) for y in YEARS]
    start = scd2_initial(first.drop("as_of"), "customer_id", columns, F.lit(YEARS[0]), size_of=t.customer)
    for snapshot in later:
        sinks.append(snapshot, inbox)
    table = HistoryTable(t.spark, fresh_path(t.spark, "tier-dimension"), columns)
    arrivals = flows.arriving(t.spark, inbox, first.schema)
    flows.run(
        lambda: flows.maintain_scd2(
            arrivals, table, fresh_path(t.spark, "progress"), "customer_id", ["tier"], "as_of", start
        )
    )
    return table.read().drop("name", "segment")


@query("history_table", tiers_over_time_sql())
def history_table(t: Tables):
    """The same snapshots applied in two versions; only the open rows are ever written again."""
    columns = VersionColumns("customer_dim_id")
    first, *later = [(y, tier_snapshot(t, y)) for y in YEARS]
    table = HistoryTable(t.spark, fresh_path(t.spark, "tier-history"), columns)
    table.start(scd2_initial(first[1], "customer_id", columns, F.lit(first[0]), size_of=t.customer))
    table.apply(later[:1], "customer_id", ["tier"])
    table.apply(later[1:], "customer_id", ["tier"])
    return table.read().drop("name", "segment")


@query(
    "stream_weekly",
    "SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week_start, event_type, count(*) AS num_events FROM events GROUP BY 1, 2",
)
def stream_weekly(t: Tables):
    """Events per week and kind on a stream, all weeks published."""
    path = fresh_path(t.spark, "stream-weekly")
    arrivals = flows.arriving(t.spark, t.folder, t.events.schema, glob="events.parquet")
    counts = flows.weekly_counts(arrivals, "ts", ["event_type"])
    flows.run(lambda: flows.write_weekly(counts, path, fresh_path(t.spark, "progress"), mode="complete"))
    return sinks.VersionedTable(t.spark, path).read()


@query(
    "materialized_view_incremental",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS num_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * (CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END)) AS DOUBLE) AS sum_price
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""",
)
def materialized_view_incremental(t: Tables):
    """Sums kept by changes alone: later orders come in, one status goes, another one's prices are updated."""
    orders = t.orders.select("o_orderstatus", "o_orderpriority", "o_orderdate", F.col("o_totalprice").cast(MONEY).alias("price"))
    view = SummaryView(t.spark, fresh_path(t.spark, "order-summary"), ["o_orderstatus", "o_orderpriority"], ["price"])
    early = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    view.rebuild(orders.where(early))
    view.apply(inserted=orders.where(~early))
    view.apply(deleted=orders.where("o_orderstatus = 'P'"))
    old = orders.where("o_orderstatus = 'O'")
    view.apply(inserted=old.withColumn("price", (F.col("price") * 2).cast(MONEY)), deleted=old)
    return view.read()


@query(
    "distinct_by_sketches",
    """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS grain, count(DISTINCT o_custkey) AS num_exact, true AS within FROM orders GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT o_custkey), true FROM orders""",
)
def distinct_by_sketches(t: Tables):
    """Customers per year and in all from stored monthly sketches, held against exact counts: within four standard errors."""
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("month")
    path = fresh_path(t.spark, "monthly-sketches")
    sinks.overwrite(distinct_sketches(t.orders, [month], "o_custkey"), path)
    stored = t.spark.read.parquet(path)
    year = F.year("month").cast("string").alias("grain")
    estimates = merged_distinct(stored, [year]).unionByName(merged_distinct(stored, [F.lit("all").alias("grain")]))
    exact = t.orders.groupBy(F.year("o_orderdate").cast("string").alias("grain")).agg(F.count_distinct("o_custkey").alias("num_exact"))
    exact = exact.unionByName(t.orders.agg(F.count_distinct("o_custkey").alias("num_exact")).select(F.lit("all").alias("grain"), "num_exact"))
    off = F.abs(F.col("num_distinct") - F.col("num_exact")) / F.col("num_exact")
    return exact.join(estimates, "grain").select("grain", "num_exact", (off <= 4 * 0.0065).alias("within"))


LATE_FROM = "2024-01-12"


@query(
    "stream_weekly_late",
    """
WITH lots AS (SELECT *, CAST(date_trunc('week', ts) AS DATE) AS week, hour(ts) = 0 AS held FROM events),
mark AS (SELECT max(ts) - INTERVAL 7 DAY AS at FROM lots WHERE NOT held)
SELECT CAST(week AS VARCHAR) AS week_start, event_type, count(*) FILTER (NOT (held AND week + 7 <= mark.at)) AS on_time,
  count(*) FILTER (held AND week + 7 <= mark.at) AS late
FROM lots, mark GROUP BY 1, 2""",
)
def stream_weekly_late(t: Tables):
    """Weeks closed on a stream whose midnight events arrive last: counted on time, and late ones apart."""
    inbox, progress = fresh_path(t.spark, "event-inbox"), fresh_path(t.spark, "progress")
    held = F.hour("ts") == 0
    early = F.col("ts") < F.lit(LATE_FROM).cast("timestamp_ntz")
    ledger = WeeklyLedger(t.spark, fresh_path(t.spark, "weekly-ledger"), t.events.schema, "ts", ["event_type"], datetime.timedelta(days=7))
    for lot in (t.events.where(~held & early), t.events.where(~held & ~early), t.events.where(held)):
        sinks.append(lot, inbox)
        flows.run(lambda: keep_weekly(flows.arriving(t.spark, inbox, t.events.schema), ledger, progress))
    ledger.flush()
    late = ledger.late().groupBy(F.date_trunc("week", "ts").cast("date").alias("week_start"), "event_type").agg(F.count(F.lit(1)).alias("num_events"))
    both = ledger.weeks().withColumn("part", F.lit("on_time")).unionByName(late.withColumn("part", F.lit("late")))
    totals = {p: F.sum(F.when(F.col("part") == p, F.col("num_events")).otherwise(0)).alias(p) for p in ("on_time", "late")}
    return both.groupBy("week_start", "event_type").agg(*totals.values())
