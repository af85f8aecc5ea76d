"""Fact tables at four grains, built from one frame of rental lines.

A *rental line* is one payment of one rental with the natural keys of its dimensions:
``rental_id, payment_id, inventory_id, customer_id, staff_id, film_id, store_id, rental_date,
return_date, payment_date, amount, last_update``.  :func:`rental_lines` makes it from the source
tables; any other source only has to provide the same columns.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith import functions as fn
from dimsmith.operators.joins import lookup, splittable


@dataclass(frozen=True)
class Dimensions:
    """The dimensions the facts refer to; each holds its natural key and surrogate key."""

    customer: DataFrame
    staff: DataFrame
    film: DataFrame
    store: DataFrame


def is_active(dim: DataFrame) -> Column | None:
    return F.col("dim_active").cast("int") == 1 if "dim_active" in dim.columns else None


def resolve(
    rows: DataFrame,
    dims: Dimensions,
    names: Sequence[str] = ("customer", "staff", "film", "store"),
    hot_key_salts: int | None = None,
    match: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Natural keys to surrogate keys of the active versions; a row missing from any dimension is dropped.

    Surrogate keys that ``rows`` already carries are not looked up again.  ``hot_key_salts``
    spreads rows of hot members (see ``lookup``) where a dimension is too large to broadcast.
    ``match`` replaces the matched columns of a dimension, say to compare names as well as the id:
    ``{"customer": {"customer_id": "customer_id", "customer_email": "email"}}``.
    """
    for name in names:
        if f"{name}_dim_id" not in rows.columns:
            dim = getattr(dims, name)
            on = _matched(name, match)
            rows = lookup(rows, dim, on, f"{name}_dim_id", is_active(dim), hot_key_salts=hot_key_salts)
    return rows


def _matched(name: str, match: Mapping[str, Mapping[str, str]] | None) -> Mapping[str, str]:
    return (match or {}).get(name, {f"{name}_id": f"{name}_id"})


def rejected_lines(
    lines: DataFrame,
    dims: Dimensions,
    names: Sequence[str] = ("customer", "staff", "film", "store"),
    match: Mapping[str, Mapping[str, str]] | None = None,
    amount_text: str | None = None,
) -> DataFrame:
    """The lines :func:`resolve` drops, once per dimension that does not know them (``missing_in``).

    With ``amount_text``, the column of the amounts as the source wrote them, also the lines whose
    amount cannot be read, missing in ``amount``. The lines are computed once and carried through all
    lookups.
    """
    rows = lines
    for name in names:
        dim = getattr(dims, name)
        rows = lookup(rows, dim, _matched(name, match), f"{name}_dim_id", is_active(dim), keep_misses=True)
    reasons = [F.when(F.col(f"{n}_dim_id").isNull(), F.lit(n)) for n in names]
    if amount_text:
        reasons.append(F.when(fn.unreadable_money(amount_text), F.lit("amount")))
    missing = F.array_compact(F.array(*reasons))
    return rows.select(*lines.columns, F.explode(missing).alias("missing_in"))


def rental_lines(
    rental: DataFrame, payment: DataFrame, inventory: DataFrame, staff: DataFrame, dims: Dimensions | None = None
) -> DataFrame:
    """Rentals with their payments, the rented copy, and the store of the staff member in charge.

    With ``dims`` every natural key is resolved in the smallest table that holds it: customers per
    rental, films per copy, staff and stores per staff member.  The fact itself then needs no
    lookup joins of its own, and no shuffle for them.
    """
    paid = payment.select("payment_id", "rental_id", "amount", "payment_date")
    copies = inventory.select("inventory_id", "film_id")
    people = staff.select("staff_id", "store_id")
    if dims is not None:
        rental, copies = resolve(rental, dims, ("customer",)), resolve(copies, dims, ("film",))
        people = resolve(people, dims, ("staff", "store"))
    return (
        rental.join(paid, "rental_id").join(copies, "inventory_id").join(people, "staff_id").withColumn("amount", fn.money("amount"))
    )


def transaction_fact(lines: DataFrame, dims: Dimensions, hot_key_salts: int | None = None) -> DataFrame:
    """One row per payment of a rental, dates as keys, times as labels, dimensions as surrogate keys."""
    return resolve(lines, dims, hot_key_salts=hot_key_salts).select(
        "rental_id",
        "payment_id",
        "inventory_id",
        fn.date_key("payment_date").alias("payment_date_id"),
        fn.minute_label("payment_date").alias("payment_hour_id"),
        fn.date_key("rental_date").alias("rental_date_id"),
        fn.minute_label("rental_date").alias("rental_hour_id"),
        fn.date_key("return_date").alias("return_date_id"),
        fn.minute_label("return_date").alias("return_hour_id"),
        "customer_dim_id",
        "staff_dim_id",
        "film_dim_id",
        "store_dim_id",
        "amount",
        "last_update",
    )


def periodic_fact(
    lines: DataFrame, dims: Dimensions, first_week: int | None = None, last_week: int | None = None,
    calendar_year: bool = False,
) -> DataFrame:
    """Rentals and income per ISO week, film and store.

    Lines are aggregated on natural keys first (combining inside each task), so the two lookups
    see one row per group instead of one per payment.  Every natural key has one active
    surrogate, so the grain stays the same.
    """
    rows = lines
    for week, is_last in ((first_week, False), (last_week, True)):
        if week is not None:
            bound = F.lit(_outer_date(week, is_last, calendar_year)).cast("timestamp_ntz")
            # On the bare column, so that the scan can skip row groups.
            rows = rows.filter(F.col("rental_date") < bound if is_last else F.col("rental_date") >= bound)
    rows = rows.withColumn("year_week", fn.iso_week_key("rental_date", calendar_year))
    if first_week is not None:
        rows = rows.filter(F.col("year_week") >= first_week)
    if last_week is not None:
        rows = rows.filter(F.col("year_week") <= last_week)
    grouped = rows.groupBy("year_week", "film_id", "store_id").agg(
        F.count(F.lit(1)).alias("num_rentals"), F.sum("amount").alias("sum_amount")
    )
    return resolve(grouped, dims, ("film", "store")).select(
        "year_week", "film_dim_id", "store_dim_id", "num_rentals", "sum_amount"
    )


def _outer_date(week: int, is_last: bool, calendar_year: bool) -> str:
    """A date before which (or from which on) no day can belong to ``week`` or anything beyond it."""
    year, number = divmod(week, 100)
    if calendar_year:
        return f"{year + 1 if is_last else year}-01-01"
    monday = datetime.date.fromisocalendar(year, number, 1)
    return (monday + datetime.timedelta(days=7) if is_last else monday).isoformat()


def write_by_month(lines: DataFrame, path: str) -> None:
    """Rental lines in one folder per month of rental, keyed like a month of the date dimension."""
    months = lines.withColumn("rental_month", fn.month_key("rental_date"))
    months.hint("rebalance", F.col("rental_month")).write.mode("overwrite").partitionBy("rental_month").parquet(path)


def in_months(stored: DataFrame, months: DataFrame) -> DataFrame:
    """The lines of a table written by :func:`write_by_month` whose months a filtered dimension names (``rental_month``).

    The filter stays on the dimension: Spark runs it first and opens the folders of its months only.
    """
    return stored.join(months.select("rental_month").distinct(), "rental_month")


def bucketed_lookup(spark: SparkSession, lines: str, dim: str, on: str, surrogate: str) -> DataFrame:
    """Lines of one bucketed table with the surrogate key from another, both bucketed by ``on`` alike, so that neither is shuffled."""
    return spark.table(lines).join(spark.table(dim).select(on, surrogate), on)


def average_time_fact(rentals: DataFrame, dims: Dimensions) -> DataFrame:
    """Average rental days per month, copy, film and store.

    An average cannot be added up, so the sum and the count it came from are stored beside it.
    Rentals not yet returned have no length and do not count.
    """
    days = F.datediff(F.to_date("return_date"), F.to_date("rental_date"))
    grouped = rentals.groupBy(
        fn.month_key("rental_date").alias("year_month"), "inventory_id", "film_id", "store_id"
    ).agg(F.sum(days).alias("sum_days"), F.count(days).alias("num_returned"), F.avg(days).alias("rental_days_avg"))
    return resolve(grouped, dims, ("film", "store")).select(
        "year_month", "inventory_id", "film_dim_id", "store_dim_id", "rental_days_avg", "sum_days", "num_returned"
    )


def accumulating_fact(
    processes: DataFrame, steps: DataFrame, key: str, started: str, step_at: str
) -> DataFrame:
    """One row per process: start, first and last step, days between them, and whether it is still open.

    Steps are reduced to one row per process before the join.
    """
    milestones = steps.groupBy(key).agg(
        F.min(step_at).alias("first_step"), F.max(step_at).alias("last_step"), F.count(F.lit(1)).alias("num_steps")
    )
    joined = processes.join(milestones, key, "left")
    return joined.select(
        *processes.columns,
        F.to_date("first_step").alias("first_step_date"),
        F.to_date("last_step").alias("last_step_date"),
        F.coalesce("num_steps", F.lit(0)).alias("num_steps"),
        F.datediff(F.to_date("first_step"), F.to_date(started)).alias("days_to_first"),
        F.datediff(F.to_date("last_step"), F.to_date(started)).alias("days_to_last"),
        F.when(F.col("first_step").isNull(), 1).otherwise(0).alias("is_open"),
    )


def regrain(fact: DataFrame, by: list[Column], additive: list[str]) -> DataFrame:
    """A fact at a coarser grain: sums of its additive measures and the number of its rows."""
    return fact.groupBy(*by).agg(*[F.sum(m).alias(m) for m in additive], F.count(F.lit(1)).alias("num_rows"))


def standard_price_totals(items: DataFrame, rental: DataFrame, payment: DataFrame, price: int = 30) -> DataFrame:
    """Rentals with several items at one price: items per rental and payment date, and their total."""
    counted = items.groupBy("rental_id").agg(F.count(F.lit(1)).alias("__items"))
    returned = counted.join(rental.select("rental_id", "return_date"), "rental_id")
    joined = payment.select("rental_id", "payment_date").join(splittable(returned), "rental_id")
    return joined.groupBy("rental_id", "return_date", "payment_date").agg(
        F.sum("__items").alias("rentals"), (F.sum("__items") * price).alias("total")
    )
