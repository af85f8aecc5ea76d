"""Rental stock, customer balances and rewards, computed for all ids at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.dates import month_end, overdue_days
from dimsmith.operators.ordering import spread


def open_rentals(rental: DataFrame) -> DataFrame:
    return rental.filter(F.col("return_date").isNull())


def _items_out(rental: DataFrame, item: Sequence[str]) -> DataFrame:
    return spread(open_rentals(rental).select(*item), item, size_of=rental).distinct()


def in_stock(inventory: DataFrame, rental: DataFrame, item: Sequence[str] = ("inventory_id",)) -> DataFrame:
    """Items never rented, or with every rental returned."""
    out = _items_out(rental, item)
    return inventory.join(out, list(item), "left_anti").select(*inventory.columns)


def not_in_stock(inventory: DataFrame, rental: DataFrame, item: Sequence[str] = ("inventory_id",)) -> DataFrame:
    out = _items_out(rental, item)
    return inventory.join(out, list(item), "left_semi").select(*inventory.columns)


def film_in_stock(inventory: DataFrame, rental: DataFrame, film_id: int, store_id: int) -> DataFrame:
    """Ids of the copies of a film that are on the shelf of a store."""
    copies = inventory.filter((F.col("film_id") == film_id) & (F.col("store_id") == store_id))
    return in_stock(copies, rental).select("inventory_id")


def film_not_in_stock(inventory: DataFrame, rental: DataFrame, film_id: int, store_id: int) -> DataFrame:
    """Ids of the copies of a film of a store that are out."""
    copies = inventory.filter((F.col("film_id") == film_id) & (F.col("store_id") == store_id))
    return not_in_stock(copies, rental).select("inventory_id")


def stock_counts(inventory: DataFrame, rental: DataFrame, item: Sequence[str] = ("inventory_id",)) -> DataFrame:
    """Copies per film and store, on the shelf and out."""
    out = _items_out(rental, item).withColumn("__out", F.lit(1))
    state = inventory.join(out, list(item), "left")
    return state.groupBy("film_id", "store_id").agg(
        F.count_if(F.col("__out").isNull()).alias("num_in"), F.count_if(F.col("__out").isNotNull()).alias("num_out")
    )


def held_by_customer(rental: DataFrame, item: Sequence[str] = ("inventory_id",)) -> DataFrame:
    """Who holds each item that is out: one row per open rental."""
    return open_rentals(rental).select(*item, "customer_id")


def customer_balance(
    rental: DataFrame,
    film: DataFrame,
    payment: DataFrame,
    as_of: str,
    charge_replacement: bool = False,
) -> DataFrame:
    """What every customer owes on ``as_of``.

    Rental fees of all rentals taken by then, plus one per whole overdue day, minus all payments
    made by then.  ``rental`` carries ``film_id`` (join it with inventory first).  With
    ``charge_replacement`` a rental overdue by more than twice its allowed time also costs the
    film's replacement price.  Both facts are reduced to one row per customer before they meet.
    """
    until = F.lit(as_of).cast("timestamp_ntz")
    terms = ["film_id", "rental_rate", "rental_duration"] + (["replacement_cost"] if charge_replacement else [])
    taken = rental.filter(F.col("rental_date") <= until).join(film.select(*terms), "film_id")
    late = overdue_days("rental_date", "return_date", "rental_duration")
    extra = F.lit(0).cast("decimal(18,2)")
    if charge_replacement:
        extra = F.when(late > F.col("rental_duration") * 2, F.col("replacement_cost").cast("decimal(18,2)")).otherwise(extra)
    charged = taken.groupBy("customer_id").agg(
        F.sum(F.col("rental_rate").cast("decimal(18,2)")).alias("fees"),
        F.sum(late).alias("late_days"),
        F.sum(extra).alias("replacements"),
    )
    paid = payment.filter(F.col("payment_date") <= until).groupBy("customer_id").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("payments")
    )
    zero = F.lit(0)
    both = charged.join(paid, "customer_id", "full").select(
        "customer_id",
        F.coalesce("fees", zero).alias("fees"),
        F.coalesce("late_days", zero).alias("late_days"),
        F.coalesce("replacements", zero).alias("replacements"),
        F.coalesce("payments", zero).alias("payments"),
    )
    owed = F.col("fees") + F.col("late_days") + F.col("replacements") - F.col("payments")
    return both.withColumn("balance", owed.cast("decimal(30,2)"))


def rewards_report(
    customer: DataFrame, payment: DataFrame, min_purchases: int, min_amount: float | str, as_of: str
) -> DataFrame:
    """Customers above both thresholds in the calendar month three months before ``as_of``."""
    if min_purchases <= 0:
        raise ValueError("the minimum number of purchases must be above zero")
    if float(min_amount) <= 0:
        raise ValueError("the minimum amount must be above zero")
    first = F.trunc(F.add_months(F.lit(as_of).cast("date"), -3), "MM")
    # Half-open range on the bare column, so the filter reaches the scan.
    within = (F.col("payment_date") >= first.cast("timestamp_ntz")) & (
        F.col("payment_date") < F.date_add(month_end(first), 1).cast("timestamp_ntz")
    )
    totals = payment.filter(within).groupBy("customer_id").agg(
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("__sum"), F.count(F.lit(1)).alias("__n")
    )
    chosen = totals.filter((F.col("__sum") > F.lit(str(min_amount)).cast("decimal(18,2)")) & (F.col("__n") > min_purchases))
    return customer.join(chosen, "customer_id", "left_semi")
