"""The rental model's source tables, read from an order-and-line schema.

Everything here is a renaming projection over the given tables (plus DISTINCT where the rental
model has a link table), so the dimension, fact and view builders can be run on them unchanged:

customer -> customer, supplier -> staff, store and actor, part -> film, p_type -> category,
p_brand -> language, nation -> address and city, region -> country, distinct (part, supplier)
-> inventory and cast, lineitem with its order -> rental line, order -> payment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.operators.joins import splittable
from dimsmith.operators.ordering import spread
from dimsmith.plans.facts import Dimensions, resolve
from dimsmith.sources.readers import Tables

MONEY = "decimal(18,2)"
# Fixed value: when the stand-in dimension rows were last touched.
LAST_UPDATE = "2006-02-15 09:57:12"


def last_update():
    return F.lit(LAST_UPDATE).cast("timestamp_ntz").alias("last_update")


def country(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country"))


def city(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
    )


def address(t: Tables) -> DataFrame:
    number = F.col("n_nationkey").cast("string")
    return t.nation.select(
        F.col("n_nationkey").alias("address_id"),
        F.concat(number, F.lit(" Main Street")).alias("address"),
        F.lit(None).cast("string").alias("address2"),
        F.col("n_name").alias("district"),
        F.col("n_nationkey").alias("city_id"),
        F.lpad(number, 5, "0").alias("postal_code"),
        F.concat(F.lit("555-"), F.lpad(number, 4, "0")).alias("phone"),
    )


def _name_parts(column: str):
    return F.split_part(F.col(column), F.lit("#"), F.lit(1)), F.split_part(F.col(column), F.lit("#"), F.lit(2))


def customer(t: Tables) -> DataFrame:
    first, last = _name_parts("c_name")
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("store_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), last, F.lit("@example.org")).alias("email"),
        F.col("c_nationkey").alias("address_id"),
        (F.col("c_acctbal") >= 5000).alias("activebool"),
        F.lit("1995-01-01").cast("date").alias("create_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_update"),
        F.lit(1).alias("active"),
    )


def staff(t: Tables) -> DataFrame:
    first, last = _name_parts("s_name")
    return t.supplier.select(
        F.col("s_suppkey").alias("staff_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.col("s_nationkey").alias("address_id"),
        F.concat(F.lower(first), last, F.lit("@example.org")).alias("email"),
        F.col("s_suppkey").alias("store_id"),
        (F.col("s_acctbal") >= 5000).alias("active"),
        F.concat(F.lower(first), last).alias("username"),
        last_update(),
    )


def store(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_suppkey").alias("manager_staff_id"),
        F.col("s_nationkey").alias("address_id"),
        last_update(),
    )


def film(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
        F.lit(2006).alias("release_year"),
        F.col("p_brand").alias("language_id"),
        F.col("p_size").alias("rental_duration"),
        F.col("p_retailprice").cast(MONEY).alias("rental_rate"),
        F.col("p_size").alias("length"),
        (F.col("p_retailprice") * 2).cast(MONEY).alias("replacement_cost"),
        F.lit("PG").alias("rating"),
        last_update(),
    )


def category(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_type").alias("category_id")).distinct().select(
        "category_id", F.concat(F.col("category_id"), F.lit("  ")).alias("name")
    )


def film_category(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id"))


def language(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_brand").alias("language_id")).distinct().select(
        "language_id", F.rpad("language_id", 20, " ").alias("name")
    )


def actor(t: Tables) -> DataFrame:
    first, last = _name_parts("s_name")
    return t.supplier.select(F.col("s_suppkey").alias("actor_id"), first.alias("first_name"), last.alias("last_name"))


def film_actor(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id")).distinct()


def inventory(t: Tables) -> DataFrame:
    """Copies: one per film and store; the pair itself is the copy's key."""
    pairs = t.lineitem.select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("store_id"))
    return spread(pairs, ["film_id", "store_id"], size_of=t.lineitem).distinct()


def line_amount():
    """Net line price, to the cent."""
    net = F.col("l_extendedprice").cast(MONEY) * (F.lit(1) - F.col("l_discount").cast(MONEY))
    return F.round(net, 2).cast(MONEY)


def rental_lines(t: Tables, amount_as_text: bool = False, dims: Dimensions | None = None, waived: Column | None = None) -> DataFrame:
    """One row per order line: taken on the order date, returned on the ship date, paid on the order date.

    ``amount_as_text`` writes amounts the way the rental source does, with a leading ``$``; those
    of ``waived`` lines as a word. With ``dims`` every surrogate key is looked up where it costs
    least: customers per order, before the lines multiply it, films on the lines while they are
    narrow, and the supplier's two roles in one lookup, last, as it adds most to a line. Amounts
    become text once the lines have moved.
    """
    amount = F.concat(F.lit("$"), F.col("amount").cast("string")) if amount_as_text else F.col("amount")
    if waived is not None:
        amount = F.when(F.col("__waived"), F.lit("waived")).otherwise(amount)
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("rental_id"),
        F.col("l_linenumber").alias("payment_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_shipdate").alias("return_date"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("returned_if_closed"),
        line_amount().alias("amount"),
        *([] if waived is None else [waived.alias("__waived")]),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
    )
    found = []
    if dims is not None:
        orders = resolve(orders, dims, ("customer",))
        lines = resolve(lines, dims, ("film",))
    lines = lines.join(orders, "rental_id")
    if dims is not None:
        roles = dims.staff.join(dims.store, F.col("staff_id") == F.col("store_id")).select("store_id", "staff_dim_id", "store_dim_id")
        lines = lines.join(splittable(roles), "store_id")
        found = ["customer_dim_id", "staff_dim_id", "film_dim_id", "store_dim_id"]
    return lines.select(
        "rental_id",
        "payment_id",
        F.concat_ws("-", "film_id", "store_id").alias("inventory_id"),
        "customer_id",
        F.col("store_id").alias("staff_id"),
        "film_id",
        "store_id",
        "rental_date",
        "return_date",
        "returned_if_closed",
        F.col("rental_date").alias("payment_date"),
        amount.alias("amount"),
        F.col("return_date").alias("last_update"),
        *found,
    )


def payment(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )


def tier_snapshot(t: Tables, until: str) -> DataFrame:
    """Customers with an order before ``until`` and the tier their spending gave them by then."""
    spent = t.orders.filter(F.col("o_orderdate") < F.lit(until).cast("timestamp_ntz")).groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("spent")
    )
    tier = F.when(F.col("spent") >= 1_000_000, "GOLD").when(F.col("spent") >= 300_000, "SILVER").otherwise("BRONZE")
    members = t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"))
    return members.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        tier.alias("tier"),
    )
