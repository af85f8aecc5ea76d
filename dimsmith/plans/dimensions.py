"""Builders of the entity, junk and conformed dimensions from the source tables.

Joins name no strategy: the lookup-sized sides are broadcast by their statistics, larger ones are
sort-merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.text import clean_key, full_name
from dimsmith.operators.dedup import latest_per_key
from dimsmith.operators.keys import assign_surrogate_keys
from dimsmith.operators.lists import ordered_array
from dimsmith.operators.scd import OPEN_END, VersionColumns, scd2_initial
from dimsmith.session import settle

# Surrogate keys of films start after 1000, those of stores after 100.
FILM_KEY_OFFSET = 1000
STORE_KEY_OFFSET = 100

CUSTOMER_VERSION = VersionColumns("customer_dim_id")
CUSTOMER_TRACKED = ("first_name", "last_name", "email", "address", "address2", "district", "postal_code", "phone")
ADDRESS_COLUMNS = ("address", "address2", "district", "postal_code", "phone")


def customer_members(staged_customer: DataFrame, staged_address: DataFrame, load_date: str = "load_date") -> DataFrame:
    """One row per customer with the address columns, from the latest load of both staging tables."""
    customer = latest_per_key(staged_customer, ["customer_id"], load_date)
    address = latest_per_key(staged_address, ["address_id"], load_date).select("address_id", *ADDRESS_COLUMNS)
    return customer.join(address, "address_id").select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "activebool",
        *ADDRESS_COLUMNS,
        "create_date",
        "last_update",
        "active",
    )


def customer_dimension(members: DataFrame, ranges: int | None = None, size_of: DataFrame | None = None) -> DataFrame:
    """First load of the type 2 customer dimension."""
    start = F.coalesce(F.to_date("last_update"), F.col("create_date"))
    return scd2_initial(members, "customer_id", CUSTOMER_VERSION, start, ranges, size_of)


def _open_version(df: DataFrame, valid_from: Column) -> DataFrame:
    return df.select(
        "*",
        valid_from.cast("date").alias("valid_from"),
        F.lit(OPEN_END).cast("date").alias("valid_to"),
        F.lit(1).alias("dim_active"),
    )


def staff_dimension(staff: DataFrame, address: DataFrame, size_of: DataFrame | None = None) -> DataFrame:
    """Staff with address; the activity flag becomes 1 or 0 and text is trimmed."""
    text = ("first_name", "last_name", "email", "username")
    people = staff.join(address.select("address_id", *ADDRESS_COLUMNS), "address_id").select(
        "staff_id",
        *[F.trim(c).alias(c) for c in ("first_name", "last_name", *ADDRESS_COLUMNS, "email")],
        F.when(F.col("active"), 1).otherwise(0).alias("active"),
        F.trim("username").alias("username"),
        "last_update",
        *[c for c in staff.columns if c == "picture" and c not in text],
    )
    return assign_surrogate_keys(
        _open_version(people, F.to_date("last_update")), ["staff_id"], "staff_dim_id", size_of=size_of or staff
    )


def film_actors(film_actor: DataFrame, actor: DataFrame, key: str = "film_id", size_of: DataFrame | None = None) -> DataFrame:
    """Names of a film's actors as a sorted array. ``size_of`` is as for :func:`ordering.ordered`."""
    names = film_actor.join(actor, "actor_id").select(key, full_name("first_name", "last_name").alias("__name"))
    return ordered_array(names, [key], "__name", "actors", size_of=film_actor if size_of is None else size_of)


def film_dimension(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    language: DataFrame,
    film_actor: DataFrame,
    actor: DataFrame,
    carried: Sequence[str] = (),
    size_of: DataFrame | None = None,
) -> DataFrame:
    """Films with category, language and the array of actors; films without actors are left out.

    ``carried`` are further film columns to keep (such as ``special_features``); ``size_of`` is a
    table at least as long as the cast that is cheap to count.
    """
    films = (
        film.join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", F.trim("name").alias("category_name")), "category_id")
        .join(language.select("language_id", F.trim("name").alias("language_name")), "language_id")
        .join(film_actors(film_actor, actor, size_of=size_of), "film_id")
        .select(
            "film_id",
            F.trim("title").alias("title"),
            F.trim("description").alias("description"),
            "category_name",
            "release_year",
            "language_name",
            "rental_duration",
            "rental_rate",
            "length",
            "replacement_cost",
            "rating",
            "last_update",
            *carried,
            "actors",
        )
    )
    versions = _open_version(films, F.to_date("last_update"))
    return assign_surrogate_keys(versions, ["film_id"], "film_dim_id", FILM_KEY_OFFSET, size_of=film)


def store_managers(store: DataFrame, address: DataFrame, staff: DataFrame) -> DataFrame:
    """Stores with the full name of the manager and the address."""
    manager = staff.select(
        F.col("staff_id").alias("manager_staff_id"), full_name("first_name", "last_name").alias("manager_staff_name")
    )
    place = address.select(
        "address_id", F.col("address").alias("store_address"), F.col("address2").alias("store_address2")
    )
    return store.join(place, "address_id").join(manager, "manager_staff_id")


def store_dimension(store: DataFrame, address: DataFrame, staff: DataFrame) -> DataFrame:
    stores = store_managers(store, address, staff).select(
        "store_id",
        *[F.trim(c).alias(c) for c in ("manager_staff_name", "store_address", "store_address2")],
        F.to_date("last_update").alias("__start"),
    )
    versions = _open_version(stores, F.col("__start")).drop("__start")
    return assign_surrogate_keys(versions, ["store_id"], "store_dim_id", STORE_KEY_OFFSET, size_of=store)


def junk_film(
    film: DataFrame, language: DataFrame, film_category: DataFrame, category: DataFrame, load_date: str
) -> DataFrame:
    """Film attributes with category and language names, stamped with the load time."""
    return (
        film.join(language.select("language_id", F.trim("name").alias("language_name")), "language_id")
        .join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", F.col("name").alias("category_name")), "category_id")
        .select(
            "film_id",
            "title",
            "description",
            "category_name",
            "language_name",
            "rental_duration",
            "rental_rate",
            "length",
            "replacement_cost",
            "rating",
            "release_year",
            *[c for c in ("special_features", "fulltext") if c in film.columns],
            F.lit(load_date).alias("load_date"),
        )
    )


def junk_dimension(df: DataFrame, flags: Sequence[str], key: str = "junk_dim_id") -> DataFrame:
    """The combinations of low-cardinality flags that occur, with a surrogate key in value order.

    Combinations are reduced inside each task before the shuffle, so ``df`` may be a whole fact.
    They are settled before they are counted and numbered, so ``df`` is read once.
    """
    combinations = settle(df.select(*flags).distinct())
    return assign_surrogate_keys(combinations, list(flags), key, stored=True)


def conformed_customer(bridge: DataFrame, ids: Mapping[str, str]) -> DataFrame:
    """The bridge between the customer ids of several systems, each id as clean text.

    ``ids`` maps output names to bridge columns.
    """
    return bridge.select(*[clean_key(column).alias(name) for name, column in ids.items()]).distinct()


def drill_across(
    bridge: DataFrame,
    staged_customer: DataFrame,
    tweets: DataFrame,
    load_date: str = "load_date",
) -> DataFrame:
    """Tweets per sentiment of every customer who rents.

    Both facts meet on the conformed ids.  Tweets are counted per author and sentiment before the
    join, so an author with very many tweets brings only a few rows to it.
    """
    customer = latest_per_key(staged_customer, ["customer_id"], load_date).select(
        F.col("customer_id").cast("long").alias("customer_id"), "first_name", "last_name"
    )
    counted = tweets.groupBy(clean_key("name").alias("__author"), "sentiment").agg(F.count(F.lit(1)).alias("num_tweets"))
    ids = bridge.select(
        "customer_conformed_id",
        "rental_customer_id",
        clean_key("twitter_id").alias("twitter_id"),
        F.col("rental_customer_id").try_cast("long").alias("customer_id"),
    )
    joined = ids.join(customer, "customer_id").join(counted, F.col("twitter_id") == F.col("__author"))
    return joined.groupBy(
        "customer_conformed_id", "rental_customer_id", "twitter_id", "first_name", "last_name", "sentiment"
    ).agg(F.sum("num_tweets").alias("num_tweets"))
