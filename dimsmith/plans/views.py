"""The named analytic views over the rental model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.text import full_name, name_case
from dimsmith.operators.lists import ordered_text


def located(address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return (
        address.select("address_id", "address", F.col("postal_code").alias("zip_code"), "phone", "city_id")
        .join(city.select("city_id", "city", "country_id"), "city_id")
        .join(country.select("country_id", "country"), "country_id")
        .drop("city_id", "country_id")
    )


def customer_list(customer: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return customer.join(located(address, city, country), "address_id").select(
        F.col("customer_id").alias("id"),
        full_name("first_name", "last_name").alias("name"),
        "address",
        "zip_code",
        "phone",
        "city",
        "country",
        F.when(F.col("activebool"), "active").otherwise("").alias("notes"),
        F.col("store_id").alias("sid"),
    )


def staff_list(staff: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    return staff.join(located(address, city, country), "address_id").select(
        F.col("staff_id").alias("id"),
        full_name("first_name", "last_name").alias("name"),
        "address",
        "zip_code",
        "phone",
        "city",
        "country",
        F.col("store_id").alias("sid"),
    )


def _film_list(film, film_category, category, film_actor, actor, shown, size_of) -> DataFrame:
    # A film without actors or category does not appear, so inner joins say it all.
    cast = film_actor.select("film_id", "actor_id").join(actor, "actor_id").select("film_id", shown.alias("__name"))
    names = ordered_text(cast, ["film_id"], "__name", name="actors", size_of=film_actor if size_of is None else size_of)
    return (
        film.join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", F.col("name").alias("category")), "category_id")
        .join(names, "film_id")
        .select(
            F.col("film_id").alias("fid"),
            "title",
            "description",
            "category",
            F.col("rental_rate").alias("price"),
            "length",
            "rating",
            "actors",
        )
    )


def film_list(film, film_category, category, film_actor, actor, size_of: DataFrame | None = None) -> DataFrame:
    """Films with category and the list of actor names. ``size_of`` is a table at least as long as the cast that is cheap to count."""
    return _film_list(film, film_category, category, film_actor, actor, full_name("first_name", "last_name"), size_of)


def cased_film_list(film, film_category, category, film_actor, actor, size_of: DataFrame | None = None) -> DataFrame:
    """As :func:`film_list`, with each name part in name casing and no blank between the parts."""
    shown = F.concat(name_case("first_name"), name_case("last_name"))
    return _film_list(film, film_category, category, film_actor, actor, shown, size_of)


def actor_info(actor, film_actor, film, film_category, category, size_of: DataFrame | None = None) -> DataFrame:
    """Per actor the titles grouped by category: ``Drama: A, B, Horror: C``.

    Titles are listed per actor and category first, then the categories per actor.
    """
    played = (
        film_actor.select("actor_id", "film_id")
        .join(film.select("film_id", "title"), "film_id")
        .join(film_category.select("film_id", "category_id"), "film_id")
        .join(category.select("category_id", "name"), "category_id")
    )
    size_of = film_actor if size_of is None else size_of
    per_category = ordered_text(played, ["actor_id", "name"], "title", name="__titles", size_of=size_of)
    entries = per_category.select("actor_id", F.concat("name", F.lit(": "), "__titles").alias("__entry"))
    info = ordered_text(entries, ["actor_id"], "__entry", name="film_info", size_of=size_of)
    return actor.select("actor_id", "first_name", "last_name").join(info, "actor_id", "left")


def sales_by_category(lines: DataFrame, film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Income per category, largest first. ``lines`` are rental lines; they are summed per film before the joins."""
    per_film = lines.groupBy("film_id").agg(F.sum("amount").alias("__amount"))
    named = per_film.join(film_category.select("film_id", "category_id"), "film_id").join(
        category.select("category_id", F.col("name").alias("category")), "category_id"
    )
    return named.groupBy("category").agg(F.sum("__amount").alias("total_sales")).orderBy(F.desc("total_sales"), "category")


def sales_by_store(
    lines: DataFrame, store: DataFrame, address: DataFrame, city: DataFrame, country: DataFrame, staff: DataFrame
) -> DataFrame:
    """Income per store with its place and manager, ordered by place."""
    per_store = lines.groupBy("store_id").agg(F.sum("amount").alias("total_sales"))
    manager = staff.select(
        F.col("staff_id").alias("manager_staff_id"), full_name("first_name", "last_name").alias("manager")
    )
    place = located(address, city, country).select("address_id", "city", "country")
    return (
        per_store.join(store.select("store_id", "manager_staff_id", "address_id"), "store_id")
        .join(place, "address_id")
        .join(manager, "manager_staff_id")
        .orderBy("country", "city", "store_id")
        .select(F.concat("city", F.lit(","), "country").alias("store"), "manager", "total_sales")
    )
