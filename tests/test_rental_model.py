"""The builders on the rental model's own tables: dimensions, facts, views, stock, rewards."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimsmith.operators import stock
from dimsmith.plans import dimensions, facts, views
from dimsmith.plans.calendars import date_dimension, time_dimension, week_attributes, week_dimension, week_month_attributes
from dimsmith.session import fresh_path
from dimsmith.sources import layout, series
from tests.conftest import tuples

STAMP = datetime.datetime(2006, 2, 15, 9, 57, 12)
AT = datetime.datetime.fromisoformat


@pytest.fixture(scope="module")
def model(spark):
    make = spark.createDataFrame
    stamp = lambda df: df.withColumn("last_update", F.lit("2006-02-15 09:57:12").cast("timestamp_ntz"))
    return {
        "address": make(
            [(1, "8 Harbour Street", None, "North", 1, "", "1"), (2, "3 Market Place", None, "South", 2, "", "2"),
             (3, "15 Mill Road ", None, "North", 1, " ", "555-0103"), (4, "77 Garden Row", None, "South", 2, "", "555-0104")],
            "address_id int, address string, address2 string, district string, city_id int, postal_code string, phone string",
        ),
        "city": make([(1, "Norton", 1), (2, "Sutton", 2)], "city_id int, city string, country_id int"),
        "country": make([(1, "Northland"), (2, "Southland")], "country_id int, country string"),
        "staff": make(
            [(1, "Tom", "Field", 3, "tom@shop.example", 1, True, "Tom"), (2, "Kim", "Porter", 4, "kim@shop.example", 2, False, "Kim")],
            "staff_id int, first_name string, last_name string, address_id int, email string, store_id int, active boolean, username string",
        ).withColumn("last_update", F.lit("2006-05-16 16:13:11").cast("timestamp_ntz")),
        "store": stamp(make([(1, 1, 1), (2, 2, 2)], "store_id int, manager_staff_id int, address_id int")),
        "customer": make(
            [(1, 1, "ANNA", "BERG", "m@x", 1, True), (2, 2, "OLE", "DAHL", None, 2, False), (5, 1, "IRIS", "FALK", "e@x", 3, True)],
            "customer_id int, store_id int, first_name string, last_name string, email string, address_id int, activebool boolean",
        ).withColumn("create_date", F.lit("2006-02-14").cast("date")).withColumn("last_update", F.lit(None).cast("timestamp_ntz")).withColumn("active", F.lit(1)),
        "film": stamp(make(
            [(1, "QUIET RIVER", "An epic", 2006, 1, 6, Decimal("0.99"), 86, Decimal("20.99"), "PG"),
             (2, "RED TOWER", "A tale", 2006, 1, 3, Decimal("4.99"), 48, Decimal("12.99"), "G"),
             (3, "SAND", "A lonely film", 2006, 1, 3, Decimal("4.99"), 48, Decimal("12.99"), "G")],
            "film_id int, title string, description string, release_year int, language_id int, rental_duration int, rental_rate decimal(4,2), length int, replacement_cost decimal(5,2), rating string",
        )),
        "language": make([(1, "English             ")], "language_id int, name string"),
        "category": make([(1, "Action"), (2, "Horror")], "category_id int, name string"),
        "film_category": make([(1, 1), (2, 2), (3, 1)], "film_id int, category_id int"),
        "actor": make([(1, "MARTA", "LIND"), (2, "ADAM", "grau"), (3, "ED", "HOLM")], "actor_id int, first_name string, last_name string"),
        "film_actor": make([(1, 1), (2, 1), (1, 2)], "actor_id int, film_id int"),
        "inventory": make([(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 2, 1)], "inventory_id int, film_id int, store_id int"),
        "rental": make(
            [(1, AT("2005-05-24 22:53:30"), 1, 1, AT("2005-05-26 22:04:30"), 1), (2, AT("2005-05-31 08:00:00"), 2, 1, AT("2005-06-20 08:00:00"), 2),
             (3, AT("2005-06-01 23:59:00"), 3, 2, None, 1)],
            "rental_id int, rental_date timestamp_ntz, inventory_id int, customer_id int, return_date timestamp_ntz, staff_id int",
        ).withColumn("last_update", F.lit("2006-02-15 21:30:53").cast("timestamp_ntz")),
        "payment": make(
            [(10, 1, 1, 1, "$2.99", AT("2005-05-25 11:30:00")), (11, 1, 2, 2, "$0.99", AT("2005-06-02 00:01:00")),
             (12, 1, 2, 2, "$1.00", AT("2005-06-03 00:01:00")), (13, 2, 1, 3, "$4.99", AT("2005-06-02 00:00:00"))],
            "payment_id int, customer_id int, staff_id int, rental_id int, amount string, payment_date timestamp_ntz",
        ),
    }


def test_staff_and_store_dimensions(model):
    staff = dimensions.staff_dimension(model["staff"], model["address"])
    shown = tuples(staff, "staff_dim_id", "staff_id", "first_name", "address", "postal_code", "active", F.col("valid_from").cast("string"), F.col("valid_to").cast("string"), "dim_active")
    assert shown == [
        (1, 1, "Tom", "15 Mill Road", "", 1, "2006-05-16", "9999-12-31", 1),
        (2, 2, "Kim", "77 Garden Row", "", 0, "2006-05-16", "9999-12-31", 1),
    ]
    store = dimensions.store_dimension(model["store"], model["address"], model["staff"])
    assert tuples(store, "store_dim_id", "store_id", "manager_staff_name", "store_address") == [
        (101, 1, "Tom Field", "8 Harbour Street"),
        (102, 2, "Kim Porter", "3 Market Place"),
    ]


def film_dimension(model):
    names = ("film", "film_category", "category", "language", "film_actor", "actor")
    return dimensions.film_dimension(*[model[n] for n in names])


def test_film_dimension(model):
    got = tuples(film_dimension(model), "film_dim_id", "film_id", "title", "category_name", "language_name", "actors")
    assert got == [
        (1001, 1, "QUIET RIVER", "Action", "English", ["ADAM grau", "MARTA LIND"]),
        (1002, 2, "RED TOWER", "Horror", "English", ["MARTA LIND"]),
    ]


def test_customer_dimension_takes_the_latest_load(model):
    old = model["customer"].withColumn("last_name", F.lit("OLD")).withColumn("load_date", F.lit("2020-01-01"))
    staged = old.unionByName(model["customer"].withColumn("load_date", F.lit("2020-01-02")))
    address = model["address"].withColumn("load_date", F.lit("2020-01-01"))
    dim = dimensions.customer_dimension(dimensions.customer_members(staged, address))
    assert tuples(dim, "customer_dim_id", "customer_id", "last_name", F.col("valid_from").cast("string")) == [
        (1, 1, "BERG", "2006-02-14"),
        (2, 2, "DAHL", "2006-02-14"),
        (3, 5, "FALK", "2006-02-14"),
    ]


def test_junk_film(model):
    got = dimensions.junk_film(model["film"], model["language"], model["film_category"], model["category"], "2020-01-01")
    assert tuples(got, "film_id", "category_name", "language_name") == [(1, "Action", "English"), (2, "Horror", "English"), (3, "Action", "English")]


def star(model):
    address = model["address"].withColumn("load_date", F.lit("1"))
    members = dimensions.customer_members(model["customer"].withColumn("load_date", F.lit("1")), address)
    return facts.Dimensions(
        customer=dimensions.customer_dimension(members),
        staff=dimensions.staff_dimension(model["staff"], model["address"]),
        film=film_dimension(model),
        store=dimensions.store_dimension(model["store"], model["address"], model["staff"]),
    )


def lines(model, dims=None):
    return facts.rental_lines(model["rental"], model["payment"], model["inventory"], model["staff"], dims)


@pytest.mark.parametrize("early", [False, True])
def test_transaction_fact(model, early):
    dims = star(model)
    fact = facts.transaction_fact(lines(model, dims if early else None), dims).drop("last_update")
    assert tuples(fact) == [
        (1, 10, 1, 20050525, "11:30", 20050524, "22:53", 20050526, "22:04", 1, 1, 1001, 101, Decimal("2.99")),
        (2, 11, 2, 20050602, "00:01", 20050531, "08:00", 20050620, "08:00", 1, 2, 1001, 102, Decimal("0.99")),
        (2, 12, 2, 20050603, "00:01", 20050531, "08:00", 20050620, "08:00", 1, 2, 1001, 102, Decimal("1.00")),
        (3, 13, 3, 20050602, "00:00", 20050601, "23:59", None, None, 2, 1, 1002, 101, Decimal("4.99")),
    ]


def test_rejected_lines(model):
    dims = star(model)
    without = facts.Dimensions(dims.customer.filter("customer_id = 1"), dims.staff, dims.film.withColumn("dim_active", F.lit(0)), dims.store)
    rejects = facts.rejected_lines(lines(model), without)
    assert tuples(rejects.groupBy("missing_in").count()) == [("customer", 1), ("film", 4)]
    assert facts.transaction_fact(lines(model), without).isEmpty()


def test_match_on_descriptive_columns(model):
    dims = star(model)
    named = lines(model).join(model["customer"].select("customer_id", F.col("email").alias("customer_email")), "customer_id")
    match = {"customer": {"customer_id": "customer_id", "customer_email": "email"}}
    found = facts.resolve(named, dims, ("customer",), match=match)
    # Customer 2 has no address to compare, so their line is rejected.
    assert tuples(found, "payment_id", "customer_dim_id") == [(10, 1), (11, 1), (12, 1)]
    assert tuples(facts.rejected_lines(named, dims, ("customer",), match), "payment_id") == [(13,)]


def test_periodic_fact_has_one_row_per_week_over_a_month_end(model):
    fact = facts.periodic_fact(lines(model), star(model), 200521, 200540)
    assert tuples(fact) == [
        (200521, 1001, 101, 1, Decimal("2.99")),
        (200522, 1001, 102, 2, Decimal("1.99")),
        (200522, 1002, 101, 1, Decimal("4.99")),
    ]


def test_average_time_fact(model):
    rentals = model["rental"].join(model["inventory"], "inventory_id")
    fact = facts.average_time_fact(rentals, star(model))
    assert tuples(fact) == [
        (20050501, 1, 1001, 101, 2.0, 2, 1),
        (20050501, 2, 1001, 102, 20.0, 20, 1),
        (20050601, 3, 1002, 101, None, None, 0),
    ]


def test_list_views(model):
    got = views.customer_list(model["customer"], model["address"], model["city"], model["country"])
    assert tuples(got, "id", "name", "country", "notes")[:2] == [(1, "ANNA BERG", "Northland", "active"), (2, "OLE DAHL", "Southland", "")]
    assert views.staff_list(model["staff"], model["address"], model["city"], model["country"]).count() == 2
    names = [model[n] for n in ("film", "film_category", "category", "film_actor", "actor")]
    assert tuples(views.film_list(*names), "fid", "actors") == [(1, "ADAM grau, MARTA LIND"), (2, "MARTA LIND")]
    assert tuples(views.cased_film_list(*names), "fid", "actors") == [(1, "AdamGrau, MartaLind"), (2, "MartaLind")]
    info = views.actor_info(model["actor"], model["film_actor"], model["film"], model["film_category"], model["category"])
    assert tuples(info, "actor_id", "film_info") == [
        (1, "Action: QUIET RIVER, Horror: RED TOWER"),
        (2, "Action: QUIET RIVER"),
        (3, None),
    ]


def test_sales_views(model):
    by_category = views.sales_by_category(lines(model), model["film_category"], model["category"])
    assert [tuple(r) for r in by_category.collect()] == [("Action", Decimal("4.98")), ("Horror", Decimal("4.99"))][::-1]
    by_store = views.sales_by_store(lines(model), *[model[n] for n in ("store", "address", "city", "country", "staff")])
    assert [tuple(r) for r in by_store.collect()] == [
        ("Norton,Northland", "Tom Field", Decimal("7.98")),
        ("Sutton,Southland", "Kim Porter", Decimal("1.99")),
    ]


def test_stock(model):
    inventory, rental = model["inventory"], model["rental"]
    assert tuples(stock.in_stock(inventory, rental), "inventory_id") == [(1,), (2,), (4,)]
    assert tuples(stock.film_in_stock(inventory, rental, 2, 1)) == [(4,)]
    assert tuples(stock.film_not_in_stock(inventory, rental, 2, 1)) == [(3,)]
    assert tuples(stock.held_by_customer(rental)) == [(3, 2)]
    assert tuples(stock.stock_counts(inventory, rental)) == [(1, 1, 1, 0), (1, 2, 1, 0), (2, 1, 1, 1)]


def balance(model, as_of, **kwargs):
    rental = model["rental"].join(model["inventory"], "inventory_id")
    payment = model["payment"].withColumn("amount", F.replace("amount", F.lit("$")).cast("decimal(5,2)"))
    return tuples(stock.customer_balance(rental, model["film"], payment, as_of, **kwargs), "customer_id", "balance")


def test_customer_balance(model):
    # Customer 1: two fees of 0.99, 14 days late with the second film, 4.98 paid.
    assert balance(model, "2006-01-01") == [(1, Decimal("11.00")), (2, Decimal("0.00"))]
    assert balance(model, "2005-05-25") == [(1, Decimal("0.99"))]
    assert balance(model, "2006-01-01", charge_replacement=True)[0] == (1, Decimal("31.99"))


def test_rewards(model):
    payment = model["payment"].withColumn("amount", F.replace("amount", F.lit("$")).cast("decimal(5,2)"))
    got = stock.rewards_report(model["customer"], payment, 1, "1.50", as_of="2005-09-30")
    assert tuples(got, "customer_id") == [(1,)]
    assert stock.rewards_report(model["customer"], payment, 2, "1.50", as_of="2005-09-30").isEmpty()
    for purchases, amount in ((0, 1), (1, 0)):
        with pytest.raises(ValueError):
            stock.rewards_report(model["customer"], payment, purchases, amount, as_of="2005-09-30")


def test_drill_across(spark, model):
    bridge = spark.createDataFrame(
        [("1", "1", " anna "), ("2", "2", "ole"), ("3", "n/a", "ghost")], "customer_conformed_id string, rental_customer_id string, twitter_id string"
    )
    tweets = spark.createDataFrame([("anna", "positive"), (" anna", "positive"), ("ole", "negative"), ("ghost", "neutral")], "name string, sentiment string")
    staged = model["customer"].withColumn("load_date", F.lit("1"))
    got = dimensions.drill_across(bridge, staged, tweets)
    assert tuples(got, "twitter_id", "first_name", "sentiment", "num_tweets") == [
        ("anna", "ANNA", "positive", 2),
        ("ole", "OLE", "negative", 1),
    ]


def test_conformed_customer_trims(spark):
    bridge = spark.createDataFrame([(" 1", "a "), ("1", "a")], "x string, y string")
    assert tuples(dimensions.conformed_customer(bridge, {"rental": "x", "crm": "y"})) == [("1", "a")]


def test_calendars(spark):
    dates = date_dimension(spark)
    assert dates.count() == 7653
    row = dates.filter("date_id = 20000101").collect()[0]
    assert (row.monthname, row.weekdayname, row.formatteddate, row.yearcalendarweek, row.period, row.americanholiday) == (
        "January", "Saturday", "01. 01. 2000", "1999/52", "Winter break", "Holiday",
    )
    assert (row.cwstart, row.cwend, row.monthend) == (datetime.date(1999, 12, 27), datetime.date(2000, 1, 2), datetime.date(2000, 1, 31))
    assert dates.agg(F.max("date_id")).collect()[0][0] == 20201213
    weeks = week_dimension(spark)
    assert weeks.count() == weeks.select("week_id").distinct().count()
    new_year = series.days(spark, "1999-12-31", 3)
    assert tuples(week_month_attributes(new_year), "week_id", "month") == [(199952, 12), (200052, 1)]
    assert tuples(week_attributes(new_year), "week_id") == [(199952,)]
    minutes = time_dimension(spark)
    assert minutes.count() == 1440
    shown = tuples(minutes.filter("minute in (0, 509, 510, 1349, 1439)"), "timeofday", "quarterhour", "daytimename", "daynight")
    assert shown == [
        ("00:00", "00:00 – 00:14", "Night", "Night"),
        ("08:29", "08:15 – 08:29", "Morning", "Day"),
        ("08:30", "08:30 – 08:44", "AM", "Day"),
        ("22:29", "22:15 – 22:29", "Evening", "Night"),
        ("23:59", "23:45 – 23:59", "Night", "Night"),
    ]


def test_a_filter_on_the_dimension_prunes_the_fact(spark, model):
    path = fresh_path(spark, "by-month")
    facts.write_by_month(lines(model), path)
    months = spark.createDataFrame([(20050501, "spring"), (20050601, "summer")], "rental_month int, season string").where("season = 'summer'")
    found = facts.in_months(spark.read.parquet(path), months)
    assert tuples(found, "rental_id") == [(3,)] * found.count() and found.count() > 0
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_bucketed_lookup_moves_no_line(spark):
    layout.write_bucketed_table(spark.range(1000).select((F.col("id") % 50).alias("film_id"), "id"), "some_lines", "film_id", 4)
    layout.write_bucketed_table(spark.range(50).select(F.col("id").alias("film_id"), (F.col("id") + 1000).alias("film_dim_id")), "some_films", "film_id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = facts.bucketed_lookup(spark, "some_lines", "some_films", "film_id", "film_dim_id")
        grouped = found.groupBy("film_id", "film_dim_id").count()
        assert grouped.count() == 50 and {r["count"] for r in grouped.collect()} == {20}
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
