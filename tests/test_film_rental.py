"""Rental reports on hand-made tables: NULLs, ties, never rented and never returned copies."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.plans import film_rental as rental

T = dt.datetime


@pytest.fixture(scope="module")
def shop(spark):
    def frame(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return {
        "film": frame(
            "film_id int, title string, release_year int, rental_rate double, rental_rate_cents bigint, "
            "rental_duration int, replacement_cents bigint, rating string, language string",
            (1, "Alpha Dawn", 2017, 2.99, 299, 3, 1999, "G", "English"),
            (2, "beta dawn", 2019, 0.99, 99, 5, 999, "R", "English"),
            (3, "Gamma", 2018, 4.99, 499, 2, 2999, None, "French"),
            (4, "Delta", None, 4.99, 499, 2, 2999, "X", "French"),
            (5, "Alpha Dusk", 2016, 1.99, 199, 2, 2999, "PG", "French"),
        ),
        "film_category": frame("film_id int, category_id int", (1, 1), (2, 1), (3, 2), (5, 1)),
        "category": frame("category_id int, name string", (1, "Animation"), (2, "Drama"), (3, "Travel")),
        "inventory": frame(
            "inventory_id int, film_id int, store_id int",
            (11, 1, 1), (12, 1, 2), (21, 2, 1), (31, 3, 2), (51, 5, 1), (52, 5, 1),
        ),
        "rental": frame(
            "rental_id int, inventory_id int, customer_id int, rental_date timestamp_ntz, return_date timestamp_ntz",
            (1, 11, 1, T(2020, 1, 1, 10), T(2020, 1, 3, 10)),
            (2, 11, 2, T(2020, 2, 1, 10), T(2020, 2, 8, 12)),
            (3, 21, 1, T(2020, 1, 1, 10), None),
            (4, 51, 2, T(2020, 1, 5, 10), T(2020, 1, 6, 10)),
            (5, 31, 1, T(2020, 3, 1, 10), T(2020, 3, 20, 10)),
        ),
        "payment": frame(
            "payment_id int, customer_id int, staff_id int, rental_id int, amount_cents bigint, payment_date timestamp_ntz",
            (1, 1, 1, 1, 299, T(2020, 1, 1, 10)),
            (2, 2, 1, 2, 1000, T(2020, 2, 1, 10)),
            (3, 1, 2, 3, 99, T(2020, 4, 1, 0)),
            (4, 2, 2, 4, 199, T(2020, 1, 5, 10)),
            (5, 1, 2, 5, 500, T(2021, 1, 1, 0)),
        ),
        "customer": frame(
            "customer_id int, customer_name string, country string",
            (1, "Mia Stone", "Chile"), (2, "Pat Jonas", "China"), (3, "No Rentals", "Peru"),
        ),
        "store": frame("store_id int, address string, address2 string", (1, "1 Road", None), (2, "2 Road", "Flat B")),
        "actor": frame("actor_id int, name string", (1, "A"), (2, "B"), (3, "C")),
        "film_actor": frame("actor_id int, film_id int", (1, 1), (1, 2), (1, 5), (2, 3), (2, 4), (3, 4)),
    }


@pytest.fixture(scope="module")
def payments(shop):
    return rental.resolved_payments(shop["payment"], shop["rental"], shop["inventory"])


@pytest.fixture(scope="module")
def rentals(shop):
    return rental.resolved_rentals(shop["rental"], shop["inventory"])


def test_category_list_forms_agree(shop):
    tables = (shop["film"], shop["film_category"], shop["category"])
    forms = [
        rows_of(rental.titles_in_category(*tables, "ANIMATION", (2016, 2018), 1, by_membership=m)) for m in (False, True)
    ]
    assert forms[0] == forms[1] == [("Alpha Dawn",), ("Alpha Dusk",)]


def test_store_revenue_forms_agree(shop, payments):
    forms = [
        rows_of(rental.revenue_by_store(payments, shop["store"], dt.date(2020, 1, 2), first)) for first in (True, False)
    ]
    assert forms[0] == forms[1] == [(1, "1 Road", Decimal("12.98")), (2, "2 Road, Flat B", Decimal("5.00"))]


def test_genre_forms_agree_on_known_years(shop):
    genres = {"dramas": "drama", "cartoons": "animation", "trips": "TRAVEL"}
    tables = (shop["film"], shop["film_category"], shop["category"])
    joined = rows_of(rental.genre_counts_by_year(*tables, genres))
    looked_up = rows_of(rental.genre_counts_by_lookup(*tables, genres))
    assert joined == looked_up
    assert (2018, 1, 0, 0) in joined and (2017, 0, 1, 0) in joined and (None, 0, 0, 0) in joined


def test_top_lists(shop, payments, rentals):
    busiest = rental.busiest_actors(shop["film_actor"], shop["film"], shop["actor"], 2015, k=2)
    assert [tuple(r) for r in busiest.collect()] == [(1, 3, "A"), (2, 1, "B")]
    most = rental.most_rented(rentals, shop["film"], k=2)
    assert [tuple(r)[1:] for r in most.collect()] == [
        ("Alpha Dawn", 2, "G – General Audiences (All ages admitted)"),
        ("beta dawn", 1, "R – Restricted (Under 17 requires parent)"),
    ]
    known = shop["actor"].filter("actor_id <> 1")  # the busiest has no row
    assert [r.actor_id for r in rental.busiest_actors(shop["film_actor"], shop["film"], known, 2015, k=1).collect()] == [2]
    unrated = rental.most_rented(rentals.filter("film_id = 3"), shop["film"])
    assert unrated.first().expected_audience == "Not Rated"
    staff = shop["store"].select(F.col("store_id").alias("staff_id"), F.lit("S").alias("staff_name"), "address", "address2")
    assert [tuple(r) for r in rental.best_staff(payments, staff, 2020, 1).collect()] == [
        (1, "S", Decimal("12.99"), "1 Road")
    ]


def test_pauses_and_inactivity(shop):
    years = rental.actor_years(shop["film_actor"], shop["film"])
    expected = [(1, "A", 2)]
    assert rows_of(rental.longest_pause(years, shop["actor"])) == expected
    assert rows_of(rental.longest_pause(years, shop["actor"], by_set=True)) == expected
    idle = rental.years_since_last_film(years, shop["actor"], 2024)
    assert [tuple(r) for r in idle.collect()] == [(3, "C", None), (2, "B", 6), (1, "A", 5)]


def test_category_revenue_of_a_quarter(shop, payments):
    named = shop["film_category"].join(shop["category"], "category_id").select("film_id", F.col("name").alias("category"))
    out = rental.category_revenue_in_quarter(payments, named, dt.date(2020, 3, 31))
    assert [tuple(r) for r in out.collect()] == [("Animation", Decimal("14.98"))]
    assert rental.category_revenue_in_quarter(payments, named).collect() == []


def test_popular_film_by_country(shop, rentals):
    def popular(pattern, **options):
        placed = rentals.join(shop["customer"], "customer_id")
        return rental.most_popular_by_country(placed, shop["film"], shop["customer"], pattern, ["title"], **options)

    assert rows_of(popular("ch%")) == [("Chile", "Alpha Dawn", 1), ("China", "Alpha Dawn", 1)]
    assert rows_of(popular("PERU", check=False)) == []
    with pytest.raises(LookupError, match="no rental information"):
        popular("PERU")
    with pytest.raises(LookupError):
        popular("atlantis")
    assert popular("atlantis", check=False).collect() == []
    with pytest.raises(ValueError):
        popular(" ")


def test_stock_by_title(shop):
    def stock(pattern, **options):
        out = rental.in_stock_by_title(
            shop["film"], shop["inventory"], shop["rental"], shop["customer"], pattern, **options
        )
        return [tuple(r) for r in out.collect()]

    alpha = (1, "Alpha Dawn", "English", "Pat Jonas", T(2020, 2, 1, 10))
    dusk = (2, "Alpha Dusk", "French", "Pat Jonas", T(2020, 1, 5, 10))
    assert sorted(stock("%ALPHA%")) == [alpha, dusk]
    never_rented = stock("%alpha%", never_rented_first=True)
    assert sorted(never_rented) == [(1, "Alpha Dawn", "English", "", None), (2, "Alpha Dusk", "French", "", None)]
    assert stock("%beta%") == [(1, "No films in stock matching pattern: %beta%", None, None, None)]
    assert stock("Delta")[0][1].startswith("No films in stock")
    with pytest.raises(ValueError):
        stock("")


def test_loyal_and_active_customers(shop, rentals):
    paid = shop["payment"]
    loyal = rental.loyal_customers(paid, shop["customer"], 1, 1100, dt.date(2020, 4, 1))
    assert rows_of(loyal.select("customer_id")) == [(2,)]
    assert rental.loyal_customers(paid, shop["customer"], 2, 1100, dt.date(2020, 4, 1)).collect() == []
    active = rental.high_activity_customers(shop["customer"].select("customer_id"), rentals, paid, 2, 2)
    assert [tuple(r) for r in active.collect()] == [(1, 3, 3)]


def test_balances_by_hand(shop, rentals):
    as_of = dt.date(2020, 6, 1)
    out = rental.customer_balances(shop["customer"].select("customer_id"), rentals, shop["film"], shop["payment"], as_of)
    # Customer 1: film 1 back in time; film 2 still out after 151 days, so its replacement; film 3 back after 19
    # days of 2: 17 days late and its replacement. Customer 2: film 1 back after 7 days and 2 hours of 3: 4 days
    # late and, 7 > 6, its replacement; film 5 back in time.
    late_1, late_2 = 9_99 + 17_00 + 29_99, 4_00 + 19_99
    rent_1, rent_2 = 2_99 + 99 + 4_99, 2_99 + 1_99
    money = [Decimal(c) / 100 for c in (rent_1, late_1, 3_98, rent_1 + late_1 - 3_98)]
    other = [Decimal(c) / 100 for c in (rent_2, late_2, 11_99, rent_2 + late_2 - 11_99)]
    zero = [Decimal("0.00")] * 4
    assert rows_of(out) == [(1, *money), (2, *other), (3, *zero)]
    rounded = rental.customer_balances(
        shop["customer"].select("customer_id"), rentals, shop["film"], shop["payment"], as_of, round_late_fees=True
    )
    assert {r.customer_id: r.late_fees for r in rounded.collect()} == {1: Decimal(57), 2: Decimal(24), 3: Decimal(0)}


def test_new_films(spark, shop):
    language = spark.createDataFrame([(3, "Klingon "), (2, "klingon"), (1, "English")], "language_id int, name string")
    batch = spark.createDataFrame(
        [("GAMMA", 2020, "English"), ("New One", None, None), ("new one", 2001, "english"), (" ", 2000, "English"), ("X", 2000, "Elvish")],
        "title string, release_year int, language_name string",
    )
    rows, rejects = rental.new_films(shop["film"].select("film_id", "title"), language, batch, dt.date(2024, 5, 1))
    assert rows_of(rows.select("film_id", "title", "release_year", "language_id", "rating")) == [
        (6, "New One", 2024, 2, "G")
    ]
    assert rows_of(rejects.select("title", "reject_reason")) == [
        (" ", "title must not be empty"),
        ("X", "language not found"),
    ]
    again = shop["film"].select("film_id", "title").unionByName(rows.select(F.col("film_id").cast("int"), "title"))
    assert rental.new_films(again, language, batch, dt.date(2024, 5, 1))[0].collect() == []


def test_rent_and_pay_once(spark, shop):
    requests = spark.createDataFrame([(1, 5), (1, 1), (1, 5), (3, 3)], "customer_id int, film_id int")
    homes = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "customer_id int, store_id int")
    staff = spark.createDataFrame([(9, 1), (4, 1), (6, 2)], "staff_id int, store_id int")
    days = dt.date(2024, 5, 1), dt.date(2017, 1, 1)
    tables = (homes, shop["film"], shop["inventory"], staff, shop["rental"], shop["payment"])
    rentals, payments = rental.rent_films(requests, *tables, *days)
    # Film 1 in store 1 was rented by customer 1 before; film 3 is not in store 1.
    assert rows_of(rentals) == [
        (6, days[0], 1, 51, dt.date(2024, 5, 3), 4),
        (7, days[0], 1, 52, dt.date(2024, 5, 3), 4),
    ]
    assert rows_of(payments) == [(6, 1, 4, 6, 199, days[1]), (7, 1, 4, 7, 199, days[1])]


def test_one_copy_has_one_renter(spark, shop):
    requests = spark.createDataFrame([(2, 2), (1, 2), (3, 5), (1, 5), (4, 5), (8, 5), (1, 9), (3, 3)], "customer_id int, film_id int")
    homes = spark.createDataFrame([(c, 1) for c in (1, 2, 3, 4)], "customer_id int, store_id int")
    staff = spark.createDataFrame([(9, 1)], "staff_id int, store_id int")
    day = dt.date(2024, 5, 1)
    tables = (homes, shop["film"], shop["inventory"], staff, shop["rental"], shop["payment"], day, day)

    def rented(one_each):
        rentals, payments = rental.rent_films(requests, *tables, one_each=one_each)
        unmet = rental.unmet_requests(requests, homes, shop["film"], shop["inventory"], rentals)
        assert payments.count() == rentals.count()
        return [(r.customer_id, r.inventory_id) for r in rentals.collect()], rows_of(unmet)

    unknown = [(1, 9, "film not found"), (3, 3, "no copy in the store"), (8, 5, "customer not found")]
    # Copy 21 was with customer 1 before, so customer 2 gets it; copies 51 and 52 go to the two lowest customers.
    given, unmet = rented(one_each=True)
    assert sorted(given) == [(1, 51), (2, 21), (3, 52)]
    assert unmet == sorted([(1, 2, "no copy left"), (4, 5, "no copy left"), *unknown], key=repr)
    given, unmet = rented(one_each=False)
    assert sorted(given) == [(1, 51), (1, 52), (2, 21)]
    assert unmet == sorted([(1, 2, "no copy left"), (3, 5, "no copy left"), (4, 5, "no copy left"), *unknown], key=repr)
