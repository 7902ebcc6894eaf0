"""Reports over a rental shop.

Facts carry the keys a report needs, resolved once by ``resolved_payments`` / ``resolved_rentals``:
``payments``: customer_id, film_id, store_id, staff_id, payment_date, amount_cents;
``rentals``: rental_id, inventory_id, film_id, customer_id, rental_date, return_date (NULL while out).
Each report reads only the columns it uses.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.dates import in_window, in_years, months_later, ntz, quarter_bounds, whole_days
from salesloom.functions.money import from_cents
from salesloom.functions.text import concat_skip_nulls, folded, require_text, same_text
from salesloom.operators.changes import assign_keys, highest_key, rows_to_append
from salesloom.operators.gaps import longest_gap, longest_gap_by_set
from salesloom.operators.lookup import in_set, label_by_value, lowest_dimension_key, not_in_set, with_counts
from salesloom.operators.ordered import By, numbers_within
from salesloom.operators.ranking import latest_per_key, number_rows, top_k_per_group
from salesloom.sources.inline import with_fallback_row
from salesloom.sources.storage import frozen

# The audience text shown for each film rating.
AUDIENCE = {
    "G": "G – General Audiences (All ages admitted)",
    "PG": "PG – Parental Guidance Suggested",
    "PG-13": "PG-13 – Parents Strongly Cautioned (<13)",
    "R": "R – Restricted (Under 17 requires parent)",
    "NC-17": "NC-17 – Adults Only",
}
AUDIENCE_DEFAULT = "Not Rated"

# What a film gets when only its title, year and language are given.
NEW_FILM = {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99", "rating": "G"}
DEFAULT_LANGUAGE = "Klingon"


def resolved_payments(payment: DataFrame, rental: DataFrame, inventory: DataFrame) -> DataFrame:
    """Payments with the film and store of the rented copy."""
    return payment.join(rental.select("rental_id", "inventory_id"), "rental_id").join(
        inventory.select("inventory_id", "film_id", "store_id"), "inventory_id"
    )


def resolved_rentals(rental: DataFrame, inventory: DataFrame) -> DataFrame:
    return rental.join(inventory.select("inventory_id", "film_id", "store_id"), "inventory_id")


def titles_in_category(
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    name: str,
    years: tuple[int, int],
    min_rate: float,
    by_membership: bool = False,
) -> DataFrame:
    """Titles of one category (any case) released in ``years`` above a rental rate.

    ``by_membership`` filters the bridge through a semi-join instead of joining the category in.
    """
    wanted = category.filter(same_text(F.col("name"), name)).select("category_id")
    if by_membership:
        linked = in_set(film_category, wanted, "category_id")
    else:
        linked = film_category.join(wanted, "category_id")
    films = film.filter(F.col("release_year").between(*years) & (F.col("rental_rate") > min_rate))
    return films.join(linked.select("film_id"), "film_id").select("title").orderBy("title")


def _address(*parts: str) -> Column:
    return F.concat_ws(", ", *parts)


def revenue_by_store(
    payments: DataFrame, stores: DataFrame, since: dt.date, aggregate_first: bool = True
) -> DataFrame:
    """Revenue per store from a date on. ``stores``: store_id, address, address2 (may be NULL)."""
    paid = payments.filter(F.col("payment_date") >= ntz(since))
    total = F.sum("amount_cents").alias("cents")
    if aggregate_first:
        with_store = paid.groupBy("store_id").agg(total).join(stores, "store_id")
    else:
        with_store = paid.join(stores, "store_id").groupBy("store_id", "address", "address2").agg(total)
    return with_store.orderBy(F.col("cents").desc(), "store_id").select(
        "store_id", _address("address", "address2").alias("store_address"), from_cents("cents").alias("revenue")
    )


def busiest_actors(film_actor: DataFrame, film: DataFrame, actor: DataFrame, after_year: int, k: int = 5) -> DataFrame:
    """Actors with most films released after a year. ``film_actor`` holds each (actor, film) once."""
    recent = film.filter(F.col("release_year") > after_year)
    counts = (
        film_actor.select("actor_id", "film_id")
        .join(recent.select("film_id"), "film_id")
        .groupBy("actor_id")
        .agg(F.count("film_id").alias("number_of_movies"))
    )
    named = counts.join(actor, "actor_id")
    return named.orderBy(F.col("number_of_movies").desc(), "actor_id").limit(k)


def genre_counts_by_year(
    film: DataFrame, film_category: DataFrame, category: DataFrame, genres: Mapping[str, str]
) -> DataFrame:
    """Films per release year, one column per genre (``genres``: column name to genre, any case).

    Years without any such film, and the NULL year, are kept.
    """
    per_film = film.groupBy("release_year", "film_id").agg(F.count(F.lit(1)).alias("films"))
    linked = per_film.join(film_category, "film_id", "left").join(category, "category_id", "left")
    cells = [
        F.sum(F.when(same_text(F.col("name"), genre), F.col("films")).otherwise(0)).alias(column)
        for column, genre in genres.items()
    ]
    return linked.groupBy("release_year").agg(*cells).orderBy(F.col("release_year").desc_nulls_first())


def genre_counts_by_lookup(
    film: DataFrame, film_category: DataFrame, category: DataFrame, genres: Mapping[str, str]
) -> DataFrame:
    """Same table as a count looked up per year and genre, 0 where nothing matches (also for the NULL year)."""
    wanted = category.filter(F.lower("name").isin(*[g.lower() for g in genres.values()]))
    counts = (
        film.groupBy("release_year", "film_id")
        .agg(F.count(F.lit(1)).alias("films"))
        .join(film_category, "film_id")
        .join(wanted.select("category_id", F.lower("name").alias("genre")), "category_id")
        .groupBy("release_year")
        .pivot("genre", [g.lower() for g in genres.values()])
        .agg(F.sum("films"))
    )
    years = film.select("release_year").distinct()
    cells = [F.coalesce(F.col(f"`{g.lower()}`"), F.lit(0)).alias(column) for column, g in genres.items()]
    return (
        years.join(counts, "release_year", "left")
        .select("release_year", *cells)
        .orderBy(F.col("release_year").desc_nulls_first())
    )


def best_staff(payments: DataFrame, staff: DataFrame, year: int, k: int = 3) -> DataFrame:
    """Staff with the highest revenue of a year. ``staff``: staff_id, staff_name, address, address2."""
    revenue = (
        payments.filter(in_years(F.col("payment_date"), year, year))
        .groupBy("staff_id")
        .agg(F.sum("amount_cents").alias("cents"))
    )
    best = revenue.join(staff, "staff_id").orderBy(F.col("cents").desc(), "staff_id").limit(k)
    return best.select(
        "staff_id",
        "staff_name",
        from_cents("cents").alias("total_revenue"),
        _address("address", "address2").alias("last_store_address"),
    )


def most_rented(
    rentals: DataFrame,
    film: DataFrame,
    k: int = 5,
    labels: Mapping[str, str] = AUDIENCE,
    default: str = AUDIENCE_DEFAULT,
) -> DataFrame:
    """Films with most rentals and the audience text of their rating."""
    counts = rentals.groupBy("film_id").agg(F.count(F.lit(1)).alias("number_of_rentals"))
    return (
        counts.join(film, "film_id")
        .orderBy(F.col("number_of_rentals").desc(), "film_id")
        .limit(k)
        .select(
            "film_id",
            "title",
            "number_of_rentals",
            label_by_value(F.col("rating"), labels, default).alias("expected_audience"),
        )
    )


def actor_years(film_actor: DataFrame, film: DataFrame) -> DataFrame:
    """(actor_id, release_year) for every film of an actor."""
    return film_actor.select("actor_id", "film_id").join(film.select("film_id", "release_year"), "film_id")


def years_since_last_film(years: DataFrame, actor: DataFrame, as_of_year: int) -> DataFrame:
    """Years between ``as_of_year`` and the last release of each actor; ``years`` as from ``actor_years``."""
    last = years.groupBy("actor_id").agg(F.max("release_year").alias("last_year"))
    gap = F.lit(as_of_year) - F.col("last_year")
    return (
        last.join(actor, "actor_id")
        .select(*actor.columns, gap.alias("inactivity_gap_years"))
        .orderBy(F.col("inactivity_gap_years").desc_nulls_first(), "actor_id")
    )


def longest_pause(years: DataFrame, actor: DataFrame, by_set: bool = False) -> DataFrame:
    """Longest distance between consecutive release years of each actor with at least two of them."""
    gaps = (longest_gap_by_set if by_set else longest_gap)(years, "actor_id", "release_year")
    return gaps.join(actor, "actor_id").select(*actor.columns, "max_gap").orderBy(F.col("max_gap").desc(), "actor_id")


def category_revenue_in_quarter(
    payments: DataFrame, film_category: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Revenue per category in the quarter of ``as_of`` (default: today), positive totals only.

    ``film_category``: film_id, category (the name).
    """
    start, end = quarter_bounds(as_of or dt.date.today())
    per_film = (
        payments.filter(in_window(F.col("payment_date"), start, end))
        .groupBy("film_id")
        .agg(F.sum("amount_cents").alias("cents"))
    )
    return (
        per_film.join(film_category, "film_id")
        .groupBy("category")
        .agg(F.sum("cents").alias("cents"))
        .filter(F.col("cents") > 0)
        .orderBy(F.col("cents").desc(), "category")
        .select("category", from_cents("cents").alias("total_sales_revenue"))
    )


def most_popular_by_country(
    rentals: DataFrame,
    film: DataFrame,
    countries: DataFrame,
    country_pattern: str,
    film_columns: Sequence[str],
    check: bool = True,
    renters: DataFrame | None = None,
) -> DataFrame:
    """Most rented film of every country whose name matches the pattern (case-insensitive LIKE).

    ``rentals``: film_id and the country of the customer. Films are told apart by ``film_columns``, which are
    returned; ties go to the lowest values. A country without rentals gives no row. With ``check`` a pattern that
    matches none of ``countries``, or only countries without rentals, raises ``LookupError``. ``renters``: a cheaper
    source of the countries with rentals than ``rentals``, such as the countries of customers with an order.
    """
    require_text(country_pattern, "country")
    if check and countries.filter(F.col("country").ilike(country_pattern)).isEmpty():
        raise LookupError(f"no country matches {country_pattern!r}")
    placed = rentals.filter(F.col("country").ilike(country_pattern))
    if check and (rentals if renters is None else renters).filter(F.col("country").ilike(country_pattern)).isEmpty():
        raise LookupError(f"no rental information for {country_pattern!r}")
    counts = (
        placed.groupBy("country", "film_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(film.select("film_id", *film_columns), "film_id")
        .groupBy("country", *film_columns)
        .agg(F.sum("n").alias("rental_count"))
    )
    order = [F.col("rental_count").desc(), *[F.col(c).asc_nulls_last() for c in film_columns]]
    best = top_k_per_group(counts, ["country"], order, 1)
    return best.select("country", *film_columns, "rental_count").orderBy("country")


def in_stock_by_title(
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    customer: DataFrame,
    pattern: str,
    never_rented_first: bool = False,
) -> DataFrame:
    """Titles matching the pattern with a copy in the shop, numbered, with their latest rental.

    A film is in stock when it has more copies than open rentals. One row per title: its latest rental,
    ties to the highest customer; with ``never_rented_first`` a never rented copy outranks every rental.
    No match gives one row that says so. ``film``: film_id, title, language; ``inventory``: inventory_id,
    film_id; ``rental``: inventory_id, customer_id, rental_date, return_date; ``customer``: customer_id,
    customer_name.
    """
    require_text(pattern, "search pattern")
    films = film.filter(F.col("title").ilike(pattern))
    copies = inventory.select("inventory_id", "film_id").join(films.select("film_id"), "film_id", "left_semi")
    latest = F.max(F.struct("rental_date", "customer_id"))
    # Only rentals of the copies asked for are totalled.
    asked = in_set(rental, copies, "inventory_id")
    per_copy = asked.groupBy("inventory_id").agg(
        F.count_if(F.col("return_date").isNull()).alias("open"), latest.alias("latest")
    )
    per_film = (
        copies.join(per_copy, "inventory_id", "left")
        .groupBy("film_id")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.coalesce(F.sum("open"), F.lit(0)).alias("open"),
            F.max("latest").alias("latest"),
            F.bool_or(F.col("latest").isNull()).alias("unused"),
        )
        .filter(F.col("copies") > F.col("open"))
    )
    rented = F.when(F.col("unused"), F.lit(None)).otherwise(F.col("latest")) if never_rented_first else F.col("latest")
    matching = films.join(per_film.withColumn("rented", rented), "film_id")
    date_order = F.col("rented.rental_date")
    date_order = date_order.desc_nulls_first() if never_rented_first else date_order.desc_nulls_last()
    per_title = latest_per_key(
        matching, ["title"], [date_order, F.col("rented.customer_id").desc_nulls_last(), F.col("film_id")]
    )
    picked = per_title.select("title", "language", "rented.customer_id", "rented.rental_date")
    named = picked.join(customer.select("customer_id", "customer_name"), "customer_id", "left")
    numbered = number_rows(named, [F.col("title")], "row_num").select(
        "row_num",
        F.col("title").alias("film_title"),
        "language",
        concat_skip_nulls(F.col("customer_name")).alias("customer_name"),
        "rental_date",
    )
    return with_fallback_row(
        numbered,
        {
            "row_num": 1,
            "film_title": f"No films in stock matching pattern: {pattern}",
            "language": None,
            "customer_name": None,
            "rental_date": None,
        },
    )


def new_films(
    film: DataFrame, language: DataFrame, batch: DataFrame, as_of: dt.date, default_language: str = DEFAULT_LANGUAGE
) -> tuple[DataFrame, DataFrame]:
    """Films to add from ``batch`` (title, release_year, language_name): (new rows, rejects).

    Blank titles and unknown languages are rejected; titles already there in any case are skipped; the
    rest get the next film ids in title order and the fixed defaults. A missing year means the year of
    ``as_of``, a missing language the default language.
    """
    known = lowest_dimension_key(language, "name", "language_id")
    blank = F.col("title").isNull() | (F.trim("title") == "")
    resolved = (
        batch.withColumn("_name", folded(F.coalesce("language_name", F.lit(default_language))))
        .join(known.withColumnRenamed("name", "_name"), "_name", "left")
        .drop("_name")
        .withColumn(
            "reject_reason",
            F.when(blank, F.lit("title must not be empty")).when(
                F.col("language_id").isNull(), F.lit("language not found")
            ),
        )
    )
    accepted = resolved.filter(F.col("reject_reason").isNull())
    fresh = rows_to_append(film, accepted, ["title"], [F.col("title"), F.col("release_year").asc_nulls_last()])
    keyed = assign_keys(film, fresh, "film_id", [F.col("title")])
    rows = keyed.select(
        "film_id",
        "title",
        F.coalesce(F.col("release_year"), F.lit(as_of.year)).alias("release_year"),
        "language_id",
        F.lit(NEW_FILM["rental_duration"]).alias("rental_duration"),
        F.lit(NEW_FILM["rental_rate"]).cast("decimal(4,2)").alias("rental_rate"),
        F.lit(NEW_FILM["replacement_cost"]).cast("decimal(5,2)").alias("replacement_cost"),
        F.lit(NEW_FILM["rating"]).alias("rating"),
        F.lit(as_of).alias("last_update"),
    )
    return rows, resolved.filter(F.col("reject_reason").isNotNull())


def _asked(requests: DataFrame, customer: DataFrame) -> DataFrame:
    """Distinct requests with the customer's own store."""
    asked = requests.select("customer_id", "film_id").distinct()
    return asked.join(customer.select("customer_id", "store_id"), "customer_id")


def _every_copy(asked: DataFrame, copies: DataFrame, rental: DataFrame) -> DataFrame:
    """Each copy goes to the lowest customer who asks for its film and never had this copy."""
    natural = ["customer_id", "inventory_id"]
    wanted = not_in_set(asked.join(copies, ["film_id", "store_id"]), rental, natural)
    return wanted.groupBy("inventory_id", "film_id", "store_id").agg(F.min("customer_id").alias("customer_id"))


def _one_copy_each(asked: DataFrame, copies: DataFrame, rental: DataFrame) -> DataFrame:
    """Requests and copies of a film and store are ranked and joined by rank, so a copy has one renter at most.

    A pair that was together before is undone; what is left on both sides is ranked again, customers from the last one.
    The sides and the first round are read several times, so each is written once.
    """
    asked, copies = frozen(asked), frozen(copies)
    place, natural = ["film_id", "store_id"], ["customer_id", "inventory_id"]

    def paired(waiting: DataFrame, free: DataFrame, descending: bool) -> DataFrame:
        left = numbers_within(waiting, place, [By("customer_id", descending)], "turn")
        right = numbers_within(free, place, ["inventory_id"], "turn")
        return not_in_set(left.join(right, [*place, "turn"]).drop("turn"), rental, natural)

    first = frozen(paired(asked, copies, descending=False))
    waiting = not_in_set(asked, first, ["customer_id", *place])
    second = paired(frozen(waiting), frozen(not_in_set(copies, first, "inventory_id")), descending=True)
    return first.unionByName(second)


def rent_films(
    requests: DataFrame,
    customer: DataFrame,
    film: DataFrame,
    inventory: DataFrame,
    staff: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
    rental_day: dt.date,
    payment_day: dt.date,
    highest_rental: Column | None = None,
    one_each: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rent the requested (customer_id, film_id) and pay: (new rentals, new payments).

    A copy has one renter, and nobody rents a copy that they had before. Every copy of the film in the customer's own
    store is rented, each to the lowest customer who can have it; with ``one_each`` a request gets one copy, requests
    are served in the order of customers. The first employee of the store serves. A payment follows its rental through
    the new rental key. ``unmet_requests`` lists what nothing was rented for.
    """
    asked = _asked(requests, customer)
    shelf = inventory.select("inventory_id", "film_id", "store_id")
    given = (_one_copy_each if one_each else _every_copy)(asked, shelf, rental)
    clerks = staff.groupBy("store_id").agg(F.min("staff_id").alias("staff_id"))
    films = film.select("film_id", "rental_duration", "rental_rate_cents")
    # Numbering reads its input several times: written with all that is joined to it.
    copies = frozen(given.join(clerks, "store_id", "left").join(films, "film_id"))
    natural = ["customer_id", "inventory_id"]
    top_rental = highest_key(rental, "rental_id") if highest_rental is None else highest_rental
    rented = assign_keys(rental, copies, "rental_id", natural, top_rental, grouped=True)
    rentals = rented.select(
        "rental_id",
        F.lit(rental_day).alias("rental_date"),
        *natural,
        F.date_add(F.lit(rental_day), F.col("rental_duration")).alias("return_date"),
        "staff_id",
    )
    # Payments are numbered in the order of their rentals.
    paid = rented.withColumn("payment_id", F.col("rental_id") - top_rental + highest_key(payment, "payment_id"))
    payments = paid.select(
        "payment_id",
        "customer_id",
        "staff_id",
        "rental_id",
        F.col("rental_rate_cents").alias("amount_cents"),
        F.lit(payment_day).alias("payment_date"),
    )
    return rentals, payments


def unmet_requests(
    requests: DataFrame, customer: DataFrame, film: DataFrame, inventory: DataFrame, rentals: DataFrame
) -> DataFrame:
    """Requests (customer_id, film_id) that ``rentals`` of ``rent_films`` hold no copy for, with the reason."""
    place = ["film_id", "store_id"]
    served = rentals.join(inventory.select("inventory_id", "film_id"), "inventory_id").select("customer_id", "film_id")
    asked = not_in_set(requests.select("customer_id", "film_id").distinct(), served, ["customer_id", "film_id"])
    homes = customer.select("customer_id", "store_id", F.lit(True).alias("_customer"))
    known = film.select("film_id", F.lit(True).alias("_film")).distinct()
    shelf = inventory.select(*place, F.lit(True).alias("_copy")).distinct()
    looked_up = asked.join(homes, "customer_id", "left").join(known, "film_id", "left").join(shelf, place, "left")
    reason = (
        F.when(F.col("_customer").isNull(), "customer not found")
        .when(F.col("_film").isNull(), "film not found")
        .when(F.col("_copy").isNull(), "no copy in the store")
        .otherwise("no copy left")
    )
    return looked_up.select("customer_id", "film_id", reason.alias("reject_reason"))


def loyal_customers(
    payments: DataFrame, customer: DataFrame, min_purchases: int, min_cents: int, period_end: dt.date, months: int = 3
) -> DataFrame:
    """Customers with more purchases and a higher amount than given in the months before ``period_end``."""
    start = months_later(period_end, -months)
    active = (
        payments.filter(in_window(F.col("payment_date"), start, period_end))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("cents"))
        .filter((F.col("n") > min_purchases) & (F.col("cents") > min_cents))
    )
    return in_set(customer, active, "customer_id")


def high_activity_customers(
    customer: DataFrame, rentals: DataFrame, payments: DataFrame, min_rentals: int, min_payments: int, k: int = 1
) -> DataFrame:
    """The ``k`` most active customers that reach both thresholds."""
    counted = with_counts(with_counts(customer, rentals, "customer_id", "rentals"), payments, "customer_id", "payments")
    enough = counted.filter((F.col("rentals") >= min_rentals) & (F.col("payments") >= min_payments))
    return enough.orderBy(F.col("rentals").desc(), F.col("payments").desc(), "customer_id").limit(k)


def customer_balances(
    customer: DataFrame,
    rentals: DataFrame,
    film: DataFrame,
    payments: DataFrame,
    as_of: dt.date,
    round_late_fees: bool = False,
) -> DataFrame:
    """Balance of every customer at a date: rental fees + late fees - payments.

    A day late costs one unit; a film out for more than twice its rental duration also costs its
    replacement. Rentals still out pay no late days but may pay the replacement. ``film``: film_id,
    rental_rate_cents, rental_duration (days), replacement_cents. With ``round_late_fees`` the late total
    of a customer is rounded to whole units.
    """
    until = ntz(as_of)
    duration = F.col("rental_duration")
    allowed = F.make_dt_interval(days=duration)
    late = F.when(
        F.col("return_date") - F.col("rental_date") > allowed,
        F.extract(F.lit("DAY"), F.col("return_date") - F.col("rental_date") - allowed),
    ).otherwise(0)
    out_for = whole_days(F.coalesce(F.col("return_date"), until), F.col("rental_date"))
    replacement = F.when(out_for > duration * 2, F.col("replacement_cents")).otherwise(0)
    owed = (
        rentals.filter(F.col("rental_date") <= until)
        .join(film, "film_id")
        .groupBy("customer_id")
        .agg(
            F.sum("rental_rate_cents").alias("rent"),
            F.sum(late.cast("bigint") * 100 + replacement).alias("late"),
        )
    )
    paid = (
        payments.filter(F.col("payment_date") <= until)
        .groupBy("customer_id")
        .agg(F.sum("amount_cents").alias("paid"))
    )
    both = customer.join(owed, "customer_id", "left").join(paid, "customer_id", "left")
    rent, fees, settled = (F.coalesce(F.col(c), F.lit(0)) for c in ("rent", "late", "paid"))
    if round_late_fees:
        fees = (F.round(fees / 100) * 100).cast("bigint")
    return both.select(
        "customer_id",
        from_cents(rent).alias("rent_fees"),
        from_cents(fees).alias("late_fees"),
        from_cents(settled).alias("payments"),
        from_cents(rent + fees - settled).alias("balance"),
    )
