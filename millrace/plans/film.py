"""Film-rental reports.

Facts are summed to the next join key before each join, so a hot copy or film
costs one row there, and where that key is unique on the other side the join
reuses the aggregate's partitioning. Per-film sums are stored before they meet
film-to-many tables: Spark then knows their size, broadcasts them when small, and
can split a film holding many of the other side's rows when they are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import micros_between, micros_to_hours
from millrace.operators.matching import with_match, without_match
from millrace.operators.ranking import argmax_with_ties, top_k, top_k_with_ties
from millrace.operators.tally import count_by_condition
from millrace.session import materialise

# How the two results of the rental-hours report are named, and what they look for.
TITLE_TAG, TITLE_PATTERN = "starts with a", "a%"
CITY_TAG, CITY_PATTERN = "contains a dash", "%-%"

# Fixed value: the category of the appearance report.
CHILDREN = "Children"


def films_per_category(film: DataFrame, film_category: DataFrame, category: DataFrame) -> DataFrame:
    """Films in each category, largest first."""
    counts = (
        with_match(film_category, film, "film_id")
        .groupBy("category_id")
        .agg(F.count("film_id").alias("movie_count"))
    )
    return (
        counts.join(category.select("category_id", F.col("name").alias("category_name")), "category_id")
        .select("category_id", "category_name", "movie_count")
        .orderBy(F.col("movie_count").desc(), F.col("category_id"))
    )


def rentals_per_film(inventory: DataFrame, rental: DataFrame) -> DataFrame:
    """Rentals of each film over all its copies."""
    per_copy = rental.groupBy("inventory_id").agg(F.count("rental_id").alias("rentals"))
    return (
        inventory.select("inventory_id", "film_id")
        .join(per_copy, "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("rentals").alias("rentals"))
    )


def top_actors_by_rentals(
    actor: DataFrame,
    film_actor: DataFrame,
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    n: int = 10,
) -> DataFrame:
    """The ``n`` actors whose films were rented most; ties go to the lower id."""
    per_film = materialise(with_match(rentals_per_film(inventory, rental), film, "film_id"))
    per_actor = (
        film_actor.select("actor_id", "film_id")
        .join(per_film, "film_id")
        .groupBy("actor_id")
        .agg(F.sum("rentals").alias("rentals"))
    )
    order = [F.col("rentals").desc(), F.col("actor_id")]
    # Only the n winners meet the names.
    return (
        actor.select("actor_id", "first_name", "last_name")
        .join(F.broadcast(top_k(per_actor, order, n)), "actor_id")
        .orderBy(*order)
    )


def category_spend(
    category: DataFrame,
    film_category: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    payment: DataFrame,
) -> DataFrame:
    """Money spent per category."""
    per_copy = (
        payment.select("rental_id", "amount")
        .join(rental.select("rental_id", "inventory_id"), "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("amount").alias("amount"))
    )
    per_film = materialise(
        inventory.select("inventory_id", "film_id")
        .join(per_copy, "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("amount").alias("amount"))
    )
    per_category = (
        film_category.select("film_id", "category_id")
        .join(per_film, "film_id")
        .groupBy("category_id")
        .agg(F.sum("amount").alias("spent_money"))
    )
    return per_category.join(
        category.select("category_id", F.col("name").alias("category_name")), "category_id"
    ).select("category_id", "category_name", "spent_money")


def top_category_by_spend(*tables: DataFrame) -> DataFrame:
    """The category with the most money spent, ties included; arguments as ``category_spend``."""
    # One row per category, stored: finding the maximum must not repeat the joins.
    return argmax_with_ties(materialise(category_spend(*tables)), "spent_money")


def films_without_inventory(film: DataFrame, inventory: DataFrame) -> DataFrame:
    """Titles of films with no copy in stock."""
    return without_match(film.select("film_id", "title"), inventory, "film_id").select("title")


def top_actors_in_category(
    actor: DataFrame,
    film_actor: DataFrame,
    film: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    name: str = CHILDREN,
    k: int = 3,
) -> DataFrame:
    """Actors with one of the ``k`` greatest appearance counts in a category."""
    chosen = category.where(F.col("name") == name).select("category_id")
    films = materialise(
        with_match(film_category.join(chosen, "category_id"), film, "film_id")
        .groupBy("film_id")
        .agg(F.count(F.lit(1)).alias("listed"))
    )
    appearances = (
        film_actor.select("actor_id", "film_id")
        .join(films, "film_id")
        .groupBy("actor_id")
        .agg(F.sum("listed").alias("appearances"))
    )
    # One row per actor, stored: finding the best counts must not repeat the joins.
    named = materialise(appearances.join(actor.select("actor_id", "first_name", "last_name"), "actor_id"))
    return (
        top_k_with_ties(named, "appearances", k)
        .select("actor_id", "first_name", "last_name", "appearances")
        .orderBy(F.col("appearances").desc(), F.col("actor_id"))
    )


def customers_by_city(customer: DataFrame, address: DataFrame, city: DataFrame) -> DataFrame:
    """Active and inactive customers per city, most inactive first."""
    per_address = count_by_condition(
        customer,
        ["address_id"],
        {"active": F.col("active") == 1, "inactive": F.col("active") == 0},
    )
    per_city = (
        address.select("address_id", "city_id")
        .join(per_address, "address_id")
        .groupBy("city_id")
        .agg(F.sum("active").alias("active_customers"), F.sum("inactive").alias("inactive_customers"))
    )
    return (
        city.select("city_id", "city")
        .join(per_city, "city_id")
        .orderBy(F.col("inactive_customers").desc(), F.col("city_id"))
    )


def category_hours(
    category: DataFrame,
    film_category: DataFrame,
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    city: DataFrame,
    film_test: Column,
    city_test: Column,
) -> DataFrame:
    """Per category, rental time under a film test and under a city test, in one pass.

    ``by_film``/``by_city`` are summed microseconds, ``film_rows``/``city_rows``
    the rentals that passed.
    """
    places = address.select("address_id", "city_id").join(
        city.select("city_id", F.coalesce(city_test, F.lit(False)).alias("city_ok")), "city_id"
    )
    customers = customer.select("customer_id", "address_id").join(places, "address_id")
    per_copy = (
        rental.select(
            "inventory_id", "customer_id", micros_between(F.col("rental_date"), F.col("return_date")).alias("t")
        )
        .join(customers.select("customer_id", "city_ok"), "customer_id")
        .groupBy("inventory_id")
        .agg(
            F.sum("t").alias("t"),
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.when(F.col("city_ok"), F.col("t"))).alias("city_t"),
            F.count_if("city_ok").alias("city_rows"),
        )
    )
    titles = film.select("film_id", F.coalesce(film_test, F.lit(False)).alias("film_ok"))
    per_film = materialise(
        inventory.select("inventory_id", "film_id")
        .join(per_copy, "inventory_id")
        .groupBy("film_id")
        .agg(*[F.sum(c).alias(c) for c in ("t", "rows", "city_t", "city_rows")])
        .join(titles, "film_id")
    )
    return (
        film_category.select("film_id", "category_id")
        .join(per_film, "film_id")
        .groupBy("category_id")
        .agg(
            F.sum(F.when(F.col("film_ok"), F.col("t"))).alias("by_film"),
            F.sum(F.when(F.col("film_ok"), F.col("rows"))).alias("film_rows"),
            F.sum("city_t").alias("by_city"),
            F.sum("city_rows").alias("city_rows"),
        )
        .join(category.select("category_id", "name"), "category_id")
    )


def top_category_by_hours(
    category: DataFrame,
    film_category: DataFrame,
    film: DataFrame,
    inventory: DataFrame,
    rental: DataFrame,
    customer: DataFrame,
    address: DataFrame,
    city: DataFrame,
    title_pattern: str = TITLE_PATTERN,
    city_pattern: str = CITY_PATTERN,
    tags: tuple[str, str] = (TITLE_TAG, CITY_TAG),
) -> DataFrame:
    """The category with most rental hours for films by title, and for cities by name.

    Titles match without regard to case. One row per tag, of the lower id on a tie;
    a category whose rentals were all unreturned ranks last.
    """
    hours = category_hours(
        category, film_category, film, inventory, rental, customer, address, city,
        film_test=F.col("title").ilike(title_pattern),
        city_test=F.col("city").like(city_pattern),
    )
    # One row per category and tag, so both winners come out of the same aggregate.
    tagged = hours.select(
        "category_id",
        "name",
        F.explode(
            F.array(
                F.struct(F.lit(tags[0]).alias("filter"), F.col("by_film").alias("t"), F.col("film_rows").alias("n")),
                F.struct(F.lit(tags[1]).alias("filter"), F.col("by_city").alias("t"), F.col("city_rows").alias("n")),
            )
        ).alias("s"),
    ).select("category_id", "name", "s.*").where(F.col("n") > 0)
    best = F.max_by(
        F.struct("name", "t"),
        F.struct(F.col("t").isNotNull().alias("known"), "t", (-F.col("category_id")).alias("low_id")),
    )
    return tagged.groupBy("filter").agg(best.alias("best")).select(
        "filter", F.col("best.name").alias("category"), micros_to_hours(F.col("best.t")).alias("rental_hours")
    )
