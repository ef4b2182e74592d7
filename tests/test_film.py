from datetime import datetime
from decimal import Decimal

import pytest

from millrace.plans import film


@pytest.fixture(scope="module")
def tables(frame):
    d = datetime
    return {
        "film": frame("film_id long, title string", [(1, "Alpha"), (2, "alpha two"), (3, "Beta"), (4, "Lost")]),
        "category": frame("category_id long, name string", [(1, "Children"), (2, "Drama"), (3, "Empty")]),
        "film_category": frame("film_id long, category_id long", [(1, 1), (2, 1), (3, 2), (4, 2)]),
        "actor": frame(
            "actor_id long, first_name string, last_name string",
            [(i, f"F{i}", f"L{i}") for i in range(1, 9)],
        ),
        # Appearances in Children: 1 and 2 twice, 3 to 5 once, 6 never.
        "film_actor": frame(
            "actor_id long, film_id long",
            [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 2), (5, 2), (6, 3), (7, 4)],
        ),
        # Film 1 has two copies; film 4 has none.
        "inventory": frame("inventory_id long, film_id long", [(10, 1), (11, 1), (20, 2), (30, 3)]),
        "rental": frame(
            "rental_id long, inventory_id long, customer_id long, rental_date timestamp_ntz, return_date timestamp_ntz",
            [
                (1, 10, 1, d(2020, 1, 1), d(2020, 1, 1, 10)),
                (2, 11, 2, d(2020, 1, 1), d(2020, 1, 1, 1, 0, 0, 800000)),
                (3, 20, 3, d(2020, 1, 1), None),
                (4, 30, 3, d(2020, 1, 1), d(2020, 1, 2)),
                (5, 30, 1, d(2020, 1, 1), d(2020, 1, 1, 5)),
            ],
        ),
        "payment": frame(
            "payment_id long, rental_id long, amount decimal(10,2)",
            [(1, 1, Decimal("1.10")), (2, 1, Decimal("1.00")), (3, 3, Decimal("0.90")), (4, 4, Decimal("3.00"))],
        ),
        "customer": frame(
            "customer_id long, address_id long, active int",
            [(1, 1, 1), (2, 2, 0), (3, 3, 0), (4, 3, 2), (5, 3, None), (6, 1, 0)],
        ),
        "address": frame("address_id long, city_id long", [(1, 1), (2, 2), (3, 3)]),
        # Two cities share a name.
        "city": frame("city_id long, city string", [(1, "Aix-en"), (2, "Rome"), (3, "Rome")]),
    }


def pick(tables, *names):
    return [tables[n] for n in names]


def test_films_per_category(tables, rows):
    got = rows(film.films_per_category(*pick(tables, "film", "film_category", "category")))
    assert got == [(1, "Children", 2), (2, "Drama", 2)]


def test_top_actors_by_rentals_breaks_ties_by_id(tables, rows):
    args = pick(tables, "actor", "film_actor", "film", "inventory", "rental")
    got = rows(film.top_actors_by_rentals(*args, n=3))
    assert got == [(1, "F1", "L1", 3), (2, "F2", "L2", 3), (3, "F3", "L3", 2)]
    assert [r[0] for r in rows(film.top_actors_by_rentals(*args))] == [1, 2, 3, 6, 4, 5]


def test_top_category_by_spend_keeps_ties(tables, rows):
    args = pick(tables, "category", "film_category", "inventory", "rental", "payment")
    assert sorted(rows(film.top_category_by_spend(*args))) == [
        (1, "Children", Decimal("3.00")), (2, "Drama", Decimal("3.00")),
    ]
    assert film.category_spend(*args).count() == 2


def test_films_without_inventory(tables, rows):
    assert rows(film.films_without_inventory(*pick(tables, "film", "inventory"))) == [("Lost",)]


def test_top_actors_in_category_uses_distinct_counts(tables, rows):
    args = pick(tables, "actor", "film_actor", "film", "film_category", "category")
    assert [(r[0], r[3]) for r in rows(film.top_actors_in_category(*args, k=1))] == [(1, 2), (2, 2)]
    assert [(r[0], r[3]) for r in rows(film.top_actors_in_category(*args, k=2))] == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1)]


def test_customers_by_city_counts_only_zero_and_one(tables, rows):
    got = rows(film.customers_by_city(*pick(tables, "customer", "address", "city")))
    assert got == [(1, "Aix-en", 1, 1), (2, "Rome", 0, 1), (3, "Rome", 0, 1)]


def hours_args(tables):
    return pick(tables, "category", "film_category", "film", "inventory", "rental", "customer", "address", "city")


def test_top_category_by_hours(tables, rows):
    got = {r[0]: r[1:] for r in rows(film.top_category_by_hours(*hours_args(tables)))}
    assert got["starts with a"] == ("Children", pytest.approx(11 + 0.8 / 3600))
    assert got["contains a dash"] == ("Children", pytest.approx(10.0))


def test_hours_of_unreturned_rentals_rank_last(tables, frame, rows):
    films = frame("film_id long, title string", [(2, "alpha"), (3, "aleph"), (1, "x")])
    args = hours_args(tables)
    args[2] = films
    got = {r[0]: r[1:] for r in rows(film.top_category_by_hours(*args))}
    assert got["starts with a"] == ("Drama", pytest.approx(29.0))
    args[2] = frame("film_id long, title string", [(2, "alpha"), (1, "x")])
    got = {r[0]: r[1:] for r in rows(film.top_category_by_hours(*args))}
    assert got["starts with a"] == ("Children", None)
