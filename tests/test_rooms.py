from datetime import datetime as d
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.plans import rooms as plan


@pytest.fixture(scope="module")
def rooms(frame):
    return frame("id int, name string", [(i, f"Room {i}") for i in range(1, 8)])


@pytest.fixture(scope="module")
def students(frame):
    return frame(
        "id int, name string, birthday timestamp_ntz, room int, sex string",
        [
            (1, "a", d(2000, 2, 29), 1, "M"),
            (2, "b", d(2001, 1, 1), 1, "F"),
            (3, "c", None, 2, "M"),
            (4, "d", d(1990, 1, 1, 13), 3, "F"),
            (5, "e", d(1999, 12, 31), 3, None),
            (6, "f", d(2000, 1, 1), None, "M"),
            (7, "g", d(2000, 1, 1), 4, "M"),
            (8, "h", d(2000, 1, 1), 5, "M"),
            (9, "i", d(2000, 1, 1), 6, None),
        ],
    )


def test_students_per_room_lists_empty_rooms(rooms, students, rows):
    got = sorted(rows(plan.students_per_room(rooms, students)))
    assert [(r[0], r[2]) for r in got] == [(1, 2), (2, 1), (3, 2), (4, 1), (5, 1), (6, 1), (7, 0)]


def test_lowest_avg_age_rounds_and_breaks_ties_by_id(rooms, students, rows):
    as_of = F.lit("2021-02-28").cast("timestamp_ntz")
    got = rows(plan.lowest_avg_age_rooms(rooms, students, as_of))
    # Born 29 February 2000: 20 on 28 February 2021.
    assert [(r[0], r[2]) for r in got] == [
        (1, Decimal("20.00")), (4, Decimal("21.00")), (5, Decimal("21.00")), (6, Decimal("21.00")), (3, Decimal("26.00")),
    ]
    assert [r[0] for r in rows(plan.lowest_avg_age_rooms(rooms, students, as_of, n=9))][-1] == 2
    assert plan.lowest_avg_age_rooms(rooms, students).count() == 5


def test_largest_age_gap_puts_unknown_first(rooms, students, rows):
    got = rows(plan.largest_age_gap_rooms(rooms, students))
    assert [(r[0], r[2]) for r in got] == [(2, None), (3, 9), (1, 0), (4, 0), (5, 0)]


def test_mixed_sex_rooms_ignore_unknown(rooms, students, rows):
    assert rows(plan.mixed_sex_rooms(rooms, students)) == [(1, "Room 1")]
