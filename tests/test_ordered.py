import itertools
import random

import pytest
from pyspark.errors import PySparkException

from millrace.operators import ordered

SCHEMA = "s int, i long, v int"


def series(values, name=1):
    return [(name, i, v) for i, v in enumerate(values)]


def encode(frame, rows, data, **kw):
    return sorted(rows(ordered.run_length_encode(frame(SCHEMA, data), ["s"], ["i"], "v", **kw)), key=lambda r: (str(r[0]), r[1]))


def by_hand(data):
    out = []
    for name, group in itertools.groupby(sorted(data, key=lambda r: (str(r[0]), r[1])), key=lambda r: r[0]):
        for n, (value, run) in enumerate(itertools.groupby(group, key=lambda r: r[2]), start=1):
            out.append((name, n, value, len(list(run))))
    return out


# Numbers of ranges: all series in one, and long series in many.
PARTS = [1, 40]


@pytest.mark.parametrize("parts", PARTS)
def test_run_length_examples(frame, rows, parts):
    got = encode(frame, rows, series([2, 2, 2, 3, 3, 3, 2, 5]), parts=parts)
    assert [(r[2], r[3]) for r in got] == [(2, 3), (3, 3), (2, 1), (5, 1)]
    # The published example and its answer.
    got = encode(frame, rows, series([2, 2, 2, 3, 3, 3, 5]), parts=parts)
    assert [(r[2], r[3]) for r in got] == [(2, 3), (3, 3), (5, 1)]


@pytest.mark.parametrize("parts", PARTS)
def test_run_length_with_hot_series(frame, rows, parts):
    rng = random.Random(5)
    data = series([1] * 40, name=1)  # one run over every range
    data += series([rng.choice([1, 2, None]) for _ in range(60)], name=2)
    data += series([None] * 11 + [1] * 11 + [None], name=None)
    for name in range(3, 9):
        data += series([rng.randrange(2) for _ in range(name % 4)], name=name)
    rng.shuffle(data)
    got = encode(frame, rows, data, parts=parts)
    assert got == by_hand(data)
    decoded = [(s, v) for s, _, v, n in got for _ in range(n)]
    assert decoded == [(s, v) for s, _, v in sorted(data, key=lambda r: (str(r[0]), r[1]))]


@pytest.mark.parametrize("parts", PARTS)
def test_max_after(frame, rows, parts):
    # The published example; its answer is 5.
    data = series([6, 2, 0, 3, 0, 0, 5, 7, 0], name=1) + series([1, 2, 3], name=2)
    rng = random.Random(7)
    long = [rng.randrange(5) for _ in range(80)]
    data += series(long, name=3) + series([4, 0], name=4)
    got = dict(rows(ordered.max_after(frame(SCHEMA, data), ["s"], ["i"], "v", parts=parts)))
    assert got == {1: 5, 2: None, 3: max(b for a, b in zip(long, long[1:]) if a == 0), 4: None}


def test_equal_entries_have_no_order(frame, rows):
    data = [(1, 1, 2), (1, 2, 3), (1, 2, 4)]
    for job in (ordered.max_after, ordered.run_length_encode):
        with pytest.raises(PySparkException, match="repeats an entry"):
            job(frame(SCHEMA, data), ["s"], ["i"], "v").collect()
