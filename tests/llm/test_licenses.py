"""Base columns against a plain search, and expressions against truth by hand."""

import random
import re
import time

import pytest

from millrace.llm import licenses as L

SCHEMA = "doc_id long, text string, labels string, score int"


def plain_base(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = []
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def texts():
    rng = random.Random(8)
    pieces = " ".join([*L.BASE_PHRASES, "under the", "mit", "license", "CC-BY", "nc", "é", "x9", "Version 2.0"]).split()
    made = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 400))) for _ in range(30)]
    return made + [
        None, "", "...", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0; CC BY-NC 4.0",
        "cc by nc cc by nc by nc", "under the mit license under the mit license", "Under\tthe\nMIT -- license", "underthe mit license",
        "CC BY NCÉ", "cc by nc 2", "a " * 100_000 + "cc by nc",
    ]


@pytest.mark.parametrize("text", texts())
def test_base(text):
    got = L.scan_text(text)
    assert got[:5] == plain_base(text)
    assert set(got[4].split(",")) <= set(got[5].split(",")) | {""} and 0 <= got[6] < 1


@pytest.mark.parametrize(
    ("line", "labels", "permissive"),
    [
        ("mit", {"mit"}, True),
        ("gpl-3.0-only", {"gpl-3.0-only"}, False),
        ("mit or gpl-2.0-only", {"mit", "gpl-2.0-only"}, True),
        ("mit and gpl-2.0-only", {"mit", "gpl-2.0-only"}, False),
        ("mit or gpl-2.0-only and agpl-3.0", {"mit", "gpl-2.0-only", "agpl-3.0"}, True),
        ("(mit or gpl-2.0-only) and agpl-3.0", {"mit", "gpl-2.0-only", "agpl-3.0"}, False),
        ("gpl-2.0-only with classpath-exception-2.0 or apache-2.0", {"gpl-2.0-only", "apache-2.0", "gpl-2.0-only-with-classpath-exception-2.0"}, True),
        ("apache-2.0. this file is part of it", {"apache-2.0"}, True),
        ("((isc))", {"isc"}, True),
        ("mit or", {"mit"}, True),
    ],
)
def test_expressions(line, labels, permissive):
    value, none = L.read_expression(line)
    assert not none and value.labels == labels and value.permissive == permissive


@pytest.mark.parametrize("line", ["", "and mit", ") mit", "( ", "or", "(mit"])
def test_no_expression(line):
    assert L.read_expression(line) == (None, True)


def test_rows(spark, frame):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts())]
    rows += [(None, "// SPDX-License-Identifier: MIT OR (GPL-2.0-only AND Zlib)\nLicense-Expression: and\n", "x", 1), rows[3], rows[3]]
    got = L.scan(frame(SCHEMA, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, *_ in rows[:-3]:
        assert tuple(by_id[i])[1:6] == plain_base(text)
    tagged = by_id[None]
    assert (tagged.labels, tagged.n_expressions, tagged.n_broken, tagged.permissive) == ("gpl-2.0-only,mit,zlib", 1, 1, True)
    assert L.scan(frame(SCHEMA, [])).count() == 0


@pytest.mark.parametrize("n", [150, 3000, 50_000])
@pytest.mark.parametrize("marks", ["", "()"])
def test_long_expressions(n, marks):
    names = [f"licence-{i}.0" for i in range(n)]
    line = marks[:1] + " OR ".join(names) + marks[1:]
    got = L.scan_text(f"x\n// SPDX-License-Identifier: {line} is what holds\nmit")
    assert set(got[5].split(",")) == set(names) and got[7:] == (1, 0, False)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("spdx-license-identifier:mit or " * 60_000, ("mit", 60_000, 0)),
        ("spdx-license-identifier:" * 60_000 + "isc", ("isc", 1, 59_999)),
        ("spdx-license-identifier:(" * 60_000, ("", 0, 60_000)),
        ("SPDX-License-Identifier: MIT or (Zlib)License-Expression: ISC and x-license-expression:0BSD", ("0bsd,isc,mit,zlib", 3, 0)),
    ],
)
def test_tags_of_one_line(line, want):
    begun = time.perf_counter()
    got = L.scan_text(line)
    assert (got[5], got[7], got[8]) == want and time.perf_counter() - begun < 10


def test_longest_expression_against_every_prefix():
    rng = random.Random(5)
    found = 0
    for _ in range(20_000):
        tokens = [rng.choice(["(", ")", "or", "and", "with", "mit", "gpl", "x", "x"]) for _ in range(rng.randint(1, 12))]
        want = None, True
        for stop in range(len(tokens), 0, -1):
            try:
                want = L.evaluate(L.postfix(tokens[:stop])), False
                break
            except ValueError:
                continue
        found += not want[1] and len(tokens) > stop > 3
        assert L.read_expression(" ".join(tokens)) == want, tokens
    assert found > 100
