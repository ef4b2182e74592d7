"""Fingerprints and components against a plain implementation of the definition."""

import random

import pytest
import xxhash

from millrace.llm.components import stars
from millrace.llm.simhash import ball, keep_one, links, near_duplicates, text_fingerprint

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + ([word] if word else []), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    label = list(range(len(prints)))
    for x, (_, a) in enumerate(prints):
        for y, (_, b) in enumerate(prints[:x]):
            if (a ^ b).bit_count() <= 4:
                old, new = label[x], label[y]
                label = [new if z == old else z for z in label]
    out = []
    for x, (i, a) in enumerate(prints):
        ids = [prints[y][0] for y in range(len(prints)) if label[y] == label[x] and prints[y][0] is not None]
        out.append((i, a, min(ids, default=None)))
    return out


def found(df):
    return sorted(((r[0], r[1] % 2**64, r[2]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "Ünï cÖDE a B\x0bc\x1fd é f g", "x " * 70000])
def test_fingerprint(text):
    assert text_fingerprint(text) == plain_fingerprint(text)


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéè") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    rows = [(None, "lone words of no id at all"), (900, None), (901, ""), (902, " ")]
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 200, 600]))]
        for copy in range(rng.choice([1, 2, 5])):
            edited = list(words)
            for _ in range(copy):
                edited[rng.randrange(len(edited))] = "edit"
            rows.append((base * 10 + copy, " ".join(edited)))
    return rows + [(5000, rows[5][1]), (5000, rows[5][1]), (None, rows[6][1])]


def test_components(spark, frame):
    rows = texts()
    expected = sorted(plain_components(rows), key=repr)
    assert found(near_duplicates(frame(SCHEMA, rows))) == expected
    assert len({c for _, _, c in expected}) < len(rows) - 5


def test_links_connect_all_within_reach(spark, frame):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    masks = ball(2).tolist()
    values = {centre ^ rng.choice(masks) ^ rng.choice(masks) for _ in range(60)} | {rng.getrandbits(64) for _ in range(60)}
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    edges = [tuple(r) for r in links(frame("fp long", [(v,) for v in values])).collect()]
    assert all(((a ^ b) % 2**64).bit_count() <= 4 for a, b in edges)
    label = {v: v for v in values}
    for pairs in (edges, [(a, b) for a in values for b in values if ((a ^ b) % 2**64).bit_count() <= 4]):
        label = {v: v for v in values}
        for a, b in pairs:
            old, new = label[a], label[b]
            label = {v: new if z == old else z for v, z in label.items()}
        groups = sorted(sorted(v for v in values if label[v] == g) for g in set(label.values()))
        if pairs is edges:
            by_edges = groups
    assert by_edges == groups


def test_stars_over_a_long_chain_and_a_hub(spark, frame):
    chain = [(i, i + 1) for i in range(300)] + [(7, 7), (None, 3)]
    hub = [(1000, i) for i in range(1001, 1200)]
    got = dict(tuple(r) for r in stars(frame("a long, b long", chain + hub)).collect())
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1200)}}
    assert stars(frame("a long, b long", [])).count() == 0


def test_keep_one(spark, frame):
    rows = texts()
    schema = "doc_id long, text string, fp string, component_id int"
    kept = keep_one(frame(schema, [(*r, "x", i) for i, r in enumerate(rows)]))
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    got = sorted(((r[0], r[1]) for r in kept.collect()), key=repr)
    wanted = {(c, f if c is None else 0) for _, f, c in plain_components(rows)}
    assert len(got) == len(wanted)
    assert {i for i, _ in got} == {c for c, _ in wanted}
    assert set(got) <= set(rows)
    assert keep_one(frame(schema, [])).count() == 0


def test_no_rows(spark, frame):
    assert near_duplicates(frame(SCHEMA, [])).count() == 0
