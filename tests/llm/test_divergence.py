"""Source divergence against plain counting, and the transducer against a sorted list."""

import random
import re
from collections import Counter

import pytest

from millrace.llm import divergence
from millrace.llm.transducer import Transducer, build

SCHEMA = "text string, lang string, source string, n long, term string, ord long"
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=3, most=200):
    rows = [[x or "" for x in r[:3]] for r in rows]
    terms = [TERMS.findall(t.translate(LOWER)) for t, _, _ in rows]
    held = Counter((lang, w) for (_, lang, _), own in zip(rows, terms) for w in set(own))
    kept = {}
    for (lang, w), n in held.items():
        if n >= least:
            kept.setdefault(lang, set()).add(w)
    counts = {(lang, source): Counter() for _, lang, source in rows}
    for (_, lang, source), own in zip(rows, terms):
        counts[lang, source].update(w for w in own if w in kept.get(lang, ()))

    def share(count, words):
        total = sum(count.values())
        return {w: 1 + 10**9 * (count[w] + 1) // (total + len(words)) for w in words}

    out = []
    for lang in {g[0] for g in counts}:
        words = kept.get(lang, set())
        own = {s: share(counts[lang, s], words) for k, s in counts if k == lang}
        q = share(sum((counts[lang, s] for s in own), Counter()), words)
        for s, p in own.items():
            pairs = [(sum((p[w] - r[w]) ** 2 // r[w] for w in words), x) for x, r in own.items() if x != s]
            found = [((p[w] - q[w]) ** 2 // q[w], w) for w in words if counts[lang, s][w] and p[w] > q[w]]
            for part, listed, limit in (("pair", pairs, None), ("term", found, most)):
                listed = sorted(listed, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(listed)]
    return sorted(out)


def rows():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdéß漢XY") for _ in range(rng.randint(1, 4))) for _ in range(160)]
    made = []
    for _ in range(150):
        words = [rng.choice(vocabulary[: rng.choice([20, 160])]) for _ in range(rng.choice([0, 3, 60]))]
        made.append((rng.choice([" ", ", ", "1"]).join(words), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, "S3"])))
    made += [(None, "en", "s1"), ("", "fr", "a"), ("once only here", "fr", "b"), ("alone " * 30_000, "it", "x"), ("Alone ALONE", "it", "x"), ("alone", "it", "x")]
    return made + made[:9]


@pytest.mark.parametrize("small", [False, True])
def test_audit(spark, frame, monkeypatch, small):
    if small:  # several ranges, blocks of transducers and tiles
        for name, value in (("RANGE_TERMS", 7), ("BLOCK_BYTES", 3000), ("TILE_TERMS", 16), ("TILE_SOURCES", 2), ("TEXT_BYTES", 200)):
            monkeypatch.setattr(divergence, name, value)
    made = rows()
    got = divergence.audit(frame(SCHEMA, [(*r, 1, "x", 2) for r in made]), most_terms=12)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(made, most=12)


def test_no_rows(frame):
    assert divergence.audit(frame(SCHEMA, [])).count() == 0


def test_transducer():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abé漢") for _ in range(rng.randint(1, 7))).encode() for _ in range(3000)})
    made = Transducer.unpacked(build(words).packed())
    assert made.ordinals(words).tolist() == list(range(len(words)))
    assert [made.word(i) for i in range(len(words))] == words
    known = set(words)
    others = ["".join(rng.choice("abcé漢") for _ in range(rng.randint(0, 9))).encode() for _ in range(500)]
    others = [w for w in others if w not in known] + [b"", b"\xff", words[0][:1] + b"zz"]
    assert set(made.ordinals(others).tolist()) == {-1}


def test_transducer_is_minimal():
    """All words of a regular set share their ends: as many states as the set's minimal automaton has."""
    words = sorted(a + b + c for a in (b"x", b"y", b"z") for b in (b"1", b"2") for c in (b"", b"!", b"??"))
    made = build(words)
    assert len(made.final) == 5 and made.ordinals(words).tolist() == list(range(len(words)))
    assert build([]).ordinals([b"a", b""]).tolist() == [-1, -1]
    assert build([b""]).ordinals([b"a", b""]).tolist() == [-1, 0]
