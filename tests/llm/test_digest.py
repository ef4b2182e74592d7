"""Digests against plain counting, and the order of documents against sorting them all."""

import hashlib
import random

import pytest

from millrace.llm import digest as D

SCHEMA = "doc_id long, text string, part string, ahead int"


def plain_codes(text):
    data = (text or "").encode()
    counts = [0] * D.BUCKETS
    for a, b, c in zip(data, data[1:], data[2:]):
        h = (a * 0x9E3779B1 ^ b * 0x85EBCA77 ^ c * 0xC2B2AE3D) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x2C1B3C6D & 0xFFFFFFFF
        counts[(h >> 12) % D.BUCKETS] += 1
    limits = [sorted(counts)[D.BUCKETS * k // 4] for k in (1, 2, 3)]
    return [sum(c > q for q in limits) for c in counts]


@pytest.mark.parametrize("text", [None, "", "ab", "abc", "Füñf Wörter sind hier, nicht mehr.", "xyz " * 400_000])
def test_digest(text):
    assert D._codes(D.digest(text)).tolist() == plain_codes(text)


def test_likeness():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(2000)]
    for n in (8, 40, 400, 3000):
        a, b = ([rng.choice(words) for _ in range(n)] for _ in range(2))
        same, half, other = (" ".join(x) for x in (a, a[: n // 2] + b[n // 2 :], b))
        own = D.digest(same)
        assert D.likeness(own, D.digest(same)) == 1
        assert 0 <= D.likeness(own, D.digest(other)) < D.likeness(own, D.digest(half)) < 1
        assert D.likeness(D.digest(half), own) == D.likeness(own, D.digest(half))


def plain_rows(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own = D.digest(text)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.hex(), D.digest(edited).hex(),
            D.likeness(own, D.digest(edited)), D.likeness(own, D.digest(following)),
        ))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 3, 150])
@pytest.mark.parametrize("null_id", [False, True])
def test_rows(spark, frame, n, null_id):
    rng = random.Random(n)
    ids = rng.sample(range(-500, 10**12), n)
    rows = [(i, rng.choice([None, "", "é" * 7, "word " * rng.randint(1, 50), f"text {i}"])) for i in ids]
    rows += [(None, "no id")] if null_id else []
    got = D.fingerprints(frame(SCHEMA, [(*r, "x", 1) for r in rows]).repartition(3)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_rows(rows)))


def test_repeated_rows(spark, frame):
    rows = [(1, "one"), (1, "one"), (2, "two two"), (2, "two two"), (3, "x")]
    got = D.fingerprints(frame(SCHEMA, [(*r, "x", 1) for r in rows])).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_rows(rows)))
