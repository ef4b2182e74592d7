"""MinHash near-duplicates against all pairs of plain sets."""

import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import minhash

SCHEMA = "doc_id long, text string, n long, bucket string"


def plain_set(text, words=2):
    found, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            found, word = found + ([word] if word else []), ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def plain(rows, words=2, percent=80):
    sets = [plain_set(t, words) for _, t in rows]
    label = list(range(len(rows)))
    for x, a in enumerate(sets):
        for y in range(x):
            b = sets[y]
            if a and b and label[x] != label[y] and 100 * len(a & b) >= percent * len(a | b):
                old, new = label[x], label[y]
                label = [new if z == old else z for z in label]
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if label[y] == label[x] and rows[y][0] is not None]
        component = min(ids, default=None) if sets[x] else i
        out.append((i, len(sets[x]), component, i == component))
    return out


def edited(rng, words, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return words


def texts():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdeéXYZ") for _ in range(rng.randint(2, 6))) for _ in range(900)]
    rows = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "Two one"), (None, "no id here at all")]
    rows += [(907, "a b " * 40_000), (908, "b a " * 40_000), (909, "ab " * 3), (910, "ab\x0bab ab"), (905, "one two"), (None, "one")]
    for _ in range(10):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 200, 600]))]
        for copy in range(rng.choice([1, 2, 9])):
            rows.append((rng.randrange(800), " ".join(edited(rng, words, copy * len(words) // 40, vocabulary))))
    rng.shuffle(rows)
    return rows


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=repr)


def test_components(frame):
    rows = texts()
    got = minhash.near_duplicates(frame(SCHEMA, [(*r, 1, "x") for r in rows]))
    assert result(got) == sorted(plain(rows), key=repr)


def test_other_bounds(frame):
    rows = texts()
    got = minhash.near_duplicates(frame(SCHEMA, [(*r, 1, "x") for r in rows]), words=5, percent=90)
    assert result(got) == sorted(plain(rows, 5, 90), key=repr)


def test_large_group_in_blocks(frame, monkeypatch):
    """Near-copies at and under the bound, in buckets of many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    words = [rng.choice(vocabulary) for _ in range(300)]
    rows = [(i, " ".join(edited(rng, words, rng.choice([5, 15, 25, 35, 45, 60]), vocabulary))) for i in range(400)]
    got = minhash.near_duplicates(frame(SCHEMA, [(*r, 1, "x") for r in rows]))
    assert result(got) == sorted(plain(rows), key=repr)


def test_no_rows_and_no_sets(frame):
    assert minhash.near_duplicates(frame(SCHEMA, [])).count() == 0
    assert result(minhash.near_duplicates(frame(SCHEMA, [(1, None, 1, "")]))) == [(1, 0, 1, True)]


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_pruning_keeps_pairs_at_the_bound(percent):
    """Agreements drawn at the bound: hardly any pair is given up; half as alike, nearly all are."""
    rng = np.random.default_rng(1)
    least = minhash.least_agreements(percent)
    for chance, low, high in ((percent / 100, 0.9999, 1), (percent / 200, 0, 0.05)):
        agreed = np.cumsum(rng.random((100_000, minhash.HASHES)) < chance, axis=1)[:, minhash.BATCH - 1 :: minhash.BATCH]
        stay = (agreed >= np.array(least)).all(axis=1).mean()
        assert low <= stay <= high


def test_recall_of_bands():
    """Sets of similarity 7/9, below the bound, still share a band and survive."""
    rng = np.random.default_rng(5)
    lost = 0
    for n in (9, 45, 450):  # seven ninths are common: a little below the bound
        for _ in range(200):
            pool = np.unique(rng.integers(0, 1 << 63, n, dtype="u8"))
            a, b = np.sort(pool[: n - n // 9]), np.sort(pool[n // 9 :])
            assert len(np.intersect1d(a, b)) * 9 == 7 * n
            signature = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a)]))
            keys = minhash.band_keys(signature)
            lost += not (keys[0] == keys[1]).any()
            sketch = (signature & 0xFF).astype("u1")
            i, *_ = minhash.surviving(sketch, np.array([len(a), len(b)]), np.array([0]), np.array([1]), 80, minhash.MISS)
            lost += not len(i)
    assert lost <= 1


def test_sets():
    digests, at = minhash.shingle_sets(pa.array([None, "a b A b c", "", "x"]))
    assert np.diff(at).tolist() == [0, 3, 0, 1]


def test_sets_of_unlike_members_stay(spark, frame):
    """Texts that share buckets and are not alike enough cost their signatures there, not their sets."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for i in range(40):
        own = list(words)
        for at in rng.sample(range(1000), 125):  # pairs have a similarity of about 0.65
            own[2 * at] = f"o{i}x{at}"
        rows.append((i, " ".join(own)))
    sets = [plain_set(t) for _, t in rows]
    assert all(0.6 < len(sets[x] & sets[y]) / len(sets[x] | sets[y]) < 0.68 for x in range(40) for y in range(x))

    def shuffled():
        executors = spark._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))

    before = shuffled()
    got = minhash.near_duplicates(frame(SCHEMA, [(*r, 1, "x") for r in rows]))
    assert result(got) == sorted(plain(rows), key=repr)
    assert shuffled() - before < 6 * sum(len(t) for _, t in rows)
