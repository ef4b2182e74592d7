"""Found pairs against the edit distance of every pair, with recall under edits."""

import random

import numpy as np
import pytest

from millrace.llm import decontamination as D

DOCS = "doc_id long, text string, item_id string, edits int"
ITEMS = "item_id long, text string, doc_id int"


def plain_fit(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def made(seed=2, docs=150):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to", "in"]
    vocabulary = common * 40 + ["".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 8))) for _ in range(900)]

    def text(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    items = [(i, text(rng.choice([3, 9, 10, 14, 19, 20, 30, 41, 60]))) for i in range(40)]
    rows = []
    for d in range(docs):
        words = text(rng.randint(0, 300))
        if d % 3 == 0:
            passage = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2, len(passage) // 6])):
                at = rng.randrange(len(passage))
                edit = rng.choice(["swap", "drop", "add"])
                passage[at : at + (edit != "add")] = [] if edit == "drop" else [rng.choice(vocabulary)]
            at = rng.randint(0, len(words))
            words = words[:at] + passage + words[at:]
        rows.append((d, words))
    return items, rows


def test_recall_and_precision(spark, frame):
    items, rows = made()
    sentence = lambda words: " ".join(w.upper() if i % 7 == 0 else w + ",%"[i % 2] for i, w in enumerate(words))
    docs = frame(DOCS, [(d, sentence(w), "x", 1) for d, w in rows] + [(900, None, "x", 1), (None, sentence(items[7][1]), "x", 1)])
    benchmark = frame(ITEMS, [(i, sentence(w), 1) for i, w in items] + [(800, None, 1), (801, "", 1), (802, "?!", 1)])
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(docs, benchmark).collect()}
    exact, near = set(), set()
    for d, words in rows:
        for i, item in items:
            edits = plain_fit(item, words)
            if edits <= 0.2 * len(item):
                (near if edits else exact).add((d, i))
                if (d, i) in got:
                    assert got[d, i].edits == edits and got[d, i].item_words == len(item)
    assert (None, 7) in got
    assert {p for p in got if p[0] is not None} <= exact | near
    assert exact <= set(got)
    assert len(near) > 10 and len(near & set(got)) >= 0.9 * len(near)
    kept = D.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in got} | {900}


def test_blocks_find_the_same(spark, frame, monkeypatch):
    items, rows = made(docs=30)
    docs = frame(DOCS, [(d, " ".join(w), "x", 1) for d, w in rows])
    benchmark = frame(ITEMS, [(i, " ".join(w), 1) for i, w in items])
    exact = lambda: sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).where("edits = 0").collect())
    whole = exact()
    monkeypatch.setattr(D, "BLOCK_BYTES", 1500)
    assert len(list(D.indexes(benchmark))) > 2
    assert whole and exact() == whole
    left = {r.doc_id for r in D.without_contaminated(docs, benchmark).collect()}
    assert left == {d for d, _ in rows} - {r.doc_id for r in D.contaminated(docs, benchmark).collect()}


@pytest.mark.parametrize("seed", range(5))
def test_fit(seed):
    rng = np.random.default_rng(seed)
    item, text = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(0, 20))
    assert D.fit(item, text) == plain_fit(item.tolist(), text.tolist())


def test_repeated_rows_and_no_rows(spark, frame):
    passage = "one two three four five six seven eight nine ten eleven"
    docs = frame(DOCS, [(1, passage, "x", 1)] * 2 + [(2, "z " + passage * 3000, "x", 1)])
    benchmark = frame(ITEMS, [(5, passage, 1)] * 2)
    assert sorted((r.doc_id, r.item_id) for r in D.contaminated(docs, benchmark).collect()) == [(1, 5)] * 4 + [(2, 5)] * 2
    none = frame(DOCS, [])
    assert D.contaminated(none, benchmark).count() == 0 and D.without_contaminated(none, benchmark).count() == 0
    assert D.contaminated(docs, frame(ITEMS, [])).count() == 0
    assert D.without_contaminated(docs, frame(ITEMS, [])).count() == 3


@pytest.mark.parametrize("n", [5, 6, 7, 9, 10, 11, 15, 19, 20, 24, 40, 60, 100])
def test_all_within_the_bound_with_foreign_words(n):
    rng = random.Random(n)
    items = [(i, [f"i{rng.randrange(400)}" for _ in range(n)]) for i in range(40)]
    index = D.Index([(i, " ".join(words)) for i, words in items])
    texts = []
    for _, words in items:
        passage = list(words)
        for at in sorted(rng.sample(range(n), n // 5), reverse=True):
            edit = rng.choice(["swap", "drop", "add"])
            passage[at : at + (edit != "add")] = [] if edit == "drop" else [f"f{rng.randrange(10**6)}"]
        around = [[f"f{rng.randrange(10**6)}" for _ in range(rng.randint(0, 50))] for _ in range(2)]
        texts.append(" ".join(around[0] + passage + around[1]))
    got = {(t, i) for t, i, *_ in index.matches(texts)}
    assert {(i, i) for i, _ in items} <= got


def test_fewest_edits_of_all_places():
    item = "one two three four five six seven eight nine ten"
    text = f"{item.replace('five', 'x')} {'y ' * 40} {item} {'y ' * 40} {item.replace('two', 'x')}"
    assert list(D.Index([(3, item)]).matches([text])) == [(0, 0, 0, 50)]
