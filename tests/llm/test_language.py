"""Phrase counts against plain parsing, held-out accuracy, and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score int, lang_pred int"


def plain_phrases(text, labelled):
    """Greedy longest substrings of ``labelled``; an unseen letter is one phrase."""
    count = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in labelled:
            size += 1
        count, at = count + 1, at + size
    return count


@pytest.mark.parametrize("seed", range(8))
def test_phrases(seed):
    rng = random.Random(seed)
    labelled = "".join(rng.choice("aabbc ") for _ in range(rng.randint(1, 60)))
    text = "".join(rng.choice("aabbcde ") for _ in range(rng.randint(1, 90)))
    code = {" ": 1, "d": 2, "e": 2, "a": 3, "b": 4, "c": 5}
    table = L.parser(L.suffix_automaton(np.array([code[c] for c in labelled]), 6))
    row = phrases = 0
    for c in text + "\0\0":
        value = int(table[row + code.get(c, L.PAD)])
        phrases, row = phrases + (value & 3), value >> 2
    assert phrases + (row > 0) == plain_phrases(text.replace("e", "d"), labelled)


def test_judge_against_plain_parsing():
    rng = random.Random(1)
    speak = {k: [rng.choice(s) + rng.choice(s) + rng.choice(s) for _ in range(40)] for k, s in (("x", "abcd"), ("y", "cdef"), ("z", "éfga"))}
    text = lambda k, n: " ".join(rng.choice(speak[k]) for _ in range(n))
    model = L.train([(k, text(k, 150)) for k in speak for _ in range(3)])
    assert model.languages == ["x", "y", "z"]
    for k in speak:
        for n in (1, 5, 200):
            own = text(k, n).upper() + " 12."
            best, score = model.judge([own, None, "", "123 ?", own])
            assert best.tolist()[1:4] == [-1, -1, -1] and score.tolist()[1:4] == [0, 0, 0]
            assert best[0] == best[4] and 1 / 3 <= score[0] <= 1
            if n > 1:
                assert model.languages[best[0]] == k


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(docs)
    got = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(L.held_out(F.col("doc_id"))).toPandas()
    assert len(got) > 200 and (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_odd_rows(spark, frame):
    rows = [(i, f"hello world number {'x' * (i % 5)}", "en", 1, 1) for i in range(40)]
    rows += [(100 + i, "bonjour le monde entier", "fr", 1, 1) for i in range(40)] + [(200 + i, None, "de", 1, 1) for i in range(4)]
    rows += [(None, "le monde", None, 1, 1), (300, "", "en", 1, 1), (301, "1 2 3", None, 1, 1), (5, "hello", "en", 1, 1), (302, "le monde " * 50_000, None, 1, 1)]
    df = frame(SCHEMA, rows)
    model = L.fit(df)
    assert model.languages == ["en", "fr"]
    got = L.identify(df, model).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.lang_pred for r in got}
    assert by_id[200] == by_id[300] == by_id[301] == "und"
    assert by_id[None] == by_id[302] == "fr" and by_id[5] == "en"


def test_nothing_to_learn_from(spark, frame):
    df = frame(SCHEMA, [(1, "some text", None, 1, 1), (2, None, "en", 1, 1)])
    assert [r.lang_pred for r in L.identify(df, L.fit(df)).collect()] == ["und", "und"]
    none = frame(SCHEMA, [])
    assert L.identify(none, L.fit(none)).count() == 0
