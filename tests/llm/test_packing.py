"""Ids against the vocabulary's own library, cuts against plain dynamic programming, and an exact round trip."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, start string, length int"
TEXTS = [
    None, "", " ", "a  b", "a   b ", "x\t\n y.", "a. ,b ..., c.,d 3.5, e.\nf,\n", " lead", "\n", "\n\n", "x \n\n y",
    "it's. don't, we'll", "é. ü, ñ", "a <|endoftext|> b", " .", "x .", "hi\x1c y.", "«a», “b”. c… d\u00a0 e",
    "tail. ", "日本語。 テスト 123 4.", "Hello, World. " * 900, "word " * 3000, "x" * 9000, "One two three.\nFour five! Six?",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids(library):
    encoder = packing.Encoder(PATH)
    for texts in (TEXTS, TEXTS[::-1], []):
        ids, ends = encoder.ids(pa.array(texts, pa.string()))
        for text, part in zip(texts, np.split(ids, ends)):
            assert part.tolist() == library.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_after_forgetting(library, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 2)
    encoder = packing.Encoder(PATH)
    for text in ("a b c d", "b c x y", "d c"):
        assert encoder.ids(pa.array([text]))[0].tolist() == library.encode(text).ids + [0]


def plain_cost(cuts, penalty, length):
    total = [0.0] + [None] * (len(cuts) - 1)
    for j in range(1, len(cuts)):
        costs = []
        for i in range(j):
            size = cuts[j] - cuts[i]
            if size <= length:
                costs.append(total[i] + (0 if size & (size - 1) == 0 else length - size))
        total[j] = min(costs) + penalty[j] + packing.SEQUENCE_COST
    return total[-1]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_the_best(seed):
    rng = random.Random(seed)
    length = rng.choice([8, 16, 40])
    cuts = np.cumsum([0] + [rng.randint(1, length) for _ in range(rng.randint(1, 120))])
    penalty = np.array([rng.choice([0, 3, 24]) for _ in cuts], dtype=float)
    chosen = packing.best_cuts(cuts, penalty, length)
    sizes = np.diff(cuts[chosen])
    assert sizes.max() <= length and chosen[0] == 0 and chosen[-1] == len(cuts) - 1
    padding = sum(0 if n & (n - 1) == 0 else length - n for n in sizes.tolist())
    cost = padding + sum(penalty[j] + packing.SEQUENCE_COST for j in chosen[1:])
    assert cost == plain_cost(cuts.tolist(), penalty.tolist(), length)


def test_round_trip(spark, frame, library):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(TEXTS[-4:]) for _ in range(3)) for _ in range(20)]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)]
    pieces = packing.pack(frame(SCHEMA, rows).repartition(3), PATH).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert len(by_doc) == len(texts)
    for i, text in enumerate(texts):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH


def test_streams_in_small_chunks(spark, frame, monkeypatch):
    rows = [(i, f"Line {i} is here. " * (i % 90), "x", 1) for i in range(400)]
    df = frame(SCHEMA, rows).coalesce(1)
    whole = packing.pack(df, PATH).collect()
    tokens = sum(p.length for p in whole)
    used = {}
    for p in whole:
        used[p.sequence_id] = used.get(p.sequence_id, 0) + p.length
    padding = sum(0 if n & (n - 1) == 0 else packing.LENGTH - n for n in used.values())
    assert padding < 0.03 * tokens
    encoder = packing.Encoder(PATH)
    stream, parts = packing._Stream(encoder.sentence_end, 0, packing.LENGTH), []
    for i in range(0, 400, 10):
        stream.add([r[0] for r in rows[i : i + 10]], *encoder.ids(pa.array([r[1] for r in rows[i : i + 10]])))
        if stream.size > 6000:
            parts += stream.pack(last=False)
    parts += stream.pack(last=True)
    got = pa.Table.from_batches(parts).to_pandas()
    assert got.length.sum() == tokens
    assert (got.groupby("doc_id").length.sum() == got.groupby("doc_id").doc_tokens.first()).all()
    assert (got.sort_values(["doc_id", "start"]).groupby("doc_id").start.first() == 0).all()


def test_null_ids_and_no_rows(spark, frame):
    got = packing.pack(frame(SCHEMA, [(None, "a b", "x", 1), (None, None, "x", 1)]).coalesce(1), PATH).collect()
    assert [(p.doc_id, p.length, p.offset) for p in got] == [(None, 3, 0), (None, 1, 3)]
    assert packing.pack(frame(SCHEMA, []), PATH).count() == 0
