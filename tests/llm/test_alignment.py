"""Alignment of two tokenizers against a plain implementation on texts' bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from millrace.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, chunk int, pairs string"
TEXTS = [
    None, "", "a", " ", "Plain words, and more of them.", "Plain words, and more of them.", "two  spaces \n\n\tand tabs\r\n", "x▁y is altered",
    "漢字かな交じり文 🙂‍🙂 é\x00 ende", "<|endoftext|> <s> <unk> <0x0A>", "\U00010348" * 40, "ab" * 900, " " * 3000, "don't you'll 12345 ...!!",
    "-" * 500 + "\n" * 500,
]


def library_ids():
    """Ids and byte lengths by the vocabularies' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    alphabet = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}

    def of_a(text):
        ids = first.encode(" " + text, add_special_tokens=False).ids
        return ids, [bytes(alphabet[c] for c in first.id_to_token(i)) for i in ids]

    def of_b(text):
        ids = second.encode(text)
        return ids, [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in ids]

    return of_a, of_b


def plain(rows):
    of_a, of_b = library_ids()
    links, groups, out = [], [], []
    for _, text in rows:
        links.append([])
        groups.append([])
        if not text:
            continue
        (a, ta), (b, tb) = of_a(text), of_b(text)
        if not (b"".join(ta) == b"".join(tb) == b" " + text.encode()):
            continue
        i = j = at_a = at_b = 0
        left, right = [], []
        while i < len(a):
            if not left:
                left.append(a[i])
                right.append(b[j])
            links[-1].append((a[i], b[j]))
            end_a, end_b = at_a + len(ta[i]), at_b + len(tb[j])
            if end_a == end_b:
                groups[-1].append((left, right))
                left, right = [], []
            if end_a <= end_b:
                at_a, i = end_a, i + 1
                if left:
                    left.append(a[i])
            if end_b <= end_a:
                at_b, j = end_b, j + 1
                if right:
                    right.append(b[j])
    count = Counter(p for own in links for p in own)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    for (doc, _), own, parts in zip(rows, links, groups):
        text = ";".join(",".join(map(str, l)) + "|" + ",".join(map(str, r)) for l, r in parts)
        out.append((
            doc, sum(len(l) for l, _ in parts), sum(len(r) for _, r in parts), len(parts), len(own),
            sum(count[p] == top[p[1]] for p in own), sum(count[p] for p in own),
            hashlib.sha256(text.encode()).hexdigest() if text else "", sum(len(l) * len(r) for l, r in parts),
        ))
    return out


def texts():
    rng = random.Random(3)
    signs = "abcdefghij   \n\t.,;'éß漢🙂-0123ABC"
    made = ["".join(rng.choice(signs) for _ in range(rng.choice([3, 40, 400]))) for _ in range(60)]
    return [(i, t) for i, t in enumerate(TEXTS + made)] + [(None, TEXTS[4]), (4, TEXTS[4])]


@pytest.mark.parametrize("size", [1, 300, 1 << 22])
def test_rows(spark, frame, monkeypatch, size):
    monkeypatch.setattr(alignment, "CHUNK_BYTES", size)
    monkeypatch.setattr(alignment, "BLOCK_TERMS", 7 if size == 300 else 1 << 20)
    rows = texts()
    if size == 1:
        rows = rows[:30]
    got = alignment.align(frame(SCHEMA, [(*r, 1, "x") for r in rows]).repartition(3), A, B)
    assert got.columns == alignment.COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain(rows), key=repr)


def test_no_rows(frame):
    assert alignment.align(frame(SCHEMA, []), A, B).count() == 0


def test_products():
    rng = np.random.default_rng(2)
    left, right = (rng.integers(0, 3, shape) * rng.integers(0, 2, shape) for shape in ((7, 5), (5, 9)))

    def rows(m):
        at = np.nonzero(m)
        return alignment.Csr(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), at[1], m[at], m.shape[1])

    made = np.zeros((7, 9), dtype=int)
    for i, j, v in rows(left).product(rows(right)):
        made[i, j] += v
    assert (made == left @ right).all()
    turned = rows(left).transposed()
    assert all((x == y).all() for x, y in zip(turned[:3], rows(left.T)[:3]))


def test_shared_links_hold_the_overlaps():
    a, b = alignment.tokenizer(A), alignment.tokenizer(B)
    chunk = alignment.Chunk(alignment.tokens([t or "" for t in TEXTS], a, b), a, b)
    overlap, shared = ({(i, j) for x, y, _ in found for i, j in zip(x, y)} for found in (chunk.links(), chunk.shared()))
    assert overlap <= shared and len(shared) == chunk.shared_counts().sum()


@pytest.mark.parametrize("text", ["a" * 1_000_000, " " * 1_000_000, "漢" * 300_000, "ab c\n" * 200_000])
def test_long_texts(text):
    a, b = alignment.tokenizer(A), alignment.tokenizer(B)
    (of_a, of_b), = alignment.tokens([text], a, b)
    assert of_a and of_b
    chunk = alignment.Chunk([(of_a, of_b)], a, b)
    assert sum(v.sum() for *_, v in chunk.links()) == len(text.encode()) + 1
