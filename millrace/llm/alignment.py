"""Alignment of two tokenizers by products of sparse incidence matrices.

Both tokenizers part the same bytes. The matrix of a tokenizer has a row per token
and a column per byte, with ones where the token holds the byte. The product of the first
matrix with the transposed second one has an entry for each two tokens that overlap,
the number of bytes they share: a link. Places where tokens of both end cut the tokens
into groups; matrices of tokens and groups give, multiplied alike, the links within groups.
Products are taken row by row (Gustavson), over compressed sparse rows.

Link counts per pair of ids are sums over the corpus. A task numbers the pairs of its texts,
a few megabytes at a time (a chunk), so only a chunk's distinct pairs are counted, joined with
their corpus-wide counts and sent back to the chunk's documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import PIECES, _byte_alphabet
from millrace.session import discard, materialise

#: Bytes of text in a chunk (a longer text is one by itself), and bytes encoded at once.
CHUNK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
#: White space longer than this is left to the vocabulary's own library.
LONG_WHITE = 50_000
#: Products that are added up at once.
BLOCK_TERMS = 1 << 20

_WORDS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, "
    "links array<int>, times array<int>, pairs array<long>, totals array<long>"
)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]


class Csr(NamedTuple):
    """Compressed sparse rows: where each row begins, the columns and values of its entries, and the number of columns."""

    begins: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.begins) - 1

    def row_of(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(self.rows), np.diff(self.begins))

    def transposed(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        begins = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(begins, self.row_of()[order], self.values[order], self.rows)

    def entries_of_product(self, other: Csr) -> np.ndarray:
        """Per row the number of products that its row of ``self @ other`` adds up."""
        terms = np.concatenate([[0], np.cumsum(np.diff(other.begins)[self.columns])])
        return terms[self.begins[1:]] - terms[self.begins[:-1]]

    def product(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries ``(row, column, value)`` of ``self @ other``, some rows at a time, in their order."""
        terms = np.cumsum(self.entries_of_product(other))
        row = 0
        while row < self.rows:
            done = terms[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(terms, done + BLOCK_TERMS, side="right")))
            yield self._rows_of_product(other, row, stop)
            row = stop

    def _rows_of_product(self, other: Csr, first: int, stop: int):
        own = slice(self.begins[first], self.begins[stop])
        inner = self.columns[own]
        size = np.diff(other.begins)[inner]
        ends = np.cumsum(size)
        # Each entry (i, k) meets the whole row k of the other matrix.
        place = np.repeat(other.begins[inner] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        row = np.repeat(np.repeat(np.arange(first, stop), np.diff(self.begins[first : stop + 1])), size)
        value = np.repeat(self.values[own], size) * other.values[place]
        key = row * other.width + other.columns[place]
        if np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        value = np.add.reduceat(value, new) if len(new) else value
        return key[new] // max(other.width, 1), key[new] % max(other.width, 1), value


def incidence(ends: np.ndarray) -> Csr:
    """Tokens by bytes, of a stream whose tokens end at ``ends``."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(size), np.ones(size, dtype="i8"), size)


def group_incidence(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens by groups: a token is in the group that ends at the next cut."""
    n = len(ends)
    return Csr(np.arange(n + 1), np.searchsorted(cuts, ends), np.ones(n, dtype="i8"), len(cuts))


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary file; a space goes before each text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        as_byte = _byte_alphabet()
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        special = {t["content"] for t in described["added_tokens"] if t["special"]}
        vocabulary = described["model"]["vocab"]
        ranks = {bytes(as_byte[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        self.encoding = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._ids(" " + t) for t in texts]

    def _ids(self, text: str) -> list[int]:
        # The faster library cannot part very long white space.
        if len(text) > LONG_WHITE and max(map(len, re.findall(r"\s+", text)), default=0) > LONG_WHITE:
            return self.library.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)


class Pieces:
    """Ids and token bytes of a sentence-piece model, which puts the space there itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [b""] * model.get_piece_size()
        for i in range(len(self.bytes)):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not model.is_control(i) and not model.is_unknown(i):
                self.bytes[i] = piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def tokens(texts: list[str], a, b) -> list[tuple[list[int], list[int]]]:
    """Ids of each text by both; none where the text is empty or joined token bytes differ from a space and the text."""
    found = []
    filled = [t for t in texts if t]
    coded = zip(filled, a.encode(filled), b.encode(filled))
    for text in texts:
        if not text:
            found.append(([], []))
            continue
        _, of_a, of_b = next(coded)
        whole = b" " + text.encode("utf-8")
        same = all(b"".join(map(side.bytes.__getitem__, ids)) == whole for side, ids in ((a, of_a), (b, of_b)))
        found.append((of_a, of_b) if same else ([], []))
    return found


class Chunk:
    """Alignment of some texts, laid end to end: both tokenizers end a token at each text's end."""

    def __init__(self, coded: list[tuple[list[int], list[int]]], a, b):
        self.ids = [np.fromiter((i for pair in coded for i in pair[side]), dtype="i8") for side in (0, 1)]
        size = [np.fromiter(map(len, t.bytes), dtype="i8", count=len(t.bytes)) for t in (a, b)]
        self.ends = [np.cumsum(size[side][self.ids[side]]) for side in (0, 1)]
        #: Where each text's tokens end, by both tokenizers.
        self.stops = [np.cumsum([len(pair[side]) for pair in coded]) for side in (0, 1)]
        self.cuts = np.intersect1d(*self.ends, assume_unique=True)
        self.groups = [group_incidence(ends, self.cuts) for ends in self.ends]
        of_a = self.groups[0].columns
        last = self.stops[0] - 1
        self.group_stops = np.where(self.stops[0] > 0, of_a[last] + 1, 0) if len(of_a) else 0 * self.stops[0]

    def text_of(self, token: np.ndarray) -> np.ndarray:
        """Text of each token of the first tokenizer."""
        return np.searchsorted(self.stops[0], token, side="right")

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Token of the first, token of the second, and how many bytes they share."""
        left, right = (incidence(ends) for ends in self.ends)
        return left.product(right.transposed())

    def shared(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Links of all tokens within a group."""
        return self.groups[0].product(self.groups[1].transposed())

    def shared_counts(self) -> np.ndarray:
        """Links within groups, per token of the first; the products need not be formed to count them."""
        return self.groups[0].entries_of_product(self.groups[1].transposed())

    def group_texts(self) -> list[str]:
        """Per text ``a1,a2|b1;a3|b2``: the ids of each group."""
        n = [len(i) for i in self.ids]
        code = np.empty(sum(n), dtype="i8")
        for side in (0, 1):
            own, other = self.groups[side].columns, self.groups[1 - side].columns
            # A token stands behind its own predecessors and the other's tokens of earlier groups (or the same, on the right).
            place = np.arange(n[side]) + np.searchsorted(other, own, side="right" if side else "left")
            last = np.diff(own, append=-1) != 0
            code[place] = self.ids[side] * 4 + 2 * side + last
        words = _Words()
        stops = (self.stops[0] + self.stops[1]).tolist()
        code = code.tolist()
        return ["".join(map(words.__getitem__, code[i:j]))[:-1] for i, j in zip([0, *stops], stops)]


class _Words(dict):
    """Text of an id and what follows it, by ``4 id + 2 (on the right) + (last of its group)``."""

    def __missing__(self, code: int) -> str:
        self[code] = text = f"{code >> 2}{',|,;'[code & 3]}"
        return text


def _rows(chunk: int, ids: list, coded: list, a, b) -> pa.RecordBatch:
    """A row per document with its distinct pairs by number, and one row that lists the chunk's pairs."""
    found = Chunk(coded, a, b)
    n = len(ids)
    parts = [np.zeros((0, 2), dtype="i8")]
    n_links = np.zeros(n, dtype="i8")
    for left, right, _ in found.links():
        text = found.text_of(left)
        n_links += np.bincount(text, minlength=n)
        parts.append(np.stack([text, found.ids[0][left] << 32 | found.ids[1][right]], axis=1))
    text, pair = np.concatenate(parts).T
    pairs, number = np.unique(pair, return_inverse=True)
    key, times = np.unique(text * max(len(pairs), 1) + number, return_counts=True)
    own, number = key // max(len(pairs), 1), key % max(len(pairs), 1)
    at = np.searchsorted(own, np.arange(n + 1))
    totals = np.bincount(number, weights=times, minlength=len(pairs)).astype("i8")
    texts = found.group_texts()
    shared = np.concatenate([[0], np.cumsum(found.shared_counts())])[np.concatenate([[0], found.stops[0]])]

    def per_document(values) -> pa.Array:
        return pa.array([*values.tolist(), None], pa.int64())

    def listed(values) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([*at, at[-1]], pa.int32()), pa.array(values, pa.int32()))

    def of_chunk(values) -> pa.Array:
        return pa.array([*[None] * n, values.tolist()], pa.list_(pa.int64()))

    digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk] * (n + 1), pa.int64()), pa.array([*ids, None], pa.int64()),
            *(per_document(np.diff(s, prepend=0)) for s in found.stops),
            per_document(np.diff(np.maximum.accumulate(found.group_stops), prepend=0)),
            per_document(n_links), per_document(np.diff(shared)), pa.array([*digests, None]),
            listed(number), listed(times), of_chunk(pairs), of_chunk(totals),
        ],
        names=[column.split()[0] for column in _WORDS.split(", ")],
    )


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizer(path_a), tokenizer(path_b)
        chunk = TaskContext.get().partitionId() << 32
        ids, coded, texts, size, held = [], [], [], 0, 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids.append(doc)
                texts.append(text)
                size += len(text or "")
                held += len(text or "")
                if size >= BLOCK_BYTES:
                    coded += tokens(texts, a, b)
                    texts, size = [], 0
                if held >= CHUNK_BYTES:
                    coded += tokens(texts, a, b)
                    yield _rows(chunk, ids, coded, a, b)
                    chunk += 1
                    ids, coded, texts, size, held = [], [], [], 0, 0
        if ids:
            yield _rows(chunk, ids, coded + tokens(texts, a, b), a, b)

    return run


def _counted(key, documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """Rows of a chunk's documents times the column of its pairs' counts."""
    counts = np.zeros(pairs.num_rows, dtype="i8")
    best = np.zeros(pairs.num_rows, dtype="i8")
    at = pairs["at"].to_numpy()
    counts[at], best[at] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    lists = documents["links"].combine_chunks()
    begins = lists.offsets.to_numpy()
    begins = begins - begins[0]
    links = Csr(
        begins, lists.flatten().to_numpy().astype("i8"),
        documents["times"].combine_chunks().flatten().to_numpy().astype("i8"), len(counts),
    )
    sums = [_times(links, column) for column in (best, counts)]
    done = documents.drop_columns(["chunk", "links", "times"])
    done = done.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))
    return done.select(COLUMNS)


def _times(matrix: Csr, column: np.ndarray) -> np.ndarray:
    """Exact product of a matrix and a column of integers."""
    sums = np.concatenate([[0], np.cumsum(matrix.values * column[matrix.columns])])
    return sums[matrix.begins[1:]] - sums[matrix.begins[:-1]]


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) how the tokens of two vocabulary files align.

    ``path_a`` names a byte-level vocabulary, whose tokens of a space and the text are taken,
    ``path_b`` a sentence-piece model, which puts the space there itself. ``n_a``, ``n_b``: tokens;
    ``n_groups``: stretches between places where tokens of both end, whose ids ``groups_sha256`` digests;
    ``n_links``: pairs of tokens that share a byte; ``n_shared``: pairs of tokens of one group. The count
    of a pair of ids is the number of all rows' links that have it; ``count_sum`` adds it up over
    the row's links, ``n_best`` are those whose count no other pair with their second id exceeds.

    Null and empty texts, and those that the second model alters, have zeros and an
    empty digest. Repeated rows and null ids count as rows of their own; other columns are
    not read; no rows give no rows. The vocabulary files must be at one path on every machine.
    """
    stored = materialise(docs.select("doc_id", "text").mapInArrow(_aligned(path_a, path_b), _WORDS))
    listed = stored.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "totals")).alias("at", "p"))
    listed = listed.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.totals").alias("n"))
    counts = materialise(listed.groupBy("pair").agg(F.sum("n").alias("count")))
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = materialise(counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest")))
    judged = materialise(
        counts.join(highest, second == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).cast("int").alias("best"))
    )
    numbered = listed.select(F.col("chunk").alias("of"), "at", "pair")
    dealt = numbered.join(judged, "pair").select("of", "at", "count", F.col("best").cast("long"))
    kept = stored.where("pairs is null").select("chunk", *[c for c in COLUMNS if c in stored.columns], "links", "times")
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in COLUMNS)
    done = materialise(kept.groupBy("chunk").cogroup(dealt.groupBy("of")).applyInArrow(_counted, schema))
    discard(stored, counts, highest, judged)
    return done
