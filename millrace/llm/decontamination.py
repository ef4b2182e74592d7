"""Benchmark passages in documents, found under edit distance.

Items and documents are compared by words. The CGK random walk copies a word string
symbol by symbol into an embedding and, at each step, moves on or stays by a random
bit of the step and the word; strings a few edits apart fall into step again, so
their embeddings differ in few places. Sampling some places gives a key, and
several walks with keys of their own give the wanted recall. A document's windows
are taken at a stride and an item's at every word, so that an unedited stretch
of an item always has a window in step with one of the document. Within the edit
bound a run of up to four of an item's words stays whole, and equal windows walk alike
by any walk, so windows as long as that run, taken at every word of item and document,
find every passage within the bound. Where keys meet, the exact edit distance between
the whole item and the best-fitting part of the document decides.

The items are a stated query set: they are sent to the tasks in blocks of a
bounded size, and each block reads the documents once, without a shuffle. Words
that no item of a block has are one symbol, which moves a walk like any other.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIMILARITY = 0.8
RECALL = 0.99
#: Places sampled for a key, and the share of equal places that the recall is reckoned for.
SAMPLED, ALIKE = 6, 0.8
#: Bytes of item text sent to the tasks at once, on average.
BLOCK_BYTES = 4 << 20
#: Words of text that a task looks at together.
BATCH_WORDS = 1 << 21
#: Window length, stride between a document's windows, and fewest words of items of this size.
SIZES = ((32, 9, 40), (16, 5, 20), (8, 3, 10))
#: Most words of the windows that find all within the bound.
RUN_WORDS = 4
#: Codes: after a window's end, and words that no item has. Words of items follow.
PAD, FOREIGN = 0, 1

SCHEMA = "doc_id long, item_id long, edits long, item_words long, first_word long"

#: Byte by byte: ASCII letters in lower case, digits and all beyond ASCII stay, the rest parts words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, ASCII letters in lower case and characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def repeats(recall: float = RECALL, sampled: int = SAMPLED, alike: float = ALIKE) -> int:
    """Walks after which two windows that agree in a share ``alike`` of places have met with the given chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - alike**sampled))


def window_sizes(words: int) -> list[tuple[int, int]]:
    """Lengths and strides of the sampled windows for items of so many words, none for short items.

    Items have the longest length that fits and the shortest one, which more
    often falls between two edits.
    """
    fitting = [(size, stride) for size, stride, least in SIZES if words >= least]
    return list(dict.fromkeys([fitting[0], fitting[-1]])) if fitting else []


def run_words(words: int, edits: int) -> int:
    """Words of a run that so many edits leave whole in an item of so many words, ``RUN_WORDS`` at most.

    Edits touch as many words at most and part the others into ``edits + 1`` runs.
    """
    return max(1, min(RUN_WORDS, -(-(words - edits) // (edits + 1))))


def keys(codes: np.ndarray, starts: np.ndarray, size: int, walk: int) -> np.ndarray:
    """Key of each window of ``codes`` by walk number ``walk``. Words count as ``PAD`` after a window's end."""
    rng = np.random.default_rng([size, walk])
    steps = 2 * size
    sampled = set(rng.choice(steps, min(SAMPLED, steps), replace=False).tolist())
    odd = rng.integers(1, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    at, last = starts.copy(), starts + size
    key = np.zeros(len(starts), dtype=np.uint64)
    padded = np.append(codes, PAD).astype(np.uint64)
    for step in range(max(sampled) + 1):
        symbol = np.where(at < last, padded[np.minimum(at, len(codes))], PAD).astype(np.uint64)
        if step in sampled:
            key = (key ^ symbol) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        at += ((symbol * odd[step]) >> np.uint64(63)).astype(np.int64)
    return key


def fits(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Least numbers of word edits between ``item`` and the parts of ``text`` that end before each place."""
    place = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    for word in item:
        above = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        new = np.concatenate([[row[0] + 1], above])
        row = np.minimum.accumulate(new - place) + place
    return row


def fit(item: np.ndarray, text: np.ndarray) -> int:
    """Least number of word edits between ``item`` and any part of ``text``."""
    return int(fits(item, text).min())


class Index:
    """Items of one block with the sorted keys of their windows, by window size and walk."""

    def __init__(self, items: list[tuple[int | None, str | None]], similarity: float = SIMILARITY, recall: float = RECALL):
        known: dict[bytes, int] = {}
        self.ids, self.items, self.bounds = [], [], []
        sizes, runs = defaultdict(list), defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            for size in window_sizes(len(words)):
                sizes[size].append(len(self.items))
            self.ids.append(item_id)
            self.items.append(np.array([known.setdefault(w, len(known) + FOREIGN + 1) for w in words], dtype=np.int64))
            self.bounds.append(math.floor((1 - similarity) * len(words) + 1e-9))
            runs[run_words(len(words), self.bounds[-1]), 1].append(len(self.items) - 1)
        self.known, self.similarity, self.tables = known, similarity, []
        codes = np.concatenate([*self.items, np.zeros(0, dtype=np.int64)])
        begin = np.cumsum([0] + [len(i) for i in self.items])
        groups = [(*k, m, repeats(recall)) for k, m in sizes.items()] + [(*k, m, 1) for k, m in runs.items()]
        for size, stride, members, walks in groups:
            starts = [np.arange(begin[m], begin[m + 1] - size + 1) for m in members]
            item = np.repeat(members, [len(s) for s in starts])
            starts = np.concatenate(starts)
            for walk in range(walks):
                key = keys(codes, starts, size, walk)
                order = np.argsort(key, kind="stable")
                self.tables.append((size, stride, walk, key[order], item[order], (starts - begin[item])[order]))

    def matches(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int]]:
        """``(text, item, edits, word)`` for each item near to a part of a text, ``word`` being about where.

        A pair of text and item appears once.
        """
        get = self.known.get
        coded, first = [], 0
        waiting = 0
        for i, text in enumerate(texts):
            coded.append(np.array([get(w, FOREIGN) for w in words_of(text)], dtype=np.int64))
            waiting += len(coded[-1])
            if waiting >= BATCH_WORDS or i == len(texts) - 1:
                yield from self._near(coded, first)
                coded, first, waiting = [], i + 1, 0

    def _near(self, coded: list[np.ndarray], first: int) -> Iterator[tuple[int, int, int, int]]:
        codes = np.concatenate(coded)
        ends = np.cumsum([len(c) for c in coded])
        heard = np.concatenate([[0], np.cumsum(codes > FOREIGN)])
        found = set()
        starts_by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, stride, walk, key, item, offset in self.tables:
            if len(codes) < size:
                continue
            if size not in starts_by_size:
                starts = np.arange(0, len(codes) - size + 1, stride)
                # A window with too many words of no item is beyond the edit bound.
                starts = starts[heard[starts + size] - heard[starts] >= math.ceil(self.similarity * size - 1e-9)]
                text = np.searchsorted(ends, starts, side="right")
                inside = starts + size <= ends[text]
                starts_by_size[size] = starts[inside], text[inside]
            starts, text = starts_by_size[size]
            own = keys(codes, starts, size, walk)
            low, high = np.searchsorted(key, own, side="left"), np.searchsorted(key, own, side="right")
            hit = np.flatnonzero(high > low)
            counts = (high - low)[hit]
            entry = np.repeat(low[hit] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            window = np.repeat(hit, counts)
            found.update(zip(text[window].tolist(), item[entry].tolist(), (starts[window] - offset[entry]).tolist()))
        for (text, item), places in groupby(sorted(found), key=lambda f: f[:2]):
            best = self._best(coded[text], item, [at - int(ends[text]) + len(coded[text]) for *_, at in places])
            if best:
                yield first + text, item, *best

    def _best(self, text: np.ndarray, item: int, places: list[int]) -> tuple[int, int] | None:
        """Fewest edits between an item and the text near to ``places``, if within the bound, and about where."""
        words, slack = self.items[item], self.bounds[item]
        best = None
        while places:
            low = max(0, places[0] - slack)
            # Parts that overlap are one.
            near = 1
            while near < len(places) and places[near] - places[near - 1] <= len(words) + 2 * slack:
                near += 1
            part = text[low : places[near - 1] + len(words) + slack]
            places = places[near:]
            # Words that are nowhere in the part are edited in any case.
            there = set(part.tolist())
            if sum(word not in there for word in words.tolist()) > slack:
                continue
            edits = fits(words, part)
            end = int(edits.argmin())
            if edits[end] <= slack and (best is None or edits[end] < best[0]):
                best = int(edits[end]), max(0, low + end - len(words))
        return best


def indexes(benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> Iterator[Index]:
    """An index per block of ``benchmark`` (``item_id``, ``text``); the driver holds one block at a time."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("text"), F.lit(blocks))
    for i in range(blocks):
        yield Index([tuple(r) for r in items.where(block == i).collect()], similarity, recall)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Pairs of document and item: ``doc_id, item_id, edits, item_words, first_word``.

    A pair is found if some part of the document is within ``edits`` word edits of the
    whole item, at most ``1 - similarity`` of the item's words. All such pairs are found by
    their unedited runs; ``recall`` is the chance for the sampled windows that agree in four
    fifths of places. Null and empty texts match nothing. Ids may be null or repeat:
    each row of either table counts. Further columns are not read.
    """
    context = docs.sparkSession.sparkContext
    found = []
    for index in indexes(benchmark, similarity, recall):
        sent = context.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [
                    (ids[t], index.ids[i], edits, len(index.items[i]), word)
                    for t, i, edits, word in index.matches(batch.column(1).to_pylist())
                ]
                columns = list(zip(*rows)) or [[]] * 5
                names = ["doc_id", "item_id", "edits", "item_words", "first_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        found.append(docs.select("doc_id", "text").mapInArrow(run, SCHEMA))
    return reduce(DataFrame.union, found)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Rows of ``docs`` near to no item, as they are."""
    context = docs.sparkSession.sparkContext
    kept = docs
    for index in indexes(benchmark, similarity, recall):
        kept = kept.where(_clean(context.broadcast(index))("text"))
    return kept


def _clean(sent):
    @F.pandas_udf(T.BooleanType())
    def clean(texts: pd.Series) -> pd.Series:
        found = np.ones(len(texts), dtype=bool)
        for text, *_ in sent.value.matches(texts.tolist()):
            found[text] = False
        return pd.Series(found)

    return clean
