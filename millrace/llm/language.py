"""Language identification by cross-parsing.

For each language a suffix automaton holds a bounded amount of labelled text. A text is
parsed against it from left to right into the longest phrases that the labelled text
contains; the fewer phrases, the lower the cross entropy. The language needing the
fewest, after normalisation by the labelled text's size, wins.

A task parses many texts in step: letters become codes, texts are cut into lanes of
equal length, and one table look-up per letter and language moves all lanes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the labelled sample: documents per language (those whose ids hash lowest), and characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 800
#: Letters that have a code of their own, the most frequent ones in the sample.
LETTERS = 240
#: Letters that are parsed as one lane; a phrase ends with its lane.
LANE = 256
#: Bytes of text that a task parses together.
BLOCK_BYTES = 4 << 20
UNKNOWN = "und"

PAD, SPACE, OTHER = 0, 1, 2
SCHEMA = "doc_id long, lang_pred string, score double"


@lru_cache(maxsize=1)
def _lowered() -> np.ndarray:
    """For each code point the code point of its lower-case letter, or 0 if it is no letter."""
    points = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            points[i] = ord(c.lower()[0])
    return points


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, with 0 for each run of others."""
    points = _lowered()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]
    return points[(points > 0) | (np.append(0, points[:-1]) > 0)]


def suffix_automaton(codes: np.ndarray, alphabet: int) -> np.ndarray:
    """Transitions of the automaton of all substrings of ``codes``: ``[state, code]``, -1 where there is none."""
    go = np.full((2 * len(codes) + 2, alphabet), -1, dtype=np.int32)
    link, length, states, last = [-1], [0], 1, 0
    for c in codes.tolist():
        new, states = states, states + 1
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and go[p, c] < 0:
            go[p, c] = new
            p = link[p]
        if p >= 0:
            q = int(go[p, c])
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone, states = states, states + 1
                length.append(length[p] + 1)
                link.append(link[q])
                go[clone] = go[q]
                while p >= 0 and go[p, c] == q:
                    go[p, c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return go[:states]


def parser(go: np.ndarray) -> np.ndarray:
    """One look-up per letter: ``[state * alphabet + code]`` gives four times the next row plus the phrases ended.

    Where no transition exists the phrase ends and the letter begins the next one
    from the root; a letter that the root lacks is a phrase of its own.
    """
    states, alphabet = go.shape
    missing = go < 0
    root = go[0]
    following = np.where(missing, np.maximum(root, 0)[None, :], go)
    ended = missing & (np.arange(states) > 0)[:, None]
    phrases = ended.astype(np.int32) + (missing & (root < 0)[None, :])
    table = 4 * (following * alphabet) + phrases
    table[:, PAD] = 4 * np.arange(states) * alphabet
    return table.astype(np.int32).ravel()


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # of code points
    alphabet: int
    parsers: list[np.ndarray]
    weights: np.ndarray  # bits that name a phrase

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Place of the best language for each text, -1 without letters, and its score."""
        coded = []
        for text in texts:
            points = letters_of(text or "")
            coded.append(self.codes[points[: len(points) - 1] if len(points) and not points[-1] else points])
        sizes = np.array([len(c) for c in coded], dtype=np.int64)
        lanes = -(-sizes // LANE)
        if not self.languages or not lanes.sum():
            return np.full(len(texts), -1), np.zeros(len(texts))
        padded = np.zeros((int(lanes.sum()), LANE), dtype=np.uint8)
        flat, begin = padded.reshape(-1), np.cumsum(lanes) - lanes
        for at, codes in zip((begin * LANE).tolist(), coded):
            flat[at : at + len(codes)] = codes
        steps = np.ascontiguousarray(padded.T)
        owner = np.repeat(np.arange(len(texts)), lanes)
        bits = np.zeros((len(self.languages), len(texts)))
        for i, table in enumerate(self.parsers):
            row = np.zeros(len(padded), dtype=np.int32)
            phrases = np.zeros(len(padded), dtype=np.int32)
            for step in steps:
                row += step
                value = table.take(row)
                phrases += value & 3
                row = value >> 2
            phrases += row > 0
            bits[i] = np.bincount(owner, weights=phrases, minlength=len(texts)) * self.weights[i]
        seen = sizes > 0
        inverse = np.where(seen, 1 / np.maximum(bits, 1e-9), 0)
        best = np.argmin(bits, axis=0)
        score = inverse[best, np.arange(len(texts))] / np.maximum(inverse.sum(axis=0), 1e-300)
        return np.where(seen, best, -1), np.where(seen, score, 0.0)


def train(sample: list[tuple[str, str]]) -> Model:
    """Model from pairs of language and text. Languages without letters are left out; ties go to the first by name."""
    texts: dict[str, list[np.ndarray]] = {}
    for language, text in sorted(sample):
        letters = letters_of(text)
        if letters.any():
            texts.setdefault(language, []).append(np.append(letters, 0))
    whole = {k: np.concatenate(v) for k, v in texts.items()}
    every = np.concatenate([*whole.values(), np.zeros(0, dtype=np.uint32)])
    found, counts = np.unique(every[every > 0], return_counts=True)
    found = found[np.argsort(-counts, kind="stable")][:LETTERS]
    codes = np.full(0x110000, OTHER, dtype=np.uint8)
    codes[0] = SPACE
    codes[found] = np.arange(len(found)) + OTHER + 1
    alphabet = len(found) + OTHER + 1
    parsers = [parser(suffix_automaton(codes[w], alphabet)) for w in whole.values()]
    weights = np.array([np.log2(len(w) + 1) for w in whole.values()])
    return Model(list(whole), codes, alphabet, parsers, weights)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id is not one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Model from a bounded sample of the rows that are not held out and have a language.

    The choice moves ids only, and each task sends at most ``sample_docs`` a language.
    """
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = known.select("doc_id", "lang").withColumn("__n", F.row_number().over(order))
    chosen = ranked.where(F.col("__n") <= sample_docs).select("doc_id", F.col("lang").alias("__lang")).distinct()
    texts = known.join(F.broadcast(chosen), ["doc_id"]).where(F.col("lang") == F.col("__lang"))
    rows = texts.select("lang", F.substring("text", 1, sample_chars).alias("text")).dropna()
    return train([tuple(r) for r in rows.collect()])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) for the whole text of every row, without a shuffle.

    ``und`` with score 0 stands for a null text, a text without letters, or a model
    without languages. Only ``doc_id`` and ``text`` are read; ids may be null or
    repeat. No rows give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype("i8")
            block = np.cumsum(sizes) // BLOCK_BYTES
            cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1)).tolist()
            for begin, stop in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(begin, stop - begin)
                best, score = model.judge(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
