"""Divergence of sources within a language, over a transducer vocabulary.

Per language the terms of enough documents are kept. They are sorted, cut into ranges, and each range
becomes a minimal acyclic transducer from terms to lexicographic ordinals. The texts are then read
again through the transducers: counts, joins and ties work on ordinals, and terms come back
only for the rows of the report.

Transducers are sent to the tasks in blocks of a fixed size, one pass over the texts a
block; how many blocks there are follows from the vocabulary.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.transducer import Transducer, build
from millrace.session import discard, materialise, materialise_counted

LEAST_DOCUMENTS = 3
MOST_TERMS = 200
SCALE = 1_000_000_000
#: Terms in a transducer, and bytes of transducers sent at once.
RANGE_TERMS = 100_000
BLOCK_BYTES = 64 << 20
#: Bytes of text read at once, and counts that a task gathers.
TEXT_BYTES = 4 << 20
GATHERED = 1 << 20
#: Ordinals and sources in a tile of the pair sums.
TILE_TERMS, TILE_SOURCES = 2048, 64


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = size[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(size, done + TEXT_BYTES, side="right")))
        yield first, stop
        first = stop


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Text and code of each term of all texts, and the distinct terms by code; A-Z in lower case."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], dtype="i8", count=len(texts) + 1)
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype="u1")[: offsets[-1]]
    upper = (raw >= 65) & (raw <= 90)
    inside = upper | (raw >= 128) | ((raw >= 97) & (raw <= 122))
    raw = np.where(upper, raw | 32, raw).astype("u1")
    filled = offsets[:-1] < offsets[1:]
    before, after = np.zeros(len(raw), dtype=bool), np.zeros(len(raw), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][filled]] = after[offsets[1:][filled] - 1] = False
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    size = end - begin
    place = np.concatenate([[0], np.cumsum(size)])
    data = raw[np.repeat(begin - place[:-1], size) + np.arange(place[-1])]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(place), pa.py_buffer(data)])
    coded = words.dictionary_encode()
    text = np.searchsorted(offsets, begin, side="right") - 1
    return text, coded.indices.to_numpy(zero_copy_only=False).astype("i8"), coded.dictionary


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, term, n``: documents of the slice that hold the term."""
    for batch in batches:
        for first, stop in _slices(batch.column(0)):
            part = batch.slice(first, stop - first)
            text, code, known = terms_of(part.column(0))
            width = max(len(known), 1)
            pair = np.unique(text * width + code)
            lang = part.column(1).dictionary_encode()
            own = lang.indices.to_numpy(zero_copy_only=False).astype("i8")[pair // width]
            key, n = np.unique(own * width + pair % width, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(key // width)), known.take(pa.array(key % width)).cast(pa.large_string()).cast(pa.string()), pa.array(n)],
                names=["lang", "term", "n"],
            )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A transducer per language and ``RANGE_TERMS`` terms of a sorted partition."""

    def rows():
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    for lang, own in groupby(rows(), key=lambda r: r[0]):
        words: list[bytes] = []

        def made() -> pa.RecordBatch:
            blob = build(words).packed()
            columns = [[lang], [words[0].decode()], [len(words)], [blob]]
            types = (pa.string(), pa.string(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "first", "n", "blob"])

        for _, term in own:
            words.append(term.encode())
            if len(words) == RANGE_TERMS:
                yield made()
                words.clear()
        if words:
            yield made()


class Vocabulary:
    """Kept terms of each language as stored transducers, and where the ordinals of each begin."""

    def __init__(self, docs: DataFrame, least_documents: int = LEAST_DOCUMENTS):
        counted = docs.mapInArrow(_document_counts, "lang string, term string, n long")
        kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least_documents)
        kept, total = materialise_counted(kept.select("lang", "term"))
        ranges = -(-total // RANGE_TERMS) or 1
        ordered = kept.repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
        self.stored = materialise(ordered.mapInArrow(_ranges, "lang string, first string, n long, blob binary"))
        self.sizes = materialise(self.stored.groupBy("lang").agg(F.sum("n").alias("terms")))
        # One row per range of a hundred thousand terms.
        rows = self.stored.select("lang", "first", "n", F.length("blob").alias("bytes")).collect()
        rows.sort(key=lambda r: (r["lang"].encode(), r["first"].encode()))
        self.places, done = [], {}
        for r in rows:
            self.places.append((r["lang"], r["first"], done.get(r["lang"], 0), r["n"], r["bytes"]))
            done[r["lang"]] = done.get(r["lang"], 0) + r["n"]
        discard(kept)

    def blocks(self) -> Iterator[dict[str, list[tuple[int, int, bytes]]]]:
        """Per language the first ordinals, sizes and transducers, some ``BLOCK_BYTES`` at a time."""
        block, size = [], 0
        for place in self.places:
            if block and size + place[4] > BLOCK_BYTES:
                yield self._loaded(block)
                block, size = [], 0
            block.append(place)
            size += place[4]
        if block:
            yield self._loaded(block)

    def _loaded(self, places: list[tuple]) -> dict[str, list[tuple[int, int, bytes]]]:
        named = {(lang, first): (base, n) for lang, first, base, n, _ in places}
        wanted = [(F.col("lang") == lang) & (F.col("first") == first) for lang, first in named]
        found: dict[str, list[tuple[int, int, bytes]]] = {}
        for r in self.stored.where(reduce(or_, wanted)).collect():
            found.setdefault(r["lang"], []).append((*named[r["lang"], r["first"]], bytes(r["blob"])))
        return {lang: sorted(own) for lang, own in found.items()}


def _recounted(sent):
    """Function from texts to ``lang, source, ord, n``, gathered over slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: [(base, Transducer.unpacked(blob)) for base, _, blob in own] for lang, own in sent.value.items()}
        numbers: dict[tuple[str, str], int] = {}
        held, size = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(c) for c in zip(*held))
            keys, at = np.unique(keys, return_inverse=True)
            return keys, np.bincount(at, weights=n).astype("i8")

        def made(keys, n) -> pa.RecordBatch:
            groups = list(numbers)
            own = keys >> 40
            lang, source = (pa.array([g[k] for g in groups], pa.string()).take(pa.array(own)) for k in (0, 1))
            return pa.RecordBatch.from_arrays([lang, source, pa.array(keys & ((1 << 40) - 1)), pa.array(n)], names=["lang", "source", "ord", "n"])

        for batch in batches:
            for first, stop in _slices(batch.column(0)):
                part = batch.slice(first, stop - first)
                text, code, words = terms_of(part.column(0))
                groups = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
                of_text = np.array([numbers.setdefault(g, len(numbers)) for g in groups], dtype="i8")
                langs = np.array([g[0] for g in groups], dtype=object)
                for lang in set(langs.tolist()) & known.keys():
                    mine = np.flatnonzero((langs == lang)[text])
                    used, at = np.unique(code[mine], return_inverse=True)
                    listed = words.take(pa.array(used)).to_pylist()
                    ordinal = np.full(len(used), -1, dtype="i8")
                    for base, transducer in known[lang]:
                        found = transducer.ordinals(listed)
                        ordinal = np.where(found >= 0, found + base, ordinal)
                    ordinal = ordinal[at]
                    there = ordinal >= 0
                    keys, n = np.unique(of_text[text[mine[there]]] << 40 | ordinal[there], return_counts=True)
                    held.append((keys, n))
                    size += len(keys)
                if size > 2 * GATHERED:
                    held = [summed()]
                    size = len(held[0][0])
                    if size > GATHERED:
                        yield made(*held[0])
                        held, size = [], 0
        if held:
            yield made(*summed())

    return run


def _spelled(sent):
    """Function that puts terms in the place of the ordinals of this block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        opened: dict[tuple[str, int], Transducer] = {}
        for batch in batches:
            rows = []
            for lang, source, ordinal, value, rank in zip(*(c.to_pylist() for c in batch.columns)):
                ranges = known.get(lang, ())
                i = bisect_right(ranges, ordinal, key=lambda r: r[0]) - 1
                if i < 0 or ordinal >= ranges[i][0] + ranges[i][1]:
                    continue  # another block's
                base, _, blob = ranges[i]
                if (lang, base) not in opened:
                    opened[lang, base] = Transducer.unpacked(blob)
                transducer = opened[lang, base]
                rows.append((lang, source, transducer.word(ordinal - base).decode(), value, rank))
            columns = zip(*rows) if rows else ([], [], [], [], [])
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["lang", "source", "item", "value", "rank"])

    return run


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE (count + 1) / (total + terms))``, exact for every count."""
    above = (count + 1).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, (total + terms).cast("decimal(19,0)"))


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(key, rows):
    """Sums of a tile: sources of one bucket against those of another over a range of ordinals."""
    width = rows["width"][0].as_py()

    def dense(mine: pa.Table) -> np.ndarray:
        table = np.repeat(mine["p0"].to_numpy()[:, None], width, axis=1)
        items = mine["items"].combine_chunks()
        own = np.repeat(np.arange(len(mine)), pc.fill_null(pc.list_value_length(items), 0).to_numpy())
        flat = items.flatten()
        table[own, flat.field("i").to_numpy()] = flat.field("p").to_numpy()
        return table

    left, right = (rows.filter(pc.equal(rows["role"], k)) for k in (0, 1))
    p, q = dense(left), dense(right)
    sums = np.array([((row - q) ** 2 // q).sum(axis=1) for row in p], dtype="i8").reshape(-1)
    source = np.repeat(np.arange(len(left)), len(right))
    item = np.tile(np.arange(len(right)), len(left))
    found = pa.table({
        "lang": pa.array([key[0].as_py()] * len(sums), pa.string()), "source": left["source"].combine_chunks().take(pa.array(source)),
        "item": right["source"].combine_chunks().take(pa.array(item)), "value": pa.array(sums),
    })
    return found.filter(pc.not_equal(found["source"], found["item"]))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of all pairs of sources of a language."""
    block = F.call_function("div", F.col("ord"), F.lit(TILE_TERMS))
    item = F.struct((F.col("ord") % TILE_TERMS).cast("int").alias("i"), "p")
    cells = shares.groupBy("lang", "source", block.alias("block")).agg(F.collect_list(item).alias("items"))
    last = F.call_function("div", F.col("terms") - 1, F.lit(TILE_TERMS))
    spread = groups.where("terms > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    rows = spread.join(materialise(cells), ["lang", "source", "block"], "left").select(
        "lang", "source", "block", "bucket", "buckets", "p0", "items",
        F.least(F.lit(TILE_TERMS).cast("long"), F.col("terms") - F.col("block") * TILE_TERMS).cast("int").alias("width"),
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1))
    as_source = rows.select("*", F.lit(0).alias("role"), F.col("bucket").alias("x"), every.alias("y"))
    as_item = rows.select("*", F.lit(1).alias("role"), every.alias("x"), F.col("bucket").alias("y"))
    tiles = as_source.unionByName(as_item).select("lang", "block", "x", "y", "role", "source", "p0", "width", "items")
    sums = tiles.groupBy("lang", "block", "x", "y").applyInArrow(_pair_sums, "lang string, source string, item string, value long")
    summed = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # A language without kept terms has pairs, too.
    bare = materialise(groups.where("terms = 0").select("lang", "source"))
    others = bare.withColumnRenamed("source", "item")
    return summed.unionByName(bare.join(others, "lang").where("source != item").select("lang", "source", "item", F.lit(0).cast("long").alias("value")))


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_terms: int = MOST_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources differ within their language.

    Terms are runs of letters A-Z, a-z and all characters beyond ASCII, A-Z in lower case; a language keeps those
    in ``least_documents`` of its rows. Each group of language and source, and each language, gives a kept
    term the share ``p = 1 + floor(10^9 (count + 1) / (N + V))``; the excess of ``p`` over ``q`` is
    ``floor((p - q)^2 / q)``. Part ``pair``: excess of the source over each other source of the language,
    summed over all kept terms (0 without any). Part ``term``: the source's terms with ``p > q``, ``q`` the language's
    share, to rank ``most_terms``. Ranks run from 1 by value, descending, then item, ascending by bytes.

    Null ``text``, ``lang`` and ``source`` count as empty. Repeated rows are rows of their own. No other column
    is read. No rows give no rows; a language with one source has no ``pair``.
    """
    read = _read(docs)
    vocabulary = Vocabulary(read, least_documents)
    context = docs.sparkSession.sparkContext
    nothing = docs.sparkSession.createDataFrame([], "lang string, source string, ord long, n long")
    counted = [nothing]
    for block in vocabulary.blocks():
        sent = context.broadcast(block)
        found = read.mapInArrow(_recounted(sent), "lang string, source string, ord long, n long")
        counted.append(materialise(found.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))))
        sent.unpersist()
    counts = reduce(DataFrame.union, counted)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = read.groupBy("lang", "source").agg(F.lit(1)).select("lang", "source")
    groups = groups.join(materialise(totals), ["lang", "source"], "left").join(vocabulary.sizes, "lang", "left")
    groups = materialise(groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "terms")]))
    of_lang = materialise(groups.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.ceil(F.count("*") / TILE_SOURCES).cast("long").alias("buckets")
    ))
    share_0 = F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    groups = materialise(groups.join(of_lang, "lang").select(
        "*", share_0.alias("p0"), F.pmod(F.xxhash64("source"), F.col("buckets")).alias("bucket")
    ))
    shares = materialise(counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "ord", "n", "terms", "lang_total", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p")
    ))
    pairs = materialise(_pairs(groups, shares))
    in_lang = materialise(counts.groupBy("lang", "ord").agg(F.sum("n").alias("lang_n")))
    judged = shares.join(in_lang, ["lang", "ord"]).withColumn("q", _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")))
    judged = judged.where("p > q").select("lang", "source", "ord", _excess(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    top = materialise(judged.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= most_terms))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    parts = [ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")]
    for block in vocabulary.blocks():
        terms = top.select("lang", "source", "ord", "value", "rank").mapInArrow(
            _spelled(context.broadcast(block)), "lang string, source string, item string, value long, rank int"
        )
        parts.append(materialise(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")))
    done = materialise(reduce(DataFrame.unionByName, parts))
    discard(*counted[1:], shares, pairs, in_lang, top, *parts[1:], vocabulary.stored)
    return done
