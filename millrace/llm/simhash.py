"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``2 r`` bits if and only if some 64-bit value
differs from each in at most ``r``: the bits in which they differ can be shared
out. So every distinct fingerprint emits all values within ``r`` of it (2,081 for
``r = 2``), the values are shuffled, and those emitted twice show the links. All
emitters of one value lie within ``2 r`` of each other, so a star around the
least of them links them all; no pairs within a bucket are formed. A value has at
most 2,081 emitters, hence no bucket is hot, however many copies a text has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import stars
from millrace.session import discard, materialise, materialise_counted

BITS = 64
SEED = 42
SHINGLE_WORDS = 4
MAX_DIFFERING_BITS = 4
#: Each round shuffles one part of the variants, so that disk holds one part at a time.
ROUNDS = 8
#: Fingerprints that a task expands, variants that a task compares, and buckets for each such task.
TASK_FINGERPRINTS = 8192
TASK_VARIANTS = 1 << 20
TASK_BUCKETS = 4

#: A variant and the number of the mask that made it.
EMITTED = np.dtype([("v", "<u8"), ("m", "<u2")])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def text_fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint, unsigned, of one text.

    ASCII letters are lower-cased; words are what white space (U+0020, U+0009 to
    U+000D) separates. Fewer words than a shingle has make one shingle; none, or
    a null text, give 0. A bit is set where over half the shingles' hashes set it.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - words_per_shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + (1 << 16)], stops[i : i + (1 << 16)])]
        bits = np.unpackbits(np.array(part, dtype="<u8").view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    found = np.fromiter((text_fingerprint(t) for t in texts), dtype=np.uint64, count=len(texts))
    return pd.Series(found.view(np.int64))


def fingerprint(text):
    """Column of signed 64-bit fingerprints of a text column; nulls count as empty."""
    return _fingerprint(text)


def hex_digits(value):
    """Sixteen lower-case hex digits of a long column."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@lru_cache(maxsize=4)
def ball(radius: int, bits: int = BITS) -> np.ndarray:
    """All masks of at most ``radius`` set bits."""
    masks = [0]
    for k in range(1, radius + 1):
        masks += [sum(1 << b for b in chosen) for chosen in combinations(range(bits), k)]
    return np.array(masks, dtype=np.uint64)


def _emit(radius: int, part: int, rounds: int, buckets: int):
    """Function from a partition's fingerprints to this round's variants, one blob per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball(radius)
        packed, bucket = [np.empty(0, dtype=EMITTED)], [np.empty(0, dtype=np.int32)]
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(own), 1024):
                variants = (own[i : i + 1024, None] ^ masks[None, :]).ravel()
                mixed = variants * _MIX
                mixed ^= mixed >> np.uint64(32)
                mixed *= _MIX
                mine = np.flatnonzero((mixed >> np.uint64(40)) % np.uint64(rounds) == part)
                packed.append(np.empty(len(mine), dtype=EMITTED))
                packed[-1]["v"], packed[-1]["m"] = variants[mine], mine % len(masks)
                bucket.append(((mixed[mine] & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32))
        packed, bucket = np.concatenate(packed), np.concatenate(bucket)
        order = np.argsort(bucket, kind="stable")
        packed, bucket = packed[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        blobs = [packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[cuts[:-1]]), pa.array(blobs, pa.binary())], names=["bucket", "blob"]
        )

    return run


def _meet(radius: int):
    """Function from the blobs of a partition to star edges between emitters of one variant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball(radius)
        blobs = [blob.as_buffer() for batch in batches for blob in batch.column(1)]
        if not blobs:
            return
        packed = np.concatenate([np.frombuffer(b, dtype=EMITTED) for b in blobs])
        variants = np.ascontiguousarray(packed["v"])
        ordered = np.sort(variants)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(twice):
            return
        at = np.minimum(np.searchsorted(twice, variants), len(twice) - 1)
        hit = np.flatnonzero(twice[at] == variants)
        slot, own = at[hit], variants[hit] ^ masks[packed["m"][hit]]
        order = np.lexsort((own, slot))
        slot, own = slot[order], own[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        root = np.repeat(own[first], np.diff(np.append(first, len(slot))))
        near = (own != root) & (np.bitwise_count(own ^ root) <= 2 * radius)
        pairs = np.unique(np.stack([own[near], root[near]], axis=1), axis=0).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


def links(prints: DataFrame, differing_bits: int = MAX_DIFFERING_BITS, rounds: int = ROUNDS) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints within ``differing_bits`` (even) of each other.

    ``prints`` holds one long column of distinct, non-null values. Edges connect
    what the links connect; they are fewer than the links.
    """
    radius = differing_bits // 2
    if differing_bits != 2 * radius:
        raise ValueError("an even number of bits is needed to halve the radius")
    column = prints.columns[0]
    stored, n = materialise_counted(prints)
    tasks = -(-n // TASK_FINGERPRINTS) or 1
    spread = materialise(stored.repartition(tasks, column))
    parts = -(-n * len(ball(radius)) // (rounds * TASK_VARIANTS)) or 1
    found = []
    for part in range(rounds):
        dealt = spread.repartition(tasks, column).mapInArrow(
            _emit(radius, part, rounds, TASK_BUCKETS * parts), "bucket int, blob binary"
        )
        met = dealt.repartition(parts, "bucket").mapInArrow(_meet(radius), "a long, b long")
        found.append(materialise(met))
    edges = materialise(reduce(DataFrame.union, found).distinct())
    discard(stored, spread, *found)
    return edges


def near_duplicates(docs: DataFrame, differing_bits: int = MAX_DIFFERING_BITS) -> DataFrame:
    """Per row ``doc_id``, ``fp`` (signed) and ``component_id``, the least id it is linked to.

    Only ``doc_id`` and ``text`` are read, so further columns cannot clash. Equal
    texts have equal fingerprints and hence one component. Repeated rows are all
    returned. Null ids are passed over in ``component_id``, which is null where a
    component has no other. Null and empty texts share fingerprint 0. No rows
    give no rows.
    """
    return _classes(docs, differing_bits).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, differing_bits: int = MAX_DIFFERING_BITS) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each component the row of the least id.

    Equal ids are parted by their texts' digest; of rows equal in both, one stays.
    A component whose ids are all null keeps one row, too. The columns stay as
    they are; names that start with two underscores are used on the way.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("__null"), _key("doc_id"), "__digest"))
    kept = materialise(_classes(docs, differing_bits).groupBy("root").agg(first.alias("row")).select("row.*"))
    by = ["__null", "__key", "__digest"]
    keyed = docs.select("*", F.col("doc_id").isNull().alias("__null"), _key("doc_id"), _digest("text"))
    return keyed.join(kept, by, "left_semi").dropDuplicates(by).select(*docs.columns)


def _key(name: str):
    return F.coalesce(F.col(name), F.lit(0)).alias("__key")


def _digest(name: str):
    return F.xxhash64(name).alias("__digest")


def _classes(docs: DataFrame, differing_bits: int) -> DataFrame:
    own = materialise(docs.select("doc_id", _digest("text"), fingerprint("text").alias("fp")))
    least = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    rooted = stars(links(least.select("fp"), differing_bits)).withColumnRenamed("node", "fp")
    named = materialise(least.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = materialise(named.groupBy("root").agg(F.min("least").alias("component_id")))
    classes = materialise(named.select("fp", "root").join(ids, "root"))
    return own.join(classes, "fp")
