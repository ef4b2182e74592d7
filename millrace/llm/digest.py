"""Quartile bucket digests of texts, and a bounded score of how alike two of them are.

Each byte triplet of a text is hashed into one of ``BUCKETS`` counters. The digest keeps,
for every counter, which of the three quartiles of all counters it exceeds (two
bits), and the logarithm of the length (one byte). The difference of two digests
adds one, two or six per counter for one, two or three quartiles between them, and
something for the lengths; likeness sets it against what unrelated digests of such
quartiles would differ by.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 512
#: Parts of the id range that a shuffle partition takes on average.
PARTS_PER_PARTITION = 4
#: Difference by the quartiles between two counters.
STEP = np.array([0, 1, 2, 6])
#: Share of ``BUCKETS`` that each step of the logarithm of the length adds, and steps that count at most.
LENGTH_SHARE, LENGTH_STEPS = 1 / 200, 40

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def digest(text: str | None) -> bytes:
    """Digest of a text: a byte for its length, then four quartile codes a byte. Null counts as empty."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for i in range(0, max(0, len(data) - 2), 1 << 20):
        part = data[i : i + (1 << 20) + 2].astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1) ^ part[1:-1] * np.uint32(0x85EBCA77) ^ part[2:] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        counts += np.bincount((mixed >> np.uint32(12)) % np.uint32(BUCKETS), minlength=BUCKETS)
    quarter = BUCKETS // 4
    limits = np.partition(counts, [quarter, 2 * quarter, 3 * quarter])[[quarter, 2 * quarter, 3 * quarter]]
    codes = (counts[:, None] > limits[None, :]).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    return bytes([min(255, round(math.log(len(data) + 1) / math.log(1.07)))]) + packed.astype(np.uint8).tobytes()


def _codes(value: bytes) -> np.ndarray:
    packed = np.frombuffer(value, dtype=np.uint8, offset=1)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).ravel()


_GAPS = STEP[np.abs(np.arange(4)[:, None] - np.arange(4)[None, :])]


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, down to 0 for those as far apart as unrelated ones, or farther."""
    if a == b:
        return 1.0
    x, y = _codes(a), _codes(b)
    unrelated = np.bincount(x, minlength=4) @ _GAPS @ np.bincount(y, minlength=4) / BUCKETS
    length = min(abs(a[0] - b[0]), LENGTH_STEPS) * LENGTH_SHARE * BUCKETS
    apart = _GAPS[x, y].sum() + length
    return float(max(0.0, 1 - apart / max(unrelated, 1.0)))


def _places(bounds: np.ndarray, firsts: dict[int, int | None], before: dict[int, int]):
    """Column function from an id to its part and, for a part's first id, the part before it, else -1."""

    @F.pandas_udf(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("ahead", T.IntegerType())]))
    def place(ids: pd.Series) -> pd.DataFrame:
        none = ids.isna().to_numpy()
        own = ids.fillna(0).to_numpy().astype("i8")
        part = np.where(none, 0, np.searchsorted(bounds, own, side="right")).astype("i4")
        starts = np.array([firsts.get(p) is None for p in range(len(bounds) + 1)])
        least = np.array([firsts.get(p) or 0 for p in range(len(bounds) + 1)], dtype="i8")
        previous = np.array([before.get(p, -1) for p in range(len(bounds) + 1)], dtype="i4")
        first = np.where(none, starts[part], ~starts[part] & (least[part] == own))
        return pd.DataFrame({"part": part, "ahead": np.where(first, previous[part], -1).astype("i4")})

    return place


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``docs`` (``doc_id``, ``text``) dealt by id ranges: ``part, ahead, doc_id, text``, sorted within partitions.

    After a part's rows comes, with ``ahead`` set, the first row of the next part,
    and after the last part's the first row of all. So each row finds the next one
    behind it. Texts are shuffled once; the driver sees the bounds of the parts.
    Null ids come first; rows of one id follow the hash of their texts.
    """
    spark = docs.sparkSession
    parts = parts or PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 50 * parts)).first()[0] if parts > 1 else None
    bounds = np.unique(np.array(found or [], dtype="i8"))
    plain = _places(bounds, {}, {})
    # Nulls sort first, as in the rows themselves.
    least = docs.select("doc_id", plain("doc_id")["part"].alias("part")).groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("there"), "doc_id")).alias("first")
    )
    firsts = {r["part"]: r["first"]["doc_id"] for r in least.collect()}
    filled = sorted(firsts)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}
    placed = docs.select("doc_id", "text", _places(bounds, firsts, before)("doc_id").alias("at"))
    copies = F.filter(
        F.array(
            F.struct(F.col("at.part").alias("part"), F.lit(0).alias("ahead")),
            F.struct(F.col("at.ahead").alias("part"), F.lit(1).alias("ahead")),
        ),
        lambda c: c["part"] >= 0,
    )
    dealt = placed.select("doc_id", "text", F.explode(copies).alias("c")).select("c.part", "c.ahead", "doc_id", "text")
    order = ["part", "ahead", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").sortWithinPartitions(*order)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting = None  # the last row, until the next one is known
    for batch in batches:
        rows = []
        for part, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            if ahead and waiting is None:
                continue
            text = text or ""
            own = digest(text)
            if waiting is not None:
                rows.append(_row(*waiting, text, own))
            waiting = None if ahead else (doc_id, text, own)
        columns = list(zip(*rows)) or [[]] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _row(doc_id: int | None, text: str, own: bytes, following: str, its: bytes) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = digest(edited)
    name = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), name, own.hex(), changed.hex(), likeness(own, changed), likeness(own, its)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Digest of each text, of its edited form, and how alike both and the next document's are.

    The edited form has its last half replaced by the beginning of the next
    document's text, in the order of ``in_order``; a single document is its own
    next one. Null texts count as empty. Equal texts have equal digests. Repeated
    rows are documents of their own. Only ``doc_id`` and ``text`` are read. No
    rows give no rows.
    """
    return in_order(docs.select("doc_id", "text")).mapInArrow(_compared, SCHEMA)
