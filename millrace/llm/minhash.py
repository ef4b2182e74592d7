"""MinHash near-duplicates with sequential Bayesian verification.

Every distinct shingle set gets a signature. Sets that share a band of it meet in a bucket.
There, tasks compare signatures batch by batch: after each batch a pair goes if the posterior
chance that its similarity reaches the bound (uniform prior, so the tail of a binomial
distribution) is below the chosen chance of a miss. What survives all batches is verified on
full sets, in the same task, the most alike first, unless links found before connect it already;
so a task returns links that connect its members and no other pairs. A pair is looked at in the
bucket of the first band that both share only.

A bucket is dealt in blocks. The first round takes the buckets of a few bands, which connect most of
what is alike; a bucket's pivots, a sample, go to all its blocks. The second round takes the buckets of all bands
that are not connected yet: where there are several blocks, the members outside the largest component meet
every one. Then all pairs of members of different components have met, hence no link is lost between components.

Each round compares signatures twice: first without the sets, which leaves the rows that are in a pair to be verified;
only these rows are sent on with their sets. Full sets are formed again from the texts, for members of buckets only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import stars
from millrace.session import discard, materialise

SHINGLE_WORDS = 2
PERCENT = 80
#: Sets at the bound share none of 40 bands of 5 hashes in one of ten million cases.
BANDS, BAND_HASHES = 40, 5
#: Signatures have more hashes than bands use; a byte of each is kept to compare them.
HASHES = 320
#: Chance at which a pair is given up after a batch of so many hashes.
MISS = 1e-7
BATCH = 40
#: Bands of the first round.
FIRST_BANDS = 4
#: Members of a bucket that meet in one block, on average, and the pivots that all its blocks have.
BLOCK, PIVOTS = 512, 16
#: Bytes of text hashed at once; rows and bytes of sets compared at once, if no block has more.
TEXT_BYTES = 1 << 21
ROWS, SET_BYTES = 4096, 32 << 20

_SETS = "place long, doc_id long, t long, n long, d1 long, d2 long, keys array<long>"
_TILES = ["tile", "band", "side", "node", "root"]
_MEMBERS = "node long, n long, keys array<long>, sketch binary, hashes binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digest of each word of all texts, A-Z in lower case, and where each text's words begin and end."""
    texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.large_string()), "")])
    offsets = np.frombuffer(texts.buffers()[1], dtype="i8", count=len(texts) + 1)
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
    raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw).astype(np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
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
    known = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), dtype="u8", count=len(coded.dictionary))
    return known[coded.indices.to_numpy(zero_copy_only=False)], np.searchsorted(begin, offsets)


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit digests of the shingles of each text, end to end, and where each text's begin."""
    word, at = _word_hashes(texts)
    n = np.diff(at)
    own = np.repeat(np.arange(len(n)), n)
    left = np.repeat(at[1:], n) - np.arange(len(word))  # words from here to the text's end
    length = np.minimum(np.repeat(n, n), words)
    digest = np.zeros(len(word), dtype="u8")
    for i in range(words):
        there = left > i
        step = np.zeros(len(word), dtype="u8")
        step[: len(word) - i] = word[i:]
        digest = np.where(there, mix(digest * np.uint64(0x9E3779B97F4A7C15) + step), digest)
    begins = left >= length
    digest, own = digest[begins], own[begins]
    order = np.lexsort((digest, own))
    digest, own = digest[order], own[order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = (digest[1:] != digest[:-1]) | (own[1:] != own[:-1])
    return digest[new], np.searchsorted(own[new], np.arange(len(n) + 1))


@lru_cache(maxsize=2)
def _multipliers(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(0, 1 << 63, hashes, dtype="u8") * np.uint64(2) + np.uint64(1), draw.integers(0, 1 << 63, hashes, dtype="u8")


def signatures(digests: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Least hash values of the sets (none of them empty) that begin there, by ``HASHES`` functions."""
    found = np.zeros((len(begins), HASHES), dtype="u4")
    if len(begins):
        for i, (a, b) in enumerate(zip(*_multipliers(HASHES))):
            found[:, i] = np.minimum.reduceat(((digests * a + b) >> np.uint64(32)).astype("u4"), begins)
    return found


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A digest of each band and its number."""
    bands = signature[:, : BANDS * BAND_HASHES].reshape(len(signature), BANDS, BAND_HASHES)
    key = np.broadcast_to(np.arange(BANDS, dtype="u8"), bands.shape[:2])
    for i in range(BAND_HASHES):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, i])
    return key


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches of at most ``TEXT_BYTES``, or of one text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        done = size[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(size, done + TEXT_BYTES, side="right")))
        yield first, stop
        first = stop


def _listed(keys: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(keys.ravel()))


def _parts(batches: Iterator[pa.RecordBatch], words: int):
    """Slices of batches whose second column are texts, with sizes, sets, signatures and band keys."""
    for batch in batches:
        for first, stop in _slices(batch.column(1)):
            part = batch.slice(first, stop - first)
            digests, at = shingle_sets(part.column(1), words)
            n = np.diff(at)
            filled = np.flatnonzero(n)
            signature = np.zeros((len(n), HASHES), dtype="u4")
            signature[filled] = signatures(digests, at[:-1][filled])
            keys = np.zeros((len(n), BANDS), dtype="i8")
            keys[filled] = band_keys(signature[filled]).view("i8")
            yield part, n, [digests[i:j].tobytes() for i, j in zip(at[:-1], at[1:])], signature, keys


def _hashed(words: int):
    """Function from texts to their sets' digests and bands, each row under a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 33
        for part, n, blobs, _, keys in _parts(batches, words):
            whole = np.array([divmod(xxhash.xxh128_intdigest(b), 1 << 64) for b in blobs], dtype="u8").reshape(-1, 2).view("i8")
            columns = [
                pa.array(place + np.arange(len(n))), part.column(0).cast(pa.int64()), part.column(2), pa.array(n),
                pa.array(whole[:, 0]), pa.array(whole[:, 1]), _listed(keys),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SETS.split(", ")])
            place += len(n)

    return run


def _formed(words: int):
    """Function from nodes and texts to all that a member of buckets is compared by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n, blobs, signature, keys in _parts(batches, words):
            sketch = [row.tobytes() for row in (signature & 0xFF).astype("u1")]
            columns = [part.column(0), pa.array(n), _listed(keys), pa.array(sketch, pa.binary()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _MEMBERS.split(", ")])

    return run


@lru_cache(maxsize=8)
def least_agreements(percent: int, miss: float = MISS) -> list[int]:
    """Per batch the hashes that must agree so far for a pair to stay.

    After ``m`` of ``n`` agreements the chance of a similarity of ``t`` or more is, by a uniform
    prior, that of at most ``m`` successes in ``n + 1`` trials of chance ``t``.
    """
    t, found = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found.append(m)
    return found


def surviving(sketch: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int, miss: float):
    """Pairs of rows that no batch gives up, and the hashes in which they agree."""
    stay = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    i, j = i[stay], j[stay]
    agreed = np.zeros(len(i), dtype="i8")
    for at, least in zip(range(0, HASHES, BATCH), least_agreements(percent, miss)):
        agreed += (sketch[i, at : at + BATCH] == sketch[j, at : at + BATCH]).sum(axis=1)
        stay = agreed >= least
        i, j, agreed = i[stay], j[stay], agreed[stay]
    return i, j, agreed


def _connecting(tile, i, j, agreed, node, root, sets, percent: int) -> list[tuple[int, int]]:
    """Links, verified on whole sets, that connect what the survivors ``i, j`` connect."""
    leads: dict[tuple[int, int], tuple[int, int]] = {}

    def lead(x: tuple[int, int]) -> tuple[int, int]:
        while (y := leads.get(x, x)) != x:
            leads[x] = x = leads.get(y, y)
        return x

    links = []
    order = np.lexsort((j, i, -agreed))
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        one, other = lead((tile[x], root[x])), lead((tile[y], root[y]))
        if one == other:
            continue
        a, b = (np.frombuffer(sets[z], dtype="u8") for z in (x, y))
        both = len(np.intersect1d(a, b, assume_unique=True))
        if 100 * both >= percent * (len(a) + len(b) - both):
            leads[max(one, other)] = min(one, other)
            links.append((node[x], node[y]))
    return links


def _pairs(rows: pa.Table, percent: int, miss: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of a tile that are to be verified, and the hashes in which they agree.

    They differ in ``root``, and in ``side`` unless that is null, meet first in the tile's band, and no batch gives them up.
    """
    tile, band, n, root = (rows[c].to_numpy() for c in ("tile", "band", "n", "root"))
    side = pc.fill_null(rows["side"], -1).to_numpy()
    sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), dtype="u1").reshape(-1, HASHES)
    keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    found = [(np.zeros(0, "i8"),) * 3]
    i, step = np.arange(len(tile) - 1), 1
    while len(i):
        i = i[i + step < len(tile)]
        i = i[tile[i] == tile[i + step]]
        j = i + step
        meet = (root[i] != root[j]) & ((side[i] < 0) | (side[i] != side[j]))
        x, y, agreed = surviving(sketch, n, i[meet], j[meet], percent, miss)
        first = np.argmax(keys[x] == keys[y], axis=1) == band[x] if len(x) else np.zeros(0, dtype=bool)
        found.append((x[first], y[first], agreed[first]))
        step += 1
    i, j, agreed = map(np.concatenate, zip(*found))
    return i, j, agreed


def _whole_tiles(batches: Iterator[pa.RecordBatch], entry_bytes: int) -> Iterator[pa.Table]:
    """Rows sorted by tile, some whole tiles at a time; a set's entry counts as so many bytes."""
    held, size, weight = [], 0, 0
    for whole in batches:
        for at in range(0, len(whole), 512):
            batch = whole.slice(at, 512)
            held.append(batch)
            size += len(batch)
            weight += entry_bytes * pc.sum(batch.column("n")).as_py()
            if size < ROWS and weight < SET_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            begins = np.flatnonzero(np.diff(rows["tile"].to_numpy()))
            if len(begins):  # the last tile may go on
                stop = int(begins[-1]) + 1
                yield rows.slice(0, stop)
                rows = rows.slice(stop)
                held, size, weight = rows.to_batches(), len(rows), entry_bytes * pc.sum(rows["n"]).as_py()
    if size:
        yield pa.Table.from_batches(held)


def _facing(percent: int, miss: float):
    """Function from rows sorted by tile, without sets, to those that are in a pair to be verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_tiles(batches, 0):
            i, j, _ = _pairs(rows, percent, miss)
            found = rows.select(_TILES).take(np.union1d(i, j))
            yield from found.to_batches()

    return run


def _met(percent: int, miss: float):
    """Function from rows sorted by tile to links between rows that differ in ``root``.

    ``side`` is null where all rows of a tile meet; else those on different sides do.
    """

    def linked(rows: pa.Table) -> pa.RecordBatch:
        i, j, agreed = _pairs(rows, percent, miss)
        sets = [s.as_buffer() for s in rows["hashes"].combine_chunks()] if len(i) else []
        tile, node, root = (rows[c].to_pylist() for c in ("tile", "node", "root"))
        links = _connecting(tile, i, j, agreed, node, root, sets, percent)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(linked, _whole_tiles(batches, 8))

    return run


def _whole_sets(docs: DataFrame, classes: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Sets and signatures of all members of buckets, from the texts."""
    nodes = materialise(members.select("node").distinct())
    wanted = materialise(classes.join(nodes, "node", "left_semi").select("node", F.col("first").alias("__id"), F.col("t").alias("__t")))
    same = (F.col("t") == F.col("__t")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    # Shuffled at every size, as the list of members grows with the texts.
    texts = docs.join(wanted.hint("shuffle_hash"), same).select("node", "text").dropDuplicates(["node"])
    formed = materialise(texts.mapInArrow(_formed(words), _MEMBERS))
    discard(nodes, wanted)
    return formed


def _links(tiles: DataFrame, whole: DataFrame, percent: int, miss: float) -> DataFrame:
    """Links ``a, b`` from ``tiles`` (``tile, band, side, node, root``)."""
    def dealt(tiles: DataFrame, *sets: str) -> DataFrame:
        rows = tiles.join(whole.select("node", "n", "sketch", "keys", *sets).hint("merge"), "node")
        return rows.select(*_TILES, "n", "sketch", "keys", *sets).repartition("tile").sortWithinPartitions("tile", "node")

    tiles = materialise(tiles)
    facing = materialise(dealt(tiles).mapInArrow(_facing(percent, miss), tiles.schema))
    links = materialise(dealt(facing, "hashes").mapInArrow(_met(percent, miss), "a long, b long"))
    discard(tiles, facing)
    return links


def _bucket_members(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """``bucket, band, m, node`` of buckets of two or more; of buckets with the same members the first band's stays."""
    own = sets.select(F.col("place").alias("node"), "keys").join(classes.select("node"), "node", "left_semi")
    banded = own.select("node", F.posexplode("keys").alias("band", "bucket"))
    sums = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (0, 1)]
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("m"), F.min("node").alias("least"), F.min("band").alias("band"), *sums)
    first = F.min(F.struct("band", "bucket")).alias("first")
    buckets = sizes.where("m > 1").groupBy("m", "least", "x0", "x1").agg(first).select("first.bucket", "m")
    return materialise(banded.join(materialise(buckets), "bucket"))


def _draw(seed: int, below) -> F.Column:
    """Number under ``below`` that a node gets in a bucket."""
    return F.pmod(F.xxhash64("node", "bucket", F.lit(seed)), below)


def _every(count) -> F.Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def _first_tiles(members: DataFrame) -> DataFrame:
    """Members of the first bands by block of their bucket; of a bucket with more blocks the pivots in all of them."""
    blocks = F.ceil(F.col("m") / BLOCK).cast("long")
    dealt = members.where(F.col("band") < FIRST_BANDS).withColumn("blocks", blocks).withColumn("block", _draw(1, F.col("blocks")))
    pivot = (F.col("blocks") > 1) & (_draw(2, F.col("m")) < PIVOTS)
    sent = dealt.where(pivot).select("bucket", "band", "node", "block", _every(F.col("blocks")).alias("other")).where("block != other")
    tiles = dealt.select("bucket", "band", "block", "node").union(sent.select("bucket", "band", "other", "node"))
    nobody = F.lit(None).cast("int").alias("side")
    return tiles.select(F.xxhash64("bucket", "block").alias("tile"), "band", nobody, "node", F.col("node").alias("root"))


def _second_tiles(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Buckets with several components: in one tile, or all members against those outside the largest one, by blocks."""
    rooted = materialise(members.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")))
    parts = rooted.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.max("m").alias("m"))
    open_ = parts.groupBy("bucket").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("n"), F.max("m").alias("all")
    )
    open_ = materialise(open_.where(F.col("all") > F.col("n")).select(
        "bucket", "major",
        F.ceil(F.col("all") / BLOCK).cast("long").alias("blocks"),
        F.ceil((F.col("all") - F.col("n")) / BLOCK).cast("long").alias("minors"),
    ))
    dealt = rooted.join(open_, "bucket").select("bucket", "band", "node", "root", "major", "blocks", "minors")
    narrow, wide = dealt.where("blocks = 1"), dealt.where("blocks > 1")
    nobody = F.lit(None).cast("int").alias("side")
    together = narrow.select(F.xxhash64("bucket").alias("tile"), "band", nobody, "node", "root")
    everyone = wide.select("*", F.lit(0).alias("side"), _draw(3, F.col("blocks")).alias("x"), _every(F.col("minors")).alias("y"))
    outside = wide.where("root != major")
    outside = outside.select("*", F.lit(1).alias("side"), _draw(4, F.col("minors")).alias("y"), _every(F.col("blocks")).alias("x"))
    tiles = everyone.unionByName(outside)
    return together.unionByName(tiles.select(F.xxhash64("bucket", "x", "y").alias("tile"), "band", "side", "node", "root"))


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, miss: float = MISS
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    A row's set are the distinct ``words``-word shingles of its text (A-Z in lower case, words parted by
    white space of ASCII); with fewer words the whole sequence is one. Sets link if their intersection has at least
    ``percent`` hundredths of their union. ``component_id`` is the least id that is reachable over links,
    ``kept`` tells whether it is the row's own.

    Null and empty texts and those without words have an empty set and are linked with nothing, not even
    with each other. Rows with equal sets are linked. Repeated rows are all returned. Null ids are passed over in ``component_id``, which
    is null (and ``kept`` true) where a component has no other. Only ``doc_id`` and ``text`` are read. No rows give no rows.
    Shingles are compared by 64-bit digests, sets by 128-bit ones.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("t"))
    sets = materialise(docs.mapInArrow(_hashed(words), _SETS))
    filled = sets.where("n > 0")
    first = F.min(F.struct("place", "doc_id", "t")).alias("row")
    classes = filled.groupBy("d1", "d2").agg(first, F.min("doc_id").alias("least"))
    classes = materialise(
        classes.select("d1", "d2", F.col("row.place").alias("node"), F.col("row.doc_id").alias("first"), F.col("row.t").alias("t"), "least")
    )
    members = _bucket_members(filled, classes)
    whole = _whole_sets(docs, classes, members, words)
    links = _links(_first_tiles(members), whole, percent, miss)
    joined = materialise(stars(links))
    more = _links(_second_tiles(members, joined), whole, percent, miss)
    rooted = materialise(stars(links.union(more)))
    discard(whole, links, more, joined)
    named = materialise(classes.join(rooted, "node", "left").select("d1", "d2", "least", F.coalesce("root", "node").alias("root")))
    ids = materialise(named.groupBy("root").agg(F.min("least").alias("component")))
    by_set = materialise(named.select("d1", "d2", "root").join(ids, "root").select("d1", "d2", "component"))
    own = sets.select("doc_id", F.col("n").alias("n_shingles"), "d1", "d2").join(by_set, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    done = materialise(own.select("doc_id", "n_shingles", component.alias("component_id")))
    discard(sets, classes, members, rooted, named, ids, by_set)
    return done.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
