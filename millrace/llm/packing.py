"""Order-preserving packing of token streams by dynamic programming.

Documents stay in the order of their partition and are laid end to end. A
sequence is a stretch of this stream of at most ``LENGTH`` tokens, so packing means
choosing cuts. Cuts are cheap at the end of a document, cost a little at the end
of a sentence and more elsewhere; a sequence costs its padding. The least total
is found over the possible cuts from left to right. As padding falls with the
length of a sequence, the best earlier cut for each place is the least of
``cost + position`` within a sliding window, kept in a monotone queue. Lengths that are a power of
two need no padding and are looked up besides.

Partitions are packed apart from each other, in one pass without a shuffle: a
task holds some hundred sequences at a time and carries the last ones on, so a
partition boundary costs the padding of one sequence.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 1024
#: Costs in tokens of padding: a sequence as such, a cut at a sentence's end, a cut elsewhere in a document.
SEQUENCE_COST = 16
SENTENCE_CUT = 3
OTHER_CUT = 24
#: Without a sentence's end over so many tokens, cuts become possible at every ``STEP`` tokens.
GAP, STEP = 256, 64
#: Tokens that a task gathers before it packs.
CHUNK = 1 << 18
#: Words whose ids a task keeps before it begins anew, and bytes of text that it encodes at once.
KEPT_WORDS = 400_000
BLOCK_BYTES = 8 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
#: Fixed value: how the vocabulary's byte-level tokenizer parts a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of texts by a byte-level BPE vocabulary file, with the ids of frequent words kept.

    The file's own library takes about 0.6 microseconds a character. Here texts are
    parted at single spaces and line feeds and before a last stop or comma, where the
    tokenizer parts them too; each distinct word of a block is looked up, only new
    ones are encoded, and the block's ids are gathered. Texts with other white
    space next to a space are encoded whole. Results equal those of the library.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        as_byte = _byte_alphabet()
        added = {t["content"]: t["id"] for t in described["added_tokens"] if t["special"]}
        ranks = {bytes(as_byte[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in added}
        self.encoding = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=added)
        self.special = added
        ids = max([*ranks.values(), *added.values()]) + 1
        self.sentence_end, self.after_space = np.zeros(ids, dtype=bool), np.zeros(ids, dtype=bool)
        for token, i in ranks.items():
            self.sentence_end[i] = token[-1:] in (b".", b"!", b"?") or b"\n" in token
            self.after_space[i] = token[:1] == b" "
        self.forget()

    def forget(self) -> None:
        """Empty the store: ids of all words end to end, where each word's begin, and their number."""
        self.words: dict[str, int] = {}
        self.flat, self.at, self.size = (np.zeros(0, dtype=t) for t in ("<u4", "i8", "i8"))
        # The empty word stands for a text's end, id 0.
        self._keep([""], np.zeros(1, dtype="<u4"), np.ones(1, dtype="i8"))

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.words.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.at = np.concatenate([self.at, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def _encode(self, words: list[str]) -> None:
        """Keep new words. Those of a space and more are encoded together and parted at their spaces."""
        usual = [w for w in words if w[0] == " " and w.count(" ") == 1 and len(w) > 1 and not w[1].isspace()]
        if usual:
            ids = np.array(self.encoding.encode_ordinary("".join(usual)), dtype="<u4")
            self._keep(usual, ids, np.diff(np.flatnonzero(self.after_space[ids]), append=len(ids)))
        others = list(set(words).difference(usual))
        if others:
            found = [self._whole(w) for w in others]
            ids = np.fromiter(chain.from_iterable(found), dtype="<u4")
            self._keep(others, ids, np.array([len(i) for i in found], dtype="i8"))

    def _whole(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all", disallowed_special=())

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, a 0 after each, and where each text's end in them."""
        if len(self.words) > KEPT_WORDS:
            self.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        texts = pa.concat_arrays([texts])  # without an offset
        offsets = np.frombuffer(texts.buffers()[1], dtype="i8", count=len(texts) + 1)
        raw = texts.buffers()[2] or pa.py_buffer(b"")
        begin = self._cuts(np.frombuffer(raw, dtype=np.uint8)[: offsets[-1]], offsets)
        # A text's end is an empty word: the position is there twice.
        ends = np.searchsorted(begin, offsets[1:], side="left") + np.arange(len(texts))
        begin = np.sort(np.concatenate([begin, offsets[1:], offsets[-1:]]))
        words = pa.LargeStringArray.from_buffers(len(begin) - 1, pa.py_buffer(begin), raw)
        coded = words.dictionary_encode()
        known = coded.dictionary.to_pylist()
        own = [self.words.get(w, -1) for w in known]
        new = [w for w, i in zip(known, own) if i < 0]
        if new:
            self._encode(new)
            own = [i if i >= 0 else self.words[w] for w, i in zip(known, own)]
        place = np.array(own, dtype="i8")[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.size[place]
        stops = np.cumsum(sizes)
        total = int(stops[-1]) if len(stops) else 0
        source = np.repeat(self.at[place] - stops + sizes, sizes) + np.arange(total)
        return self.flat[source], stops[ends]

    def _cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where words begin: at texts' beginnings and, in regular texts, where the tokenizer surely parts."""
        first, last = offsets[:-1], offsets[1:]
        filled = first < last
        space, line = raw == 32, raw == 10
        white = space | ((raw >= 9) & (raw <= 13)) | ((raw >= 28) & (raw <= 31))
        odd = np.flatnonzero((white[:-1] & white[1:]) | (white[1:] & ~space[1:] & ~line[1:]))
        irregular = set(np.searchsorted(last, odd, side="right").tolist())
        data = raw.tobytes()
        for sign in _ODD_WHITE + [t.encode() for t in self.special]:
            place = data.find(sign)
            while place >= 0:
                irregular.add(int(np.searchsorted(last, place, side="right")))
                place = data.find(sign, place + 1)
        plain = ((raw >= 97) & (raw <= 122)) | ((raw >= 65) & (raw <= 90)) | ((raw >= 48) & (raw <= 57))
        before_white = np.append(white[1:], True)
        before_white[last[filled] - 1] = True
        point = (raw == 46) | (raw == 44)
        point[1:] &= plain[:-1]
        point &= before_white
        point[first[filled]] = False
        starts = space | line | point
        starts[1:] |= line[:-1]
        starts[first[filled]] = True
        for i in irregular:
            starts[offsets[i] + 1 : offsets[i + 1]] = False
        return np.flatnonzero(starts)


#: Bytes of white space beyond ASCII, or the first two of them: a text that has them is encoded whole.
_ODD_WHITE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80"]


def _byte_alphabet() -> dict[str, int]:
    """Byte of each letter of the vocabulary file: printable ones stand for themselves, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def best_cuts(cuts: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """Chosen entries of ``cuts``: the first, the last, and those between at the least cost.

    ``cuts`` are increasing positions, none more than ``length`` after the one
    before; ``penalty`` is what a cut costs there. Of equal costs the longest
    sequence is taken.
    """
    at, cost_of = cuts.tolist(), penalty.tolist()
    pairs = []
    size = 1
    while size < length:  # a sequence of the whole length has no padding anyway
        i = np.searchsorted(cuts, cuts - size)
        j = np.flatnonzero((cuts >= size + cuts[0]) & (cuts[np.minimum(i, len(cuts) - 1)] == cuts - size))
        pairs.append(np.stack([j, i[j]], axis=1))
        size *= 2
    pairs = np.concatenate(pairs)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")].tolist()
    pairs.append((len(at), 0))
    total, origin, key = [0.0] * len(at), [0] * len(at), [0.0] * len(at)
    key[0] = at[0]
    queue = deque([0])
    nearest = 0
    for j in range(1, len(at)):
        here = at[j]
        while here - at[queue[0]] > length:
            queue.popleft()
        i = queue[0]
        best = key[i] + length - here
        while pairs[nearest][0] == j:
            other = pairs[nearest][1]
            if total[other] < best:
                best, i = total[other], other
            nearest += 1
        total[j] = best = best + cost_of[j] + SEQUENCE_COST
        origin[j] = i
        key[j] = own = best + here
        while queue and key[queue[-1]] > own:
            queue.pop()
        queue.append(j)
    chosen = [len(at) - 1]
    while chosen[-1]:
        chosen.append(origin[chosen[-1]])
    return chosen[::-1]


def possible_cuts(ids: np.ndarray, document_ends: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, from 0 to its end, and what a cut costs there."""
    n = len(ids)
    sentences = np.flatnonzero(sentence_end[ids]) + 1
    natural = np.unique(np.concatenate([[0], sentences, document_ends, [n]]))
    wide = np.flatnonzero(np.diff(natural) > GAP)
    forced = [np.arange(natural[i] + STEP, natural[i + 1], STEP) for i in wide]
    cuts = np.unique(np.concatenate([natural, *forced]))
    penalty = np.full(len(cuts), float(OTHER_CUT))
    penalty[np.searchsorted(cuts, sentences)] = SENTENCE_CUT
    penalty[np.searchsorted(cuts, document_ends)] = 0
    penalty[[0, -1]] = 0
    return cuts, penalty


class _Stream:
    """Documents laid end to end that are not packed yet."""

    def __init__(self, sentence_end: np.ndarray, first_sequence: int, length: int):
        self.sentence_end, self.sequence, self.length = sentence_end, first_sequence, length
        self.docs: list[tuple[int | None, int, int]] = []  # id, tokens, tokens packed before
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs += [(i, n, 0) for i, n in zip(doc_ids, np.diff(ends, prepend=0).tolist())]
        self.parts.append(ids)
        self.size += len(ids)

    def pack(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Pieces of all sequences, or of all but the last few, whose documents stay."""
        if not self.size:
            return
        ids = np.concatenate(self.parts)
        tokens = np.array([d[1] for d in self.docs])
        before = np.array([d[2] for d in self.docs])
        ends = np.cumsum(tokens - before)
        starts = ends - (tokens - before)
        cuts, penalty = possible_cuts(ids, ends, self.sentence_end)
        chosen = cuts[best_cuts(cuts, penalty, self.length)]
        if not last:
            chosen = chosen[chosen <= len(ids) - 4 * self.length]
        done = int(chosen[-1])
        begin = np.unique(np.concatenate([starts[starts < done], chosen[:-1]]))
        stop = np.append(begin[1:], done)
        doc = np.searchsorted(starts, begin, side="right") - 1
        seq = np.searchsorted(chosen, begin, side="right") - 1
        raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), stop.tolist())]
        columns = {
            "doc_id": pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            "start": begin - starts[doc] + before[doc],
            "length": stop - begin,
            "ids_crc32": np.array(crc, dtype=np.int64),
            "doc_tokens": tokens[doc],
            "sequence_id": self.sequence + seq,
            "offset": begin - chosen[seq],
        }
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in columns.items()})
        self.sequence += len(chosen) - 1
        kept = np.flatnonzero(ends > done).tolist()
        self.docs = [(*self.docs[i][:2], int(before[i] + max(0, done - starts[i]))) for i in kept]
        self.parts, self.size = ([ids[done:]], len(ids) - done) if kept else ([], 0)


def blocks(batch: pa.RecordBatch, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most so many bytes of its second column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype("i8")
    filled = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        before = filled[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(filled, before + most, side="right")))
        yield batch.slice(begin, stop - begin)
        begin = stop


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of the documents' token streams, each in a sequence of at most ``length`` tokens.

    A document is the ids of its text by the vocabulary file ``tokenizer``,
    followed by id 0; a null or empty text is the 0 alone. Each id lies in
    exactly one piece. ``sequence_id`` is unique; pieces of a sequence fill it
    from offset 0 on without gaps, in document order. Ids may be null or repeat,
    each row counts as a document. Only ``doc_id`` and ``text`` are read. No rows
    give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        stream = _Stream(known.sentence_end, TaskContext.get().partitionId() << 40, length)
        for batch in batches:
            for block in blocks(batch):
                stream.add(block.column(0).to_pylist(), *known.ids(block.column(1)))
                if stream.size >= CHUNK:
                    yield from stream.pack(last=False)
        yield from stream.pack(last=True)
        # The worker lives on, and other stages need its memory.
        known.forget()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
