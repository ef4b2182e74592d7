"""URL rules and block lists as memory-mapped arrays of sorted digests.

A rule is a host and the beginning of a path; its key is one string, ``host/path``. The
64-bit digests of all keys are sorted and written, with the strings behind them, to files in
the shared folder, which Spark brings to each executor. There a task maps them into
memory, forms the keys that could fit a URL (its host and parent domains, each with
the beginnings of its path that have the length of some rule's path), finds them by
vectorised binary search and confirms the full strings, as digests may collide.
"""

from __future__ import annotations

import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path

BLOCK, ALLOW = "block", "allow"
#: Bytes of keys in one file, on average; the driver writes one file at a time.
FILE_BYTES = 32 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, in lower case; empty without one."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without a host part."""
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


class DigestFiles:
    """Names of the files that hold the digests of a rule set, and the lengths of its paths."""

    def __init__(self, rules: DataFrame):
        """``rules`` has ``host, path, verdict``; a null path is empty, rules without a host are passed over.

        Hosts are taken in lower case. A key with two verdicts blocks.
        """
        context = rules.sparkSession.sparkContext
        keyed = rules.select(lower_ascii("host").alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        keyed = keyed.where((F.col("host") != "") & F.col("verdict").isin(BLOCK, ALLOW))
        unique = keyed.groupBy(F.concat("host", "path").alias("key")).agg(
            F.max("verdict").alias("verdict"), F.min(F.length("path")).alias("length")
        )
        size, lengths = unique.agg(F.sum(F.octet_length("key")), F.collect_set("length")).first()
        self.lengths = sorted(lengths)
        self.names = []
        files = -(-(size or 0) // FILE_BYTES)
        for i in range(files):
            mine = unique.where(F.pmod(F.xxhash64("key"), F.lit(files)) == i)
            path = _write(rules, _packed([(r["key"], r["verdict"]) for r in mine.select("key", "verdict").collect()]))
            context.addFile(path)
            self.names.append(path.rsplit("/", 1)[1])


def _packed(rules: list[tuple[str, str]]) -> bytes:
    """Number of keys, their sorted digests, where their strings end, and the strings, with ``+`` before allowed ones."""
    entries = sorted((_digest(k), ("+" if v == ALLOW else "-") + k) for k, v in rules)
    strings = [s.encode("utf-8") for _, s in entries]
    head = np.array([len(entries), *(d for d, _ in entries), *np.cumsum([len(s) for s in strings])], dtype="<u8")
    return head.tobytes() + b"".join(strings)


def _write(frame: DataFrame, data: bytes) -> str:
    spark = frame.sparkSession
    path = f"{scratch_path(spark)}/{uuid.uuid4().hex}.digests"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(data)
    out.close()
    return path


def _digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


class Digests:
    """A mapped file of ``_packed`` form."""

    def __init__(self, path: str):
        words = np.memmap(path, dtype=np.uint8, mode="r")
        n = int(words[:8].view("<u8")[0])
        self.digests = words[8 : 8 + 8 * n].view("<u8")
        self.ends = words[8 + 8 * n : 8 + 16 * n].view("<u8")
        self.strings = words[8 + 16 * n :]

    def find(self, keys: list[str], digests: np.ndarray) -> dict[int, str]:
        """For each place in ``keys`` whose key is in the file its verdict."""
        found = {}
        low = np.searchsorted(self.digests, digests, side="left")
        high = np.searchsorted(self.digests, digests, side="right")
        for i in np.flatnonzero(high > low).tolist():
            key = keys[i].encode("utf-8", "surrogatepass")
            for at in range(int(low[i]), int(high[i])):
                entry = self.strings[int(self.ends[at - 1]) if at else 0 : int(self.ends[at])].tobytes()
                if entry[1:] == key:
                    found[i] = ALLOW if entry[:1] == b"+" else BLOCK
        return found


@lru_cache(maxsize=64)
def _mapped(name: str) -> Digests:
    return Digests(SparkFiles.get(name))


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Keys that could fit, the longest first."""
    if not host:
        return []
    hosts, at = [host], host.find(".")
    while at >= 0:
        hosts.append(host[at + 1 :])
        at = host.find(".", at + 1)
    paths = [path[:n] for n in lengths if n <= len(path)]
    return sorted((h + p for h in hosts if h for p in paths), key=len, reverse=True)


def fitting(rules: DigestFiles):
    """Column function from host and path to ``(key, verdict)`` of the longest rule that fits, nulls if none."""
    names, lengths = rules.names, rules.lengths

    @F.pandas_udf(T.StructType([T.StructField("key", T.StringType()), T.StructField("verdict", T.StringType())]))
    def probe(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        wanted = [candidates(h, p, lengths) for h, p in zip(hosts, paths)]
        stops = np.cumsum([len(w) for w in wanted])
        keys = list(chain.from_iterable(wanted))
        digests = np.fromiter(map(_digest, keys), dtype="<u8", count=len(keys))
        found: dict[int, str] = {}
        for name in names:
            found |= _mapped(name).find(keys, digests)
        rows = [(None, None)] * len(wanted)
        # A URL's candidates run from the longest to the shortest, so the first one found stands.
        for at in sorted(found, reverse=True):
            rows[int(np.searchsorted(stops, at, side="right"))] = (keys[at], found[at])
        return pd.DataFrame(rows, columns=["key", "verdict"])

    return probe


def judge(pages: DataFrame, rules: DataFrame, block_list: DataFrame | None = None) -> DataFrame:
    """``pages`` (``page_id``, ``url``) with ``host, path, rule, verdict, listed``.

    The longest rule that fits a URL gives its verdict and ``rule``, the rule's key; a rule
    fits its host and all subdomains if the URL's path begins with the rule's. Without one, a
    URL that an entry of ``block_list`` fits (``listed``) is blocked and any other allowed. A null
    URL or one without ``://`` has an empty host, which nothing fits. Each row is
    judged by itself, without a shuffle; other columns are not read. No rows give no rows.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parsed.withColumn("__rule", fitting(DigestFiles(rules))("host", "path"))
    listed = F.lit(None).cast("string")
    if block_list is not None:
        judged = judged.withColumn("__list", fitting(DigestFiles(block_list))("host", "path"))
        listed = F.col("__list.key")
    verdict = F.coalesce("__rule.verdict", F.when(listed.isNotNull(), BLOCK).otherwise(ALLOW))
    return judged.select(
        "page_id", "host", "path", F.col("__rule.key").alias("rule"), verdict.alias("verdict"), listed.alias("listed")
    )
