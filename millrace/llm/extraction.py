"""Main text of web pages, with boilerplate told by what the pages of a host repeat.

Markup is taken apart into blocks of text in page order. Menus, forms, adverts and the like go by their
elements, and so does what stands outside the article of a page that has one. All other blocks are judged by
the host's suffix array: the pages' token streams are laid together, articles included, and all suffixes that share their
first ``RUN_TOKENS`` tokens form one interval of the array. An interval that holds suffixes of enough different streams is a
repeated substring, and a block that such substrings cover from end to end is boilerplate. An article of which
most would go is a reprint and stands.

The array is sorted in groups of a host's streams (``main_text``): what a share of all streams holds, as large a share of
some group holds, so only the common suffixes of groups are counted over the host. ``extract`` judges pages without an
article alone, at any bounds, and can cut the covered tokens out of blocks as well; its intervals are groups of a
shuffle by host and tokens.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.minhash import mix
from millrace.llm.urls import host_of
from millrace.session import discard, materialise

#: Tokens that a repeated substring has at least.
RUN_TOKENS = 6
#: Distinct pages of a host, and share of them, that repeat a run of boilerplate.
BOILERPLATE_PAGES, BOILERPLATE_SHARE = 5, 0.5
#: Streams of a host whose suffixes are sorted at once, on average, and rounds in which groups are shuffled.
GROUP_PAGES, ROUNDS = 1000, 4

PARSED = (
    "page_id long, url string, host string, text string, open array<string>, stream long, keys array<long>, "
    "others array<long>"
)
LAID = "page_id long, url string, host string, article boolean, blocks array<string>, stream long, others array<long>"

#: A tag whose quoted values may hold ``>`` (else it ends at the first one), and one that ends at the first ``>``.
_TAG, _TO_FIRST = (
    re.compile(rf"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)({inside})>)""", re.S)
    for inside in (r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+|(?P<loose>[^>]*+)""", "[^>]*+")
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_RAW = {n: re.compile(rf"</{n}\b[^>]*+(?:>|\Z)", re.I) for n in ("script", "style", "textarea", "noscript", "template", "iframe", "svg", "select", "title")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: Elements that end an open one of the same kind, up to what holds them.
_SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
_DROPPED = frozenset("aside button dialog footer form head header label menu nav object canvas audio video".split())
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words in the class or id of what is no article.
_CHROME = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion breadcrumb breadcrumbs comment comments "
    "reply replies respond disqus cookie cookies consent gdpr notice newsletter subscribe subscription signup related recommended "
    "pagination pager toolbar masthead copyright disclaimer".split()
)
#: The same, but common in what holds a whole page: an article inside is one all the same.
_FRAME = frozenset("sidebar nav navbar navigation menu header footer banner widget social share sharing popup modal".split())
_NOT = frozenset("has no with without".split())

MAIN, OTHER, CHROME, FRAME = "main", "other", "chrome", "frame"


def _kind(name: str, attributes: str, outer: str) -> str:
    """What the inside of an element is, given what the element itself is in."""
    words, role = set(), ""
    for key, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
        elif key == "role":
            role = value
    plain = not words & _NOT
    if outer == CHROME or (plain and words & _CHROME) or role in _ROLES:
        return CHROME
    if name in ("article", "main") or role in ("main", "article"):
        return MAIN
    if name in _DROPPED and not (name == "header" and outer == MAIN):
        return CHROME
    if plain and words & _FRAME and not (outer == MAIN and words & {"header"}):
        return CHROME if outer == MAIN else FRAME
    return outer


def _closable(page: str) -> tuple[list[int], list[bool]]:
    """Places of ``>`` and quotes, and whether from there, outside quotes, a ``>`` outside quotes follows."""
    places = [m.start() for m in re.finditer("[>\"']", page)]
    closes, following = [False] * (len(places) + 1), {}
    for k in range(len(places) - 1, -1, -1):
        mark = page[places[k]]
        if mark == ">":
            closes[k] = True
        else:
            if mark in following:
                closes[k] = closes[following[mark] + 1]
            following[mark] = k
    return places, closes


def _tag_reader(page: str) -> Callable[[int], re.Match | None]:
    """Function to the first tag or comment from a place on, for places that rise.

    All calls together take a time in proportion to the page: no tag is tried where no ``>`` follows, and after a tag
    whose quotes do not close it is known beforehand whether those of another do.
    """
    last = page.rfind(">")
    closable: list[tuple[list[int], list[bool]]] = []

    def first(at: int) -> re.Match | None:
        if at > last:
            comment = page.find("<!--", at)
            return _TAG.match(page, comment) if comment >= 0 else None
        tag = (_TO_FIRST if closable else _TAG).search(page, at)
        if not tag:
            return None
        if not closable and tag["loose"] is not None:
            closable.append(_closable(page))
        elif closable and tag[2]:
            places, closes = closable[0]
            if closes[bisect_left(places, tag.start(3))]:
                return _TAG.match(page, tag.start())
        return tag

    return first


def blocks(page: str | None) -> tuple[list[str], list[str], list[str]]:
    """Blocks of a page's text: inside articles, in the open, and in menus and the like."""
    page = page or ""
    found: dict[str, list[str]] = {MAIN: [], OTHER: [], CHROME: [], FRAME: []}
    stack: list[tuple[str, str]] = []
    open_: Counter[str] = Counter()
    pieces: list[str] = []
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            found[stack[-1][1] if stack else OTHER].append(text)

    def close(name: str, limits: tuple[str, ...] = ()) -> None:
        if not open_[name]:
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in limits:
                return
            if stack[i][0] == name:
                open_.subtract(n for n, _ in stack[i:])
                del stack[i:]
                return

    tag_from = _tag_reader(page)
    while True:
        tag = tag_from(at)
        pieces.append(page[at : tag.start() if tag else len(page)])
        if not tag:
            break
        at = tag.end()
        end, name, attributes = tag[1], (tag[2] or "").lower(), tag[3]
        if not name:
            continue
        if name in _BLOCK:
            flush()
        elif name == "br":
            pieces.append(" ")
        if end:
            close(name)
            continue
        if name in _RAW:
            stop = _RAW[name].search(page, at)
            at = stop.end() if stop else len(page)
            continue
        if name in _VOID or attributes.endswith("/") and name not in _BLOCK:
            continue
        if name in _BLOCK:
            close("p", ("article", "section", "div", "table", "td", "main", "body"))
            if name in _SIBLINGS:
                close(name, _SIBLINGS[name])
        open_[name] += 1
        stack.append((name, _kind(name, attributes, stack[-1][1] if stack else OTHER)))
    flush()
    return found[MAIN], found[OTHER], found[CHROME] + found[FRAME]


@lru_cache(maxsize=1 << 18)
def _digest(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass"))


def suffix_keys(tokens: list[str], size: int) -> np.ndarray:
    """Signed digests of the first ``size`` tokens of each suffix that has as many."""
    coded = np.fromiter(map(_digest, tokens), dtype="u8", count=len(tokens))
    keys = np.zeros(max(0, len(coded) - size + 1), dtype="u8")
    for i in range(size):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + coded[i : i + len(keys)])
    return keys.view("i8")


def _parsed(size: int):
    """Function from pages to their text and what the host's suffix array needs of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, opened, streams, keys, others = [], [], [], [], []
            for page in batch.column(3):
                main, free, chrome = blocks(page.as_py())
                texts.append("\n\n".join(main) if main else None)
                opened.append([] if main else free)
                tokens, menus = " ".join(free).split(), " ".join(chrome).split()
                keys.append(suffix_keys(tokens, size))
                others.append(suffix_keys(menus, size))
                # A page's stream is all that stands outside its article.
                stream = " ".join(tokens + menus).encode("utf-8", "surrogatepass")
                streams.append(xxhash.xxh64_intdigest(stream) - (1 << 63))
            columns = [
                *batch.columns[:3], pa.array(texts, pa.string()), pa.array(opened, pa.list_(pa.string())),
                pa.array(streams, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(others, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.strip().split(" ")[0] for c in PARSED.split(",")])

    return run


def _unique_runs(size: int, whole_blocks: bool):
    @F.pandas_udf(T.StringType())
    def keep(opened: pd.Series, covered: pd.Series) -> pd.Series:
        texts = []
        for parts, starts in zip(opened, covered):
            tokens = [p.split() for p in parts]
            kept = np.ones(sum(map(len, tokens)) + size, dtype=bool)
            for start in () if starts is None else starts:
                kept[start : start + size] = False
            out, at = [], 0
            for own in tokens:
                here = kept[at : at + len(own)]
                left = own if whole_blocks and here.any() else [t for t, k in zip(own, here) if k]
                at += len(own)
                if left:
                    out.append(" ".join(left))
            texts.append("\n\n".join(out))
        return pd.Series(texts)

    return keep


def repeated_keys(parsed: DataFrame, least_pages: int = 2, share: float = 0.0) -> DataFrame:
    """``host, key`` of the suffix-array intervals with suffixes of so many different streams of a host.

    These are ``least_pages`` at least, and ``share`` of the host's streams.
    """
    first = materialise(parsed.groupBy("host", "stream").agg(F.min("row").alias("row")))
    pages = parsed.select("row", "host", F.array_distinct(F.concat("keys", "others")).alias("keys"))
    suffixes = pages.join(first.select("row"), "row", "left_semi").select("host", F.explode("keys").alias("key"))
    groups = suffixes.groupBy("host", "key").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    hosts = first.groupBy("host").agg(F.count("*").alias("streams"))
    found = materialise(groups).join(materialise(hosts), "host")
    return found.where(F.col("pages") >= F.col("streams") * share).select("host", "key")


def extract(
    pages: DataFrame, run_tokens: int = RUN_TOKENS, least_pages: int = 2, share: float = 0.0, whole_blocks: bool = False
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    Inside a block white space is one space; blocks are joined by two line feeds.
    A page with articles has their text, all of it; another has what stands in the open, without
    the tokens covered by substrings that ``least_pages`` pages of the host and a ``share`` of them
    repeat; with ``whole_blocks`` a block goes if all of its tokens are covered, and stands
    as it is otherwise. Pages whose streams are equal count as
    one, so copies do not remove each other. Null and empty pages have an empty text; URLs without
    a host share the empty one. Repeated rows each have their result. Further
    columns are not read. No rows give no rows.
    """
    given = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    parsed = materialise(given.mapInArrow(_parsed(run_tokens), PARSED).withColumn("row", F.monotonically_increasing_id()))
    repeated = materialise(repeated_keys(parsed, least_pages, share))
    undecided = parsed.where(F.col("text").isNull())
    places = undecided.select("row", "host", F.posexplode("keys").alias("place", "key"))
    covered = places.join(repeated, ["host", "key"], "left_semi").groupBy("row").agg(F.collect_list("place").alias("covered"))
    judged = undecided.join(materialise(covered), "row", "left").withColumn("text", _unique_runs(run_tokens, whole_blocks)("open", "covered"))
    columns = ["page_id", "url", "text"]
    every = parsed.where(F.col("text").isNotNull()).select(*columns).unionByName(judged.select(*columns))
    return every.withColumn("n_chars", F.length("text").cast("long"))


def _laid_out(size: int):
    """Function from pages to the blocks to be judged, and the suffixes of what else stands on a page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            articles, judged, streams, others = [], [], [], []
            for page in batch.column(3):
                main, free, chrome = blocks(page.as_py())
                articles.append(bool(main))
                judged.append(main or free)
                rest = " ".join((free if main else []) + chrome)
                others.append(suffix_keys(rest.split(), size))
                stream = "\n".join([" ".join(judged[-1]), rest]).encode("utf-8", "surrogatepass")
                streams.append(xxhash.xxh64_intdigest(stream) - (1 << 63))
            columns = [
                *batch.columns[:3], pa.array(articles, pa.bool_()), pa.array(judged, pa.list_(pa.string())),
                pa.array(streams, pa.int64()), pa.array(others, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in LAID.split(", ")])

    return run


def _tokens(parts: list[str]) -> list[str]:
    return " ".join(parts).split()


def _intervals(size: int, least_pages: int, share: float):
    """Function from pages sorted by host and group to a group's suffix array: intervals of enough of its streams.

    Of a host with one group these are its repeated substrings, of another all that may be.
    """

    def pages(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, len(batch), 64):
                yield from batch.slice(at, 64).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (host, _, groups), rows in groupby(pages(batches), key=lambda r: (r["host"], r["group"], r["groups"])):
            streams = {}
            for r in rows:  # one page stands for equal streams and gives each of its suffixes once
                if r["stream"] not in streams:
                    own = suffix_keys(_tokens(r["blocks"]), size)
                    streams[r["stream"]] = np.unique(np.concatenate([own, np.array(r["others"], dtype="i8")]))
            key, count = np.unique(np.concatenate(list(streams.values())), return_counts=True)
            found = key[(count >= share * len(streams)) & (count >= (least_pages if groups == 1 else 1))]
            columns = [pa.array([host] * len(found), pa.string()), pa.array([groups] * len(found), pa.int64()), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "groups", "key"])

    return run


def _held(size: int):
    """Function from pages and suffixes of their host to those that a page has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                out = []
                for r in batch.slice(at, 64).to_pylist():
                    own = np.concatenate([suffix_keys(_tokens(r["blocks"]), size), np.array(r["others"], dtype="i8")])
                    out += [(r["host"], r["stream"], k) for k in np.intersect1d(own, np.array(r["asked"], dtype="i8")).tolist()]
                columns = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "stream", "key"])

    return run


def common_keys(laid: DataFrame, size: int, least_pages: int, share: float) -> DataFrame:
    """``host, keys``: the intervals with suffixes of so many different streams of a host, and such a share of them."""
    streams = laid.select("host", "stream").distinct().groupBy("host").agg(F.count("*").alias("streams"))
    hosts = materialise(streams.where(F.col("streams") >= least_pages).withColumn("groups", F.ceil(F.col("streams") / GROUP_PAGES)))
    group = F.pmod(F.xxhash64("stream"), "groups")
    dealt = laid.join(hosts, "host").select("host", "streams", "groups", group.alias("group"), "stream", "blocks", "others")
    parts = []
    for i in range(ROUNDS):
        part = dealt.where(F.pmod(F.xxhash64("host", "group"), F.lit(ROUNDS)) == i)
        part = part.repartition("host", "group").sortWithinPartitions("host", "group")
        parts.append(materialise(part.mapInArrow(_intervals(size, least_pages, share), "host string, groups long, key long")))
    found = reduce(DataFrame.union, parts)
    asked = materialise(found.where("groups > 1").groupBy("host").agg(F.collect_set("key").alias("asked")))
    held = dealt.join(asked, "host").select("host", "stream", "blocks", "others", "asked")
    counts = held.mapInArrow(_held(size), "host string, stream long, key long").groupBy("host", "key").agg(F.count_distinct("stream").alias("pages"))
    enough = (F.col("pages") >= least_pages) & (F.col("pages") >= F.col("streams") * share)
    counted = counts.join(hosts, "host").where(enough).select("host", "key")
    every = found.where("groups = 1").select("host", "key").union(counted)
    keys = materialise(every.groupBy("host").agg(F.collect_list("key").alias("keys")))
    discard(hosts, asked, *parts)
    return keys


def _left_blocks(size: int):
    @F.pandas_udf(T.StringType())
    def left(judged: pd.Series, article: pd.Series, keys: pd.Series) -> pd.Series:
        texts = []
        for parts, stands, repeated in zip(judged, article, keys):
            kept = list(parts)
            if repeated is not None:
                tokens = _tokens(parts)
                free = np.ones(len(tokens) + size, dtype=bool)
                for start in np.flatnonzero(np.isin(suffix_keys(tokens, size), repeated)):
                    free[start : start + size] = False
                ends = np.cumsum([len(p.split()) for p in parts])
                kept = [p for p, end in zip(parts, ends) if free[end - len(p.split()) : end].any()]
                if stands and 2 * len(_tokens(kept)) < len(tokens):
                    kept = list(parts)
            texts.append("\n\n".join(kept))
        return pd.Series(texts, dtype=object)

    return left


def main_text(
    pages: DataFrame, run_tokens: int = RUN_TOKENS, least_pages: int = BOILERPLATE_PAGES, share: float = BOILERPLATE_SHARE
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``, as in ``extract``; articles are judged, too.

    A page has the blocks of its articles, or without one those in the open, but for those that runs of ``run_tokens`` tokens
    cover from end to end which ``least_pages`` different streams of the host and a ``share`` of them repeat. A stream is all of a
    page's tokens. No block loses a part, and an article stands as it is if less than half of its tokens would.
    """
    given = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    laid = materialise(given.mapInArrow(_laid_out(run_tokens), LAID))
    keys = common_keys(laid, run_tokens, least_pages, share)
    text = _left_blocks(run_tokens)("blocks", "article", "keys")
    judged = laid.select("page_id", "url", "host", "blocks", "article").join(keys, "host", "left").select("page_id", "url", text.alias("text"))
    return judged.withColumn("n_chars", F.length("text").cast("long"))
