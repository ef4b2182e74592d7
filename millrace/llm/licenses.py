"""Licence notices and identifier expressions in texts.

An Aho-Corasick automaton over a text's words finds notice phrases, each of which
stands for a label; a second one finds identifier tags. What follows a tag on its
line is read as a licence expression: a shunting-yard parser puts ``and``, ``or``,
``with`` and brackets into postfix order, and the expression is evaluated for the
labels that it names and for whether it can be met by permissive licences alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise, takewhile
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notices.
PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "permission is hereby granted free of charge": "mit",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0": "cc0",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Beginnings of identifiers whose licences ask for no more than notice.
PERMISSIVE = ("0bsd", "apache-", "bsd-", "bsl-", "cc-by-4", "cc0-", "isc", "mit", "unlicense", "zlib")
#: How tightly operators bind; ``with`` attaches an exception to the identifier before it.
BINDING = {"or": 1, "and": 2, "with": 3}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, n_expressions long, n_broken long, permissive boolean"
)

#: Byte by byte: ASCII letters in lower case, digits and all beyond ASCII stay, the rest parts words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_TOKEN = re.compile(r"[()]|[a-z0-9.+:-]+")


class Expression(NamedTuple):
    """Labels that an expression names, and whether permissive licences alone can meet it."""

    labels: frozenset[str]
    permissive: bool


def postfix(tokens: list[str]) -> list[str]:
    """Tokens in postfix order by the shunting-yard method; ``ValueError`` if they are no expression."""
    out, waiting, operand = [], [], True  # operand: an identifier or a bracket is to come
    for token in tokens:
        if token == "(":
            if not operand:
                raise ValueError("bracket after an operand")
            waiting.append(token)
        elif token == ")":
            if operand:
                raise ValueError("operand missing")
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError("bracket not opened")
            waiting.pop()
        elif token in BINDING:
            if operand:
                raise ValueError("operand missing")
            while waiting and waiting[-1] != "(" and BINDING[waiting[-1]] >= BINDING[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        else:
            if not operand:
                raise ValueError("operator missing")
            out.append(token)
            operand = False
    if operand or "(" in waiting:
        raise ValueError("not complete")
    return out + waiting[::-1]


def evaluate(order: list[str]) -> Expression:
    """Value of an expression in postfix order. An exception is no licence: it only leaves its own as it is."""
    values: list[str | bool] = []  # an identifier, or whether permissive licences meet what is evaluated
    labels: set[str] = set()

    def met(value: str | bool) -> bool:
        if isinstance(value, str):
            labels.add(value)
            return value.startswith(PERMISSIVE)
        return value

    for token in order:
        if token not in BINDING:
            values.append(token)
            continue
        right, left = values.pop(), values.pop()
        if token == "with":
            if not isinstance(left, str) or not isinstance(right, str):
                raise ValueError("an exception follows an identifier")
            labels.add(f"{left}-with-{right}")
            values.append(met(left))
            continue
        a, b = met(left), met(right)
        values.append(a and b if token == "and" else a or b)
    (value,) = values
    permissive = met(value)
    return Expression(frozenset(labels), permissive)


def expression_tokens(tokens: Iterable[str]) -> list[str]:
    """The longest beginning of ``tokens`` that is an expression, in one pass; empty if there is none."""
    read, complete = [], 0
    operand = True  # an identifier or a bracket is to come
    # Of the innermost open bracket: whether it has no operator so far, whether ``with`` waits
    # for its exception, and whether the last operand is an identifier alone.
    single, attached, plain = True, False, False
    around = []
    for token in tokens:
        if token == "(":
            if not operand:
                break
            around.append((single, attached))
            single, attached = True, False
        elif token in BINDING:
            if operand or token == "with" and not plain:
                break
            single, attached, operand = False, token == "with", True
        else:
            if token == ")":
                if operand or not around:
                    break
                plain = single and plain
                single, attached = around.pop()
            elif operand:
                plain = True
            else:
                break
            operand = False
            if attached:
                if not plain:
                    break
                attached = plain = False
        read.append(token)
        if not operand and not around:
            complete = len(read)
    return read[:complete]


def read_expression(
    text: str, start: int = 0, stop: int | None = None, tagged: bool = False
) -> tuple[Expression | None, bool]:
    """The longest expression at the beginning of ``text[start:stop]`` (lower case), and whether there is none.

    Prose may follow an expression, so tokens are taken as long as they make one. Where a tag begins at
    ``stop`` (``tagged``), an identifier that runs into it is none.
    """
    found = _TOKEN.finditer(text, start, len(text) if stop is None else stop)
    if tagged:
        found = takewhile(lambda token: token.end() < stop or token[0] in "()", found)
    tokens = expression_tokens(token[0].rstrip(".:-") or token[0] for token in found)
    return (evaluate(postfix(tokens)), False) if tokens else (None, True)


@lru_cache(maxsize=1)
def _phrases() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in (PHRASES | BASE_PHRASES).items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, label, phrase in BASE_PHRASES))
    found.make_automaton()
    return found


@lru_cache(maxsize=1)
def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for tag in TAGS:
        found.add_word(tag, tag)
    found.make_automaton()
    return found


def scan_text(text: str | None) -> tuple:
    """The columns of ``SCHEMA`` after ``doc_id`` for one text; null counts as empty.

    Places are counted in words from 0. The score is the chance that the text
    states a licence, had every notice and expression found a chance of one half
    to be one, base phrases of three quarters. An expression ends where another tag begins, so each
    part of a line is read once.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.translate(_WORDS).split()
    joined = " " + b" ".join(words).decode("utf-8", "surrogatepass") + " "
    base, starts, labels, n_base, missed = set(), [], set(), 0, 1.0
    at, passed = 0, 0  # words before the place ``at`` of the joined words
    for end, (length, label, is_base) in _phrases().iter(joined):
        labels.add(label)
        missed *= 0.25 if is_base else 0.5
        if is_base:
            place = end - length
            # Matches come by their ends, so a long phrase may begin before an earlier one.
            passed, at = passed + (joined.count(" ", at, place) if place >= at else -joined.count(" ", place, at)), place
            base.add(label)
            starts.append(passed)
            n_base += 1
    expressions = broken = 0
    permissive = None
    lowered = data.lower().decode("utf-8", "surrogatepass")
    line = -1
    tags = [(end + 1 - len(tag), end + 1) for end, tag in _tags().iter(lowered)]
    for (_, start), (following, _) in pairwise([*tags, (len(lowered) + 1, 0)]):
        if line < start:
            line = lowered.find("\n", start)
            line = line if line >= 0 else len(lowered)
        value, none = read_expression(lowered, start, min(line, following), following <= line)
        if none:
            broken += 1
            continue
        expressions += 1
        missed *= 0.5
        labels |= value.labels
        permissive = value.permissive if permissive is None else permissive and value.permissive
    return (
        len(words), n_base, min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
        ",".join(sorted(labels)), 1 - missed, expressions, broken, permissive,
    )


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.strip().split(" ") for f in SCHEMA.split(",")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = [(i, *scan_text(t.as_py())) for i, t in zip(ids, batch.column(1))]
        columns = list(zip(*rows)) or [[]] * len(names)
        arrays = [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, names)]
        yield pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in names])


def scan(docs: DataFrame) -> DataFrame:
    """Licences stated in each text, one row per row of ``docs``, without a shuffle.

    ``base_labels`` are those of the base phrases, ``labels`` all, sorted and joined by commas, empty
    if none. ``n_broken`` counts tags without an expression behind them.
    ``permissive`` says whether all expressions can be met by permissive licences,
    null without any. Only ``doc_id`` and ``text`` are read; ids may be null or
    repeat. No rows give no rows.
    """
    return docs.select("doc_id", "text").mapInArrow(_scanned, SCHEMA)
