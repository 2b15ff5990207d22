"""License scans with templates in markup, compiled into token automata.

Markup of a template, word by word: plain words are mandatory; ``{?`` ... ``}`` encloses an
optional region; ``{name:0-6}`` stands for 0 to 6 words of any kind. An automaton has one
state per word or any-word, held as bits of an integer: a word of the text moves all places
that are open at once, and optional states can be passed over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.llm.common import text_or_empty

#: Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Wording of public licenses and notices, with what may vary in it.
TEMPLATES = (
    ("{?released under the} mit license {?copyright {holder:0-12}} permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without restriction including without limitation the rights "
     "to use copy modify merge publish distribute sublicense and or sell copies of the software", "mit-text"),
    ("released under the {?terms of the} mit license", "mit-notice"),
    ("licensed under the apache license {?version 2 0} {?the license}", "apache-notice"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("{?this} {work:1-3} is licensed under the {?terms of the} gnu {?lesser} {?affero} general public license", "gpl-notice"),
    ("gnu general public license {?as published by the free software foundation either} version 3", "gpl-3.0"),
    ("gnu general public license {?as published by the free software foundation either} version 2", "gpl-2.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under {?a} {?creative commons} cc by nc {?nd} {?sa} {version:0-2}", "cc-by-nc"),
    ("licensed under {?a} {?creative commons} cc by {?sa} 4 0", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("all rights reserved", "all-rights-reserved"),
)

_SEPARATORS = bytes(range(0x00, 0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
#: A-Z to a-z, separators to spaces; bytes of other characters belong to words.
FOLD = bytes((b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b) for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def parsed(markup: str) -> list:
    """A list of words, ``("any", least, most)`` and ``("optional", list)``."""
    tokens = re.findall(r"\{\?|\{\w+:\d+-\d+\}|\}|[^\s{}]+", markup)
    open_lists: list[list] = [[]]
    for token in tokens:
        if token == "{?":
            open_lists.append([])
        elif token == "}":
            inner = open_lists.pop()
            open_lists[-1].append(("optional", inner))
        elif token[0] == "{":
            least, most = token[:-1].split(":")[1].split("-")
            open_lists[-1].append(("any", int(least), int(most)))
        else:
            open_lists[-1].append(token.encode())
    if len(open_lists) != 1:
        raise ValueError(f"unbalanced markup: {markup}")
    return open_lists[0]


class Automaton:
    """States before each word of a template, and one behind the last. ``open`` states are those that need no more word."""

    def __init__(self, markup: str):
        self.words: dict[bytes, int] = {}
        self.any = 0
        self._skips: list[tuple[int, int]] = []
        self.final = self._add(parsed(markup), 0)
        self._onward = {}
        for state in range(self.final, -1, -1):
            reach = 1 << state
            for start, end in self._skips:
                if start == state:
                    reach |= self._onward[end]
            self._onward[state] = reach
        self.first = self._onward[0]
        self.starts = {word for word, states in self.words.items() if states & self.first}
        if self.any & self.first or self.first >> self.final & 1:
            self.starts = None  # any word can begin it

    def _add(self, items: list, at: int) -> int:
        for item in items:
            if isinstance(item, bytes):
                self.words[item] = self.words.get(item, 0) | 1 << at
                at += 1
            elif item[0] == "any":
                for k in range(item[2]):
                    self.any |= 1 << at
                    if k >= item[1]:
                        self._skips.append((at, at + item[2] - k))
                    at += 1
            else:
                end = self._add(item[1], at)
                self._skips.append((at, end))
                at = end
        return at

    def onward(self, states: int) -> int:
        reach, rest = 0, states
        while rest:
            low = rest & -rest
            reach |= self._onward[low.bit_length() - 1]
            rest ^= low
        return reach

    def accepts_at(self, words: list[bytes], start: int) -> int | None:
        """The end of the shortest accepted place that begins there."""
        states, at = self.first, start
        while not states >> self.final & 1:
            if at == len(words):
                return None
            states = (states & (self.words.get(words[at], 0) | self.any)) << 1
            if not states:
                return None
            states = self.onward(states)
            at += 1
        return at


@dataclass(frozen=True)
class Place:
    start: int
    end: int
    label: str
    base: bool


class Scanner:
    """All templates and phrases. An automaton is started only at words that can begin it."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.by_start: dict[bytes, list[tuple[Automaton, str, bool]]] = {}
        self.anywhere: list[tuple[Automaton, str, bool]] = []
        for base, rows in ((True, phrases), (False, templates)):
            for markup, label in rows:
                automaton = Automaton(markup)
                if automaton.starts is None:
                    self.anywhere.append((automaton, label, base))
                for word in automaton.starts or ():
                    self.by_start.setdefault(word, []).append((automaton, label, base))

    def places(self, words: list[bytes]) -> list[Place]:
        found = []
        known = self.by_start
        for start, word in enumerate(words):
            if word in known:
                for automaton, label, base in known[word]:
                    end = automaton.accepts_at(words, start)
                    if end is not None:
                        found.append(Place(start, end, label, base))
        for automaton, label, base in self.anywhere:
            for start in range(len(words)):
                end = automaton.accepts_at(words, start)
                if end is not None:
                    found.append(Place(start, end, label, base))
        return found


def scanner(phrases=PHRASES, templates=TEMPLATES) -> Column:
    """A function of a text column: ``n_words``, the ``places`` (start, end, label, base) and what they come to."""
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("base", pa.bool_())])
    kind = pa.struct([("n_words", pa.int64()), ("places", pa.list_(place))])

    @F.arrow_udf("n_words bigint, places array<struct<start: bigint, end: bigint, label: string, base: boolean>>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scan_words = Scanner(phrases, templates).places
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text.as_py())
                rows.append({"n_words": len(words), "places": [vars(p) for p in scan_words(words)]})
            yield pa.array(rows, kind)

    return scan


def scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, text: str = "text", into: str = "licenses") -> DataFrame:
    """All columns of ``docs`` and the struct ``into`` of ``n_words`` and ``places``; a column of that name is replaced.

    A null or empty text has no words and no places. Places may overlap; each start of a
    phrase or template counts once, with its shortest end.
    """
    return docs.withColumn(into, scanner(phrases, templates)(text_or_empty(text)))


def report(docs: DataFrame) -> DataFrame:
    """Per document: base places, labels, and a score: 1 if a template's wording was met, 0.5 if only phrases, else 0."""
    found = scan(docs.select("doc_id", "text")).withColumn("base", F.filter("licenses.places", lambda p: p["base"]))

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    starts = F.transform("base", lambda p: p["start"])
    met = F.exists("licenses.places", lambda p: ~p["base"])
    return found.select(
        "doc_id", "licenses.n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("licenses.places")).alias("labels"),
        F.when(met, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"))


def as_regex(items: list) -> str:
    """The same template as a regular expression over words that each end in a space."""
    parts = []
    for item in items:
        if isinstance(item, bytes):
            parts.append(re.escape(item.decode()) + " ")
        elif item[0] == "any":
            parts.append(f"(?:[^ ]+ ){{{item[1]},{item[2]}}}")
        else:
            parts.append(f"(?:{as_regex(item[1])})?")
    return "".join(parts)


def _sql() -> str:
    def literal(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    starts = "\n            UNION ALL ".join(
        f"SELECT r, i, {literal(label)} AS label FROM w WHERE " + " AND ".join(f"w{k or ''} = {literal(word)}" for k, word in enumerate(markup.split()))
        for markup, label in PHRASES)
    own = ", ".join(f"CASE WHEN regexp_matches(s, {literal(' ' + as_regex(parsed(markup)))}) THEN {literal(label)} END" for markup, label in TEMPLATES)
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), e AS (SELECT *, CASE WHEN len(ws) = 0 THEN '' ELSE ' ' || array_to_string(ws, ' ') || ' ' END AS s FROM d
), u AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d
), w AS (SELECT *, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM u WINDOW o AS (PARTITION BY r ORDER BY i)
), p AS ({starts}
), b AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, list_sort(list_distinct(list(label))) AS ls FROM p GROUP BY r
), m AS (SELECT r, [x FOR x IN [{own}] IF x IS NOT NULL] AS own FROM e)
SELECT e.doc_id, len(e.ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.a::BIGINT AS first_word, b.z::BIGINT AS last_word,
    coalesce(array_to_string(b.ls, ','), '') AS base_labels, array_to_string(list_sort(list_distinct(list_concat(coalesce(b.ls, []), m.own))), ',') AS labels,
    CASE WHEN len(m.own) > 0 THEN 1.0 WHEN b.n > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM e JOIN m ON e.r = m.r LEFT JOIN b ON e.r = b.r
"""


REPORT_SQL = _sql()
