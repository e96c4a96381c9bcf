"""Licence texts and notices, found by template markup compiled to automata over words.

A template is wording with two kinds of marked regions: ``<<beginOptional>> ... <<endOptional>>`` may be
left out, and ``<<var;name=...>>`` is replaceable, either by one of the wordings of ``match="a|b c"`` or by
any words, as many as ``words="least-most"`` says. All other wording is mandatory. A template is compiled
to an automaton with one state per word (position automaton): ``follow`` holds the states after each, as
bits of one number. A place of a text is accepted if the automaton gets from its first mandatory word to
an end, so every mandatory word stands there, in order and with nothing else between. The first mandatory
words are looked for in the whole text; the automaton runs from there, and stops at the first word that
no live state takes, so its work is bounded by the template and not by the text.

Words are compared, as in the other operators: lower-cased (A-Z only) runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Texts are handled as UTF-8 bytes with one space between words.
One narrow pass; only the text column goes to Python, in Arrow batches.

The score is 1 if the text of a licence was accepted, 0.8 if a notice that names one was, 0.5 if only a
phrase of the base was found, else 0.

Defined cases: a null or empty text has no words, no places and score 0; repeated rows each get their own
result; an empty table gives an empty result; other columns pass through, but one of the result's name,
which is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import table

#: Phrases of the base and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public licences.
_BSD_START = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """
<<beginOptional>>3<<endOptional>> Neither the name of <<var;name="holder";words="1-20">> nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written
permission."""
_BSD_END = """
This software is provided by <<var;name="holder";words="1-20">> "as is" and any express or implied warranties,
including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are
disclaimed. In no event shall <<var;name="holder";words="1-20">> be liable for any direct, indirect, incidental,
special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or
services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability,
whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use
of this software, even if advised of the possibility of such damage."""
TEXTS = {
    "mit-text": """
<<beginOptional>>MIT License<<endOptional>> <<var;name="copyright";words="0-40">>
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
substantial portions of the Software. The Software is provided "as is", without warranty of any kind, express or
implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and
noninfringement. In no event shall <<var;name="holder";words="1-20">> be liable for any claim, damages or other
liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software
or the use or other dealings in the Software.""",
    "isc-text": """
Permission to use, copy, modify, <<var;name="and";match="and|and or">> distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
The software is provided "as is" and <<var;name="holder";words="1-20">> disclaims all warranties with regard to this
software including all implied warranties of merchantability and fitness. In no event shall
<<var;name="holder";words="1-20">> be liable for any special, direct, indirect, or consequential damages or any damages
whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious
action, arising out of or in connection with the use or performance of this software.""",
    "zlib-text": """
This software is provided "as-is", without any express or implied warranty. In no event will
<<var;name="holder";words="1-20">> be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: <<beginOptional>>1<<endOptional>> The origin of this
software must not be misrepresented; you must not claim that you wrote the original software.""",
    "unlicense-text": """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means.""",
    "bsd-2-clause-text": _BSD_START + _BSD_END,
    "bsd-3-clause-text": _BSD_START + _BSD_NAMES + _BSD_END,
}
NOTICES = {
    "apache-2.0-notice": """
<<beginOptional>>Licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> Apache License,
<<beginOptional>>Version<<endOptional>> 2.0 <<beginOptional>>(the "License"); you may not use
<<var;name="what";words="1-6">> except in compliance with the License.<<endOptional>>""",
    "cc-by-4.0-notice": """
Creative Commons Attribution 4.0 <<beginOptional>>International<<endOptional>> <<var;name="kind";match="License|Public License">>""",
    "cc-by-nc-4.0-notice": """CC BY<<beginOptional>>-NC<<endOptional>> <<var;name="version";match="4.0">>""",
    "gpl-3.0-notice": """
GNU General Public License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
<<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>or (at your option) any later version<<endOptional>>""",
    "mit-notice": """
under the <<beginOptional>>terms of the<<endOptional>> MIT <<var;name="kind";match="License|Licence">>""",
}

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_PLAIN = bytearray(range(256))
_PLAIN[0x41:0x5B] = range(0x61, 0x7B)
for _c in _SEPARATORS:
    _PLAIN[_c] = 0x20
_MARKUP = re.compile(r"<<(.*?)>>", re.DOTALL)
_GAPS = re.compile(rb"  +")
_WORD = re.compile(rb"[^ ]+")


def spaced(text: bytes) -> bytes:
    """The words of a text with one space before and after each; one space if there are none."""
    words = _GAPS.sub(b" ", text.translate(bytes(_PLAIN))).strip(b" ")
    return b" " + words + b" " if words else b" "


def _literal(wording: str) -> list:
    return _WORD.findall(spaced(wording.encode()))


@dataclass
class Optional:
    items: list


@dataclass
class OneOf:
    wordings: list


class AnyWord:
    pass


def parse(markup: str) -> list:
    """A template as words, ``AnyWord``, ``Optional`` and ``OneOf``."""
    open_: list[list] = [[]]
    for i, part in enumerate(_MARKUP.split(markup)):
        if i % 2 == 0:
            open_[-1] += _literal(part)
        elif part == "beginOptional":
            open_.append([])
        elif part == "endOptional" and len(open_) > 1:
            done = open_.pop()
            open_[-1].append(Optional(done))
        elif match := re.search(r'match="([^"]*)"', part):
            open_[-1].append(OneOf([_literal(x) for x in match[1].split("|")]))
        elif words := re.search(r'words="(\d+)-(\d+)"', part):
            least, most = int(words[1]), int(words[2])
            open_[-1] += [AnyWord()] * least + [Optional([AnyWord()])] * (most - least)
        else:
            raise ValueError(f"unknown markup: {part}")
    if len(open_) > 1:
        raise ValueError("an optional region is not closed")
    return open_[0]


@dataclass
class Automaton:
    """States are the template's words; sets of states are the bits of a number."""

    label: str
    anchor: bytes  # the first mandatory words
    takes: dict = field(default_factory=dict)  # word to the states that take it
    takes_any: int = 0
    follow: list = field(default_factory=list)
    first: int = 0
    last: int = 0

    @classmethod
    def of(cls, label: str, markup: str) -> Automaton:
        items = parse(markup)
        while items and not isinstance(items[0], bytes):  # a region before all mandatory wording changes nothing
            items = items[1:]
        while items and not isinstance(items[-1], bytes | OneOf | AnyWord):
            items = items[:-1]
        n = next((i for i, x in enumerate(items) if not isinstance(x, bytes)), len(items))
        if n == 0:
            raise ValueError(f"{label}: a template needs mandatory wording")
        made = cls(label, b" " + b" ".join(items[:n]) + b" ")
        made.first, made.last, _ = made._sequence(items)
        return made

    def _state(self, word: bytes | None) -> tuple[int, int, bool]:
        bit = 1 << len(self.follow)
        self.follow.append(0)
        if word is None:
            self.takes_any |= bit
        else:
            self.takes[word] = self.takes.get(word, 0) | bit
        return bit, bit, False

    def _sequence(self, items: list) -> tuple[int, int, bool]:
        """First states, last states, and whether nothing at all is accepted as well."""
        first, last, empty = 0, 0, True
        for item in items:
            if isinstance(item, Optional):
                f, l, e = self._sequence(item.items)
                e = True
            elif isinstance(item, OneOf):
                parts = [self._sequence(w) for w in item.wordings]
                f, l, e = 0, 0, False
                for pf, pl, pe in parts:
                    f, l, e = f | pf, l | pl, e | pe
            else:
                f, l, e = self._state(None if isinstance(item, AnyWord) else item)
            for state in _bits(last):
                self.follow[state] |= f
            first, last, empty = first | f * empty, l | last * e, empty & e
        return first, last, empty

    def end_of(self, text: bytes, place: int) -> int | None:
        """How many words from ``place`` on the shortest accepted wording has."""
        live = self.first
        for n, word in enumerate(_WORD.finditer(text, place), 1):
            live &= self.takes.get(word[0], 0) | self.takes_any
            if live & self.last:
                return n
            if not live:
                return None
            after = 0
            for state in _bits(live):
                after |= self.follow[state]
            live = after
        return None

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        for place, word in _places(text, self.anchor):
            n = self.end_of(text, place)
            if n is not None:
                yield word, word + n


def _bits(number: int) -> Iterator[int]:
    while number:
        low = number & -number
        yield low.bit_length() - 1
        number ^= low


def _places(text: bytes, phrase: bytes) -> Iterator[tuple[int, int]]:
    """Byte place and word number of every place of a phrase that has a space at both ends."""
    word, counted, at = 0, 0, text.find(phrase)
    while at >= 0:
        word += text.count(b" ", counted, at)
        counted = at
        yield at, word
        at = text.find(phrase, at + 1)


_COMPILED: list[tuple[Automaton, float]] = []


def _automata() -> list[tuple[Automaton, float]]:
    """All templates, compiled once per worker."""
    if not _COMPILED:
        for templates, score in ((TEXTS, 1.0), (NOTICES, 0.8)):
            _COMPILED.extend((Automaton.of(label, markup), score) for label, markup in templates.items())
    return _COMPILED


def scan(text: bytes) -> dict:
    words = spaced(text)
    places, score = [], 0.0
    for phrase, label in BASE.items():
        n = phrase.count(" ") + 1
        own = [{"label": label, "base": True, "start": w, "stop": w + n} for _, w in _places(words, f" {phrase} ".encode())]
        places += own
        score = max(score, 0.5 if own else 0.0)
    for automaton, sure in _automata():
        own = [{"label": automaton.label, "base": False, "start": lo, "stop": hi} for lo, hi in automaton.find(words)]
        places += own
        score = max(score, sure if own else 0.0)
    return {"n_words": words.count(b" ") - 1, "places": places, "score": score}


FOUND = "struct<n_words:bigint,places:array<struct<label:string,base:boolean,start:bigint,stop:bigint>>,score:double>"
_PLACE = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("places", pa.list_(_PLACE)), ("score", pa.float64())])


def _scan(texts: pa.Array) -> pa.Array:
    return pa.array([scan(t.as_py() or b"") for t in texts.cast(pa.large_binary())], _FOUND)


def add_licenses(docs: DataFrame, result: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column: number of words, places (label, whether of the base, first word,
    end word exclusive) and score."""
    return docs.withColumn(result, F.arrow_udf(_scan, FOUND)(F.col(f"`{text_col}`")))


def op13_license_scan(spark, sf_dir: str) -> DataFrame:
    found = add_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    found = found.select("doc_id", "found.*")
    base = F.filter("places", lambda p: p["base"])

    def labels(places):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda p: p["start"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        "score",
    )


def _regex(items: list) -> str:
    out = ""
    for item in items:
        if isinstance(item, Optional):
            out += f"(?:{_regex(item.items)})?"
        elif isinstance(item, OneOf):
            out += "(?:" + "|".join(_regex(w) for w in item.wordings) + ")"
        else:
            out += "[^ ]+ " if isinstance(item, AnyWord) else item.decode() + " "
    return out


def license_sql() -> str:
    """The same places as patterns over the spaced words, for DuckDB."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    phrases = []
    for phrase, label in BASE.items():
        parts = phrase.split(" ")
        same = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts))
        phrases.append(f"list_transform(list_filter(range(1, len(w) + 1), lambda i: {same}), lambda i: {{'n': i - 1, 'label': '{label}'}})")
    own = []
    for templates, score in ((TEXTS, 1.0), (NOTICES, 0.8)):
        for label, markup in templates.items():
            own.append(f"CASE WHEN regexp_matches(x, ' {_regex(parse(markup)[_skip(markup):])}') THEN [{{'score': {score}, 'label': '{label}'}}] ELSE [] END")
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
s AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS x, flatten([{", ".join(phrases)}]) AS b FROM d),
t AS (SELECT *, flatten([{", ".join(own)}]) AS own FROM s)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(b) AS BIGINT) AS n_base,
  CAST(list_min(list_transform(b, lambda p: p.n)) AS BIGINT) AS first_word,
  CAST(list_max(list_transform(b, lambda p: p.n)) AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(b, lambda p: p.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(b, lambda p: p.label),
    list_transform(own, lambda p: p.label)))), ',') AS labels,
  CAST(greatest(CASE WHEN len(b) > 0 THEN 0.5 ELSE 0 END, coalesce(list_max(list_transform(own, lambda p: p.score)), 0)) AS DOUBLE) AS score
FROM t"""


def _skip(markup: str) -> int:
    return next(i for i, x in enumerate(parse(markup)) if isinstance(x, bytes))
