"""License notices in texts: exact seeds find candidates, bounded-error matching verifies them.

A text is searched as its words, A-Z in lower case, with one space between. A notice may differ from
the text in up to ``edits`` characters (inserted, dropped or changed). It is cut into ``edits`` + 1
stretches of like length: with so few edits one stretch is left whole, so every occurrence holds one
exactly. All stretches of all notices are found in one pass by an automaton; around each the notice
is matched with bounded errors by the ``regex`` library, which gives the place and the edits. A match
starts and ends with a word, and matches of one notice do not overlap, the best being taken first.
Where matches of notices with edits overlap, those with the least edits stay, so that a text has the
label of the nearest of several notices that differ little. Notices with no edits are the base
phrases, each its only stretch: their places are all those where the words stand consecutively,
overlaps included, and they neither give way nor make others do so.

The score of a text is the largest share of a notice's characters that stand as given: one if a
notice is there word by word, zero if none is there at all.

Null and empty texts have no words, no labels and the score zero. Rows are scanned each for itself,
so alike rows come out alike, and an empty table gives an empty result. Whole texts are scanned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagewright.llm.common import fresh, small_batches

#: One edit is allowed for so many characters of a notice.
PER_EDIT = 12

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Notice:
    """A notice in lower-case words with one space between."""

    label: str
    words: str
    edits: int

    @classmethod
    def fuzzy(cls, label: str, words: str) -> Notice:
        return cls(label, words, len(words) // PER_EDIT)


#: The base phrases and their labels.
BASE = (
    Notice("gpl", "gnu general public license", 0),
    Notice("apache", "apache license", 0),
    Notice("cc-by", "cc by", 0),
    Notice("mit", "mit license", 0),
)
#: Short notices as they stand in files, by the usual identifiers in lower case.
NOTICES = (
    Notice.fuzzy("gpl", "licensed under the gnu general public license"),
    Notice.fuzzy("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    Notice.fuzzy("lgpl", "gnu lesser general public license"),
    Notice.fuzzy("agpl", "gnu affero general public license"),
    Notice.fuzzy("apache", "licensed under the apache license version 2 0"),
    Notice.fuzzy("apache", "you may not use this file except in compliance with the license"),
    Notice.fuzzy("mit", "released under the mit license"),
    Notice.fuzzy("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice.fuzzy("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice.fuzzy("bsd", "neither the name of the copyright holder nor the names of its contributors"),
    Notice.fuzzy("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice.fuzzy("mpl", "subject to the terms of the mozilla public license"),
    Notice.fuzzy("epl", "made available under the terms of the eclipse public license"),
    Notice.fuzzy("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Notice.fuzzy("cc-by", "licensed under cc by 4 0"),
    Notice.fuzzy("cc-by-nc", "licensed under cc by nc 4 0"),
    Notice.fuzzy("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    Notice.fuzzy("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    Notice.fuzzy("cc-by-nd", "licensed under cc by nd 4 0"),
    Notice.fuzzy("cc-by-sa", "licensed under cc by sa 4 0"),
    Notice.fuzzy("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    Notice.fuzzy("unlicense", "this is free and unencumbered software released into the public domain"),
    Notice.fuzzy("boost", "distributed under the boost software license version 1 0"),
    Notice.fuzzy("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    Notice.fuzzy("proprietary", "all rights reserved no part of this publication may be reproduced"),
)


@dataclass(frozen=True)
class Found:
    """A notice's place: numbers of its first word and of the one after its last, and the edits."""

    notice: int
    start: int
    end: int
    edits: int


def stretches(notice: Notice) -> list[tuple[int, str]]:
    """The notice cut into one stretch more than it may have edits, each with its offset.

    A base phrase is one stretch with the spaces around it, so that it is found at whole words only.
    """
    if not notice.edits:
        return [(-1, f" {notice.words} ")]
    n, parts = len(notice.words), notice.edits + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, notice.words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Search:
    """The automaton over the stretches of some notices, and the notices as patterns."""

    def __init__(self, notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.notices = tuple(notices)
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(self.notices):
            for offset, seed in stretches(notice):
                seeds.setdefault(seed, []).append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, owners in seeds.items():
            self.automaton.add_word(seed, (len(seed), owners))
        if seeds:
            self.automaton.make_automaton()
        self.patterns = [
            regex.compile(rf"(?b)(?<= )(?:{regex.escape(n.words)}){{e<={n.edits}}}(?= )")
            for n in self.notices
        ]

    def __call__(self, body: str) -> list[Found]:
        """All places in words joined by spaces, with a space at both ends; in order, without repeats."""
        if len(body) < 2 or not len(self.automaton):
            return []
        places: list[tuple[int, int, int, int]] = []
        starts: dict[int, set[int]] = {}
        for last, (size, owners) in self.automaton.iter(body):
            for number, offset in owners:
                start = last + 1 - size - offset
                if self.notices[number].edits:
                    starts.setdefault(number, set()).add(start)
                else:
                    places.append((number, start, start + len(self.notices[number].words), 0))
        near = [(number, *place) for number, own in starts.items() for place in self._verified(number, body, sorted(own))]
        return self._in_words(body, places + _nearest(near)) if places or near else []

    def _verified(self, number: int, body: str, starts: list[int]) -> Iterator[tuple[int, int, int]]:
        """The best match around each group of starts that lie close together."""
        notice = self.notices[number]
        at = 0
        while at < len(starts):
            first = starts[at]
            while at < len(starts) and starts[at] - first <= 2 * notice.edits:
                at += 1
            # The spaces around the match belong to its window.
            low = max(0, first - notice.edits - 1)
            high = min(len(body), starts[at - 1] + len(notice.words) + notice.edits + 1)
            match = self.patterns[number].search(body, low, high)
            if match is not None:
                yield *match.span(), sum(match.fuzzy_counts)

    def _in_words(self, body: str, places: list[tuple[int, int, int, int]]) -> list[Found]:
        out, at, word = [], 0, -1
        edges = sorted({edge for _, start, end, _ in places for edge in (start, end)})
        number_at = {}
        for edge in edges:
            # The words before a place are the spaces before it.
            word += body.count(" ", at, edge)
            at = edge
            number_at[edge] = word
        for number, start, end, edits in places:
            out.append(Found(number, number_at[start], number_at[end] + 1, edits))
        return sorted(set(out), key=lambda f: (f.start, f.notice, f.end, f.edits))


def _nearest(places: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The places that stay: those with the fewest edits first, none over one that stays.

    Only another notice with as many edits may lie there as well.
    """
    stay: list[tuple[int, int, int, int]] = []
    group: list[tuple[int, int, int, int]] = []
    reach = -1
    for place in [*sorted(set(places), key=lambda p: p[1]), (0, 1 << 62, 0, 0)]:
        if group and place[1] >= reach:
            # Nothing from here on overlaps the group.
            kept: list[tuple[int, int, int, int]] = []
            for number, start, end, edits in sorted(group, key=lambda p: (p[3], p)):
                if all(end <= s or e <= start or (edits == k and number != n) for n, s, e, k in kept):
                    kept.append((number, start, end, edits))
            stay += kept
            group = []
        group.append(place)
        reach = max(reach, place[2])
    return stay


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def body_of(words: list[bytes]) -> str:
    return f" {b' '.join(words).decode('utf-8', 'replace')} "


@lru_cache(maxsize=4)
def _search(notices: tuple[Notice, ...]) -> Search:
    """A worker keeps its automaton from one batch to the next."""
    return Search(notices)


_SCAN = "n_words long, found array<struct<label:string,notice:int,start:long,end:long,edits:int>>, score double"


def scans(text: Column, notices: Sequence[Notice] = BASE + NOTICES) -> Column:
    """What is found in a text: ``n_words``, ``found`` in the order of the words, and ``score``."""
    own = tuple(notices)

    @F.pandas_udf(_SCAN)
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        search = _search(own)
        for batch in batches:
            rows = []
            for body in batch:
                words = words_of(bytes(body or b""))
                found = search(body_of(words))
                shares = [1 - f.edits / len(own[f.notice].words) for f in found]
                spans = [
                    {"label": own[f.notice].label, "notice": f.notice, "start": f.start, "end": f.end, "edits": f.edits}
                    for f in found
                ]
                rows.append((len(words), spans, max(shares, default=0.0)))
            yield pd.DataFrame(rows, columns=["n_words", "found", "score"])

    return each(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def with_licenses(
    docs: DataFrame, *, text: str = "text", notices: Sequence[Notice] = BASE + NOTICES
) -> DataFrame:
    """The documents with ``n_words``, ``found`` (label, number of the notice, words from start to
    before end, edits) and ``score``; columns of these names are replaced."""
    small_batches(docs.sparkSession)
    (scan,) = fresh(docs, "scan")
    added = ("n_words", "found", "score")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    scanned = docs.withColumn(scan, scans(F.col(text), notices))
    return scanned.select(*kept, *[F.col(scan)[name].alias(name) for name in added])
