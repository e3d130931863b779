"""License texts within documents, found by patience alignment with templates."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Templates are compared by words of these characters, in lower case.
WORDS = re.compile(r"[a-z0-9]+")
#: A phrase of a template that a match must hold word for word.
TELLING = re.compile(r"\[\[(.*?)\]\]", re.S)
MATCH = "array<struct<license:string,coverage:double,matched:int,first_word:int,last_word:int,start_char:int,end_char:int>>"


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matching places of two word lists, ascending in both.

    Words that occur once in both are anchors; of these the longest run that ascends in both counts. The gaps
    between them are aligned in the same way, after equal words at their two ends have been taken off.
    """
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i >= i_end or j >= j_end:
            continue
        anchors = _ascending(_unique_in_both(a, i, i_end, b, j, j_end))
        if anchors:
            found += anchors
            ends = [(i - 1, j - 1), *anchors, (i_end, j_end)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(ends, ends[1:])]
    return sorted(found)


def _unique_in_both(a: list[str], i: int, i_end: int, b: list[str], j: int, j_end: int) -> list[tuple[int, int]]:
    once_a, once_b = Counter(a[i:i_end]), Counter(b[j:j_end])
    place = {b[k]: k for k in range(j, j_end) if once_b[b[k]] == 1}
    return [(k, place[a[k]]) for k in range(i, i_end) if once_a[a[k]] == 1 and a[k] in place]


def _ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that ascends in the second number, by piles; pairs ascend in the first."""
    tops: list[int] = []
    top_at: list[int] = []
    below = [-1] * len(pairs)
    for n, (_, place) in enumerate(pairs):
        pile = bisect_left(tops, place)
        below[n] = top_at[pile - 1] if pile else -1
        tops[pile : pile + 1], top_at[pile : pile + 1] = [place], [n]
    out, n = [], top_at[-1] if top_at else -1
    while n >= 0:
        out.append(pairs[n])
        n = below[n]
    return out[::-1]


def _telling(template: str) -> list[tuple[int, int]]:
    """The telling phrases of a template: the places of their first words and of those after their last."""
    return [(len(WORDS.findall(template[: m.start(1)])), len(WORDS.findall(template[: m.end(1)]))) for m in TELLING.finditer(template)]


def _holds(pairs: list[tuple[int, int]], phrases: list[tuple[int, int]]) -> bool:
    """Whether phrases are aligned with all of their words and none in between."""
    place = dict(pairs)
    return all(first in place and all(place.get(i) == place[first] + i - first for i in range(first, end)) for first, end in phrases)


def _dense(pairs: list[tuple[int, int]], least: int, between: int) -> list[tuple[int, int]]:
    """The alignment with at most `between` other words within it: ends beyond the widest gaps are let go, down to `least` pairs; else none."""
    while len(pairs) >= least:
        if not pairs or pairs[-1][1] - pairs[0][1] + 1 - len(pairs) <= between:
            return pairs
        at = max(range(1, len(pairs)), key=lambda n: pairs[n][1] - pairs[n - 1][1])
        pairs = pairs[at:] if at <= len(pairs) // 2 else pairs[:at]
    return []


class Scanner:
    """Finds templates in texts."""

    def __init__(self, templates: Mapping[str, str], min_coverage: float):
        self.min_coverage = min_coverage
        self.templates = {name: words for name, text in templates.items() if (words := WORDS.findall(text.lower()))}
        self.telling = {name: _telling(templates[name].lower()) for name in self.templates}
        # A template that is one telling phrase from end to end is a naming: it must stand there word for word.
        self.namings = {name for name, words in self.templates.items() if self.telling[name] == [(0, len(words))]}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = set().union(*self.templates.values())

    def scan(self, text: str | None) -> list[tuple]:
        lowered = (text or "").lower()
        words = WORDS.findall(lowered)
        known = self.vocabulary.intersection(words)
        # A template whose words the text does not hold often enough cannot be covered.
        hopeful = [name for name, counts in self.counts.items() if len(words) >= self._needed(name)
                   and sum(n for w, n in counts.items() if w in known) >= self._needed(name)]
        if not hopeful:
            return []
        places: dict[str, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            if word in known:
                places[word].append(at)
        matches = [m for name in hopeful for m in self._matches(name, words, places)]
        # What lies within a longer match goes with it; at the same place, the template with most words aligned stays.
        matches.sort(key=lambda m: (m[3] - m[4], -m[2], -m[1], m[0]))
        kept: list[tuple] = []
        for m in matches:
            if not any(k[3] <= m[3] and m[4] <= k[4] for k in kept):
                kept.append(m)
        spans = [m.span() for m in WORDS.finditer(lowered)] if kept else []
        return [(*m, spans[m[3]][0], spans[m[4]][1]) for m in sorted(kept, key=lambda m: (m[3], m[0]))]

    def _needed(self, name: str) -> int:
        """How many words of a template a match must hold."""
        size = len(self.templates[name])
        return size if name in self.namings else size - int((1 - self.min_coverage) * size + 1e-9)

    def _matches(self, name: str, words: list[str], places: Mapping[str, list[int]]) -> list[tuple]:
        template = self.templates[name]
        size = len(template)
        may_miss = size - self._needed(name)
        if sum(min(n, len(places[w])) for w, n in self.counts[name].items()) < size - may_miss:
            return []
        # An alignment that misses at most so many words holds one of any `may_miss` + 1 of them: the rarest here.
        seeds = sorted(range(size), key=lambda i: (len(places[template[i]]), i))[: may_miss + 1]
        if name in self.namings:
            starts = (p - seeds[0] for p in places[template[seeds[0]]] if p >= seeds[0])
            return [(name, 1.0, size, p, p + size - 1) for p in starts if words[p : p + size] == template]
        slack = may_miss + 2
        starts = sorted({p - i for i in seeds for p in places[template[i]]})
        found, covered = [], -1
        windows: list[list[int]] = []
        for start in starts:
            if windows and start - windows[-1][0] <= slack:
                windows[-1][1] = start
            else:
                windows.append([start, start])
        for low, high in windows:
            low, high = max(0, low - slack, covered + 1), high + size + slack
            pairs = patience(template, words[low:high])
            if len(pairs) < size - may_miss:
                continue
            # The window may end within the place, or hold a part of another: it is aligned again where it lies.
            shifts = sorted(q - p for p, q in pairs)
            start, tried = low + shifts[len(shifts) // 2], [(low, pairs)]
            for reach in (0, slack):
                at = max(0, start - reach, covered + 1)
                tried.append((at, patience(template, words[at : max(at, start + size + reach)])))
            low, pairs = max(((at, _dense(some, size - may_miss, may_miss)) for at, some in tried), key=lambda x: len(x[1]))
            if pairs and _holds(pairs, self.telling[name]):
                first, last = low + pairs[0][1], low + pairs[-1][1]
                found.append((name, len(pairs) / size, len(pairs), first, last))
                covered = last
        return found


def license_matches(docs: DataFrame, templates: Mapping[str, str], text: str = "text", min_coverage: float = 0.8,
                    column: str = "licenses") -> DataFrame:
    """The documents with the license texts found in them, as an array that replaces a column of that name.

    A match is a place of the text that aligns with at least `min_coverage` of a template's words, with as many other words
    in between as may be missing. Phrases of a template in [[ ]] must stand there word for word, and so must a
    template that is one such phrase, as namings are. Coverage is the share of the template's words
    that align, and places are given in words and in characters of the lower-cased text. A match within a longer
    one is left out. Whole texts are scanned, once each and row by row: nothing is shuffled, so copies and long texts
    cost only themselves. Null and empty texts have no matches, an empty table no rows. Of templates that match the same place the
    one with most words aligned stays, then the better covered, then the first by name.
    """
    held = dict(templates)

    @F.pandas_udf(MATCH)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("license", "coverage", "matched", "first_word", "last_word", "start_char", "end_char")
        scanner = Scanner(held, min_coverage)
        for texts in batches:
            yield pd.Series([[dict(zip(names, m)) for m in scanner.scan(t)] for t in texts], dtype=object)

    return docs.withColumn(column, scanned(F.col(f"`{text}`")))
