"""Licence scans: winnowed fingerprints pick candidates, banded alignment measures them.

Texts are read as words of letters and digits, in lower case. Of a template's hashes of K words, winnowing keeps the least of
every W neighbours; they go into an inverted index (hash to template and place). Every hash of a document is looked up, so a
run of K + W - 1 template words cannot be missed. Hits grow to runs of equal words; runs that follow each other both in the
document and in the template make a candidate, and where the template place falls back another one begins. What lies between
the runs is aligned in full and what lies before and after them in a band; all matched words add up and give the span.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.hashing import mix, word_hashes, word_spans

#: Words in a fingerprint, fingerprints in a winnowing window, half the width of the band, least share of matched words.
K, W, BAND, COVERAGE = 3, 4, 12, 0.7
# Words that make another licence of the same wording.
VARIANTS = frozenset("lesser affero sa nc nd sharealike noncommercial noderivatives endorse".split())
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def read_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word."""
    data = _FOLD[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)]
    return word_hashes(data, lower=False), *word_spans(data)


def fingerprints(words: np.ndarray) -> np.ndarray:
    """The hash of each K words in a row; of fewer words, one of all."""
    n = min(K, len(words))
    h = np.full(len(words) - n + 1 if n else 0, np.uint64(n))
    for i in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - n + 1 + i])
    return h


def winnow(h: np.ndarray) -> np.ndarray:
    """Places of the rightmost least hash of every W in a row."""
    if len(h) <= W:
        return np.arange(len(h))[h == h.min()][-1:] if len(h) else np.empty(0, int)
    views = np.lib.stride_tricks.sliding_window_view(h, W)
    return np.unique(np.arange(len(views)) + W - 1 - views[:, ::-1].argmin(axis=1))


def align(template: np.ndarray, words: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Most template words that can be matched in order within the band around words[i + shift], with the first and last
    document word matched; of equal counts the shortest span."""
    width = 2 * BAND + 1
    best = np.zeros(width + 2, np.int64)  # one cell of border on each side
    start = np.full(width + 2, -1, np.int64)
    end = np.full(width + 2, -1, np.int64)
    offsets = np.arange(-BAND, BAND + 1)
    for i in range(len(template)):
        at = i + shift + offsets
        inside = (at >= 0) & (at < len(words))
        hit = np.zeros(width, bool)
        hit[inside] = words[at[inside]] == template[i]
        # In band coordinates, the diagonal keeps its cell, a skipped template word comes from the right.
        gain = best[1:-1] + hit
        first = np.where(hit & (start[1:-1] < 0), at, start[1:-1])
        last = np.where(hit, at, end[1:-1])
        up, up_first, up_last = best[2:], start[2:], end[2:]
        better = (up > gain) | ((up == gain) & ((up_last - up_first) < (last - first)))
        gain, first, last = np.where(better, up, gain), np.where(better, up_first, first), np.where(better, up_last, last)
        # A skipped document word comes from the left: carry the best so far along the row.
        lead = np.maximum.accumulate(gain)
        source = np.maximum.accumulate(np.where(gain == lead, np.arange(width), 0))
        source = np.where(gain == lead, np.arange(width), source)
        best[1:-1], start[1:-1], end[1:-1] = lead, first[source], last[source]
    cell = 1 + int(np.lexsort((end[1:-1] - start[1:-1], -best[1:-1]))[0])
    return int(best[cell]), int(start[cell]), int(end[cell])


def chains(runs: list[tuple[int, int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """Runs (document place, template place, length) in chains that rise in both, each run in one chain, the longest first.

    From run to run the document goes on by at most size words more than the template, the template's length.
    """
    score, before = [], []
    for j, (at, place, n) in enumerate(runs):
        best, link = n, -1
        for i in range(j - 1, -1, -1):
            at_i, place_i, n_i = runs[i]
            if at - at_i > 2 * size:
                break
            own = n - max(0, place_i + n_i - place, at_i + n_i - at)
            if place > place_i and own > 0 and score[i] + own > best and (at - at_i) - (place - place_i) <= size:
                best, link = score[i] + own, i
        score.append(best)
        before.append(link)
    used: set[int] = set()
    out = []
    for j in sorted(range(len(runs)), key=lambda j: (-score[j], j)):
        chain: list[tuple[int, int, int]] = []
        while j >= 0 and j not in used:
            used.add(j)
            chain.append(runs[j])
            j = before[j]
        if chain:
            out.append(chain[::-1])
    return out


def _common(template: np.ndarray, words: np.ndarray) -> int:
    """Most words that can be matched in order."""
    best = np.zeros(len(words) + 1, np.int64)
    for t in template:
        best[1:] = np.maximum(best[1:], best[:-1] + (words == t))
        np.maximum.accumulate(best, out=best)
    return int(best[-1])


def align_chain(template: np.ndarray, words: np.ndarray, chain: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Template words matched along a chain of runs, with the first and last document word matched."""
    at, place, n = chain[0]
    matched, first, last = n, at, at + n - 1
    if place:
        more, begin, _ = align(template[:place], words[:at], at - place)
        matched, first = matched + more, begin if more else first
    end = place + n
    for at, place, n in chain[1:]:
        over = max(0, end - place, last + 1 - at)
        matched += n - over + _common(template[end:place + over], words[last + 1:at + over])
        end, last = place + n, at + n - 1
    if end < len(template):
        more, _, stop = align(template[end:], words[last + 1:], 0)
        matched, last = matched + more, last + 1 + stop if more else last
    return matched, first, last


def tokens(text: str) -> list[str]:
    """The words of read_words as text."""
    return _FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)].tobytes().decode("utf-8", "replace").split()


@dataclass
class Marks:
    """What tells a licence from others of nearly its wording: variant words, and the version with the words before it."""

    variants: frozenset[str]
    version: list[str]
    before: frozenset[str]

    @classmethod
    def of(cls, name: str, template: str) -> Marks:
        said = tokens(template)
        number = re.search(r"\d+\.\d+", name)
        version = number[0].split(".") if number else []
        before = {said[i - 1] for i in range(1, len(said)) if version and said[i] == version[0] and not said[i - 1].isdigit()}
        return cls(VARIANTS & set(said), version, frozenset(before - {"license"}))

    def hold(self, span: list[str]) -> bool:
        """Whether the words of a span have these variants and no other, and this version and no other; .0 may be left out."""
        if VARIANTS & set(span) != self.variants:
            return False
        if not self.version:
            return True
        for i in range(1, len(span)):
            if span[i - 1] in self.before and span[i].isdigit():
                minor = span[i + 1] if i + 1 < len(span) and span[i + 1].isdigit() else "0"
                if [span[i], minor] != self.version:
                    return False
        return self.version[0] in span and (self.version[1] == "0" or self.version[1] in span)


@dataclass
class LicenseIndex:
    """The templates' words, and their fingerprints sorted by hash."""

    names: list[str] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    marks: list[Marks] = field(default_factory=list)
    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    owners: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    places: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @classmethod
    def build(cls, templates: dict[str, str]) -> LicenseIndex:
        index = cls()
        entries = []
        for name, text in templates.items():
            words, _, _ = read_words(text)
            if len(words) < K:
                raise ValueError(f"template {name} has fewer than {K} words")
            h = fingerprints(words)
            keep = winnow(h)
            entries.append((h[keep], np.full(len(keep), len(index.names)), keep))
            index.names.append(name)
            index.words.append(words)
            index.marks.append(Marks.of(name, text))
        if entries:
            h, owners, places = (np.concatenate(x) for x in zip(*entries, strict=True))
            order = np.argsort(h, kind="stable")
            index.hashes, index.owners, index.places = h[order], owners[order], places[order]
        return index

    def runs(self, words: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """By template, the runs of equal words around its hits: first place in the document and in the template, length."""
        h = fingerprints(words) if len(words) >= K else np.empty(0, np.uint64)
        low, high = np.searchsorted(self.hashes, h, "left"), np.searchsorted(self.hashes, h, "right")
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i in np.flatnonzero(low < high):
            for j in range(low[i], high[i]):
                hits[int(self.owners[j])].append((int(i), int(self.places[j])))
        out = {}
        for owner, found in hits.items():
            template = self.words[owner]
            ends: dict[int, int] = {}
            runs = []
            for at, place in found:
                if ends.get(at - place, -1) > at:
                    continue  # inside the last run of its diagonal
                back = forth = 0
                while place > back and at > back and template[place - back - 1] == words[at - back - 1]:
                    back += 1
                while place + forth < len(template) and at + forth < len(words) and template[place + forth] == words[at + forth]:
                    forth += 1
                ends[at - place] = at + forth
                if forth:
                    runs.append((at - back, place - back, back + forth))
            out[owner] = sorted(runs)
        return out

    def scan(self, text: str | None) -> list[tuple]:
        """(licence, matched words, template words, coverage, first character, end), by place; of overlapping reports the
        one with the most matched words stays."""
        words, starts, ends = read_words(text)
        data = (text or "").encode("utf-8", "replace")
        found = []
        for owner, runs in self.runs(words).items():
            template = self.words[owner]
            for chain in chains(runs, len(template)):
                matched, first, last = align_chain(template, words, chain)
                if matched < COVERAGE * len(template):
                    # The runs bind the alignment above; without them it may find more.
                    at, place, _ = chain[len(chain) // 2]
                    matched, first, last = max((matched, first, last), align(template, words, at - place))
                if matched < COVERAGE * len(template):
                    continue
                # A version may go on behind the last word matched, as .1 behind "version 2".
                goes_on = last + 1 < len(ends) and data[ends[last]:starts[last + 1]] == b"." and data[starts[last + 1]:ends[last + 1]].isdigit()
                stop = last + goes_on
                if self.marks[owner].hold(tokens(data[starts[first]:ends[stop]].decode("utf-8", "replace"))):
                    found.append((-matched, len(template), self.names[owner], first, last))
        kept: list[tuple] = []
        for report in sorted(found):
            if all(report[4] < k[3] or report[3] > k[4] for k in kept):
                kept.append(report)
        place = lambda byte: len(data[:byte].decode("utf-8"))
        return [(name, -m, size, round(-m / size, 6), place(starts[first]), place(ends[last]))
                for m, size, name, first, last in sorted(kept, key=lambda k: k[3])]


FOUND = "array<struct<license:string,matched:int,template_words:int,coverage:double,start:int,stop:int>>"


def scan_licenses(df: DataFrame, text: str, templates: dict[str, str]) -> DataFrame:
    """df with licenses: the reports of LicenseIndex.scan for the whole text.

    A name is given only where the words that tell it from like licences hold in the span (Marks). A null or empty text has none. The templates are a parameter of fixed size that travels with the task. A column named
    licenses is replaced; repeated rows are reported each; an empty table passes as it is. No template finds nothing.
    """
    small_batches(df.sparkSession)
    index = LicenseIndex.build(templates)

    @pandas_udf(FOUND)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([index.scan(t) for t in texts], dtype=object)

    return df.drop("licenses").withColumn("licenses", scanned(F.col(text)))
