"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders; what remains is a template. Windows of template tokens of the benchmark
items are the hash table of a join; document windows probe it. Hits on one diagonal (document place minus item place) add up
to the covered part of the item, and so do, in document order, pieces on neighbouring diagonals, as where a word is put in or
left out; between and beside the pieces, shorter runs are looked for word by word. An item counts as leaked where the coverage is high enough and the slots are consistent: one
value of the item stands for one value of the document, and the other way round. So a copy with other numbers or names is
caught as well as a verbatim one. Windows with too few literal words for that are compared with their slot values, so they
only match word for word, and a verbatim copy of an item that is all numbers is found too.

Every text is read three times: without names, all in lower case, for texts whose case says nothing; with names as
placeholders, a run of capitalised words being one name; and with words that open a sentence taken for names as well.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.hashing import mix

#: Tokens in a window, and the share of them that must be literal words for its slots to be open; below it, values count.
WINDOW, LITERAL = 8, 0.5
#: The share of an item's tokens that must be covered by one chain of pieces.
COVERAGE = 0.7
#: How far apart the diagonals of pieces in a row may be; between pieces, words skipped at once and the least run after them.
DRIFT, SKIP, RUN = 8, 4, 3
#: Bytes of benchmark text whose windows are held by a task at once; a larger benchmark is searched in several passes.
BLOCK_BYTES = 4 << 20
#: Words remembered per worker, and characters of texts read together.
MEMO, TOGETHER = 400_000, 1 << 21

# Measuring units that count as a slot after a number.
UNITS = frozenset("""
mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons gram grams kilogram kilograms ounce ounces pound pounds
ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month
months year years meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters dollar dollars euro
euros cent cents percent degree degrees watt watts volt volts joule joules newton newtons hz khz mhz ghz kb mb gb tb byte bytes
""".split())

# Words that open sentences and are no names.
OPENERS = frozenset("""
a about after all also an and another any are as at because before both but by can could did do does during each either every
few for from had has have he her here his how i if in into is it its let many may might more most much must my neither no nor
not now of on once one only or other our over she should since so some such than that the their them then there these they this
those though to under until upon was we were what when where whether which while who whom whose why will with would yet you your
""".split())

#: Tokens between texts that are read together: a word that no item has, and a stop.
_BREAK = ("\0", ".")
_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?]")
_NUMBER, _STOP, _CAPITAL, _UNIT, _OPENER = 1, 2, 4, 8, 16
_NUM, _NAME, _UNIT_SLOT = 1, 2, 3


class _Words(dict):
    """Token to code * 32 + flags; code is -1 for words no item has."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> int:
        if len(self) > MEMO:
            self.clear()
        if token[0].isdigit():
            value = self.vocabulary.get(token, -1) * 32 + _NUMBER
        elif token in ".!?":
            value = _STOP
        else:
            low = token.lower()
            value = self.vocabulary.get(low, -1) * 32 + (_CAPITAL if len(token) > 1 and token[0].isupper() and token[1:].islower() else 0) + (_UNIT if low in UNITS else 0) + (_OPENER if low in OPENERS else 0)
        self[token] = value
        return value


@dataclass
class _Reading:
    """Codes of the units, slots folded; the codes of what stands there; first and last word of each unit."""

    codes: np.ndarray
    own: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _readings(text: str, words: _Words) -> tuple[list[str], list[_Reading]]:
    """The words, which are the tokens without stops, in lower case, and the readings of them."""
    tokens = _TOKEN.findall(text)
    word, readings = _views(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
    return [tokens[i].lower() for i in word], readings


def _views(packed: np.ndarray) -> tuple[np.ndarray, list[_Reading]]:
    """The places of the words among the tokens, and the readings, from what _Words says of each token."""
    flags = packed & 31
    word = np.flatnonzero((flags & _STOP) == 0)
    first = np.ones(len(packed), bool)
    first[1:] = (flags[:-1] & _STOP) > 0
    first = first[word]
    own, flags = (packed >> 5)[word], flags[word]
    after_number = np.zeros(len(word), bool)
    after_number[1:] = (flags[:-1] & _NUMBER) > 0
    plain = np.where((flags & _NUMBER) > 0, _NUM, np.where(after_number & ((flags & _UNIT) > 0), _UNIT_SLOT, own))
    every = np.arange(len(word))
    capital = ((flags & _CAPITAL) > 0) & (plain != _UNIT_SLOT)
    readings = [_Reading(plain, own, every, every)]
    readings += [_folded(plain, own, name, word) for name in (capital & ~first, capital & (~first | ((flags & _OPENER) == 0)))]
    return word, readings


def _folded(plain: np.ndarray, own: np.ndarray, name: np.ndarray, word: np.ndarray) -> _Reading:
    """The reading in which each run of names is one slot; a stop ends a run."""
    goes_on = np.zeros(len(name), bool)
    goes_on[1:] = name[1:] & name[:-1] & (np.diff(word) == 1)
    first = np.flatnonzero(~goes_on)
    last = np.append(first[1:], len(name)) - 1 if len(first) else first
    codes, mine = np.where(name, _NAME, plain)[first], own[first]
    for i in np.flatnonzero(last > first):
        run = own[first[i]:last[i] + 1].tolist()
        mine[i] = -1 if min(run) < 0 else hash(tuple(run)) & ((1 << 61) - 1) | 1 << 61
    return _Reading(codes, mine, first, last)


def _windows(codes: np.ndarray, own: np.ndarray, size: int, reading: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of known tokens: of their codes with enough of them literal, else of their own codes."""
    if len(codes) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    good = np.concatenate([[0], np.cumsum(codes > _UNIT_SLOT)])
    literal = good[size:] - good[:-size] >= LITERAL * size
    out = []
    for kind, (c, here) in enumerate([(codes, literal), (own, ~literal)]):
        bad = np.concatenate([[0], np.cumsum(c < 0)])
        at = np.flatnonzero(here & (bad[size:] == bad[:-size]))
        h = np.full(len(at), np.uint64((size * 3 + reading) * 2 + kind))
        for i in range(size if len(at) else 0):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c[at + i].astype(np.uint64))
        out.append((at, h))
    return np.concatenate([out[0][0], out[1][0]]), np.concatenate([out[0][1], out[1][1]])


def _chains(covered: dict[int, set[int]], weight: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """Chains of (item place, document place), both rising, from the places covered per diagonal; the heaviest ones first.

    Every piece is in a chain. In a row of pieces, diagonals are at most DRIFT apart.
    """
    pieces = []
    for shift, places in covered.items():
        run = sorted(places)
        cuts = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1] + 1), len(run)]
        pieces += [(run[a] + shift, run[a], run[b - 1], shift) for a, b in zip(cuts, cuts[1:], strict=False)]
    pieces.sort()
    total = np.concatenate([[0], np.cumsum(weight)]).tolist()
    score, before, begin = [], [], []
    for j, (at, start, end, shift) in enumerate(pieces):
        best, link, cut = total[end + 1] - total[start], -1, start
        for i in range(j - 1, -1, -1):
            at_i, start_i, end_i, shift_i = pieces[i]
            if at - at_i > len(weight) + DRIFT:
                break
            if abs(shift - shift_i) <= DRIFT and start_i < start and end_i < end and at_i < at:
                own = max(start, end_i + 1, end_i + shift_i + 1 - shift)
                if own <= end and score[i] + total[end + 1] - total[own] > best:
                    best, link, cut = score[i] + total[end + 1] - total[own], i, own
        score.append(best)
        before.append(link)
        begin.append(cut)
    used: set[int] = set()
    for j in sorted(range(len(pieces)), key=lambda j: (-score[j], j)):
        if j not in used:
            run: list[tuple[int, int]] = []
            while j >= 0:
                used.add(j)
                run[:0] = [(p, p + pieces[j][3]) for p in range(begin[j], pieces[j][2] + 1)]
                j = before[j]
            yield run


def _walk(item: list[int], text: list[int]) -> list[tuple[int, int]]:
    """Places that match, going on from the start of both; up to SKIP words are skipped where a run of RUN, or the rest, follows."""
    out = []
    i = p = 0
    while i < len(item) and p < len(text):
        if item[i] == text[p]:
            out.append((i, p))
            i, p = i + 1, p + 1
            continue
        for skip in range(1, SKIP + 1):
            step = next((e for e in range(skip + 1) if (n := min(RUN, len(item) - i - e)) > 0 and item[i + e:i + e + n] == text[p + skip - e:p + skip - e + n]), None)
            if step is not None:
                i, p = i + step, p + skip - step
                break
        else:
            break
    return out


def _extended(chain: list[tuple[int, int]], item: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """The chain with what matches between its pieces, before and after them."""
    i, p = chain[0]
    low = max(0, p - i - DRIFT)
    out = [(i - 1 - a, p - 1 - b) for a, b in reversed(_walk(item[:i][::-1].tolist(), text[low:p][::-1].tolist()))]
    for (i, p), (k, q) in zip(chain, chain[1:], strict=False):
        out.append((i, p))
        if k > i + 1 and q > p + 1:
            out += [(i + 1 + a, p + 1 + b) for a, b in _walk(item[i + 1:k].tolist(), text[p + 1:q].tolist())]
    i, p = chain[-1]
    rest = item[i + 1:].tolist()
    return [*out, (i, p), *((i + 1 + a, p + 1 + b) for a, b in _walk(rest, text[p + 1:p + 1 + len(rest) + DRIFT].tolist()))]


def _same_name(a: str, b: str) -> bool:
    """Whether one name is the other or a part of it."""
    x, y = set(a.split()), set(b.split())
    return x <= y or y <= x


@dataclass
class TemplateIndex:
    """Items by number: key, words, readings; and by window size and reading the hashes with their items and places, sorted."""

    vocabulary: dict[str, int] = field(default_factory=dict)
    keys: list = field(default_factory=list)
    values: list[list[str]] = field(default_factory=list)
    readings: list[list[_Reading]] = field(default_factory=list)
    tables: list[dict] = field(default_factory=list)

    @classmethod
    def build(cls, items: list[tuple]) -> TemplateIndex:
        index = cls()
        for _, text in items:
            for token in _TOKEN.findall(text or ""):
                if token not in ".!?":
                    index.vocabulary.setdefault(token.lower(), len(index.vocabulary) + 16)
        words = _Words(index.vocabulary)
        entries: dict[tuple[int, int], list] = defaultdict(list)
        for key, text in items:
            values, readings = _readings(text or "", words)
            if not values:
                continue
            number = len(index.keys)
            index.keys.append(key)
            index.values.append(values)
            index.readings.append(readings)
            for reading in _different(readings):
                r = readings[reading]
                size = min(WINDOW, len(r.codes))
                at, h = _windows(r.codes, r.own, size, reading)
                entries[size, reading].append((h, np.full(len(h), number), at))
                if reading == 0 and values[0] in UNITS:
                    # A number may stand before the copy, which makes a slot of its first word.
                    after = np.concatenate([[_UNIT_SLOT], r.codes[1:size]])
                    at, h = _windows(after, r.own[:size], size, reading)
                    entries[size, reading].append((h, np.full(len(h), number), at))
        for (size, reading), found in sorted(entries.items(), key=lambda x: x[0]):
            h, number, at = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(h, kind="stable")
            index.tables.append({"size": size, "reading": reading, "hash": h[order], "item": number[order], "place": at[order]})
        return index

    def touched(self, texts: list[str | None], words: _Words) -> np.ndarray:
        """Which texts have a window of an item: all others hold none. Texts are read together, with breaks between them."""
        hit = np.zeros(len(texts), bool)
        start = 0
        while start < len(texts) and self.tables:
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end] or "") <= TOGETHER):
                size += len(texts[end] or "")
                end += 1
            found = [[*_TOKEN.findall(t or ""), *_BREAK] for t in texts[start:end]]
            lengths = [len(f) for f in found]
            word, readings = _views(np.fromiter(map(words.__getitem__, chain.from_iterable(found)), np.int64, sum(lengths)))
            owner = np.repeat(np.arange(start, end), lengths)[word]
            for table in self.tables:
                view, known = readings[table["reading"]], table["hash"]
                if not len(known):
                    continue
                at, h = _windows(view.codes, view.own, table["size"], table["reading"])
                same = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h
                hit[owner[view.first[at[same]]]] = True
            start = end
        return hit

    def leaks(self, text: str | None, words: _Words) -> list[tuple]:
        """(item key, covered tokens, item tokens, changed slots, first token, last token) per leaked item."""
        if not text or not self.tables:
            return []
        values, readings = _readings(text, words)
        different = _different(readings)
        hits: dict[tuple, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for table in self.tables:
            size, reading = table["size"], table["reading"]
            if reading not in different:
                continue
            at, h = _windows(readings[reading].codes, readings[reading].own, size, reading)
            low, high = np.searchsorted(table["hash"], h, "left"), np.searchsorted(table["hash"], h, "right")
            for i in np.flatnonzero(low < high):
                for j in range(low[i], high[i]):
                    place = int(table["place"][j])
                    hits[int(table["item"][j]), reading][int(at[i]) - place].update(range(place, place + size))
        best: dict[int, tuple] = {}
        for (item, reading), covered in sorted(hits.items()):
            own, view = self.readings[item][reading], readings[reading]
            weight = own.last - own.first + 1
            for pairs in self._candidates(covered, own, view, weight):
                n = int(weight[[i for i, _ in pairs]].sum())
                if n < COVERAGE * len(self.values[item]) or (item in best and n < best[item][1]):
                    continue
                changed = self._changes(item, reading, pairs, values, view)
                if changed is None:
                    continue
                row = (self.keys[item], n, len(self.values[item]), changed, int(view.first[pairs[0][1]]), int(view.last[pairs[-1][1]]))
                if item not in best or (-row[1], row[3], row[4]) < (-best[item][1], best[item][3], best[item][4]):
                    best[item] = row
        return [best[i] for i in sorted(best)]

    @staticmethod
    def _candidates(covered: dict[int, set[int]], own: _Reading, view: _Reading, weight: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """Each diagonal, each chain of pieces, and each chain with what matches around it."""
        whole = False
        for shift, places in covered.items():
            whole |= len(places) == len(weight)
            yield [(i, i + shift) for i in sorted(places)]
        if not whole or len(covered) > 1:
            for chain in _chains(covered, weight):
                yield chain
                if len(chain) < len(weight):
                    yield _extended(chain, own.codes, view.codes)

    def _changes(self, item: int, reading: int, pairs: list[tuple[int, int]], values: list[str], view: _Reading) -> int | None:
        """How many slot values differ; None where they do not correspond one to one. Parts of a name stand for the name."""
        there: dict[tuple, str] = {}
        back: dict[tuple, str] = {}
        r = self.readings[item][reading]
        for i, p in pairs:
            slot = int(r.codes[i])
            if slot <= _UNIT_SLOT:
                own = " ".join(self.values[item][r.first[i]:r.last[i] + 1])
                other = " ".join(values[view.first[p]:view.last[p] + 1])
                for said, value in ((there.setdefault((slot, own), other), other), (back.setdefault((slot, other), own), own)):
                    if said != value and not (slot == _NAME and _same_name(said, value)):
                        return None
        return sum(own != other for (_, own), other in there.items())


def _different(readings: list[_Reading]) -> list[int]:
    """The readings that no earlier one equals: all that such a one could find, the earlier one finds."""
    return [i for i, r in enumerate(readings) if not any(np.array_equal(r.codes, e.codes) and len(r.first) == len(e.first) for e in readings[:i])]


LEAK = "array<struct<item:long,covered:int,tokens:int,changed_slots:int,first_word:int,last_word:int>>"


def find_leaks(df: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str) -> DataFrame:
    """df with leaks, the benchmark items that its text holds: key, covered and all tokens, changed slots, first and last word.

    A null or empty text has an empty list, and a null or empty item leaks nowhere; items shorter than a window count as one
    window. Windows of fewer than half literal words match word for word only, so an item that is mostly numbers leaks where
    its words and numbers stand in order, whatever signs are between them. Repeated items are reported each, repeated rows have each their list. An empty benchmark leaves all lists empty.
    A column named leaks is replaced. The item key must be a whole number. The benchmark is read in blocks of bounded size
    (in expectation, by a hash of the items); each block is searched in the same task, one after the other.
    """
    items = benchmark.select(F.col(item).cast("long").alias("key"), F.col(item_text).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    small_batches(df.sparkSession)
    out = df.drop("leaks").withColumn("leaks", F.array().cast(LEAK))
    for block in range(blocks):
        some = items.where(F.pmod(F.xxhash64("key", "text"), F.lit(blocks)) == block)
        index = TemplateIndex.build(sorted((tuple(r) for r in some.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        out = out.withColumn("leaks", F.concat("leaks", _probe(index)(F.col(text))))
    return out


def _probe(index: TemplateIndex):
    @pandas_udf(LEAK)
    def probe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _Words(index.vocabulary)
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series([index.leaks(t, words) if hit else [] for t, hit in zip(texts, index.touched(texts, words), strict=True)], dtype=object)

    return probe
