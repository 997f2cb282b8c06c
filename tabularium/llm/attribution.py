"""Token counts of sections, from one encoding of the whole document.

A document is encoded once. The byte lengths of its tokens give character spans, which are joined with the character spans of
the sections. The rule for a token that crosses a boundary: it belongs as a whole to the section that holds most of its
characters, and to the earlier one on a tie. A token that cuts a character through counts as spanning all of it. Tokens
without a character in any section belong to none (section null).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.names import free_names, without
from tabularium.llm.bpe import load_ranks

Spans = tuple[np.ndarray, np.ndarray]


def lines(text: str) -> Spans:
    """Each line with its line feed is a section; they cover the text."""
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    ends = np.flatnonzero(code == 10) + 1
    if not len(ends) or ends[-1] != len(code):
        ends = np.append(ends, len(code))
    ends = ends[ends > 0]
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends


def token_spans(text: str, ids: np.ndarray, lengths: np.ndarray) -> Spans:
    """First character and end of each token."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    char_of = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    return char_of[ends - lengths[ids]], char_of[ends - 1] + 1


def allocate(tokens: Spans, sections: Spans) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1: none) and whether it has characters outside it. Sections are ordered and disjoint."""
    (t0, t1), (s0, s1) = tokens, sections
    first = np.searchsorted(s1, t0, "right")
    last = np.searchsorted(s0, t1, "left") - 1
    owner = np.where(first <= last, first, -1)
    for i in np.flatnonzero(first < last):
        some = slice(first[i], last[i] + 1)
        owner[i] = first[i] + int(np.argmax(np.minimum(s1[some], t1[i]) - np.maximum(s0[some], t0[i])))
    inside = owner >= 0
    crossing = np.zeros(len(owner), bool)
    crossing[inside] = (t0[inside] < s0[owner[inside]]) | (t1[inside] > s1[owner[inside]])
    return owner, crossing


def attribute(df: DataFrame, text: str, rank_lines: bytes, pattern: str, sectioner: Callable[[str], Spans] = lines) -> DataFrame:
    """One row per section of each document: the columns of df without its text, and section, section_start, section_end,
    n_tokens, n_crossing.

    The counts of a document's rows add up to its tokens. A null or empty text has no sections and gives no rows; tokens
    outside all sections give a row with section null. Columns of these names are replaced; repeated rows count each.
    """

    small_batches(df.sparkSession)

    @pandas_udf("array<struct<section:int,section_start:int,section_end:int,n_tokens:long,n_crossing:long>>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranks = load_ranks(rank_lines)
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        encoder = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([_rows(t, encoder, lengths, sectioner) for t in texts], dtype=object)

    names = ("section", "section_start", "section_end", "n_tokens", "n_crossing")
    kept, (found, each) = without(df, (*names, text)), free_names(df, "_sections", "_each")
    return (df.select(*kept, counted(F.col(text)).alias(found))
            .select(*kept, F.explode_outer(found).alias(each)).where(F.col(each).isNotNull())
            .select(*kept, f"{each}.*"))


def _rows(text: str | None, encoder: tiktoken.Encoding, lengths: np.ndarray, sectioner: Callable[[str], Spans]) -> list[tuple]:
    if not text:
        return []
    starts, ends = sectioner(text)
    owner, crossing = allocate(token_spans(text, np.array(encoder.encode_ordinary(text)), lengths), (starts, ends))
    n = np.bincount(owner + 1, minlength=len(starts) + 1)
    x = np.bincount(owner + 1, crossing, minlength=len(starts) + 1).astype(np.int64)
    rows = list(zip(range(len(starts)), starts.tolist(), ends.tolist(), n[1:].tolist(), x[1:].tolist(), strict=True))
    return [*rows, (None, None, None, int(n[0]), 0)] if n[0] else rows
