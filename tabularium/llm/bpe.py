"""Byte-level BPE by a lazily determinised transducer, and streaming decode.

In byte-level BPE the encoding of a prefix, cut at its last token, is the encoding of the shorter prefix, and a token
sequence is an encoding exactly when each neighbouring pair is one. So a transducer can read a piece byte by byte. Its state
is the last token that is certain and the bytes after it; a byte leads to a new state and emits the tokens on which all
readings that a longer token could still bring agree. No token is longer than the longest of the vocabulary, so the
lookahead is bounded. States and transitions are made when first met; once the table is full, a piece that leaves it is read to its end
by following all open readings at once, which is what a state stands for.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from tabularium.llm.batches import small_batches
from tabularium.llm.names import free_names, without

#: Entries of a worker's tables of pieces, states and pairs; beyond it a table starts anew, which costs time and changes no result.
MEMO, STATES, PAIRS = 600_000, 2_000, 300_000
#: With a full table, pieces up to so many bytes are read without making states from the first unknown move on.
SHORT = 256
_NEVER = 1 << 62
#: Ids decoded at once.
CHUNK = 1 << 16


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """The tokens of a rank file: base64 token and rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def _by_rank(ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens by their ids."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


@dataclass(slots=True)
class _State:
    """What a reader knows after some bytes. Places count the bytes that are not certain yet.

    last: for each place, the last token of the encoding up to it (at 0 the last certain token; -1 if no token ends there);
    first: where the first token of that encoding ends (-1: none); starts: places where an unfinished token may start, with
    its node in the trie, the longest token first; end: the ids these bytes come to if the piece ends here.
    """

    last: list[int]
    first: list[int]
    starts: list[tuple[int, int]]
    end: bytes | None = None


class MergeTransducer:
    """Encodes one piece at a time; see the module's text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = dict(enumerate(ranks))
        self.sizes = [len(t) for t in ranks]
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.ids = list(self.packed.values())
        self.nothing = len(self.sizes)
        self.children: dict[int, int] = {}
        self.token_at, self.open = [-1], [True]
        for number, token in enumerate(ranks):
            node = 0
            for byte in token:
                self.open[node] = True
                node = self.children.setdefault(node << 8 | byte, len(self.open))
                if node == len(self.open):
                    self.open.append(False)
                    self.token_at.append(-1)
            self.token_at[node] = number
        self.pairs: dict[int, bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[tuple[int, bytes], int] = {}
        self.states: list[_State] = []
        self.pending: list[bytes] = []
        self.moves: dict[int, tuple[int, bytes]] = {}
        self._number(b"", _State([self.nothing], [0], [(0, 0)], b""))

    def _number(self, pending: bytes, state: _State) -> int:
        number = self.numbers.setdefault((state.last[0], pending), len(self.states))
        if number == len(self.states):
            self.states.append(state)
            self.pending.append(pending)
        return number

    def merged(self, data: bytes) -> list[bytes]:
        """The encoding by its definition: join the neighbours whose join has the lowest rank, leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        joins = [rank(data[i:i + 2], _NEVER) for i in range(len(data) - 1)]
        while joins:
            best = min(joins)
            if best == _NEVER:
                break
            at = joins.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = rank(parts[at - 1] + parts[at], _NEVER)
            if at < len(joins):
                joins[at] = rank(parts[at] + parts[at + 1], _NEVER)
        return parts

    def _fits(self, left: int, right: int) -> bool:
        """Whether token right can follow token left; after nothing, whether right is its own encoding."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        token = self.tokens[right]
        own = [token] if left == self.nothing else [self.tokens[left], token]
        known = self.pairs[left << 20 | right] = self.merged(b"".join(own)) == own
        return known

    def _move(self, number: int, byte: int) -> tuple[int, bytes]:
        """The move of a state by a byte, worked out once."""
        state = self.states[number]
        here, token, starts = len(state.last), -1, []
        for place, node in state.starts:
            child = self.children.get(node << 8 | byte)
            if child is None:
                continue
            found = self.token_at[child]
            if token < 0 <= found:
                fits = self.pairs.get(state.last[place] << 20 | found)
                if fits is None:
                    fits = self._fits(state.last[place], found)
                if fits:
                    token = found
            if self.open[child]:
                starts.append((place, child))
        last, first = [*state.last, token], [*state.first, -1]
        if token >= 0:
            begin = here - self.sizes[token]
            first[here] = first[begin] if begin else here
            starts.append((here, 0))
        if not starts:
            raise ValueError("the vocabulary lacks a byte")
        pending, emitted = self.pending[number] + bytes((byte,)), b""
        # What all readings that are still open agree on is certain.
        while (cut := first[starts[0][0]]) > 0 and all(first[place] == cut for place, _ in starts):
            emitted += self.ids[last[cut]]
            last, pending = last[cut:], pending[cut:]
            starts = [(place - cut, node) for place, node in starts]
            first = [0] + [-1] * (len(last) - 1)
            for place in range(1, len(last)):
                if last[place] >= 0 and (begin := place - self.sizes[last[place]]) >= 0:
                    first[place] = first[begin] if begin else place
        target = self._number(pending, _State(last, first, starts))
        self.moves[number << 8 | byte] = target, emitted
        return target, emitted

    def _read_on(self, number: int, rest: bytes) -> bytes:
        """The ids of what a state holds and of the bytes after it, without making states."""
        last, starts = list(self.states[number].last), self.states[number].starts
        children, token_at, open_, pairs, sizes = self.children.get, self.token_at, self.open, self.pairs.get, self.sizes
        for byte in rest:
            token, going = -1, []
            for start in starts:
                child = children(start[1] << 8 | byte)
                if child is not None:
                    found = token_at[child]
                    if token < 0 <= found:
                        fits = pairs(last[start[0]] << 20 | found)
                        if fits or fits is None and self._fits(last[start[0]], found):
                            token = found
                    if open_[child]:
                        going.append((start[0], child))
            if token >= 0:
                going.append((len(last), 0))
            last.append(token)
            starts = going
        place, out = len(last) - 1, []
        while place:
            out.append(self.ids[last[place]])
            place -= sizes[last[place]]
        return b"".join(out[::-1])

    def encode(self, piece: bytes) -> bytes:
        """The ids of a piece, each as four bytes, lowest first."""
        if piece in self.packed:
            return self.packed[piece]
        number, out, moves = 0, [], self.moves.get
        full = len(self.states) >= STATES and len(piece) <= SHORT
        for at, byte in enumerate(piece):
            move = moves(number << 8 | byte)
            if move is None:
                if full:
                    out.append(self._read_on(number, piece[at:]))
                    return b"".join(out)
                move = self._move(number, byte)
            number = move[0]
            if move[1]:
                out.append(move[1])
        state = self.states[number]
        if state.end is None:
            state.end = self._read_on(number, b"")
        out.append(state.end)
        if len(self.states) > 2 * STATES:
            self._clear()
        return b"".join(out)


class Encoder(dict):
    """Whole texts to ids; as a mapping, the memo of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.before: dict[str, bytes] = {}
        self.find = regex.compile(pattern).findall
        self.transducer = MergeTransducer(ranks)

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece.encode("utf-8", "replace"))
        if len(self) > MEMO // 2:
            self.before = dict(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text or "")))


class Utf8Stream:
    """Incremental UTF-8: keeps the bytes of a character that is not yet complete."""

    def __init__(self) -> None:
        self.rest = b""

    def feed(self, data: bytes) -> str:
        data = self.rest + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                needs = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                cut -= back if needs > back else 0
                break
            if lead < 0x80:
                break
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.rest = self.rest, b""
        return rest.decode("utf-8", "replace")


def decode_stream(tokens: list[bytes], ids: np.ndarray) -> Iterator[str]:
    """The text of the ids, in chunks; a character that tokens share comes with the token that completes it."""
    stream = Utf8Stream()
    for start in range(0, len(ids), CHUNK):
        yield stream.feed(b"".join([tokens[i] for i in ids[start:start + CHUNK].tolist()]))
    yield stream.close()


def encode(df: DataFrame, text: str, lines: bytes, pattern: str, out: str = "ids") -> DataFrame:
    """df with the ids of each whole text as packed little-endian unsigned 32-bit integers.

    A null or empty text has no ids (empty binary). A column named as out is replaced; the other columns, repeated rows
    and an empty table pass as they are. lines is the content of a rank file: fixed in size, it travels with the task.
    """

    small_batches(df.sparkSession)

    @pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(load_ranks(lines), pattern)
        for texts in batches:
            yield pd.Series([encoder.encode(t) for t in texts], dtype=object)

    return df.withColumn(out, ids(F.col(text)))


def decode(df: DataFrame, ids: str, lines: bytes, out: str = "decoded") -> DataFrame:
    """df with the text of packed ids; null counts as no ids, an id outside the vocabulary fails the job."""

    small_batches(df.sparkSession)

    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = _by_rank(load_ranks(lines))
        for column in batches:
            yield pd.Series(["".join(decode_stream(tokens, np.frombuffer(x or b"", "<u4"))) for x in column], dtype=object)

    return df.withColumn(out, text(F.col(ids)))


def encode_and_decode(df: DataFrame, text: str, lines: bytes, pattern: str, out: str = "ids", back: str = "decoded") -> DataFrame:
    """df with what encode and then decode add to it, by one worker of a task instead of two.

    The ids are decoded as they are returned. Nulls, empty texts, repeated rows and empty tables are treated as there; columns
    with the two names in any case are replaced.
    """
    small_batches(df.sparkSession)

    @pandas_udf("ids binary, text string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ranks = load_ranks(lines)
        encoder, tokens = Encoder(ranks, pattern), _by_rank(ranks)
        for texts in batches:
            ids = [encoder.encode(t) for t in texts]
            yield pd.DataFrame({"ids": ids, "text": ["".join(decode_stream(tokens, np.frombuffer(x, "<u4"))) for x in ids]}, dtype=object)

    (said,) = free_names(df, "_said")
    found = df.select(*df.columns, both(F.col(text)).alias(said))
    return found.select(*without(df, (out, back)), F.col(f"{said}.ids").alias(out), F.col(f"{said}.text").alias(back))


def n_tokens(ids: str) -> Column:
    """The number of packed ids."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
