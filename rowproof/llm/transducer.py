"""Operator 11, byte-level BPE as a transducer.

A text is cut into pieces by the vocabulary's pattern, and each piece is encoded by the ranks of a
``.tiktoken`` file: of all neighbours whose bytes together are a token, those of the least rank merge
first, the leftmost of equals. What this gives has a local test: tokens in a row are the encoding of their bytes
exactly if each two neighbours are the encoding of theirs, since merges on one side of a boundary that stays never depend on the
other side. So the token that ends at each byte is determined, and a finite-state transducer reads the bytes once:

* A state holds, for each boundary from which a token may still grow to the present byte, the bytes since
  then, the token before, and the tokens that are not emitted yet.
* A byte makes the pending bytes longer; of those that are a token then, exactly one fits the token
  before it. Tokens that all the state's boundaries have in common are emitted, so what is held back is bounded by the
  longest token.
* States and transitions are determinised when they are first met, and forgotten when there are
  ``STATES`` of them, so memory is bounded whatever the texts.

The library's regular expressions and Python's know different versions of Unicode. The letters and numbers that only Python's
engine knows are found by asking the library once, and taken out of the pattern's classes.

Decoding runs tokens through an incremental UTF-8 automaton, which holds back up to three bytes of a character
whose end has not come, and puts U+FFFD for each longest part that can begin no character.

Defined cases: a null text counts as an empty one, which has no ids and decodes to an empty text. Bytes that
are no UTF-8 are replaced by U+FFFD before encoding. Texts of any length are read in one pass; repeated rows get a row
each, and kept columns of any name and type pass through. Unknown ids are an error.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowproof.llm.common import bounded_batches, fresh, kept, map_texts, release

STATES = 400_000
PIECES = 200_000
PIECE_BYTES = 32
_MEMO = "bytes-bpe"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of a few bytes by merging, the least rank first. Its time grows with the square of the length."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while True:
        least, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (least is None or rank < least):
                least, at = rank, i
        if least is None:
            return parts
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def _in_common(residuals: list[tuple]) -> int:
    """How many tokens all of them begin with alike."""
    low, high = min(residuals), max(residuals)
    n = 0
    while n < len(low) and n < len(high) and low[n] == high[n]:
        n += 1
    return n


class Transducer:
    """Ids of pieces of bytes. One instance serves one thread.

    A state is a tuple of pairs: the number of an open token (its bytes so far and the token before it), and the tokens
    behind it that are not emitted. The last pair is the boundary at the present byte.
    """

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks, self.limit = ranks, states
        self.tokens = {rank: token for token, rank in ranks.items()}
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks the single bytes {lacking[:5]}")
        self.prefixes = {part: part for token in ranks for n in range(1, len(token) + 1) for part in [token[:n]]}
        self.prefixes[b""] = b""
        self._fits: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self._open: list[tuple[bytes, int]] = []
        self._open_number: dict[tuple[bytes, int], int] = {}
        self._states: list[tuple] = []
        self._state_number: dict[tuple, int] = {}
        self._steps: dict[int, int | tuple[int, tuple]] = {}
        self._number_of((self._opened(b"", -1), ()))

    def _number_of(self, state: tuple) -> int:
        number = self._state_number.get(state)
        if number is None:
            number = self._state_number[state] = len(self._states)
            self._states.append(state)
        return number

    def _opened(self, pending: bytes, last: int) -> int:
        key = (pending, last)
        number = self._open_number.get(key)
        if number is None:
            number = self._open_number[key] = len(self._open)
            self._open.append(key)
        return number

    def _joins(self, last: int, rank: int) -> bool:
        """Whether a token stays as it is behind the token ``last``, or at the start if that is -1."""
        found = self._fits.get((last, rank))
        if found is None:
            if len(self._fits) >= 2 * self.limit:
                self._fits.clear()
            both = [self.tokens[last], self.tokens[rank]] if last >= 0 else [self.tokens[rank]]
            found = self._fits[last, rank] = merged(b"".join(both), self.ranks) == both
        return found

    def _determinise(self, number: int, byte: int) -> int | tuple[int, tuple]:
        """The step from a state by a byte: the next state's number, with the tokens emitted if there are any."""
        if len(self._states) >= self.limit or len(self._open) >= 2 * self.limit:
            state = self._states[number]
            known = [self._open[h] for h in state[::2]]
            self._forget()
            number = self._number_of(tuple(x for key, r in zip(known, state[1::2], strict=True) for x in (self._opened(*key), r)))
        state, added, prefixes, ranks, opened, numbers = self._states[number], bytes([byte]), self.prefixes, self.ranks, self._open, self._open_number
        moved, common, token = [], True, -1
        for i in range(0, len(state), 2):
            pending, last = opened[state[i]]
            grown = prefixes.get(pending + added)
            if grown is None:
                continue
            at = numbers.get((grown, last))
            moved.append(self._opened(grown, last) if at is None else at)
            residual = state[i + 1]
            moved.append(residual)
            common = common and residual
            if token < 0:
                rank = ranks.get(grown)
                if rank is not None and self._joins(last, rank):
                    token, here = rank, residual
        moved.append(self._opened(b"", token))
        moved.append((*here, token))
        n = _in_common(moved[1::2]) if common else 0
        if not n:
            step = self._steps[number << 8 | byte] = self._number_of(tuple(moved))
            return step
        emitted = moved[-1][:n]
        moved[1::2] = [residual[n:] for residual in moved[1::2]]
        step = self._steps[number << 8 | byte] = (self._number_of(tuple(moved)), emitted)
        return step

    def feed(self, data: bytes, state: int = 0) -> Iterator[tuple[int, tuple[int, ...]]]:
        """The state after each byte, and the ids emitted by it. What is held back then is in ``held``."""
        for byte in data:
            step = self._steps.get(state << 8 | byte)
            if step is None:
                step = self._determinise(state, byte)
            state, emitted = (step, ()) if isinstance(step, int) else step
            yield state, emitted

    def held(self, state: int) -> tuple[int, ...]:
        """Ids that end a piece which ends in this state."""
        return self._states[state][-1]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece; a piece that is a token has that id."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, ids, steps = 0, [], self._steps
        for byte in piece:
            step = steps.get(state << 8 | byte)
            if step is None:
                step, steps = self._determinise(state, byte), self._steps
            if isinstance(step, int):
                state = step
            else:
                state, emitted = step
                ids += emitted
        ids += self.held(state)
        return tuple(ids)


@cache
def newer_letters(kind: str) -> str:
    """Code points of a class (``L`` or ``N``) for the ``regex`` module but not for the tokenizer library's own engine.

    Both follow Unicode, in different versions. Only code points that Python's own tables don't know can differ.
    """
    ranks = {bytes([i]): i for i in range(256)} | {bytes([i, 10]): 256 + i for i in range(256)}
    library = tiktoken.Encoding("probe", pat_str=rf"\p{{{kind}}}\n|.|\n", mergeable_ranks=ranks, special_tokens={})
    member = regex.compile(rf"\p{{{kind}}}")
    unknown = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" and member.match(c)]
    ends = [i >= 256 for i in library.encode_ordinary("".join(c + "\n" for c in unknown)) if i == 10 or i >= 256]
    return "".join(c for c, known in zip(unknown, ends, strict=True) if not known)


def as_library(pattern: str) -> tuple[str, str]:
    """``pattern`` with the library's letters and numbers, and the characters for whose sake it differs."""
    newer = {kind: newer_letters(kind) for kind in "LN"}
    for kind, characters in newer.items():
        if characters:
            pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{characters}]]")
    return "(?V1)" + pattern, "".join(newer.values())


class TextEncoder:
    """Ids of texts: the pattern's pieces through the transducer; ids of short pieces are kept, up to ``PIECES``.

    ``exact`` is what ``as_library`` gives for the pattern.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, exact: tuple[str, str], states: int = STATES):
        self.transducer = Transducer(ranks, states)
        self.pattern, self.exact = regex.compile(pattern), regex.compile(exact[0])
        self.newer = frozenset(exact[1])
        self._known: dict[str, tuple] = {}

    def _ids(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        ids = self.transducer.encode(data)
        if len(data) <= PIECE_BYTES:
            if len(self._known) >= PIECES:
                self._known.clear()
            self._known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, ids = self._known.get, self._ids
        pattern = self.pattern if text.isascii() or self.newer.isdisjoint(text) else self.exact
        return list(chain.from_iterable([known(p) or ids(p) for p in pattern.findall(text)]))


# The automaton of well-formed UTF-8 (Unicode standard, table 3-7): by first byte, the range of the
# second one and how many bytes follow in all.
def _second_byte(first: int) -> tuple[int, int, int] | None:
    if 0xC2 <= first <= 0xDF:
        return 0x80, 0xBF, 1
    if 0xE0 <= first <= 0xEF:
        return (0xA0 if first == 0xE0 else 0x80), (0x9F if first == 0xED else 0xBF), 2
    if 0xF0 <= first <= 0xF4:
        return (0x90 if first == 0xF0 else 0x80), (0x8F if first == 0xF4 else 0xBF), 3
    return None


class Utf8Stream:
    """Text of bytes that come bit by bit; a character is given out with its last byte."""

    def __init__(self):
        self.pending = b""

    def push(self, data: bytes) -> str:
        out, pending = [], self.pending
        low, high, left = self._expected(pending)
        for byte in data:
            if pending and low <= byte <= high:
                pending += bytes([byte])
                low, high, left = 0x80, 0xBF, left - 1
                if left == 0:
                    out.append(pending.decode())
                    pending = b""
                continue
            if pending:
                out.append("�")
                pending = b""
            if byte < 0x80:
                out.append(chr(byte))
                continue
            expected = _second_byte(byte)
            if expected is None:
                out.append("�")
            else:
                pending, (low, high, left) = bytes([byte]), expected
        self.pending = pending
        return "".join(out)

    @staticmethod
    def _expected(pending: bytes) -> tuple[int, int, int]:
        if not pending:
            return 0, 0, 0
        low, high, left = _second_byte(pending[0])
        return (low, high, left) if len(pending) == 1 else (0x80, 0xBF, left + 1 - len(pending))

    def finish(self) -> str:
        """What stands for a character that was cut off."""
        rest, self.pending = ("�" if self.pending else ""), b""
        return rest


class TokenDecoder:
    """Texts of ids. The automaton's steps over whole tokens are kept by (bytes held back, id)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._steps: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        #: Text of the tokens that begin and end between characters.
        self.whole = {i: text for i in self.tokens for text, rest in [self._step(b"", i)] if not rest and "�" not in text}

    def _step(self, pending: bytes, token: int) -> tuple[str, bytes]:
        key = (pending, token)
        if key not in self._steps:
            if token not in self.tokens:
                raise ValueError(f"no token has the id {token}")
            stream = Utf8Stream()
            stream.pending = pending
            text = stream.push(self.tokens[token])
            if len(self._steps) >= 16 * STATES:
                self._steps.clear()
            self._steps[key] = (text, stream.pending)
        return self._steps[key]

    def decode(self, ids: Iterable[int]) -> str:
        parts, pending = [], b""
        whole, step = self.whole.get, self._step
        for i in ids:
            text = None if pending else whole(i)
            if text is None:
                text, pending = step(pending, i)
            parts.append(text)
        if pending:
            parts.append("�")
        return "".join(parts)


def _digest(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()


def _lists(values: list[list[int]]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(values), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode(
    docs: DataFrame,
    keep: list[str],
    path: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``keep`` columns with the ids of the text, and with ``decoded_col`` also the text that the ids decode to."""
    if set(keep) & {ids_col, decoded_col}:
        raise ValueError(f"{ids_col} or {decoded_col} is kept already; choose other names for the results")
    bounded_batches(docs.sparkSession)
    ranks, exact = read_ranks(path), as_library(pattern)
    name = _digest(ranks)

    def make() -> Callable[[list], Iterable]:
        encoder = kept((_MEMO, name, pattern), lambda: TextEncoder(ranks, pattern, exact))
        decoder = kept((_MEMO, name), lambda: TokenDecoder(ranks))

        def compute(texts: list) -> list:
            ids = [encoder.encode(t.decode("utf-8", "replace")) if t else [] for t in texts]
            return [_lists(ids), [decoder.decode(i) for i in ids]] if decoded_col else [_lists(ids)]

        return compute

    fields = [(ids_col, T.ArrayType(T.IntegerType()))] + ([(decoded_col, T.StringType())] if decoded_col else [])
    return map_texts(docs, text_col, keep, fields, make, as_bytes=True, keeps=_MEMO)


def decode(
    encoded: DataFrame,
    keep: list[str],
    path: str,
    ids_col: str = "ids",
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns with the text of the ids. Null ids have a null text; null elements are an error."""
    if text_col in keep:
        raise ValueError(f"{text_col} is kept already; choose another name for the result")
    bounded_batches(encoded.sparkSession)
    ranks, own = read_ranks(path), fresh("ids")
    name = _digest(ranks)
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(_MEMO)
        decoder = kept((_MEMO, name), lambda: TokenDecoder(ranks))
        for batch in batches:
            texts = [None if i is None else decoder.decode(i) for i in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*[encoded[c] for c in keep], encoded[ids_col].alias(own)).mapInArrow(run, schema)


def digests(encoded: DataFrame, keep: list[str], ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``keep`` columns with the number of ids, and hashes of the ids' spelling and of the decoded bytes."""
    ids, decoded = encoded[ids_col], encoded[decoded_col]
    return encoded.select(
        *[encoded[c] for c in keep],
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(decoded.cast("binary"), 256).alias("decoded_sha256"),
    )
