"""Encoding with a public byte-level BPE vocabulary by dynamic programming over byte prefixes.

For every prefix of a byte string there is exactly one last token such that the tokens ending there are what byte
pair encoding gives for that prefix. It is the token ``t`` ending there for which the pair (last token of the
prefix before ``t``, ``t``) is one that encoding would leave unmerged. Storing that token for each prefix makes
the encoding of a prefix a walk back through the table, an append an extension of the table, and an edit a cut of
the table followed by an extension.

The text is first split into pieces by the vocabulary's published pattern; pieces are encoded independently and
the result of a piece is kept (bounded, per Python worker), since pieces repeat throughout a corpus.

Defined results: null and empty texts give an empty list; strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The published split pattern of the vocabulary, and the same for texts of ASCII characters only.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r" ?[A-Za-z]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
CACHED_PIECES = 400_000
IDS_PER_BATCH = 4_000_000
CHUNK = 1 << 20
_CUT = re.compile(r"\w(?=[\n\r\t ])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")


class Vocabulary:
    """Ranks of a byte-level BPE vocabulary and the test whether two tokens can stand side by side."""

    def __init__(self, path: str = VOCABULARY) -> None:
        lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
        self.rank: dict[bytes, int] = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.longest = max(map(len, self.rank))
        self._parts: dict[int, tuple[int, int]] = {}
        self._spines: dict[tuple[int, bool], tuple[tuple[bytes, int], ...]] = {}
        self._apart: dict[tuple[int, int], bool] = {}

    def parts(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``."""
        if token not in self._parts:
            whole, rank = self.token[token], self.rank
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                _, at = min((rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._parts[token] = (rank[parts[0]], rank[parts[1]])
        return self._parts[token]

    def spine(self, token: int, right: bool) -> tuple[tuple[bytes, int], ...]:
        """From a single byte to ``token``: the parts at its right (or left) edge, each with the rank that absorbs it."""
        key = (token, right)
        if key not in self._spines:
            if len(self.token[token]) == 1:
                found: tuple[tuple[bytes, int], ...] = ((self.token[token], 1 << 40),)
            else:
                inner = self.spine(self.parts(token)[right], right)
                found = (*inner[:-1], (inner[-1][0], token), (self.token[token], 1 << 40))
            self._spines[key] = found
        return self._spines[key]

    def apart(self, a: int, b: int) -> bool:
        """Whether encoding leaves ``a`` and ``b`` as they are when they are adjacent: no merge across comes first."""
        key = (a, b)
        said = self._apart.get(key)
        if said is None:
            left, right, rank = self.spine(a, True), self.spine(b, False), self.rank
            i = j = 0
            said = True
            while True:
                (x, x_until), (y, y_until) = left[i], right[j]
                across = rank.get(x + y)
                if across is not None and across < x_until and across <= y_until:
                    said = False
                    break
                if i == len(left) - 1 and j == len(right) - 1:
                    break
                if x_until <= y_until:
                    i += 1
                else:
                    j += 1
            if len(self._apart) > 2_000_000:
                self._apart.clear()
            self._apart[key] = said
        return said


class PrefixTable:
    """Last tokens of all prefixes of one byte string; grows at the end and can be cut."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.extend(data)

    def extend(self, more: bytes) -> None:
        """Append bytes; earlier entries of the table stay as they are."""
        start, self.data = len(self.data), self.data + more
        data, last, vocabulary = self.data, self.last, self.vocabulary
        rank, longest, apart = vocabulary.rank, vocabulary.longest, vocabulary.apart
        for end in range(start + 1, len(data) + 1):
            for begin in range(max(0, end - longest), end):
                token = rank.get(data[begin:end])
                if token is not None and (begin == 0 or apart(last[begin], token)):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        self.data = self.data[:size]
        del self.last[size + 1 :]

    def ids(self) -> list[int]:
        found, at = [], len(self.data)
        while at:
            found.append(self.last[at])
            at -= len(self.vocabulary.token[self.last[at]])
        return found[::-1]


class Pieces(dict):
    """Piece of text -> its ids as little-endian 32-bit bytes, computed when first met."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocabulary.rank.get(data)
        ids = [whole] if whole is not None else PrefixTable(self.vocabulary, data).ids()
        packed = np.array(ids, "<i4").tobytes()
        if len(piece) <= 200:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Encoder:
    """Texts to ids; one per Python worker and vocabulary (:func:`encoder`)."""

    def __init__(self, path: str = VOCABULARY) -> None:
        import regex

        self.vocabulary = Vocabulary(path)
        self.pieces = Pieces(self.vocabulary)
        self._any, self._ascii = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN).findall

    def split(self, text: str) -> list[str]:
        return self._ascii(text) if text.isascii() else self._any(text)

    def packed(self, text: str) -> bytes:
        """Ids as little-endian 32-bit bytes; long texts are split part by part, at places no piece reaches over."""
        if len(text) <= CHUNK:
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        parts, at = [], 0
        while at < len(text):
            place = _CUT.search(text, at + CHUNK) if at + CHUNK < len(text) else None
            end = place.end() if place else len(text)
            parts.append(b"".join(map(self.pieces.__getitem__, self.split(text[at:end]))))
            at = end
        return b"".join(parts)

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), "<i4").tolist() if text else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.vocabulary.token[i] for i in ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


class EncodedText:
    """A text with its ids, kept exact under appends and edits by re-encoding only near them.

    Cuts are made where a non-space is followed by white space: no piece reaches over such a place.
    """

    def __init__(self, coder: Encoder, text: str = "") -> None:
        self.coder, self.text = coder, text
        self.pieces = coder.split(text)

    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(map(self.coder.pieces.__getitem__, self.pieces)), "<i4").tolist()

    def size(self) -> int:
        return sum(len(self.coder.pieces[p]) for p in self.pieces) // 4

    def append(self, more: str) -> int:
        """Add ``more``; only what follows the last cut before the end is encoded again, and its number of characters returned."""
        at, low = len(self.pieces), len(self.text)
        while at:
            at -= 1
            low -= len(self.pieces[at])
            if low and self.text[low].isspace() and not self.text[low - 1].isspace():
                break
        middle = self.text[low:] + more
        self.pieces[at:] = self.coder.split(middle)
        self.text += more
        return len(middle)

    def edit(self, begin: int, end: int, new: str) -> int:
        """Replace ``text[begin:end]`` by ``new``; returns the number of characters encoded again."""
        starts = np.cumsum([0, *map(len, self.pieces)]).tolist()
        cuts = [0] + [s for s in starts[1:-1] if self.text[s].isspace() and not self.text[s - 1].isspace()]
        at = max(0, bisect_right(cuts, max(begin - 1, 0)) - 1)
        low = cuts[at]
        high = next((s for s in cuts[at:] if s > end), len(self.text))
        middle = self.text[low:begin] + new + self.text[end:high]
        first, last = starts.index(low), starts.index(high)
        self.pieces[first:last] = self.coder.split(middle)
        self.text = self.text[:begin] + new + self.text[end:]
        return len(middle)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids) of every row of ``docs``; null and empty texts have an empty list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            keys, first, size, packed = batch.column(0), 0, 0, []
            offsets = [0]
            for row, body in enumerate(batch.column(1)):
                body = body.as_py()
                ids = coder.packed(body) if body else b""
                packed.append(ids)
                size += len(ids) // 4
                offsets.append(size)
                if size > IDS_PER_BATCH or row == batch.num_rows - 1:
                    values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                    yield pa.record_batch([keys.slice(first, row + 1 - first), lists], ["key", "ids"])
                    first, size, packed, offsets = row + 1, 0, [], [0]

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    out = rows.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, ids array<int>")
    return out.withColumnRenamed("key", key)


def appended(docs: DataFrame, key: str, text: str, more: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens, n_before, again) of every row of ``docs`` once the column ``more`` is appended to ``text``: its tokens then
    and before, and how many characters had to be encoded again for it. Null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            before, after, again = [], [], []
            for body, added in zip(batch.column(1), batch.column(2), strict=True):
                held = EncodedText(coder, body.as_py() or "")
                before.append(held.size())
                again.append(held.append(added.as_py() or ""))
                after.append(held.size())
            yield pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in (after, before, again))], ["key", "n_tokens", "n_before", "again"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.col(more).alias("more"))
    out = rows.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, n_tokens bigint, n_before bigint, again bigint")
    return out.withColumnRenamed("key", key)


def with_token_counts(docs: DataFrame, text: str = "text", name: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` without ``text`` but with its number of tokens (0 for null and empty texts)."""
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            counts = [len(coder.packed(t)) // 4 if (t := body.as_py()) else 0 for body in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(counts, pa.int64())], [f"c{i}" for i in range(len(kept) + 1)])

    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{text}`").alias("body"))
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept))
    out = rows.mapInArrow(run, ", ".join(filter(None, [types, f"c{len(kept)} bigint"])))
    return out.toDF(*kept, name)
