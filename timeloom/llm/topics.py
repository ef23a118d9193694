"""Topics from what texts say: clusters of hashed token counts, found on all texts and given to each.

A text is the vector of the square roots of its tokens' counts in a fixed number of buckets, at length 1, less the mean of
all. Spherical k-means over all texts gives the centres; every text has the topic of its nearest centre. The first centres are
texts drawn one after the other, by lots from their hashed keys, with the squared distance from those drawn before as weight.

The vectors are a table (:data:`SEEN`, packed), read once for every step; each task sends one sum or one drawn text. Up to
``few`` vectors take the same steps on the driver. Coordinates and weights are whole numbers, so that products and sums are
exact and the centres the same however the table is partitioned. Texts without tokens have topic -1.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.tokens import VOCABULARY, encoder
from timeloom.session import materialise

BUCKETS = 512
UNIT = 1 << 16  # the length of a vector; coordinates are whole numbers
WEIGHT = 1 << 10  # in which the weights that bring vectors less the mean to one length are whole numbers
LEAST = UNIT / 64  # a vector less the mean is brought to that length as if it were at least this long
FEW = 10_000  # vectors whose clusters are found on the driver (2 KB each at most)
ROWS, IDS = 256, 1 << 20  # vectors unpacked, and token ids packed, at once
SEEN = "seen"
_VALUE = (1 << 21) - 1  # a packed coordinate: its bucket, then 21 bits of value


def packed(texts: list[bytes]) -> pa.Array:
    """Of each text (its token ids as little-endian 32-bit bytes) the coordinates that are not 0: square roots of the shares of its
    ids by bucket; empty without ids."""
    parts, low, size = [], 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text) // 4
        if i - low >= ROWS or size >= IDS or i == len(texts):
            parts.append(_packed(texts[low:i]))
            low, size = i, 0
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def _packed(texts: list[bytes]) -> pa.Array:
    sizes = np.array([len(t) // 4 for t in texts])
    places = (np.frombuffer(b"".join(texts), "<u4") * np.uint32(2_654_435_761)) >> np.uint32(32 - 9)
    counts = np.bincount(np.repeat(np.arange(len(texts)) * BUCKETS, sizes) + places, minlength=len(texts) * BUCKETS)
    at = np.flatnonzero(counts)
    row, bucket = np.divmod(at, BUCKETS)
    codes = bucket << 21 | np.rint(np.sqrt(counts[at] / sizes[row]) * UNIT).astype(np.int64)
    ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(texts)))] * 4
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(codes.astype("<u4"))])


def unpacked(seen: pa.Array) -> Iterator[np.ndarray]:
    """The vectors of a column of :func:`packed`, some rows at a time; each holds until the next is asked for."""
    seen = seen.cast(pa.large_binary())
    _, ends, data = seen.buffers()
    ends = np.frombuffer(ends, np.int64, len(seen) + 1, 8 * seen.offset) // 4 if len(seen) else np.zeros(1, np.int64)
    codes = np.frombuffer(data, "<u4", int(ends[-1])) if ends[-1] else np.zeros(0, "<u4")
    held = np.empty((ROWS, BUCKETS))
    for low in range(0, len(seen), ROWS):
        stops = ends[low : low + ROWS + 1]
        here, rows = codes[stops[0] : stops[-1]], held[: len(stops) - 1]
        rows[:] = 0
        rows[np.repeat(np.arange(len(rows)), np.diff(stops)), here >> 21] = here & _VALUE
        yield rows


@dataclass(frozen=True)
class Topics:
    mean: np.ndarray
    centres: np.ndarray  # one row a topic, of length UNIT

    def given(self, seen: pa.Array) -> np.ndarray:
        """The topic of each row of a column of :func:`packed`."""
        if not len(self.centres) or not len(seen):
            return np.full(len(seen), -1)
        found = np.concatenate([self.likeness(rows)[0].argmax(axis=1) for rows in unpacked(seen)])
        return np.where(pc.binary_length(seen).to_numpy(zero_copy_only=False) > 0, found, -1)

    def of(self, ids: np.ndarray) -> int:
        return int(self.given(packed([ids.astype("<i4").tobytes()]))[0])

    def likeness(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products of vectors less the mean with each centre, and the lengths of vectors less the mean."""
        products = rows @ np.vstack([self.centres, self.mean]).T
        lengths = np.sqrt(np.maximum(UNIT**2 - 2 * products[:, -1] + self.mean @ self.mean, LEAST**2))
        return products[:, :-1] - self.centres @ self.mean, lengths


Drawn = tuple[float, bytes]  # the smallest lot and its vector
NONE: Drawn = (np.inf, b"")


def lots(keys: np.ndarray, draw: int) -> np.ndarray:
    """A number from an exponential distribution for each hashed key, another one for each draw."""
    x = keys.view(np.uint64) + np.uint64((draw + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return -np.log(((x ^ (x >> np.uint64(31))) >> np.uint64(12)) / float(1 << 52) + 2.0**-53)


def smallest(lot: np.ndarray, rows: np.ndarray) -> Drawn:
    least = lot.min(initial=np.inf)
    return (float(least), min(rows[i].tobytes() for i in np.flatnonzero(lot == least))) if least < np.inf else NONE


def over(table: DataFrame, few: int) -> Callable[[Callable, Callable], Any]:
    """How a step is done over all rows of ``table`` (key, packed vector; materialised): ``step(vectors, keys)`` of some rows at a
    time, joined by ``join``; None where there are no rows."""

    def steps(batch: pa.RecordBatch, step: Callable) -> Iterator[Any]:
        keys, at = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)), 0
        for rows in unpacked(batch.column(1)):
            yield step(rows, keys[at : at + len(rows)])
            at += len(rows)

    def joined(parts: Iterator[Any], join: Callable) -> Any:
        first = next(parts, None)
        return None if first is None else reduce(join, parts, first)

    if table.count() <= few:
        held = table.toArrow().to_batches()
        return lambda step, join: joined((p for batch in held for p in steps(batch, step)), join)

    def everywhere(step: Callable, join: Callable) -> Any:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = joined((p for batch in batches for p in steps(batch, step)), join)
            if part is not None:
                yield pa.record_batch([pa.array([pickle.dumps(part)], pa.binary())], ["part"])

        return joined((pickle.loads(r.part) for r in table.mapInArrow(run, "part binary").collect()), join)  # one a task

    return everywhere


def added(a: tuple, b: tuple) -> tuple:
    return tuple(x + y for x, y in zip(a, b, strict=True))


def fit(table: DataFrame, topics: int, few: int = FEW, rounds: int = 25) -> Topics:
    """Centres of at most ``topics`` clusters of all rows of ``table`` (hashed key, packed vector; materialised)."""
    each = over(table, few)
    whole = each(
        lambda rows, keys: (rows.sum(axis=0).astype(np.int64), len(rows), smallest(lots(keys, 0), rows)),
        lambda a, b: (a[0] + b[0], a[1] + b[1], min(a[2], b[2])),
    )
    if whole is None or topics < 1:
        return Topics(np.zeros(BUCKETS), np.zeros((0, BUCKETS)))
    mean = np.rint(whole[0] / whole[1])
    found = Topics(mean, directed(np.frombuffer(whole[2][1])[None] - mean))

    def away(rows: np.ndarray, keys: np.ndarray) -> Drawn:
        products, lengths = found.likeness(rows)
        weight = np.maximum(1 - products.max(axis=1) / (UNIT * lengths), 0) ** 2
        return smallest(np.divide(lots(keys, len(found.centres)), weight, out=np.full(len(rows), np.inf), where=weight > 1e-9), rows)

    while len(found.centres) < topics:  # far from those drawn
        drawn = each(away, min)
        if drawn == NONE:
            break
        found = Topics(mean, np.vstack([found.centres, directed(np.frombuffer(drawn[1])[None] - mean)]))

    def sums(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        products, lengths = found.likeness(rows)
        weights = np.zeros((len(found.centres), len(rows)))
        weights[products.argmax(axis=1), np.arange(len(rows))] = np.rint(WEIGHT * UNIT / lengths)
        return (weights @ rows).astype(np.int64), weights.sum(axis=1).astype(np.int64)

    for _ in range(rounds):
        total, weight = each(sums, added)
        moved = np.where(weight[:, None] > 0, directed(total - weight[:, None] * mean), found.centres)
        still = np.array_equal(moved, found.centres)
        found = Topics(mean, moved)
        if still:
            break
    return found


def directed(rows: np.ndarray) -> np.ndarray:
    """Rows at length ``UNIT``, in whole numbers."""
    return np.rint(rows * (UNIT / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)))


def hashed(table: DataFrame, key: str, seed: int) -> DataFrame:
    """(hashed key, packed vector), as :func:`fit` takes them."""
    return table.select(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), SEEN)


def fitted(docs: DataFrame, key: str, text: str, topics: int, few: int = FEW, seed: int = 0, vocabulary: str = VOCABULARY) -> Topics:
    """:func:`fit` on all texts of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            yield pa.record_batch([batch.column(0), packed([coder.packed(t.as_py()) for t in batch.column(1)])], ["id", SEEN])

    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("t")).filter(F.length("t") > 0)
    seen = texts.mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, {SEEN} binary").filter(F.length(SEEN) > 0)
    return fit(hashed(materialise(seen), "id", seed), topics, few)
