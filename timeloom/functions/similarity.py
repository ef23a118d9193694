"""Token sets of labels: subset test, and the set similarity that forgives added and dropped words."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from timeloom.functions.labels import normalise_label_text


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit-parallel rows (one big integer for the whole row)."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


BUCKETS = 64  # letters are counted in so many buckets; fewer only make the bounds wider
CHUNK = 2_000_000  # pairs whose bounds are held at once
LETTERS = 64  # longer names do not fit a machine word and are scored one by one


class Names:
    """Normalised names with what is needed to bound and to score all pairs with other names in whole columns."""

    def __init__(self, names: list[str]) -> None:
        self.names = names
        self.words = [sorted(set(n.split())) for n in names]
        self.texts = [" ".join(w) for w in self.words]
        self.size = np.array([len(t) for t in self.texts], np.int32)
        self.spaces = np.array([max(len(w) - 1, 0) for w in self.words], np.int32)
        self.counts = np.zeros((BUCKETS, len(names)), np.int16)
        for i, t in enumerate(self.texts):
            for c in t:
                if c != " ":
                    self.counts[ord(c) % BUCKETS, i] += 1

    def postings(self) -> dict[str, np.ndarray]:
        held: dict[str, list[int]] = {}
        for i, words_ in enumerate(self.words):
            for w in words_:
                held.setdefault(w, []).append(i)
        return {w: np.array(at) for w, at in held.items()}


def _round4(values: np.ndarray) -> np.ndarray:
    return np.rint(values * 10_000) / 10_000


def _common_of_pairs(own: list[str], theirs: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common subsequence of own[a] (at most LETTERS long) and theirs[b], all pairs stepped together."""
    code = {c: i + 1 for i, c in enumerate(sorted(set("".join(own))))}
    masks = np.zeros((len(own), len(code) + 1), np.uint64)
    for i, text in enumerate(own):
        for at, c in enumerate(text):
            masks[i, code[c]] |= np.uint64(1 << at)
    longest = max(map(len, theirs), default=0)
    coded = np.zeros((len(theirs), longest), np.int32)
    for i, text in enumerate(theirs):
        coded[i, : len(text)] = [code.get(c, 0) for c in text]
    full = np.array([(1 << len(t)) - 1 for t in own], np.uint64)[a]
    row = full.copy()
    for at in range(longest):
        hit = row & masks[a, coded[b, at]]
        row = ((row + hit) | (row - hit)) & full
    return np.array([len(t) for t in own])[a] - np.bitwise_count(row).astype(np.int64)


def nearest_of(asked: list[str], listed: list[str], order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, place) of the most similar of ``listed`` for each of ``asked``: of equally similar ones that of least ``order``;
    place is -1 where nothing is alike.

    Every pair has an upper bound of its score from letter counts and shared words; only pairs whose bound reaches the best
    score found so far are scored, those of highest bound first.
    """
    theirs = Names(listed)
    postings = theirs.postings()
    score, place = np.zeros(len(asked)), np.full(len(asked), -1)
    if not listed:
        return score, place
    step = max(1, CHUNK // len(listed))
    for at in range(0, len(asked), step):
        own = Names(asked[at : at + step])
        shape = (len(own.names), len(listed))
        shared = np.zeros(shape, np.int32)  # letters of shared words, each with one more for its space
        number = np.zeros(shape, np.int16)
        for i, words_ in enumerate(own.words):
            for w in words_:
                if w in postings:
                    shared[i, postings[w]] += len(w) + 1
                    number[i, postings[w]] += 1
        alike = np.zeros(shape, np.int32)
        for k in range(BUCKETS):
            if own.counts[k].any() and theirs.counts[k].any():
                alike += np.minimum(own.counts[k][:, None], theirs.counts[k][None, :])
        x, y = own.size[:, None] - shared, theirs.size[None, :] - shared  # with shared words: what is left of either side
        whole = (x < 0) | (y < 0)
        left_a, left_b = np.maximum(x, 0), np.maximum(y, 0)
        spaces = np.minimum(np.maximum(own.spaces[:, None] - number, 0), np.maximum(theirs.spaces[None, :] - number, 0))
        most = np.minimum(alike - (shared - number) + spaces, np.minimum(left_a, left_b))
        s, gap = np.maximum(shared - 1, 0), (shared > 0).astype(np.int32)
        total = 2 * s + 2 * gap + left_a + left_b
        with np.errstate(invalid="ignore", divide="ignore"):
            bound = np.where(total > 0, 1 - (left_a + left_b - 2 * most) / total, 0.0)
            sides = np.maximum(1 - (1 + left_a) / (2 * s + 1 + left_a), 1 - (1 + left_b) / (2 * s + 1 + left_b))
        some = shared > 0
        sure = np.where(some, np.where(whole, 1.0, sides), 0.0)  # reached in any case
        bound = _round4(np.where(some, np.where(whole, 1.0, np.maximum(bound, sides)), bound) + 1e-9)
        empty = (own.size == 0)[:, None] | (theirs.size == 0)[None, :]
        bound[empty], sure[empty] = 0.0, 0.0
        best = np.maximum(_round4(sure).max(axis=1), 1e-9)
        exact = np.full(shape, -1.0)
        top = bound.argmax(axis=1)
        rows = np.arange(shape[0])
        for a, b in ((rows, top), (None, None)):
            if a is None:
                a, b = np.nonzero((bound >= best[:, None]) & (exact < 0))
            else:
                a, b = (v[bound[rows, top] > 0] for v in (a, b))
            if not len(a):
                continue
            plain = ~some[a, b] & (own.size[a] <= LETTERS)
            value = np.zeros(len(a))
            if plain.any():
                pa_, pb_ = a[plain], b[plain]
                both = own.size[pa_] + theirs.size[pb_]
                common = _common_of_pairs([t[:LETTERS] for t in own.texts], theirs.texts, pa_, pb_)
                value[plain] = 1 - (both - 2 * common) / both
            value = _round4(value)
            for i in np.flatnonzero(~plain).tolist():
                value[i] = 1.0 if whole[a[i], b[i]] and some[a[i], b[i]] else token_set_score(own.names[a[i]], listed[b[i]])
            exact[a, b] = value
            np.maximum.at(best, a, value)
        for i in rows.tolist():
            high = exact[i].max()
            if high > 0:
                tied = np.flatnonzero(exact[i] == high)
                score[at + i], place[at + i] = high, tied[order[tied].argmin()]
    return score, place


class Nearest:
    """The most similar of a list of normalised names, the first of equally similar ones."""

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def find(self, name: str, score: float = 0.0) -> tuple[float, int | None]:
        """(score, place) of the nearest name above ``score``, or (score, None)."""
        found, place = nearest_of([name], self.names, np.arange(len(self.names)))
        return (float(found[0]), int(place[0])) if found[0] > score else (score, None)


@lru_cache(maxsize=1 << 18)
def token_set_score(a: str, b: str) -> float:
    """Similarity in [0, 1] of two normalised labels, rounded to 4 digits; 0 where one has no words.

    Words are compared as sets: 1 where one set holds the other, else the best of how alike the words not shared are
    (by longest common subsequence, each side preceded by the shared words) and how much of either side is shared.
    """
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = " ".join(sorted(left & right))
    x, y = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and (not x or not y):
        return 1.0
    gap = 1 if shared else 0
    size_x, size_y = len(shared) + gap + len(x), len(shared) + gap + len(y)
    scores = [1 - (len(x) + len(y) - 2 * _common(x, y)) / (size_x + size_y)]
    if shared:
        scores += [1 - (gap + len(x)) / (len(shared) + size_x), 1 - (gap + len(y)) / (len(shared) + size_y)]
    return round(max(scores), 4)


def similarity(left: Column, right: Column) -> Column:
    """:func:`token_set_score` of two label columns, null where either is null; each distinct pair is scored once."""

    @F.arrow_udf("double")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [
            None if x is None or y is None else token_set_score(_plain(x), _plain(y))
            for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)
        ]
        return pa.array(out, pa.float64())

    return run(left, right)


@lru_cache(maxsize=1 << 18)
def _plain(label: str) -> str:
    return normalise_label_text(label)


def words(normalised: Column) -> Column:
    return F.array_distinct(F.filter(F.split(normalised, " "), lambda w: w != ""))


def is_token_subset(left: Column, right: Column) -> Column:
    """Whether the words of one normalised label are properly contained in those of the other; false where one has none."""
    a, b = words(left), words(right)
    only_a, only_b = F.size(F.array_except(a, b)), F.size(F.array_except(b, a))
    return (F.size(a) > 0) & (F.size(b) > 0) & ((only_a == 0) != (only_b == 0))
