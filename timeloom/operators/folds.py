"""Folds over the ordered rows of a key, streamed: state of constant size, rows never gathered.

The next state of a fold depends on its own decisions, yet a key need not be one task's work (:func:`ordered_fold`). Rows are
range-partitioned by (key, order); every partition is folded as if its key began there, and only its last state is told
(constant size). Where a key goes on from the partition before, the fold is run again from the true state, only until
it agrees with the one supposed: after a few rows the two decide alike, and so does all that follows. States are settled
along the partitions, those still supposed in a further round, until none is; then every partition is folded once more,
for its rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from timeloom.operators.ordered import range_sorted


def _emitter(schema: str) -> Callable[[list[tuple]], pa.RecordBatch]:
    target = to_arrow_schema(StructType.fromDDL(schema))

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [f.type for f in target], strict=True)], names=target.names)

    return emit


def keyed_fold(df: DataFrame, key: str, order: list[str], columns: list[str], begin: Callable[[], Any], step: Callable[..., list[tuple]], finish: Callable[[Any], list[tuple]], schema: str) -> DataFrame:
    """For each key: ``state = begin()``, then ``rows = step(state, *columns)`` for each row in order, at last ``finish(state)``.

    ``step`` changes the state in place and returns finished output rows, key first. For states that cannot be compared or
    sent (images): a key is one task, through which its rows stream.
    """
    emit = _emitter(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or row[0] != at:
                    if state is not None:
                        out += finish(state)
                    at, state = row[0], begin()
                out += step(state, *row)
                if len(out) >= 10_000:
                    yield emit(out)
                    out = []
        if state is not None:
            out += finish(state)
        if out:
            yield emit(out)

    sorted_rows = df.select(*dict.fromkeys((key, *order, *columns))).repartition(key).sortWithinPartitions(key, *order)
    return sorted_rows.select(key, *columns).mapInArrow(run, schema)


State = tuple  # of a fold: (count, what else it knows); immutable, small, and comparable but for the count
NONE = object()


def ordered_fold(
    rows: DataFrame, begin: State, step: Callable[..., tuple[State, list[tuple]]], finish: Callable[[Any, State], list[tuple]], schema: str,
    box: Callable[[Iterator[tuple]], Any] | None = None, passes: Callable[[Any, State], bool] | None = None,
) -> DataFrame:
    """For each key (first column of ``rows``): ``state, out = step(state, *row)`` for each of its rows in order, then ``finish``.

    ``rows``: partitioned by range and sorted by key and order, and the same whenever read (see :func:`range_sorted`). A state
    is ``(count, core)``: what a step does depends on the core only, and it may add to the count. ``box`` may sum up the rows
    of a partition in constant size; ``passes(box, core)`` then tells that no row of it can change this core.
    """
    emit = _emitter(schema)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def said(value: Any) -> pa.RecordBatch:
        return pa.record_batch({"pid": pa.array([TaskContext.get().partitionId()], pa.int32()), "said": pa.array([pickle.dumps(value)], pa.binary())})

    def suppose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(first key, last key, last state as if the first key began here, box of the rows of its only key)."""
        first, key, state = NONE, NONE, begin
        for row in told(batches):
            if row[0] != key:
                first, key, state = row[0] if first is NONE else first, row[0], begin
            state, _ = step(state, *row)
        if first is not NONE:
            yield said((first, key, state))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed = box(told(batches))
        if summed is not None:
            yield said(summed)

    def collect(df: DataFrame) -> dict[int, Any]:
        return {r.pid: pickle.loads(bytes(r.said)) for r in df.collect()}  # constant size for each partition

    supposed = collect(rows.mapInArrow(suppose, "pid int, said binary"))
    order = sorted(supposed)
    shared = [p for q, p in zip(order[:-1], order[1:], strict=True) if supposed[q][1] == supposed[p][0]]  # go on with the key of the one before
    boxes = collect(rows.mapInArrow(look, "pid int, said binary")) if box and any(supposed[p][0] == supposed[p][1] for p in shared) else {}
    known: dict[tuple[int, Any], tuple[Any, int]] = {}  # (partition, core that enters) -> (core that leaves, what is counted)
    while True:
        entering, open_, leaving = {}, {}, begin
        for q, p in zip([None, *order], order, strict=False):
            goes_on = q is not None and supposed[q][1] == supposed[p][0]
            state = entering[p] = leaving if goes_on else begin
            if not goes_on or supposed[p][0] != supposed[p][1]:
                leaving = supposed[p][2]
            elif p in boxes and passes(boxes[p], state[1]):
                leaving = state
            elif (p, state[1]) in known:
                core, count = known[p, state[1]]
                leaving = (state[0] + count, core)
            else:
                open_[p] = state[1]
                leaving = supposed[p][2]
        if not open_:
            break
        asked = rows.sparkSession.sparkContext.broadcast(open_)

        def settle(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            core = asked.value.get(TaskContext.get().partitionId(), NONE)
            if core is NONE:
                return
            true, guess = (0, core), begin
            for row in told(batches):
                true, guess = step(true, *row)[0], step(guess, *row)[0]
                if true[1] == guess[1]:
                    yield said((None, true[0] - guess[0]))
                    return
            yield said((true[1], true[0]))

        for p, (core, count) in collect(rows.mapInArrow(settle, "pid int, said binary")).items():
            last = supposed[p][2]
            known[p, open_[p]] = (last[1], last[0] + count) if core is None else (core, count)
    ends = set(order) - {q for q, p in zip(order[:-1], order[1:], strict=True) if supposed[q][1] == supposed[p][0]}
    given = rows.sparkSession.sparkContext.broadcast((entering, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        state, key, out = given.value[0].get(at, begin), NONE, []
        for row in told(batches):
            if row[0] != key:
                if key is not NONE:
                    out += finish(key, state)
                    state = begin
                key = row[0]
            state, made = step(state, *row)
            out += made
            if len(out) >= 10_000:
                yield emit(out)
                out = []
        if key is not NONE and at in given.value[1]:
            out += finish(key, state)
        if out:
            yield emit(out)

    return rows.mapInArrow(run, schema)


def _sorted(df: DataFrame, key: str, order: list[str], columns: list[str], in_order: bool) -> DataFrame:
    """(key, columns) by range of key and order; ``in_order``: ``df`` is so already, as often as it is read."""
    wanted = df.select(*dict.fromkeys((key, *order, *columns)))
    return (wanted if in_order else range_sorted(wanted, key, *order)).select(key, *columns)


def last_kept(
    df: DataFrame, key: str, order: list[str], idx: str, band: str, full: str, threshold: float, weight: float, min_gap: int, row_id: str, in_order: bool = False
) -> DataFrame:
    """Keep a row where it differs enough from the last *kept* one, and far enough from it in index.

    (key, row_id, idx, distance, kept, suppressed, segment): the first comparable row is kept with a null distance; a row
    with a null measure is not comparable, but counts in ``idx``; ``suppressed`` rows differ enough but come too early;
    ``segment`` numbers the kept rows (from 0), each with the rows up to the next one. ``in_order``: the rows are sorted by
    ranges of key and order already, and the same whenever read.
    """

    def step(state: State, k, i, b, f, r) -> tuple[State, list[tuple]]:
        if b is None or f is None:
            return state, []
        count, last = state
        if last is None:
            return (1, (i, b, f)), [(k, r, i, None, True, False, 0)]
        score = round(abs(b - last[1]) + weight * abs(f - last[2]), 4)
        if score <= threshold:
            return state, [(k, r, i, score, False, False, count - 1)]
        if i - last[0] < min_gap:
            return state, [(k, r, i, score, False, True, count - 1)]
        return (count + 1, (i, b, f)), [(k, r, i, score, True, False, count)]

    def box(rows: Iterator[tuple]):
        """Bounds of band + weight x full and band - weight x full: the farthest row from any point is at one of them."""
        bounds = None
        for _, _, b, f, _ in rows:
            if b is not None and f is not None:
                u, v = b + weight * f, b - weight * f
                bounds = (u, u, v, v) if bounds is None else (min(bounds[0], u), max(bounds[1], u), min(bounds[2], v), max(bounds[3], v))
        return bounds

    def passes(bounds, last) -> bool:
        if last is None:
            return False
        u, v = last[1] + weight * last[2], last[1] - weight * last[2]
        return max(bounds[1] - u, u - bounds[0], bounds[3] - v, v - bounds[2]) <= threshold - 0.001  # surely, whatever the rounding

    kind = lambda c: df.schema[c].dataType.simpleString()
    return ordered_fold(
        _sorted(df, key, order, [idx, band, full, row_id], in_order), (0, None), step, lambda k, state: [],
        f"{key} {kind(key)}, {row_id} {kind(row_id)}, {idx} {kind(idx)}, distance double, kept boolean, suppressed boolean, segment bigint", box, passes,
    )


def segments(folded: DataFrame, key: str, idx: str, row_id: str) -> DataFrame:
    """(key, segment, first_idx, last_idx, n, representative, members) of a result of :func:`last_kept`: one row for each kept
    row with those up to the next; ``members`` are their ids in order, joined by commas.

    A task joins the ids of its own rows of a segment; only these pieces meet, one for each task that a segment spans.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list | None = None

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = [[r[i] for r in rows] for i in range(6)]
            kinds = (kind_key, pa.int64(), pa.int64(), pa.int64(), pa.int64(), kind_id)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.record_batch([*arrays, pa.array([",".join(r[6]) for r in rows], pa.string())], names=["k", "segment", "first_idx", "last_idx", "n", "representative", "members"])

        out: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, segment = batch.column(0), batch.column(1).to_numpy()
            coded = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            edges = np.r_[0, np.flatnonzero((coded[1:] != coded[:-1]) | (segment[1:] != segment[:-1])) + 1, batch.num_rows].tolist()
            places, ids = batch.column(2).to_pylist(), batch.column(3)
            texts = ids.cast(pa.string()).to_pylist()
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                k, at = keys[low].as_py(), int(segment[low])
                if held and held[0] == k and held[1] == at:
                    held[3], held[4] = places[high - 1], held[4] + high - low
                    held[6] += texts[low:high]
                else:
                    if held:
                        out.append(held)
                    held = [k, at, places[low], places[high - 1], high - low, ids[low].as_py(), texts[low:high]]
            if len(out) > 5_000:
                yield batch_of(out)
                out = []
        if held:
            out.append(held)
        if out:
            yield batch_of(out)

    kinds = to_arrow_schema(StructType([folded.schema[key], folded.schema[row_id]]))
    kind_key, kind_id = (f.type for f in kinds)
    types = [folded.schema[c].dataType.simpleString() for c in (key, row_id)]
    local = folded.select(key, "segment", F.col(idx).cast("bigint"), row_id).mapInArrow(
        pieces, f"k {types[0]}, segment bigint, first_idx bigint, last_idx bigint, n bigint, representative {types[1]}, members string"
    )
    parts = F.array_sort(F.collect_list(F.struct("first_idx", "members")))  # as many as tasks that share the segment
    whole = local.groupBy(F.col("k").alias(key), "segment").agg(
        F.min("first_idx").alias("first_idx"), F.max("last_idx").alias("last_idx"), F.sum("n").alias("n"), F.min_by("representative", "first_idx").alias("representative"), parts.alias("p")
    )
    return whole.withColumn("members", F.array_join(F.transform("p", lambda p: p["members"]), ",")).drop("p")


def reanchored(df: DataFrame, key: str, order: list[str], row_id: str, x: str, y: str, confidence: str, manual: str, diagonal: float, max_jump: float, min_confidence: float, after: int, in_order: bool = False) -> DataFrame:
    """Positions accepted along a track that cannot jump, but can be re-aimed.

    A manual position is taken as it is. A weak or missing one is dropped. One too far from the last accepted is held
    back; when ``after`` of them in a row stay together, the track has moved there and all of them are taken. As soon as two
    in a row are apart they are dropped, and so is what follows up to the next position that is near or by hand.
    (key, row_id, method, x, y) with method ``manual``, ``auto``, ``reanchor``, ``jump`` (held back and dropped), ``weak``.
    """
    budget, enough = max_jump * diagonal, max(after, 2)

    def near(a: tuple, b: tuple) -> bool:
        return diagonal <= 0 or math.hypot(a[0] - b[0], a[1] - b[1]) <= budget

    def dropped(held: tuple) -> list[tuple]:
        return [(k, r, "jump", None, None) for k, r, _, _ in held]

    def step(state: State, k, r, px, py, sure, by_hand) -> tuple[State, list[tuple]]:
        last, held, scattered = state[1]  # at most ``enough`` - 1 rows are held
        if by_hand:
            return (0, ((px, py), (), False)), [*dropped(held), (k, r, "manual", px, py)]
        if px is None or py is None or sure is None or sure < min_confidence:
            return (0, (last, (), False)), [*dropped(held), (k, r, "weak", None, None)]
        if last is None or near(last, (px, py)):
            return (0, ((px, py), (), False)), [*dropped(held), (k, r, "auto", px, py)]
        if scattered or (held and not near(held[-1][2:], (px, py))):
            return (0, (last, (), True)), [*dropped(held), (k, r, "jump", None, None)]
        held = (*held, (k, r, px, py))
        if len(held) >= enough:
            return (0, ((px, py), (), False)), [(*h[:2], "reanchor", *h[2:]) for h in held]
        return (0, (last, held, False)), []

    kind = lambda c: df.schema[c].dataType.simpleString()
    return ordered_fold(
        _sorted(df, key, order, [row_id, x, y, confidence, manual], in_order), (0, (None, (), False)), step, lambda k, state: dropped(state[1][1]),
        f"{key} {kind(key)}, {row_id} {kind(row_id)}, method string, x double, y double",
    )
