"""Overlapping and gapped intervals: continuous periods per entity and the gaps between them.

Intervals come in any order. Each task keeps, per entity, an ordered map of disjoint intervals and of the gaps between
them: an insertion finds the overlapped ones by binary search, merges them and updates the gaps beside them. Rows are
range-partitioned by (entity, start), never sorted, so an entity may span any number of tasks; a prefix scan over the
tasks hands each of them the period that the first entity of its range has open already, which is one more insertion.
Periods and gaps are read out of the maps.

Both bounds belong to an interval: two intervals hang together if they share an instant, and start = end is one.
Defined results: intervals with a null bound or entity, or ending before they start, do not count; repeated ones
change nothing; an empty table gives no periods.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.ordered import scan
from timeloom.session import in_partitions, shuffle_partitions


class DisjointIntervals:
    """Ordered disjoint closed intervals of one entity and the gaps between them.

    Intervals lie in chunks of bounded length, so an insertion moves few of them however many there are. ``gap_after`` has,
    for the end of every interval but the last, the start of the next.
    """

    __slots__ = ("_starts", "_ends", "bottoms", "tops", "gap_after", "size")

    def __init__(self, size: int = 512) -> None:
        self.size = size
        self._starts: list[list[int]] = []
        self._ends: list[list[int]] = []
        self.bottoms: list[int] = []  # first start and last end of each chunk
        self.tops: list[int] = []
        self.gap_after: dict[int, int] = {}

    def insert(self, start: int, end: int) -> tuple[int, int, list[tuple[int, int]]]:
        """The interval that [start, end] is part of now, and those it has swallowed."""
        i = bisect_left(self.tops, start)  # the first chunk that reaches to the start
        j = bisect_right(self.bottoms, end) - 1  # the last that begins by the end
        if i == len(self.tops):  # behind all
            before = self.tops[-1] if self.tops else None
            if not self._starts or len(self._starts[-1]) >= self.size:
                self._starts.append([]), self._ends.append([]), self.bottoms.append(start), self.tops.append(end)
            self._starts[-1].append(start), self._ends[-1].append(end)
            self.tops[-1] = end
            if before is not None:
                self.gap_after[before] = start
            return start, end, []
        low = bisect_left(self._ends[i], start)
        high = bisect_right(self._starts[j], end) if j >= i else 0
        before = self._ends[i][low - 1] if low else self.tops[i - 1] if i else None
        if j < i or (i == j and high <= low):  # overlaps nothing
            swallowed: list[tuple[int, int]] = []
            after = self._starts[i][low]
            self._starts[i].insert(low, start), self._ends[i].insert(low, end)
            last = i
        else:
            after = self._starts[j][high] if high < len(self._starts[j]) else self.bottoms[j + 1] if j + 1 < len(self.bottoms) else None
            if i == j:
                swallowed = list(zip(self._starts[i][low:high], self._ends[i][low:high], strict=True))
            else:
                swallowed = list(zip(self._starts[i][low:], self._ends[i][low:], strict=True))
                for k in range(i + 1, j):
                    swallowed += zip(self._starts[k], self._ends[k], strict=True)
                swallowed += zip(self._starts[j][:high], self._ends[j][:high], strict=True)
            start, end = min(start, swallowed[0][0]), max(end, swallowed[-1][1])
            if i == j:
                self._starts[i][low:high], self._ends[i][low:high] = [start], [end]
            else:
                rest_starts, rest_ends = self._starts[j][high:], self._ends[j][high:]
                self._starts[i][low:], self._ends[i][low:] = [start, *rest_starts], [end, *rest_ends]
            for _, gone in swallowed:
                self.gap_after.pop(gone, None)
            last = j
        if last > i:
            for held in (self._starts, self._ends, self.bottoms, self.tops):
                del held[i + 1 : last + 1]
        self.bottoms[i], self.tops[i] = self._starts[i][0], self._ends[i][-1]
        if len(self._starts[i]) > 2 * self.size:
            for held in (self._starts, self._ends):
                held[i : i + 1] = [held[i][: self.size], held[i][self.size :]]
            self.bottoms[i : i + 1] = [self._starts[i][0], self._starts[i + 1][0]]
            self.tops[i : i + 1] = [self._ends[i][-1], self._ends[i + 1][-1]]
        if before is not None:
            self.gap_after[before] = start
        if after is not None:
            self.gap_after[end] = after
        return start, end, swallowed

    @property
    def starts(self) -> list[int]:
        return [s for chunk in self._starts for s in chunk]

    @property
    def ends(self) -> list[int]:
        return [e for chunk in self._ends for e in chunk]

    def periods(self) -> list[tuple[int, int]]:
        return list(zip(self.starts, self.ends, strict=True))

    def chunks(self) -> Iterator[tuple[list[int], list[int]]]:
        return zip(self._starts, self._ends, strict=True)

    def gaps(self) -> list[tuple[int, int]]:
        return sorted(self.gap_after.items())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity, start, end) in any order -> the disjoint intervals of each entity in this task, in order."""
    maps: dict[str, DisjointIntervals] = {}
    for name, start, end in _rows(batches):
        held = maps.get(name)
        if held is None:
            held = maps[name] = DisjointIntervals()
        held.insert(start, end)
    for name in sorted(maps):
        held = maps.pop(name)
        for starts, ends in held.chunks():
            yield pa.record_batch({"entity": pa.array([name] * len(starts), pa.string()), "start": pa.array(starts, pa.int64()), "end": pa.array(ends, pa.int64())})


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int]]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _summary(batches: Iterator[pa.RecordBatch]):
    """Of the last entity: (entity, furthest end, start of its last period here, whether it is the only one here)."""
    entity, reach, head, only = None, 0, 0, True
    for name, start, end in _rows(batches):
        only = entity in (None, name) and only
        entity, head, reach = name, start, end
    return None if entity is None else (entity, reach, head, only)


def _combine(a, b):
    """The period that is open after both; an earlier one may reach over all that begins later."""
    if not b[3] or a[0] != b[0]:
        return (*b[:3], False)
    return (b[0], max(a[1], b[1]), b[2] if b[2] > a[1] else a[2], a[3])


def periods_and_gaps(intervals: DataFrame, entity: str, start: str, end: str, max_gap: int | None = None) -> DataFrame:
    """(entity, kind, start, end): kind ``period`` for each maximal set of intervals that hang together, kind ``gap``
    from a period to the next of its entity where that is at most ``max_gap`` long."""

    def read_out(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        name_at, held = None, DisjointIntervals()

        def found() -> Iterator[pa.RecordBatch]:
            rows = [(name_at, "period", *p) for p in held.periods()] + [(name_at, "gap", *g) for g in held.gaps() if max_gap is None or g[1] - g[0] <= max_gap]
            for at in range(0, len(rows), 50_000):
                yield _batch(rows[at : at + 50_000])

        for name, low, high in _rows(batches):
            if name != name_at:
                yield from found()
                name_at, held = name, DisjointIntervals()
                if carry and carry[0] == name:
                    held.insert(carry[2], carry[1])
            held.insert(low, high)
        yield from found()

    valid = intervals.selectExpr(f"cast({entity} as string) as entity", f"cast({start} as bigint) as start", f"cast({end} as bigint) as end")
    valid = valid.filter("entity is not null and start <= end")
    local = valid.repartitionByRange(shuffle_partitions(valid.sparkSession), "entity", "start")
    sets = in_partitions(local.mapInArrow(_sets, "entity string, start bigint, end bigint"))
    pieces = scan(sets, _summary, _combine, read_out, "entity string, kind string, start bigint, end bigint")
    whole = pieces.groupBy("entity", "kind", "start").agg(F.max("end").alias("end"))  # a period that tasks share ends where its last task says
    return whole.selectExpr(f"entity as {entity}", "kind", f"start as {start}", f"end as {end}")


def _batch(rows: list[tuple[str, str, int, int]]) -> pa.RecordBatch:
    names = ("entity", "kind", "start", "end")
    types = (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))
