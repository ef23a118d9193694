"""Pairing rows with the record nearest in time of the same entity, within a tolerance.

Both passes range-partition by (entity, time), scan locally and hand the edge of each partition to the following ones
through a prefix scan of constant-size summaries, so an entity may be larger than a task.

Pass 1 gives every record the first instant from which it is the nearest one. In order of (start, id) a record whose
end is not beyond all ends before it is never nearer than an earlier one and drops out. For the others, the record
before reaches to ``reach``; from the instant after ``reach`` (where they overlap or touch) or after the middle of the
gap on, the record is nearest. So these instants need nothing but the running maximum of the ends.

Pass 2 sorts instants and rows together; a row takes the last record before it, if it is near enough.

Defined results: distance is 0 inside a record (both bounds included), else to the nearer bound; of equally near ones
the smaller start, then the smaller id; null entities, ids or times pair with nothing; a record with one null bound is
an instant, with two null bounds it does not count; bounds in the wrong order are turned; repeated rows are paired
alike; empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.ordered import range_sorted, scan

ALWAYS = -(1 << 62)


def _latest(a, b):
    return b


def responsibilities(records: DataFrame) -> DataFrame:
    """(entity, since, id, t_start, t_end): from ``since`` on, until the next one of the entity, this record is nearest."""
    ordered = range_sorted(records, "entity", "t_start", "id")

    def reaches(batches: Iterator[pa.RecordBatch], entity, reach):
        """Each batch with the furthest end before each row (ALWAYS where there is none)."""
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = batch.column(0).dictionary_encode()
            code = codes.indices.to_numpy(zero_copy_only=False)
            end = batch.column(3).to_numpy(zero_copy_only=False)
            edges = np.r_[0, np.flatnonzero(code[1:] != code[:-1]) + 1, len(code)]
            before = np.empty(len(end), np.int64)
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                name = codes.dictionary[int(code[low])].as_py()
                start = reach if name == entity else ALWAYS
                upto = np.maximum.accumulate(np.r_[start, end[low:high]])
                before[low:high] = upto[:-1]
                entity, reach = name, int(upto[-1])
            yield batch, before, entity, reach

    def summarise(batches: Iterator[pa.RecordBatch]):
        first, last = None, None
        for batch, _, entity, reach in reaches(batches, None, ALWAYS):
            first = first if first is not None else batch.column(0)[0].as_py()
            last = (entity, reach)
        return None if last is None else (*last, first == last[0])

    def combine(a, b):
        return (b[0], max(a[1], b[1]), a[2]) if b[2] and a[0] == b[0] else (b[0], b[1], False)

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        for batch, before, _entity, _reach in reaches(batches, *(carry[:2] if carry else (None, ALWAYS))):
            start, end = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 3))
            gap = np.maximum(before, -(1 << 61))
            since = np.where(before == ALWAYS, ALWAYS, np.where(start <= before, before + 1, (gap + start) // 2 + 1))
            kept = pa.array(end > before)
            yield pa.record_batch([batch.column(0), pa.array(since), *(batch.column(i) for i in (2, 1, 3))], ["entity", "since", "id", "t_start", "t_end"]).filter(kept)

    return scan(ordered, summarise, combine, apply, "entity string, since bigint, id string, t_start bigint, t_end bigint")


def nearest(rows: DataFrame, records: DataFrame, tolerance: int) -> DataFrame:
    """(key, entity, id, distance) for every row (key, entity, t) that has a record (entity, id, t_start, t_end) near enough."""
    valid = records.selectExpr(
        "entity", "least(t_start, t_end) as t_start", "id", "greatest(t_start, t_end) as t_end"
    ).filter("entity is not null and id is not null and t_start is not null")
    owned = responsibilities(valid).selectExpr("entity", "since as at", "0 as kind", "id", "t_start", "t_end", "cast(null as bigint) as key")
    asked = rows.filter("entity is not null and t is not null and key is not null").selectExpr(
        "entity", "t as at", "1 as kind", "cast(null as string) as id", "cast(null as bigint) as t_start", "cast(null as bigint) as t_end", "key"
    )
    ordered = range_sorted(owned.unionByName(asked), "entity", "at", "kind", "t_start", "id", "key")

    def summarise(batches: Iterator[pa.RecordBatch]):
        last = None
        for batch in batches:
            at = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False) == 0)
            if len(at):
                last = tuple(batch.column(i)[int(at[-1])].as_py() for i in (0, 3, 4, 5))
        return last

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        held = carry  # the last record so far: (entity, id, t_start, t_end)
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                values = [[held[0]], [0], [0], [held[1]], [held[2]], [held[3]], [None]]
                head = pa.record_batch([pa.array(v, f.type) for v, f in zip(values, batch.schema, strict=True)], schema=batch.schema)
                table = pa.Table.from_batches([head, batch]).combine_chunks()
            else:
                table = pa.Table.from_batches([batch])
            kind = table.column("kind").to_numpy()
            place = np.maximum.accumulate(np.where(kind == 0, np.arange(len(kind)), -1))
            if place[-1] >= 0:
                held = tuple(table.column(c)[int(place[-1])].as_py() for c in ("entity", "id", "t_start", "t_end"))
            asking = np.flatnonzero((kind == 1) & (place >= 0))
            if not len(asking):
                continue
            wanted = table.select(["entity", "at", "key"]).take(pa.array(asking))
            given = table.select(["entity", "id", "t_start", "t_end"]).take(pa.array(place[asking]))
            t, low, high = wanted.column("at").to_numpy(), given.column("t_start").to_numpy(), given.column("t_end").to_numpy()
            distance = np.maximum(0, np.maximum(low - t, t - high))
            same = np.array(wanted.column("entity").to_numpy(zero_copy_only=False) == given.column("entity").to_numpy(zero_copy_only=False), bool)
            found = pa.table({"key": wanted.column("key"), "entity": wanted.column("entity"), "id": given.column("id"), "distance": pa.array(distance)})
            yield from found.filter(pa.array(same & (distance <= tolerance))).to_batches()

    return scan(ordered, summarise, _latest, apply, "key bigint, entity string, id string, distance bigint")
