"""Global row numbers without a global task: range partitions, and a prefix scan over their sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.ordered import range_sorted, scan


def numbered(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """``df`` with its position (from 0) in ``order``, which must be total for a repeatable result."""

    def summarise(batches: Iterator[pa.RecordBatch]):
        return sum(b.num_rows for b in batches) or None

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        at = carry or 0
        for batch in batches:
            places = pa.array(np.arange(at, at + batch.num_rows), pa.int64())
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, places], [*batch.schema.names, name])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return scan(range_sorted(df, *order), summarise, lambda a, b: a + b, apply, f"{kinds}, `{name}` bigint")


def _runs(batch: pa.RecordBatch) -> tuple[list, np.ndarray]:
    """Keys (first column) of a sorted batch, and where each begins and the batch ends."""
    coded = batch.column(0).dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    edges = np.r_[0, np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes)]
    return [batch.column(0)[int(e)].as_py() for e in edges[:-1]], edges


def numbered_within(df: DataFrame, key: str, *order: str, name: str = "idx") -> DataFrame:
    """``df`` with the place (from 0) of each row among those of its key; a key may span any number of tasks."""

    def summarise(batches: Iterator[pa.RecordBatch]):
        last, n, only, seen = None, 0, True, False
        for batch in batches:
            if batch.num_rows:
                keys, edges = _runs(batch)
                for k, size in zip(keys, np.diff(edges).tolist(), strict=True):
                    if seen and k == last:
                        n += size
                    else:
                        last, n, only, seen = k, size, not seen, True
        return (last, n, only) if seen else None

    def combine(a, b):
        return (b[0], a[1] + b[1], a[2]) if b[2] and a[0] == b[0] else (b[0], b[1], False)

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        last, n, seen = (*carry[:2], True) if carry else (None, 0, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, edges = _runs(batch)
            places = np.arange(batch.num_rows, dtype=np.int64) - np.repeat(edges[:-1], np.diff(edges))
            if seen and keys[0] == last:
                places[: edges[1]] += n
            last, n, seen = keys[-1], int(places[-1]) + 1, True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places)], [*batch.schema.names, name])

    rows = df.select(key, *(c for c in df.columns if c != key))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return scan(range_sorted(rows, key, *order), summarise, combine, apply, f"{kinds}, `{name}` bigint")


def with_previous(df: DataFrame, key: str, value: str, *order: str, name: str = "previous") -> DataFrame:
    """``df`` with the value of the row before among those of its key (null for the first); a key may span tasks."""

    def summarise(batches: Iterator[pa.RecordBatch]):
        last = None
        for batch in batches:
            if batch.num_rows:
                last = (batch.column(0)[-1].as_py(), batch.column(1)[-1].as_py())
        return last

    def apply(batches: Iterator[pa.RecordBatch], carry, _: int) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, edges = _runs(batch)
            same = carry is not None and carry[0] == keys[0]
            before = pa.concat_arrays([pa.array([carry[1] if same else None], batch.schema.field(1).type), batch.column(1).slice(0, batch.num_rows - 1)])
            places = np.arange(batch.num_rows)
            first = np.zeros(batch.num_rows, bool)
            first[edges[:-1]] = True
            first[0] = False  # its value is null unless the key goes on
            carry = (keys[-1], batch.column(1)[-1].as_py())
            yield pa.RecordBatch.from_arrays([*batch.columns, before.take(pa.array(places, mask=first))], [*batch.schema.names, name])

    rows = df.select(key, value, *(c for c in df.columns if c not in (key, value)))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return scan(range_sorted(rows, key, *order), summarise, lambda a, b: b, apply, f"{kinds}, `{name}` {df.schema[value].dataType.simpleString()}")


def chunked(df: DataFrame, size: int, *order: str) -> DataFrame:
    """``df`` with sheet (number of a chunk of ``size`` rows) and row (place in it)."""
    out = numbered(df, *order)
    return out.withColumn("sheet", F.floor(F.col("position") / size).cast("bigint")).withColumn("row", F.pmod("position", F.lit(size))).drop("position")
