"""Ordered scans over globally sorted data, without one task per entity.

A window function partitioned by entity gives the whole of a hot entity to one task. Here rows are
range-partitioned by (entity, order), so that a hot entity spans as many tasks as its rows need. Each task
reduces its rows to one summary of constant size; the summaries (one per task, so their number is the number
of partitions and not of rows) are combined by a prefix scan into what each task has to know of the rows
before it; then each task scans its own rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.session import in_partitions, shuffle_partitions


def range_sorted(df: DataFrame, *order: str | Column, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, materialised so that later jobs see the same partitions."""
    n = partitions or shuffle_partitions(df.sparkSession)
    return in_partitions(df.repartitionByRange(n, *order).sortWithinPartitions(*order))


def prefix_scan(items: list[Any], combine: Callable[[Any, Any], Any]) -> list[Any]:
    """Inclusive scan of ``items`` in log2(n) doubling rounds; ``combine`` must be associative."""
    out, step = list(items), 1
    while step < len(out):
        out = out[:step] + [combine(out[i - step], out[i]) for i in range(step, len(out))]
        step *= 2
    return out


def scan(
    df: DataFrame,
    summarise: Callable[[Iterator[pa.RecordBatch]], Any],
    combine: Callable[[Any, Any], Any],
    apply: Callable[[Iterator[pa.RecordBatch], Any, int], Iterable[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Run ``apply(batches, carry, partition)`` on each partition of ``df`` (a result of :func:`range_sorted`).

    ``carry`` is the combination of the summaries of all non-empty partitions before, or None for the first.
    ``summarise`` must return None for a partition without rows and something of constant size otherwise.
    """

    def edge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = summarise(batches)
        if said is not None:
            at = TaskContext.get().partitionId()
            yield pa.record_batch({"pid": pa.array([at], pa.int32()), "said": pa.array([pickle.dumps(said)], pa.binary())})

    edges = sorted((r.pid, r.said) for r in df.mapInArrow(edge, "pid int, said binary").collect())
    scanned = prefix_scan([pickle.loads(bytes(x)) for _, x in edges], combine)
    carries = {edges[i + 1][0]: pickle.dumps(scanned[i]) for i in range(len(edges) - 1)}
    shared = df.sparkSession.sparkContext.broadcast(carries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        carry = shared.value.get(at)
        yield from apply(batches, None if carry is None else pickle.loads(carry), at)

    return df.mapInArrow(run, schema)


def heavy_keys(counted: DataFrame, n: str, total: int, parts: int = 512) -> DataFrame:
    """Rows of ``counted`` (one per key, with count ``n``) that hold at least ``total / parts`` rows: at most ``parts``."""
    return counted.filter(F.col(n) * parts >= F.lit(max(total, 1)))


def join_unique(rows: DataFrame, unique: DataFrame, key: str, n: str, total: int, parts: int = 512) -> DataFrame:
    """Inner join of ``rows`` with ``unique`` (one row per ``key``, ``n`` of its rows in ``rows``), safe against hot keys.

    Keys holding at least ``total / parts`` of the rows are at most ``parts`` in number, so their side is broadcast
    and their rows are not shuffled; all other keys are shuffled, none of them large.
    """
    hot = heavy_keys(unique, n, total, parts)
    keys = F.broadcast(hot.select(F.col(key).alias("_hot")))
    cold_rows = rows.join(keys, rows[key] == F.col("_hot"), "left_anti")
    cold = unique.filter(F.col(n) * parts < F.lit(max(total, 1)))
    return rows.join(F.broadcast(hot), key).unionByName(cold_rows.join(cold, key))
