"""Holding a run against recorded truth: greedy one-to-one pairing in time, anti joins, gaps covered, fields compared."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.session import materialise

SLOT_MS = 60_000  # interval joins are equi-joins on slots of this length


def tolerance_ms(run_fps: float, fixture_fps: float | None = None, intervals: int = 2) -> int:
    """Two intervals of the coarser of the two rates; 2000 where there is no rate."""
    fps = min(run_fps, fixture_fps) if fixture_fps else run_fps
    return int(intervals * 1000 / fps) if fps > 0 else 2000


def tolerance_of(run_fps: Column, fixture_fps: Column, intervals: int = 2) -> Column:
    """:func:`tolerance_ms` of columns; a missing rate of the fixture is that of the run."""
    fps = F.least(run_fps.cast("double"), fixture_fps.cast("double"))  # nulls do not count
    return F.when(fps > 0, (F.lit(intervals * 1000.0) / fps).cast("bigint")).otherwise(2000)


def _slots(df: DataFrame, start: Column, end: Column) -> DataFrame:
    slot = lambda c: F.floor(c / SLOT_MS).cast("bigint")
    return df.withColumn("_slot", F.explode(F.sequence(slot(start), slot(end))))


def near_pairs(points: DataFrame, spans: DataFrame, tolerance: int) -> DataFrame:
    """All (key, entity, ord, id, span_ord, distance) of points (key, entity, ord, t) within ``tolerance`` of a span
    (entity, id, span_ord, t_start, t_end) of their entity, by an equi-join on entity and time slot."""
    left = points.filter("t is not null").withColumn("_slot", F.floor(F.col("t") / SLOT_MS).cast("bigint"))
    right = _slots(spans.filter("t_start <= t_end"), F.col("t_start") - tolerance, F.col("t_end") + tolerance)
    t, s, e = F.col("t"), F.col("t_start"), F.col("t_end")
    gap = F.when(t.between(s, e), 0).otherwise(F.least(F.abs(t - s), F.abs(t - e)))
    joined = left.join(right, ["entity", "_slot"]).filter(t.between(s - tolerance, e + tolerance))
    return joined.select("key", "entity", "ord", "id", "span_ord", gap.cast("bigint").alias("distance"))


REST = 200_000  # open pairs that one task settles; more are settled in rounds by all


def greedy_match(points: DataFrame, spans: DataFrame, tolerance: int, rest: int = REST) -> DataFrame:
    """(key, entity, id, distance): points in order of ``ord`` each claim the nearest span nobody claimed before (of equally
    near ones the first by span_ord).

    The claims of a serial order are the stable pairing in which every span prefers the earliest point, so they are found
    in rounds for all entities at once: each open point asks for its best remaining span; later points lose a span that an
    earlier one asks for; and a point that asks for a span which no earlier one could still want has it for good, so both
    are taken out. When few pairs are open, one task goes through them in their order.
    """
    open_, done = materialise(near_pairs(points, spans, tolerance)), []
    while open_.count() > rest:
        best = open_.groupBy("entity", "key").agg(F.min(F.struct("distance", "span_ord", "id")).alias("b")).select("entity", "key", F.col("b.id").alias("wanted"))
        rows = open_.join(best, ["entity", "key"])
        me = F.struct("ord", "key")
        claims = rows.groupBy("entity", "id").agg(F.min(F.when(F.col("id") == F.col("wanted"), me)).alias("holder"), F.min(me).alias("first"))
        told = rows.join(claims, ["entity", "id"])
        mine = (F.col("id") == F.col("wanted")) & (F.col("holder") == me) & (F.col("first") == me)
        told = materialise(told.withColumn("settled", F.coalesce(mine, F.lit(False))).withColumn("lost", F.coalesce(me > F.col("holder"), F.lit(False))))
        settled = told.filter("settled").select("key", "entity", "id", "distance")
        done.append(settled)
        left = told.filter("not settled and not lost").select(*open_.columns)
        open_ = materialise(left.join(settled.select("entity", "key"), ["entity", "key"], "left_anti"))
    kinds = ", ".join(f"{c} {open_.schema[c].dataType.simpleString()}" for c in ("key", "entity", "id", "distance"))
    out = open_.select("entity", "ord", "key", "distance", "span_ord", "id").coalesce(1).sortWithinPartitions("entity", "ord", "key", "distance", "span_ord", "id")
    out = out.mapInArrow(_in_turn, kinds)
    for settled in done:
        out = out.unionByName(settled)
    return out


def _in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each point, in the order of the rows, takes the first of its spans that is free."""
    at, taken, served = None, set(), None
    for batch in batches:
        found = []
        for place, (entity, key, span) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("entity", "key", "id")), strict=True)):
            if entity != at:
                at, taken, served = entity, set(), None
            if key != served and span not in taken:
                taken.add(span)
                served = key
                found.append(place)
        yield batch.take(pa.array(found, pa.int64())).select(["key", "entity", "id", "distance"])


def covered_gaps(gaps: DataFrame, spans: DataFrame, tolerance: int) -> DataFrame:
    """``gaps`` (key, entity, t_start, t_end) with covered: whether any span of the entity comes within ``tolerance``."""
    left = _slots(gaps.filter("t_start <= t_end"), F.col("t_start") - tolerance, F.col("t_end") + tolerance).select("key", "entity", "_slot", F.col("t_start").alias("gs"), F.col("t_end").alias("ge"))
    right = _slots(spans.filter("t_start <= t_end"), F.col("t_start"), F.col("t_end")).select("entity", "_slot", "t_start", "t_end")
    hit = left.join(right, ["entity", "_slot"]).filter((F.col("t_start") <= F.col("ge") + tolerance) & (F.col("t_end") >= F.col("gs") - tolerance)).select("key").distinct()
    return gaps.join(hit.withColumn("covered", F.lit(True)), "key", "left").withColumn("covered", F.coalesce("covered", F.lit(False)))


def field_differences(pairs: DataFrame, fields: dict[str, tuple[str, str, str]]) -> DataFrame:
    """``pairs`` (key, ...) compared field by field: (key, field, status, expected, actual) where an expected value that is
    neither null nor empty differs from the actual one. ``fields``: name -> (expected column, actual column, status)."""
    checks = [
        F.when((F.coalesce(F.col(e), F.lit("")) != "") & ~F.col(e).eqNullSafe(F.col(a)), F.struct(F.lit(n).alias("field"), F.lit(s).alias("status"), F.col(e).alias("expected"), F.col(a).alias("actual")))
        for n, (e, a, s) in fields.items()
    ]
    return pairs.select("key", F.explode(F.array_compact(F.array(*checks))).alias("d")).select("key", "d.*")
