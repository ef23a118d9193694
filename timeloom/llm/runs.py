"""Runs of identical or near-identical consecutive events, found by pointer doubling.

Events are put in a global order by (entity, time, id) over range partitions; a scan links every event that repeats
the one before it to that predecessor, also across partitions. The links are pointers; in each round a self-join
replaces every pointer by its target's pointer, so after a number of rounds logarithmic in the longest run every event
points to the start of its run. Each round is written to the checkpoint folder, and pointers that have arrived take
no part in later rounds except as targets.

Defined results: events with a null entity, id or start time have no place in the order and are left out; a null end
is the start; repeated deliveries of an event count once (the earliest received, then the smallest); an event without
a readable name is in no run and ends one; equal start times are ordered by id; an empty table gives no runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.names import same_heading
from timeloom.operators.ordered import range_sorted, scan
from timeloom.session import materialise

MAX_PAUSE_MS = 10_000
LINK = "gid bigint, ptr bigint, entity string, id string, t_start bigint, t_end bigint, first_id string, first_start bigint, first_end bigint"


def delivered_once(screens: DataFrame) -> DataFrame:
    """(entity, id, t_start, t_end, name, section): each screen once, the delivery received first."""
    rows = screens.filter("slug is not null and id is not null and t_ms_start is not null").select(
        F.col("slug").alias("entity"), "id",
        F.struct(
            F.col("received_at").isNull().alias("late"), "received_at", F.col("t_ms_start").alias("t_start"),
            F.coalesce("t_ms_end", "t_ms_start").alias("t_end"), F.col("identity.name").alias("name"),
            F.col("identity.section").alias("section"),
        ).alias("d"),
    )
    return rows.groupBy("entity", "id").agg(F.min("d").alias("d")).select("entity", "id", "d.t_start", "d.t_end", "d.name", "d.section")


def links(events: DataFrame, max_pause: int = MAX_PAUSE_MS) -> DataFrame:
    """One row per event that repeats its predecessor: its number, the predecessor's, and both events' bounds."""
    ordered = range_sorted(events.select("entity", "t_start", "id", "t_end", "name", "section"), "entity", "t_start", "id")

    def summarise(batches: Iterator[pa.RecordBatch]):
        n, last = 0, None
        for batch in batches:
            if batch.num_rows:
                n, last = n + batch.num_rows, batch.slice(batch.num_rows - 1)
        if last is None:
            return None
        return (*(c[0].as_py() for c in last.columns), (TaskContext.get().partitionId() << 33) + n - 1)

    def apply(batches: Iterator[pa.RecordBatch], carry, pid: int) -> Iterator[pa.RecordBatch]:
        before, gid = carry, pid << 33
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                entity, start, key, end, name, section = row
                if (
                    before and before[0] == entity and before[5] == section and start <= before[3] + max_pause
                    and name and before[4] and same_heading(before[4], name)
                ):
                    found.append((gid, before[6], entity, key, start, end, before[2], before[1], before[3]))
                before = (*row, gid)
                gid += 1
            if found:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                names = [part.split()[0] for part in LINK.split(", ")]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    return scan(ordered, summarise, lambda a, b: b, apply, LINK)


def run_starts(pointers: DataFrame) -> DataFrame:
    """(gid, ptr) -> (gid, head): every pointer followed to the end of its chain, by doubling."""
    state = pointers.select("gid", "ptr", F.lit(False).alias("arrived"))
    while True:
        t = state.select(F.col("gid").alias("at"), F.col("ptr").alias("next"), F.col("arrived").alias("there"))
        moved = state.filter("not arrived").join(t, F.col("ptr") == F.col("at"), "left").select(
            "gid", F.coalesce("next", "ptr").alias("ptr"), F.coalesce("there", F.lit(True)).alias("arrived")
        )
        state = materialise(state.filter("arrived").unionByName(moved))
        if state.filter("not arrived").isEmpty():
            return state.select("gid", F.col("ptr").alias("head"))


def collapse(screens: DataFrame, max_pause: int = MAX_PAUSE_MS) -> tuple[DataFrame, DataFrame]:
    """(runs, members). runs: entity, first_id, last_id, screens, t_start, t_end of every run of two or more;
    members: (head, entity, id) of every event in a run."""
    linked = materialise(links(delivered_once(screens), max_pause))
    placed = linked.join(run_starts(linked.select("gid", "ptr")), "gid")
    runs = placed.groupBy("head").agg(
        F.min("entity").alias("entity"), F.min_by("first_id", "gid").alias("first_id"), F.max_by("id", "gid").alias("last_id"),
        (F.count("*") + 1).alias("screens"), F.min("first_start").alias("t_start"),
        F.greatest(F.max("t_end"), F.max("first_end")).alias("t_end"),
    )
    members = placed.select("head", "entity", "id").unionByName(runs.select("head", "entity", F.col("first_id").alias("id")))
    return runs, members


def collapsed_runs(screens: DataFrame, max_pause: int = MAX_PAUSE_MS) -> DataFrame:
    """One record per run with its number of screens, of different frames, and its duration."""
    runs, members = collapse(screens, max_pause)
    runs = materialise(runs)
    frames = screens.filter("slug is not null").select(F.col("slug").alias("entity"), "id", F.explode("frame_ids").alias("frame")).distinct()
    counted = members.join(frames, ["entity", "id"]).select("head", "frame").distinct().groupBy("head").agg(F.count("frame").alias("frames"))
    return runs.join(counted, "head", "left").select(
        F.col("entity").alias("slug"), F.col("first_id").alias("first_screen_id"), F.col("last_id").alias("last_screen_id"),
        "screens", F.coalesce("frames", F.lit(0)).alias("frames"), F.col("t_start").alias("t_ms_start"), F.col("t_end").alias("t_ms_end"),
        (F.col("t_end") - F.col("t_start")).alias("duration_ms"),
    )
