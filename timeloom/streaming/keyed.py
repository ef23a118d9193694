"""Keyed state over streams: the last-kept fold and the interval map, by ``applyInPandasWithState``.

State per key is of constant size for the fold, and one row per open period for the interval map; nothing else of the
stream is kept. Input with a watermark lets both drop what can no longer change.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DateType, IntegralType, LongType, StringType, StructField, StructType

from timeloom.operators.intervals import DisjointIntervals
from timeloom.session import materialise


def last_kept_stream(stream: DataFrame, key: str, order: str, band: str, full: str, threshold: float, weight: float, min_gap: int) -> DataFrame:
    """Rows kept by the last-kept fold, as they come: (key, idx, order, distance). Rows of a key must arrive in order from
    batch to batch; within a batch they are sorted. ``idx`` counts all rows of the key."""
    kind = stream.schema[key].dataType.simpleString()

    def step(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        count, at, kept_band, kept_full = state.get if state.exists else (0, -1, 0.0, 0.0)
        rows = pd.concat(list(parts)).sort_values(order, kind="stable")  # one key in one micro-batch, whose size the trigger bounds
        out = []
        for when, b, f in zip(rows[order], rows[band], rows[full], strict=True):
            idx, count = count, count + 1
            if pd.isna(b) or pd.isna(f):
                continue
            score = None if at < 0 else round(abs(b - kept_band) + weight * abs(f - kept_full), 4)
            if score is None or (score > threshold and idx - at >= min_gap):
                at, kept_band, kept_full = idx, float(b), float(f)
                out.append((name[0], idx, when, score))
        state.update((count, at, kept_band, kept_full))
        if out:
            yield pd.DataFrame(out, columns=["k", "idx", "at", "distance"])

    rows = stream.select(F.col(key).alias("k"), F.col(order).cast("bigint").alias(order), F.col(band).cast("double").alias(band), F.col(full).cast("double").alias(full))
    made = rows.groupBy("k").applyInPandasWithState(
        step, f"k {kind}, idx bigint, at bigint, distance double", "count bigint, at bigint, band double, full double", "append", GroupStateTimeout.NoTimeout
    )
    return made.withColumnsRenamed({"k": key, "at": order})


def interval_stream(stream: DataFrame, entity: str, start: str, end: str, horizon: int) -> DataFrame:
    """Continuous periods and the gaps between them as they change: (entity, kind, start, end, closed, gone).

    Each interval is inserted into the entity's ordered map, which merges periods and updates gaps; what a batch has changed
    is sent, with ``gone`` for a period or gap that was sent before and holds no more. A period that ends more than ``horizon``
    before the latest start is closed: sent once more with the gap before it, and forgotten but for its end. An interval that
    reaches into what is closed is sent as kind ``late`` and changes nothing.
    """

    def step(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        starts, ends, latest, edge = state.get if state.exists else ([], [], -(1 << 62), None)
        held = DisjointIntervals()
        for s, e in zip(starts, ends, strict=True):
            held.insert(int(s), int(e))

        def present() -> set[tuple[str, int, int]]:
            first = held.bottoms[:1]
            gaps = [*held.gaps(), *((edge, f) for f in first if edge is not None)]
            return {("period", *p) for p in held.periods()} | {("gap", *g) for g in gaps}

        before, out = present(), []
        for part in parts:
            for s, e in zip(part[start], part[end], strict=True):
                if pd.isna(s) or pd.isna(e) or s > e:
                    continue
                if edge is not None and s <= edge:
                    out.append(("late", int(s), int(e), True, False))
                else:
                    held.insert(int(s), int(e))
                    latest = max(latest, int(s))
        now = present()
        out += [(*p, False, True) for p in sorted(before - now)] + [(*p, False, False) for p in sorted(now - before)]
        periods = held.periods()
        done = sum(e < latest - horizon for _, e in periods)
        for s, e in periods[:done]:
            out += [("gap", edge, s, True, False)] * (edge is not None) + [("period", s, e, True, False)]
            edge = e
        state.update(([s for s, _ in periods[done:]], [e for _, e in periods[done:]], latest, edge))
        if out:
            yield pd.DataFrame([(name[0], *row) for row in out], columns=["k", "kind", "s", "e", "closed", "gone"])

    rows = stream.select(F.col(entity).alias("k"), F.col(start).cast("bigint").alias(start), F.col(end).cast("bigint").alias(end))
    made = rows.groupBy("k").applyInPandasWithState(
        step, "k string, kind string, s bigint, e bigint, closed boolean, gone boolean", "starts array<bigint>, ends array<bigint>, latest bigint, edge bigint", "update", GroupStateTimeout.NoTimeout
    )
    return made.withColumnsRenamed({"k": entity, "s": start, "e": end})


def sampled_stream(stream: DataFrame, key: str, ts: str, every: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """The first row of each key in each window of event time: (key, window, first), final once the watermark has passed."""
    first = F.min_by(F.struct(*stream.columns), ts)
    return stream.withWatermark(ts, late).groupBy(F.window(ts, every), key).agg(first.alias("first"))


def session_stream(stream: DataFrame, key: str, ts: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of a key: rows less than ``gap`` apart."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap), key).agg(F.count("*").alias("rows"))


def replace_in_batches(stream: DataFrame, path: str, owner: str, run: str, checkpoint: str):
    """A sink that keeps, for each owner, the rows of its latest delivery: the greatest value of ``run``.

    A delivery may come in any number of micro-batches; each adds its rows in a folder of its own (owner, run, batch), so a
    micro-batch that is repeated writes over itself only. Once a later run of an owner is written, its earlier ones are
    deleted; rows of an earlier run that come after it are left out. Rows without owner or run belong to no delivery.
    Batches are numbered by the checkpoint, so with a new checkpoint begin new runs.
    """
    kind = stream.schema[run].dataType

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.filter(F.col(owner).isNotNull() & F.col(run).isNotNull()).persist()
        try:
            arrived = batch.groupBy(owner).agg(F.max(run).alias("_last"))
            place, fs = at(spark, path)
            if fs.exists(place):
                held = spark.read.option("basePath", path).schema(StructType([*stream.schema.fields, StructField("_batch", LongType())])).parquet(path)
                held = held.join(arrived.select(owner), owner, "left_semi").groupBy(owner).agg(F.max(run).alias("_last"))
                arrived = arrived.unionByName(held).groupBy(owner).agg(F.max("_last").alias("_last"))
            arrived = materialise(arrived)
            rows = batch.join(arrived, owner).filter(F.col(run) == F.col("_last")).drop("_last").withColumn("_batch", F.lit(number).cast("bigint"))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(owner, run, "_batch").parquet(path)
            for r in arrived.select(F.col(owner).cast("string").alias("o"), F.col("_last").cast("string").alias("r")).toLocalIterator():
                folder, _ = at(spark, f"{path}/{part(spark, owner, r.o)}")
                for old in fs.listStatus(folder):
                    if old.getPath().getName() != part(spark, run, r.r):
                        fs.delete(old.getPath(), True)
        finally:
            batch.unpersist()

    if not isinstance(kind, (StringType, IntegralType, DateType)):
        raise TypeError(f"{run} must be text, a whole number or a date to be a folder's name: {kind.simpleString()}")
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def at(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(sc._jsc.hadoopConfiguration())


def part(spark: SparkSession, column: str, value: str) -> str:
    """The folder's name that Spark gives a partition."""
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return name.getPartitionPathString(column, value)
