"""What changed between full snapshots: a key-to-hash index probed by the next snapshot.

The index of a snapshot has one narrow row per entry: its key, a 128-bit hash of the values that count and the
smallest row id among its copies. Two uses:

* :func:`diff_history` runs the whole history of all entities at once. Index rows are hashed into buckets by (entity,
  key), so that a hot entity is spread over all buckets; a task reads its bucket snapshot by snapshot, probes the index
  of the last one with the rows of the next, and swaps. It holds one entity's share of two snapshots at a time.
* :class:`SnapshotIndex` keeps the index of the last snapshot in a bucketed table between deliveries: ``probe`` joins
  a new delivery with the buckets it touches, ``swap`` puts its index in place of the old one in these.

Old values are fetched (:func:`fetch_values`) only for the rows found changed.

Defined results: rows with a null key part or no snapshot time belong to no snapshot; a null entity is an entity;
copies of an entry count once, with the values of the copy of smallest id; the first snapshot gives no change; an
empty table gives none; columns other than those named are ignored whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.operators.buckets import BucketStore
from timeloom.operators.manifest import must_be_free
from timeloom.operators.ordered import join_unique
from timeloom.session import materialise, shuffle_partitions

CHANGES = "entity string, key string, change string, row_id bigint, old_row_id bigint, new_row_id bigint"


def value_hash(*values: Column) -> Column:
    """128-bit hash of string values, 16 bytes; null differs from every string."""
    return F.unhex(F.md5(F.concat_ws("\x01", *(F.coalesce(v, F.lit("\x00")) for v in values))))


def snapshot_index(rows: DataFrame, entity: Column, snapshot: Column, key: Column, row_id: Column, digest: Column, label: Column | None = None) -> DataFrame:
    """(entity, snapshot, key, row_id, digest): one row per entry of a snapshot; copies are reduced before the shuffle.
    A null entity becomes the string of one zero character. ``label``: what ``key`` is made from and null with; given,
    the key itself need not be computed to find the snapshot times."""
    whose = F.coalesce(entity.cast("string"), F.lit("\x00"))
    rows = rows.filter(snapshot.isNotNull() & (key if label is None else label).isNotNull())
    narrow = rows.select(whose.alias("entity"), snapshot.alias("snapshot"), key.alias("key"), row_id.alias("row_id"), digest.alias("digest"))
    return narrow.groupBy("entity", "snapshot", "key").agg(F.min(F.struct("row_id", "digest")).alias("m")).select("entity", "snapshot", "key", "m.*")


def diff_history(index: DataFrame) -> DataFrame:
    """(entity, key, change, row_id, old_row_id, new_row_id) for every snapshot of an entity and its next one."""
    index = materialise(index.select(F.struct("entity", "snapshot").alias("at"), "key", "row_id", "digest"))
    sizes = index.groupBy("at").agg(F.count("*").alias("n"))
    order = Window.partitionBy("at.entity").orderBy("at.snapshot")
    times = materialise(sizes.select("at", "n", F.row_number().over(order).alias("gen"), F.lead("at").over(order).isNull().alias("final")))
    total = times.agg(F.sum("n")).first()[0] or 0
    at = join_unique(index, times, "at", "n", total).select("at.entity", "gen", "key", "final", "row_id", "digest")
    n = shuffle_partitions(index.sparkSession)
    bucketed = at.repartition(n, "entity", "key").sortWithinPartitions("entity", "gen", "key")
    return bucketed.mapInArrow(_probe_and_swap, CHANGES)


def _probe_and_swap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: rows of each entity by snapshot. ``stored`` is the bucket's index of the entity's last snapshot; the
    rows of the next one probe it and fill ``arriving``, which then takes its place."""
    out: list[tuple] = []
    entity, gen, final = None, 0, False
    stored: dict[str, tuple[str, int]] = {}
    arriving: dict[str, tuple[str, int]] = {}

    def left() -> None:
        """What the snapshot just read did not have any more; then swap."""
        nonlocal stored, arriving
        out.extend((entity, key, "removed", row, row, None) for key, (_, row) in stored.items())
        stored, arriving = arriving, {}

    for batch in batches:
        for whose, at, key, last, row, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if whose != entity or at != gen:
                if entity is not None:
                    left()
                    if (whose != entity and not final) or (whose == entity and at > gen + 1):
                        left()  # this bucket has no row of the following snapshot
                if whose != entity:
                    stored = {}
                entity, gen, final = whose, at, last
            before = stored.pop(key, None)
            if before is None:
                if at > 1:
                    out.append((whose, key, "added", row, None, row))
            elif before[0] != digest:
                out.append((whose, key, "changed", row, before[1], row))
            arriving[key] = (digest, row)
        if len(out) > 50_000:
            yield _changes(out)
            out = []
    if entity is not None:
        left()
        if not final:
            left()
    if out:
        yield _changes(out)


def _changes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in CHANGES.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def fetch_values(changes: DataFrame, rows: DataFrame, row_id: str, *values: str) -> DataFrame:
    """``changes`` with old and new values of the columns ``values``; rows that did not change are filtered out first."""
    ids = changes.select(F.explode(F.array_compact(F.array("old_row_id", "new_row_id"))).alias("_id"))
    kept = rows.select(F.col(row_id).alias("_id"), F.struct(*values).alias("_v")).join(ids, "_id", "left_semi")
    old = kept.select(F.col("_id").alias("old_row_id"), F.col("_v").alias("old_values"))
    new = kept.select(F.col("_id").alias("new_row_id"), F.col("_v").alias("new_values"))
    return changes.join(old, "old_row_id", "left").join(new, "new_row_id", "left")


class SnapshotIndex(BucketStore):
    """The index of the last snapshot of every entity, kept as a table in buckets of entities.

    A delivery touches the buckets of its entities only: ``probe`` reads these, ``swap`` writes these. Within a bucket rows are
    spread over files by their key, so that a large entity is not one task's work.
    """

    SCHEMA = "entity string, key string, snapshot timestamp, row_id bigint, digest binary"
    FEW = 100_000  # entities of a delivery that are broadcast; more are joined by a shuffle

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        super().__init__(spark, path, self.SCHEMA, buckets)

    def _touched(self, index: DataFrame) -> tuple[DataFrame, list[int]]:
        """Entities of a delivery with their number of rows, and their buckets (at most as many as the store has)."""
        arrived = materialise(index.groupBy("entity").agg(F.count("*").alias("new_n")))
        return arrived, [r[0] for r in arrived.select(self.bucket("entity")).distinct().collect()]

    def probe(self, index: DataFrame) -> DataFrame:
        """Changes from the stored snapshots to ``index``, which holds one whole new snapshot of some entities."""
        arrived, touched = self._touched(index)
        stored = self.read(touched)
        sizes = materialise(stored.groupBy("entity").agg(F.count("*").alias("old_n")).join(arrived, "entity"))
        old_total, new_total = sizes.agg(F.sum("old_n"), F.sum("new_n")).first()  # entities not stored before have no change
        old = join_unique(stored, sizes.select("entity", "old_n"), "entity", "old_n", old_total or 0)
        new = join_unique(index, sizes.select("entity", "new_n"), "entity", "new_n", new_total or 0)
        n, o = new.alias("n"), old.alias("o")
        same = (F.col("n.key") == F.col("o.key")) & (F.col("n.entity") == F.col("o.entity"))
        change = (
            F.when(F.col("o.row_id").isNull(), "added").when(F.col("n.row_id").isNull(), "removed")
            .when(F.col("n.digest") != F.col("o.digest"), "changed")
        )
        return n.join(o, same, "full_outer").select(
            F.coalesce("n.entity", "o.entity").alias("entity"), F.coalesce("n.key", "o.key").alias("key"), change.alias("change"),
            F.coalesce("n.row_id", "o.row_id").alias("row_id"), F.col("o.row_id").alias("old_row_id"), F.col("n.row_id").alias("new_row_id"),
        ).filter("change is not null")

    def swap(self, index: DataFrame) -> None:
        """Store ``index`` in place of the stored snapshots of its entities."""
        must_be_free(self.spark, self.path, self.generation + 1)
        arrived, touched = self._touched(index)
        count, size = arrived.agg(F.count("*"), F.coalesce(F.sum("new_n"), F.lit(0))).first()
        whose = arrived.select("entity")
        kept = self.read(touched).join(F.broadcast(whose) if count <= self.FEW else whose, "entity", "left_anti")
        new = index.select("entity", "key", F.col("snapshot").cast("timestamp").alias("snapshot"), "row_id", "digest")
        self.rows += size
        self.replace(kept.select(*new.columns).unionByName(new), touched, self.rows * len(touched) // self.buckets + size, "key", "entity")
