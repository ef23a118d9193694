"""Duplicates hidden by formatting: an incremental ledger of canonical keys.

Every row gets a 128-bit canonical key: of each of its fields everything but letters and digits is dropped and case is
ignored. The ledger holds per key how many rows had it and the smallest id among them, in buckets of the key. A new
batch is aggregated first (so a hot key shuffles one row per task), joined full-outer with the buckets it touches, and
its counts are added; only the touched buckets are written again.

Defined results: null equals only null, an empty value only values without letters and digits; accents count; JSON
that cannot be read is compared as one text, and a field missing from readable JSON is null; rows with a null id are
counted nowhere; a repeated row id is counted but is no copy of itself; an empty batch changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.buckets import BucketStore
from timeloom.operators.manifest import must_be_free
from timeloom.operators.ordered import join_unique
from timeloom.session import checkpoint_dir, materialise, shuffle_partitions

NULL, FIELD, ITEM = "\x00", "\x01", "\x02"
IDENTITY_FIELDS = "record string, module string, tabs array<string>, section string, dialog string, description string, unread string"


def bare(value: Column) -> Column:
    """Letters and digits of a text in one case; null as a sign of its own."""
    lower = F.translate(F.replace(F.lower(value), F.lit("ß"), F.lit("ss")), "ς", "σ")
    return F.coalesce(F.regexp_replace(lower, r"[^\p{L}\p{N}]+", ""), F.lit(NULL))


def canonical_key(*fields: Column) -> Column:
    """128-bit digest of fields that are already bare."""
    return F.unhex(F.md5(F.concat_ws(FIELD, *fields)))


def identity_key(table: str) -> Column:
    said = F.from_json("other_fields", IDENTITY_FIELDS, {"columnNameOfCorruptRecord": "unread"})
    tabs = F.coalesce(F.array_join(F.transform(said["tabs"], bare), ITEM), F.lit(NULL))
    tabs = F.when(F.size(said["tabs"]) > 0, F.concat(F.lit(ITEM), tabs)).otherwise(tabs)
    read = F.concat_ws(FIELD, *(tabs if c == "tabs" else bare(said[c]) for c in ("record", "module", "tabs", "section", "dialog", "description")))
    other = F.when(F.col("other_fields").isNull(), F.lit(NULL)).when(said["unread"].isNotNull(), F.concat(F.lit(ITEM), bare(F.col("other_fields")))).otherwise(read)
    return canonical_key(F.lit(table), bare(F.col("slug")), bare(F.col("frame_id")), bare(F.col("name")), other)


def flat_key(table: str, *columns: str) -> Column:
    return canonical_key(F.lit(table), *(bare(F.col(f"`{c}`")) for c in columns))


PER_BUCKET = 1_000_000  # keys; a ledger that holds four times as many is given more buckets


class Ledger(BucketStore):
    """Counts and earliest ids by canonical key, kept in buckets under ``path`` (shared by all executors).

    A ledger opened on a folder that has one goes on from there. The number of buckets follows from the number of keys,
    unless ``buckets`` says it.
    """

    SCHEMA = "key binary, n bigint, first_id bigint"

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None) -> None:
        super().__init__(spark, path or f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}", self.SCHEMA, buckets)

    def add(self, rows: DataFrame, key: str = "key", row_id: str = "id") -> None:
        """Count a batch of rows (key, id) into the ledger."""
        must_be_free(self.spark, self.path, self.generation + 1)
        batch = rows.select(F.col(key).alias("key"), F.col(row_id).cast("bigint").alias("id")).filter("key is not null and id is not null")
        batch = materialise(batch.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first_id")))
        size = batch.count()
        self.rows += size
        wanted = -(-self.rows // PER_BUCKET)
        touched = None
        if self.buckets is None:
            self.buckets = max(min(shuffle_partitions(self.spark), size), wanted, 1)
        elif self.rows > 4 * PER_BUCKET * self.buckets:
            self.buckets = wanted  # all keys move
        else:
            touched = [r[0] for r in batch.select(self.bucket("key")).distinct().collect()]  # at most the number of buckets
        merged = batch
        if self.written:
            old = self.read(touched).select("key", F.col("n").alias("old_n"), F.col("first_id").alias("old_first"))
            merged = batch.join(old, "key", "full_outer").select(
                "key", (F.coalesce("n", F.lit(0)) + F.coalesce("old_n", F.lit(0))).alias("n"), F.least("first_id", "old_first").alias("first_id")
            )
        self.replace(merged, touched, size, "key", "key")


def copies(rows: DataFrame, ledger: DataFrame, *also: str) -> DataFrame:
    """(key, *also, first_id, copy_id): one row for each further row of a key that the ledger counts twice or more."""
    repeated = materialise(ledger.filter("n > 1").select("key", "n", "first_id"))
    total = repeated.agg(F.sum("n")).first()[0] or 0
    found = join_unique(rows.select("key", "id", *also), repeated, "key", "n", total)
    return found.filter("id <> first_id").select("key", *also, "first_id", F.col("id").alias("copy_id")).distinct()
