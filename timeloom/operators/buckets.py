"""A table kept in buckets between jobs, of which only the buckets that change are read and written.

Every write is a generation: a folder with the buckets it has written. A manifest beside them says in which generation
each bucket was last written; it is put in place by a rename once the generation is whole, so a failed job leaves the
table as it was. Buckets of older generations are deleted when neither the present manifest nor the one before needs
them any more, so a reader that has opened the table before a write may still finish.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.operators.manifest import drop_all_but, must_be_free, parts_of, read_manifest, write_manifest

PER_FILE = 1_000_000  # rows that one task writes of a bucket


class BucketStore:
    """Rows of ``schema`` in buckets under ``path``, which all executors share. A store opened on a folder that has a
    manifest goes on from there, with the buckets it was made with."""

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int | None = None) -> None:
        held = {"generation": 0, "buckets": buckets, "written": {}, "before": {}, "rows": 0} | (read_manifest(spark, path) or {})
        self.spark, self.path, self.schema = spark, path, schema
        self.generation: int = held["generation"]
        self.buckets: int | None = held["buckets"]
        self.rows: int = held["rows"]  # at most so many
        self.written = {int(b): g for b, g in held["written"].items()}  # bucket -> its present generation
        self.before = {int(b): g for b, g in held["before"].items()}

    def bucket(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of ``buckets``, or all: one scan over their folders."""
        paths = [f"{self.path}/g{g}/bucket={b}" for b, g in sorted(self.written.items()) if buckets is None or b in set(buckets)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, touched: list[int] | None, size: int, spread: str, *keys: str) -> None:
        """Put ``rows`` in place of the buckets ``touched`` (None: of all). ``size``: how many rows there are at most."""
        must_be_free(self.spark, self.path, self.generation + 1)
        number, folder = self.generation + 1, f"{self.path}/g{self.generation + 1}"
        names = rows.columns
        split = F.pmod(F.xxhash64(spread), F.lit(max(1, -(-size // (PER_FILE * (len(touched) if touched else self.buckets))))))
        placed = rows.withColumn("bucket", self.bucket(*keys)).repartition("bucket", split)
        placed.select(*names, "bucket").write.partitionBy("bucket").option("compression", "zstd").mode("overwrite").parquet(folder)
        kept = {} if touched is None else {b: g for b, g in self.written.items() if b not in set(touched)}
        following = kept | {int(name.removeprefix("bucket=")): number for name in parts_of(self.spark, folder) if name.startswith("bucket=")}
        state: dict[str, Any] = {"buckets": self.buckets, "written": following, "before": self.written, "rows": self.rows}
        write_manifest(self.spark, self.path, number, **state)
        needed = {f"g{g}/bucket={b}" for held in (following, self.written) for b, g in held.items()}
        drop_all_but(self.spark, self.path, needed, number)
        self.before, self.written, self.generation = self.written, following, number
