"""A data source of fixed-rate sample grids: ``spark.read.format("timeloom_grid")``."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Slice(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class GridReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.slug = options.get("slug", "")
        self.fps = float(options.get("fps", "1"))
        duration = float(options["duration_s"])
        if self.fps <= 0:
            raise ValueError("fps must be above 0")
        self.n = max(int(duration * self.fps) + 1, 0)
        cap = options.get("max_frames")
        self.n = min(self.n, int(cap)) if cap else self.n
        self.size = int(options.get("rowsPerPartition", "100000"))

    def partitions(self) -> list[Slice]:
        return [Slice(low, min(low + self.size, self.n)) for low in range(0, self.n, self.size)] or [Slice(0, 0)]

    def read(self, partition: Slice) -> Iterator[tuple]:
        for idx in range(partition.low, partition.high):
            yield self.slug, idx, f"f_{idx:06d}", round(idx * 1000 / self.fps)


class GridSource(DataSource):
    """Options: slug, duration_s, fps (1), max_frames, rowsPerPartition."""

    @classmethod
    def name(cls) -> str:
        return "timeloom_grid"

    def schema(self) -> str:
        return "slug string, idx bigint, frame_id string, t_ms bigint"

    def reader(self, schema) -> GridReader:
        return GridReader(self.options)  # case does not count in its keys


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GridSource)
