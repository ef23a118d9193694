"""Stages as functions from DataFrames to DataFrames, with results kept by the digests of what they depend on.

A stage's result is one or several tables under ``root/stage/digest``, where the digest covers the configuration sections the
stage reads, the files of its sources (names, sizes, times) and the digests of the stages before it. Changing a section or a
source gives every stage that depends on it another folder, so a result that is there is a result that still holds;
nothing is changed in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from timeloom.plans.config import digest

Tables = DataFrame | dict[str, DataFrame]
Run = Callable[[dict[str, Any], dict[str, Any]], Tables]


@dataclass(frozen=True)
class Stage:
    """``run(results of the stages required, configuration)`` gives a table, or several by name."""

    name: str
    run: Run
    requires: tuple[str, ...] = ()
    sections: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()


@dataclass
class Pipeline:
    spark: SparkSession
    root: str
    config: dict[str, Any]
    stages: dict[str, Stage] = field(default_factory=dict)
    ran: list[str] = field(default_factory=list)

    def add(self, stage: Stage) -> None:
        missing = [r for r in stage.requires if r not in self.stages]
        if missing:
            raise ValueError(f"{stage.name} requires {missing}")
        self.stages[stage.name] = stage

    def _files(self, path: str) -> list[str]:
        """Names, sizes and times of the files under a source."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found, held = [], fs.listFiles(place, True)
        while held.hasNext():
            f = held.next()
            found.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}")
        return sorted(found)

    def digest_of(self, name: str) -> str:
        stage = self.stages[name]
        parts = [name, *(digest(self.config[s]) for s in stage.sections), *(self.digest_of(r) for r in stage.requires)]
        for source in stage.sources:
            parts += self._files(source)
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]

    def path_of(self, name: str) -> str:
        return f"{self.root}/{name}/{self.digest_of(name)}"

    def _fs(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def done(self, name: str) -> bool:
        place, fs = self._fs(self.path_of(name) + "/_SUCCESS")
        return fs.exists(place)

    def stale(self) -> list[str]:
        """Stages whose result for the present configuration and sources is not there."""
        return [name for name in self.stages if not self.done(name)]

    def result(self, name: str) -> Any:
        """The table of a stage, or its tables by name, made (with those it requires) unless they are there."""
        path = self.path_of(name)
        if not self.done(name):
            stage = self.stages[name]
            made = stage.run({r: self.result(r) for r in stage.requires}, self.config)
            if isinstance(made, dict):
                for part, table in made.items():
                    table.write.mode("overwrite").parquet(f"{path}/part={part}")
                place, fs = self._fs(f"{path}/_SUCCESS")
                fs.create(place, True).close()  # at last: all parts are whole
            else:
                made.write.mode("overwrite").parquet(path)
            self.ran.append(name)
        place, fs = self._fs(path)
        parts = sorted(f.getPath().getName() for f in fs.listStatus(place) if f.getPath().getName().startswith("part="))
        if parts:
            return {part.removeprefix("part="): self.spark.read.parquet(f"{path}/{part}") for part in parts}
        return self.spark.read.parquet(path)
