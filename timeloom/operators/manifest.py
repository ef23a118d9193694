"""Which generation of a table kept in a folder holds: one small JSON file beside the generations, made whole by a rename."""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(sc._jsc.hadoopConfiguration())


def _latest(spark: SparkSession, path: str):
    """(number, path, file system) of the latest manifest under ``path``, or None."""
    place, fs = _at(spark, f"{path}/manifest-*.json")
    found = [(int(f.getPath().getName()[len("manifest-") : -len(".json")]), f.getPath()) for f in fs.globStatus(place) or ()]
    return (*max(found, key=lambda f: f[0]), fs) if found else None


def read_manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The manifest of the latest generation under ``path``, or None where nothing was kept there."""
    last = _latest(spark, path)
    if last is None:
        return None
    stream = last[2].open(last[1])
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def must_be_free(spark: SparkSession, path: str, generation: int) -> None:
    """Fail where ``generation`` or a later one is stated already, before anything of it is written over."""
    last = _latest(spark, path)
    if last is not None and last[0] >= generation:
        raise RuntimeError(f"generation {generation} of {path} is there already: another job wrote to it")


def parts_of(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing where it is not there."""
    place, fs = _at(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []


def drop_all_but(spark: SparkSession, path: str, needed: set[str], generation: int) -> None:
    """Delete the buckets (``g<generation>/bucket=<n>``) up to ``generation`` that are not ``needed``, then generations without
    buckets, and all manifests but this and the one before. Buckets of a generation that is not stated stay."""
    _, fs = _at(spark, path)
    drop = lambda name: fs.delete(_at(spark, f"{path}/{name}")[0], True)
    for folder in parts_of(spark, path):
        if re.fullmatch(r"g\d+", folder) and int(folder[1:]) <= generation:
            held = [b for b in parts_of(spark, f"{path}/{folder}") if b.startswith("bucket=")]
            kept = [b for b in held if f"{folder}/{b}" in needed]
            for b in held:
                if b not in kept:
                    drop(f"{folder}/{b}")
            if not kept and int(folder[1:]) < generation:
                drop(folder)
        elif (m := re.fullmatch(r"manifest-(\d+)\.json", folder)) and int(m[1]) < generation - 1:
            drop(folder)


def write_manifest(spark: SparkSession, path: str, generation: int, **kept: Any) -> None:
    """Make ``generation`` the one that holds. A generation is stated once: who comes second with the same one fails."""
    final, fs = _at(spark, f"{path}/manifest-{generation}.json")
    part, _ = _at(spark, f"{path}/_manifest-{generation}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(json.dumps({"generation": generation} | kept).encode()))
    finally:
        stream.close()
    must_be_free(spark, path, generation)
    if not fs.rename(part, final):
        raise RuntimeError(f"the manifest of generation {generation} of {path} could not be put in place")
