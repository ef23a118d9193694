"""Images as a source: files decoded to rows, and kernels run over them in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from timeloom.functions import pixels
from timeloom.operators.folds import keyed_fold

IMAGE = "struct<h:int,w:int,c:int,data:binary>"


def read_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, sha256, content) of files; the digest is the identity of a source."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"), "content")


def kernel(run: Callable[..., object], kind: str, *images: Column) -> Column:
    """A kernel over one or more encoded images (binary); null where an image is null. Bad images are errors."""

    arrow = to_arrow_type(StructType.fromDDL(f"v {kind}")[0].dataType)

    @F.arrow_udf(kind)
    def over(*columns: pa.Array) -> pa.Array:
        out = []
        for row in zip(*(c.to_pylist() for c in columns), strict=True):
            out.append(None if any(x is None for x in row) else run(*(pixels.decode(x) for x in row)))
        return pa.array(out, arrow)

    return over(*images)


def sizes(content: Column) -> Column:
    """struct(w, h): of a PNG from its head, of other images once decoded; null where there is no image."""

    @F.arrow_udf("struct<w:int,h:int>")
    def read(values: pa.Array) -> pa.Array:
        out = []
        for data in values:
            data = data.as_py()
            found = None if data is None else pixels.png_size(data) or pixels.decode(data).shape[1::-1]
            out.append(None if found is None else {"w": int(found[0]), "h": int(found[1])})
        return pa.array(out, pa.struct([("w", pa.int32()), ("h", pa.int32())]))

    return read(content)


def kept_frames(frames: DataFrame, screens: DataFrame, frame: str = "frame_id") -> DataFrame:
    """The frames (slug, frame_id, ...) that stand for a screen, each once whatever the number of its screens."""
    return frames.join(screens.select("slug", F.col("representative_frame").alias(frame)), ["slug", frame], "left_semi")


def full_frames(frames: DataFrame, image: str) -> DataFrame:
    """``frames`` with their whole image encoded anew (content) and its digest, as they are asked about."""
    return frames.withColumn("content", kernel(pixels.encode_png, "binary", F.col(image))).withColumn("sha256", F.sha2("content", 256))


def montage(rows: DataFrame, sheet: str, row: str, image: str, width: int = 1568, strip: int = 64) -> DataFrame:
    """(sheet, content, rows, sha256): the images of a sheet under each other, scaled to one width; the same bytes for the
    same images. A sheet holds a fixed number of rows, so its group is small."""

    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by(row)
        strips = []
        for data in table.column(image).to_pylist():
            g = pixels.gray(pixels.decode(data))
            strips.append(np.rint(pixels.shrink(g, width, strip)).astype(np.uint8))
        yield pa.record_batch({sheet: pa.array([key[0].as_py()], pa.int64()), "content": pa.array([pixels.encode_png(np.vstack(strips))], pa.binary()), "rows": pa.array([len(strips)], pa.int64())})

    made = rows.select(F.col(sheet).cast("bigint").alias(sheet), row, image).groupBy(sheet).applyInArrow(build, f"{sheet} bigint, content binary, rows bigint")
    return made.withColumn("sha256", F.sha2("content", 256))


def cleaned(frames: DataFrame, key: str, position: str, image: str, steps: dict) -> DataFrame:
    """(key, position, content, aligned): frames run through the cleaning steps in their order; ``steps`` are those of the
    configuration (align, clahe, deglare, moire). Each frame is aligned to the one before it as aligned, so the frames of a
    key are streamed in order with one image held."""

    def step(state: dict, k, at, data) -> list[tuple]:
        if data is None:
            return []
        picture, done = pixels.decode(data), False
        if steps.get("align") and "last" in state and state["last"].shape == picture.shape:
            picture, done = pixels.align(picture, state["last"])
        state["last"] = picture
        if steps.get("clahe", {}).get("on"):
            picture = pixels.equalise(picture, steps["clahe"]["clip"], steps["clahe"]["tiles"])
        if steps.get("deglare", {}).get("on"):
            picture = pixels.suppress_glare(picture, steps["deglare"]["amount"])
        if steps.get("moire", {}).get("on"):
            picture = np.clip(np.rint(pixels.blur(picture, steps["moire"]["sigma"])), 0, 255).astype(np.uint8)
        return [(k, at, pixels.encode_png(picture), done)]

    kind = lambda c: frames.schema[c].dataType.simpleString()
    schema = f"{key} {kind(key)}, {position} {kind(position)}, content binary, aligned boolean"
    return keyed_fold(frames, key, [position], [position, image], dict, step, lambda state: [], schema)
