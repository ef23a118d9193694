"""Pixel queries: embeddings as small grey images, run through the kernels in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import pixels
from timeloom.operators import numbering
from timeloom.plans.tables import table
from timeloom.sources import images

SCALE = 300.0


def as_image(embedding: Column) -> Column:
    """A 64-vector as an 8 x 8 grey PNG."""

    @F.arrow_udf("binary")
    def draw(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            grid = np.clip(np.rint(128 + SCALE * np.array(v, float)), 0, 255).astype(np.uint8).reshape(8, 8)
            out.append(pixels.encode_png(grid))
        return pa.array(out, pa.binary())

    return draw(embedding)


def frame_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", as_image(F.col("embedding")).alias("image"))


def pixel_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, contrast, legibility and difference hash of each image."""
    image = F.col("image")
    return frame_images(spark, sf_dir).select(
        "vec_id", images.sizes(image)["w"].alias("w"), images.kernel(pixels.contrast, "double", image).alias("contrast"),
        images.kernel(pixels.legibility, "double", image).alias("legibility"), images.kernel(pixels.difference_hash, "string", image).alias("hash"),
    )


def band_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far light and dark are apart in each image, and how well it can be read."""
    image = F.col("image")
    return frame_images(spark, sf_dir).select("vec_id", images.kernel(pixels.contrast, "double", image).alias("contrast"), images.kernel(pixels.legibility, "double", image).alias("legibility"))


def frame_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of pixels changed since the image before of the same label."""
    rows = numbering.with_previous(frame_images(spark, sf_dir), "label", "image", "vec_id")
    return rows.select("vec_id", images.kernel(pixels.changed_share, "double", F.col("previous"), F.col("image")).alias("changed"))


def montage_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of 20 images with their digest."""
    rows = frame_images(spark, sf_dir).withColumn("sheet", F.floor(F.col("vec_id") / 20).cast("bigint"))
    return images.montage(rows, "sheet", "vec_id", "image", width=160, strip=16).select("sheet", "rows", "sha256")


QUERIES = {f.__name__: f for f in (pixel_features, band_measures, frame_differences, montage_sheets)}

_DRAWN = f"drawn AS (SELECT vec_id, label, list_transform(embedding, lambda x: least(greatest(round_even(128 + {SCALE} * x::DOUBLE, 0), 0), 255)) AS p FROM embeddings)"
_EDGES = "list_transform(range(0, 36), lambda i: p[(i // 6) * 8 + i % 6 + 2] + p[(i // 6) * 8 + i % 6 + 18] + p[(i // 6) * 8 + i % 6 + 9] + p[(i // 6) * 8 + i % 6 + 11] - 4 * p[(i // 6) * 8 + i % 6 + 10])"
SQL = {
    "band_measures": f"""WITH {_DRAWN}, px AS (SELECT vec_id, unnest(p) AS v FROM drawn), levels AS (SELECT DISTINCT vec_id, v AS t FROM px),
        cut AS (SELECT l.vec_id, t, count(*) FILTER (v <= t) AS below, count(*) FILTER (v > t) AS above, avg(v) FILTER (v <= t) AS low, avg(v) FILTER (v > t) AS high FROM levels l JOIN px USING (vec_id) GROUP BY l.vec_id, t),
        best AS (SELECT vec_id, coalesce((high - low) / 255, 0.0) AS apart FROM cut QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY coalesce(round(below * above * (low - high) * (low - high), 6), 0.0) DESC, t) = 1)
        SELECT vec_id, CAST(round_even(least(list_aggregate(p, 'stddev_pop') / {pixels.CONTRAST_SCALE}, 1.0), 4) AS DOUBLE) AS contrast,
            CAST(round_even(least(least(apart / {pixels.SEPARATION_SCALE}, 1.0), least(list_aggregate({_EDGES}, 'var_pop') / {pixels.SHARPNESS_SCALE}, 1.0)), 4) AS DOUBLE) AS legibility
        FROM drawn JOIN best USING (vec_id)""",
    "frame_differences": f"""WITH {_DRAWN}, b AS (SELECT vec_id, p, lag(p) OVER (PARTITION BY label ORDER BY vec_id) AS q FROM drawn)
        SELECT vec_id, CAST(round_even(list_sum(list_transform(range(1, 65), lambda i: (abs(p[i] - q[i]) > 16)::INT)) / 64.0::DOUBLE, 4) AS DOUBLE) AS changed FROM b""",
}
