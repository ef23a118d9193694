"""Timelines: grids, ranges, windows and islands of the ordered observations of a key, words of a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grid(df: DataFrame, idx: str, fps: float) -> DataFrame:
    """``df`` with t_ms and frame_id of its grid position; the id is the position, never a row number after filtering."""
    return df.withColumn("t_ms", F.bround(F.col(idx) * 1000.0 / fps).cast("bigint")).withColumn("frame_id", F.format_string("f_%06d", idx))


def expected_samples(duration_s: Column, fps: float) -> Column:
    return F.greatest(F.floor(duration_s * fps) + 1, F.lit(0)).cast("bigint")


def ranges_column(ranges: list[tuple[int, int]]) -> Column:
    """A parameter list of (start, end) as a literal array."""
    return F.array(*(F.struct(F.lit(s).cast("bigint").alias("s"), F.lit(e).cast("bigint").alias("e")) for s, e in ranges)).cast("array<struct<s:bigint,e:bigint>>")


def skip_ranges(df: DataFrame, t: str, ranges: list[tuple[int, int]]) -> DataFrame:
    """Without the rows in half-open ranges [start, end)."""
    return df.filter(~F.exists(ranges_column(ranges), lambda r: (r["s"] <= F.col(t)) & (F.col(t) < r["e"]))) if ranges else df


def first_range(t: Column, ranges: list[tuple[int, int]]) -> Column:
    """Number (from 0) of the first closed range [start, end] that holds ``t``; null where none does."""
    found = F.lit(None).cast("int")
    for i in reversed(range(len(ranges))):
        found = F.when(t.between(*ranges[i]), F.lit(i)).otherwise(found)
    return found


SLAB = 1_000_000  # rows of one key that a task handles at once in the operators below


def slabs(df: DataFrame, position: str, halo: int, size: int = SLAB) -> DataFrame:
    """``df`` cut into slabs of ``size`` positions, each with copies of the ``halo`` positions around it: _slab, and _own
    for the rows that belong to it. With dense positions a window within a slab sees what it would see without slabs."""
    slab = lambda shift: F.floor((F.col(position) + shift) / size).cast("bigint")
    cut = df.withColumn("_slab", F.explode(F.array_distinct(F.array(slab(0), slab(-halo), slab(halo)))))
    return cut.withColumn("_own", F.col("_slab") == slab(0))


def median_smooth(df: DataFrame, key: str, position: str, value: str, window: int, pinned: Column | None = None, name: str = "smoothed", size: int = SLAB) -> DataFrame:
    """Centred median over ``window`` rows, nulls not counted; null, pinned and lonely values stay as they are.
    ``position`` counts the rows of a key without holes; a key may be larger than a task."""
    if window <= 1:
        return df.withColumn(name, F.col(value))
    half = window // 2
    near = Window.partitionBy(key, "_slab").orderBy(position).rowsBetween(-half, half)
    keep = F.col(value).isNull() | (pinned if pinned is not None else F.lit(False)) | (F.count(value).over(near) < 2)
    out = slabs(df, position, half, size).withColumn(name, F.when(keep, F.col(value)).otherwise(F.percentile(value, 0.5).over(near)))
    return out.filter("_own").drop("_slab", "_own")


def interpolate_gaps(df: DataFrame, key: str, position: str, value: str, max_span: int, name: str = "filled", size: int = SLAB) -> DataFrame:
    """Runs of at most ``max_span`` nulls between two values are filled linearly by position; the rest stay null.
    ``position`` counts the rows of a key without holes; a key may be larger than a task."""
    reach = max_span + 1  # a value farther away does not matter
    before = Window.partitionBy(key, "_slab").orderBy(position).rowsBetween(-reach, 0)
    after = Window.partitionBy(key, "_slab").orderBy(position).rowsBetween(0, reach)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(position).alias("i"), F.col(value).alias("v")))
    out = slabs(df, position, reach, size).withColumn("_p", F.last(known, ignorenulls=True).over(before)).withColumn("_n", F.first(known, ignorenulls=True).over(after))
    gap = F.col("_n.i") - F.col("_p.i") - 1
    weight = (F.col(position) - F.col("_p.i")) / (gap + 1)
    inferred = F.col(value).isNull() & (gap <= max_span)
    return out.filter("_own").withColumn("interpolated", F.coalesce(inferred, F.lit(False))).withColumn(
        name, F.when(F.col("interpolated"), (1 - weight) * F.col("_p.v") + weight * F.col("_n.v")).otherwise(F.col(value))
    ).drop("_p", "_n", "_slab", "_own")


def islands(df: DataFrame, key: list[str], position: str, size: int = SLAB) -> DataFrame:
    """Runs of consecutive positions: (key, first, last, n). Runs are found per slab; only those that touch the edge of a
    slab (two per slab at most) are then put together."""
    marked = df.select(*key, position).withColumn("_slab", F.floor(F.col(position) / size).cast("bigint"))
    order = Window.partitionBy(*key, "_slab").orderBy(position)
    marked = marked.withColumn("_g", F.col(position) - F.row_number().over(order))
    local = marked.groupBy(*key, "_slab", "_g").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count("*").alias("n")).drop("_slab", "_g")
    edge = (F.col("first") % size == 0) | (F.col("last") % size == size - 1)
    along = Window.partitionBy(*key).orderBy("first")
    opens = F.coalesce((F.col("first") != F.lag("last").over(along) + 1).cast("int"), F.lit(1))
    joined = local.filter(edge).withColumn("_o", opens).withColumn("_g", F.sum("_o").over(along))
    whole = joined.groupBy(*key, "_g").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("_g")
    return local.filter(~edge).unionByName(whole)


def join_words(words: Column, least: float) -> Column:
    """struct(text, confidence) of an array of struct(text, left, right, height, confidence): confident words from left
    to right and their mean confidence; both null where none is confident."""
    sure = F.array_sort(F.transform(F.filter(words, lambda w: w["confidence"] >= least), lambda w: F.struct(w["left"].alias("left"), w["text"].alias("text"), w["confidence"].alias("c"))))
    n = F.size(sure)
    mean = F.bround(F.aggregate(sure, F.lit(0.0), lambda s, w: s + w["c"]) / n, 4)
    return F.struct(F.when(n > 0, F.array_join(F.transform(sure, lambda w: w["text"]), " ")).alias("text"), F.when(n > 0, mean).alias("confidence"))


def labels_by_gaps(words: Column, least: float) -> Column:
    """Labels of a line of words: a new one begins where the gap to the word before is wider than the text is high."""
    sure = F.array_sort(F.transform(F.filter(words, lambda w: w["confidence"] >= least), lambda w: F.struct(w["left"].alias("left"), w["right"].alias("right"), w["text"].alias("text"), w["height"].alias("height"))))
    heights = F.array_sort(F.transform(sure, lambda w: w["height"].cast("double")))
    n = F.size(heights)
    median = (F.get(heights, F.floor((n - 1) / 2).cast("int")) + F.get(heights, F.floor(n / 2).cast("int"))) / 2
    pieces = F.transform(
        sure, lambda w, i: F.concat(F.when(i == 0, F.lit("")).when(w["left"] - F.get(sure, i - 1)["right"] > median, F.lit("\x00")).otherwise(F.lit(" ")), w["text"])
    )
    return F.when(n > 0, F.split(F.array_join(pieces, ""), "\x00")).otherwise(F.array().cast("array<string>"))
