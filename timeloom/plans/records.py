"""Queries of the records between stages: why a screen is reviewed, what was read of it, what a sheet asks, what a header says."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import pixels
from timeloom.functions.timecode import format_timecode
from timeloom.operators import confidence, numbering, timeline
from timeloom.plans import frames, signals
from timeloom.plans.tables import table
from timeloom.sources import images

PREVIEW = 5
CHROME = {"threshold": 25.0, "coverage": 0.5, "min_height": 2, "search": 1.0, "margin": 0.0, "max_start": 0.5}


def verdict_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each line item's signals, with the first reason that holds."""
    rows = table(spark, sf_dir, "lineitem")
    why = F.when(F.col("l_linenumber") == 7, "glare")
    said = confidence.combine(signals.signals_of(), signals.WEIGHTS, signals.THRESHOLD, why)
    rows = rows.select("l_orderkey", "l_linenumber", said.alias("c"), why.alias("why"))
    return rows.select("l_orderkey", "l_linenumber", "c.verdict", confidence.reason_of(F.col("c"), F.col("why"), signals.THRESHOLD).alias("reason"))


def ocr_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was read of each screen as one record: text, confidence, labels, and how many words were sure and unsure."""
    words = signals._words(spark, sf_dir)
    sure = F.size(F.filter("words", lambda w: w["confidence"] >= signals.LEAST))
    joined = timeline.join_words(F.col("words"), signals.LEAST)
    rows = words.select("slug", "id", joined.alias("j"), F.array_join(timeline.labels_by_gaps(F.col("words"), signals.LEAST), "|").alias("labels"), sure.alias("sure"), F.size("words").alias("words"))
    return rows.select("slug", "id", "j.text", "j.confidence", "labels", "sure", "words").distinct()


def _once(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "screens").groupBy("slug", "id").agg(F.min(F.struct("received_at", "t_ms_start", "t_ms_end", "representative_frame")).alias("d"))
    return rows.select("slug", "id", "d.t_ms_start", F.col("d.representative_frame").alias("frame_id"))


def sheet_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hint for each screen's row on a sheet: what the last reading of its frame said, blanks where there is none."""
    reads = table(spark, sf_dir, "readings").groupBy("slug", "frame_id").agg(F.max_by(F.struct("name", "tabs"), "reading_id").alias("r"))
    rows = _once(spark, sf_dir).join(reads, ["slug", "frame_id"], "left")
    hint = F.concat_ws("", F.coalesce("frame_id", F.lit("")), F.lit(" | title: "), F.coalesce("r.name", F.lit("")), F.lit(" | tabs: "), F.coalesce(F.array_join("r.tabs", ", "), F.lit("")))
    return rows.select("slug", "id", hint.alias("hint"))


def unreadable_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why screens have no identity: no reading of their frame, or one without a name."""
    reads = table(spark, sf_dir, "readings").groupBy("slug", "frame_id").agg(F.max_by(F.struct("name"), "reading_id").alias("r"))
    rows = _once(spark, sf_dir).join(reads, ["slug", "frame_id"], "left")
    why = F.when(F.col("r").isNull(), "no reading").when(F.col("r.name").isNull(), "no name was read")
    return rows.select("slug", "id", why.alias("why")).filter("why is not null")


def span_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first spans of stage 02 of every video, and how many more there are."""
    spans = table(spark, sf_dir, "review_spans").filter("slug is not null and t_ms_start is not null and reason like '02:%'").select("slug", "t_ms_start", "span_id", "reason")
    placed = numbering.numbered_within(spans, "slug", "t_ms_start", "span_id", name="n")
    totals = spans.groupBy("slug").agg(F.count("*").alias("all"))
    line = F.concat(format_timecode(F.col("t_ms_start")), F.lit(" "), F.substring_index("reason", ":", -1))
    return placed.filter(F.col("n") < PREVIEW).join(totals, "slug").select("slug", F.col("n"), line.alias("line"), F.greatest(F.col("all") - PREVIEW, F.lit(0)).alias("more"))


def header_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of each video's documents: length, size, frames due and seen, frames kept and screens."""
    videos = table(spark, sf_dir, "videos")
    screens = table(spark, sf_dir, "screens")
    seen = screens.select("slug", F.explode("frame_ids").alias("f")).filter("f is not null").distinct().groupBy("slug").agg(F.count("*").alias("seen"))
    kept = screens.groupBy("slug").agg(F.count_distinct("representative_frame").alias("kept"), F.count_distinct("id").alias("screens"))
    due = timeline.expected_samples(F.col("duration_s"), 1.0)
    length = format_timecode(F.floor(F.col("duration_s") * 1000).cast("bigint"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return videos.join(seen, "slug", "left").join(kept, "slug", "left").select(
        "slug", length.alias("length"), F.format_string("%dx%d", "width", "height").alias("size"), F.coalesce(due, F.lit(0)).alias("due"), zero("seen"), zero("kept"), zero("screens")
    )


def _in_colour(embedding: Column) -> Column:
    """A 64-vector as an 8 x 8 PNG, red by its values and otherwise grey."""

    @F.arrow_udf("binary")
    def draw(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            red = np.clip(np.rint(128 + frames.SCALE * np.array(v, float)), 0, 255).astype(np.uint8).reshape(8, 8)
            out.append(pixels.encode_png(np.dstack([red, np.full_like(red, 128), np.full_like(red, 128)])))
        return pa.array(out, pa.binary())

    return draw(embedding)


def chrome_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first coloured band of each image that begins early enough and is high enough; none has no row."""
    found = images.kernel(lambda i: None if (b := pixels.chrome_extent(i, **CHROME)) is None else {"top": b[0], "bottom": b[1]}, "struct<top:int,bottom:int>", F.col("image"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", _in_colour(F.col("embedding")).alias("image"))
    return rows.select("vec_id", found.alias("b")).filter("b is not null").select("vec_id", "b.top", "b.bottom")


QUERIES = {f.__name__: f for f in (verdict_reasons, ocr_record, sheet_hints, unreadable_reasons, span_preview, header_full, chrome_bands)}


def _sql() -> dict[str, str]:
    from timeloom.plans.timeline import _clock

    once = "o AS (SELECT slug, id, representative_frame AS frame_id FROM screens QUALIFY row_number() OVER (PARTITION BY slug, id ORDER BY received_at, t_ms_start, t_ms_end) = 1)"
    reads = "r AS (SELECT slug, frame_id, name, tabs FROM readings QUALIFY row_number() OVER (PARTITION BY slug, frame_id ORDER BY reading_id DESC) = 1)"
    row_full = f"list_sum(list_transform(range(1, 9), lambda i: (abs(p[(y * 8 + i)::INT] - 128) > {CHROME['threshold']})::INT)) >= {8 * CHROME['coverage']}"
    return {
        "verdict_reasons": f"""WITH c AS ({signals.SQL["confidence_combine"]}) SELECT l_orderkey, l_linenumber, verdict, CASE WHEN verdict = 'accepted' THEN NULL WHEN l_linenumber = 7 THEN 'glare'
            WHEN coverage < 0.5 THEN 'too little was measured, without: ' || replace(missing, ',', ', ') ELSE 'score ' || format('{{:.4f}}', score) END AS reason FROM c""",
        "ocr_record": f"""WITH a AS ({signals.SQL["join_words"]}), b AS ({signals.SQL["group_by_gaps"]}), {signals._TABS},
            n AS (SELECT slug, id, count(*) FILTER (c >= {signals.LEAST}) AS sure, count(c) AS words FROM tabs LEFT JOIN placed USING (slug, id) GROUP BY slug, id)
            SELECT slug, id, text, confidence, labels, sure::INT AS sure, words::INT AS words FROM a JOIN b USING (slug, id) JOIN n USING (slug, id)""",
        "sheet_hints": f"""WITH {once}, {reads} SELECT o.slug, id, coalesce(o.frame_id, '') || ' | title: ' || coalesce(name, '') || ' | tabs: ' || coalesce(array_to_string(tabs, ', '), '') AS hint
            FROM o LEFT JOIN r ON r.slug = o.slug AND r.frame_id = o.frame_id""",
        "unreadable_reasons": f"""WITH {once}, {reads} SELECT o.slug, id, CASE WHEN r.slug IS NULL THEN 'no reading' ELSE 'no name was read' END AS why
            FROM o LEFT JOIN r ON r.slug = o.slug AND r.frame_id = o.frame_id WHERE r.slug IS NULL OR r.name IS NULL""",
        "span_preview": f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY t_ms_start, span_id) - 1 AS n, count(*) OVER (PARTITION BY slug) AS total
            FROM review_spans WHERE slug IS NOT NULL AND t_ms_start IS NOT NULL AND reason LIKE '02:%')
            SELECT slug, n, {_clock("t_ms_start")} || ' ' || split_part(reason, ':', 2) AS line, greatest(total - {PREVIEW}, 0) AS more FROM p WHERE n < {PREVIEW}""",
        "header_full": f"""WITH s AS (SELECT slug, count(DISTINCT f) AS seen FROM (SELECT slug, unnest(frame_ids) AS f FROM screens) GROUP BY slug),
            k AS (SELECT slug, count(DISTINCT representative_frame) AS kept, count(DISTINCT id) AS screens FROM screens GROUP BY slug),
            v AS (SELECT *, CAST(floor(duration_s * 1000) AS BIGINT) AS ms FROM videos)
            SELECT slug, CASE WHEN ms IS NOT NULL THEN {_clock("ms")} END AS length, width || 'x' || height AS size, CASE WHEN duration_s IS NULL THEN 0 ELSE greatest(CAST(floor(duration_s) AS BIGINT) + 1, 0) END AS due, coalesce(seen, 0) AS seen,
                coalesce(kept, 0) AS kept, coalesce(screens, 0) AS screens FROM v LEFT JOIN s USING (slug) LEFT JOIN k USING (slug)""",
        "chrome_bands": f"""WITH {frames._DRAWN}, rows AS (SELECT vec_id, y FROM drawn, range(0, 8) r(y) WHERE {row_full}),
            runs AS (SELECT vec_id, min(y) AS top, max(y) + 1 AS bottom FROM (SELECT *, y - row_number() OVER (PARTITION BY vec_id ORDER BY y) AS g FROM rows) GROUP BY vec_id, g)
            SELECT vec_id, top::INT AS top, bottom::INT AS bottom FROM runs WHERE bottom - top >= {CHROME["min_height"]} AND top <= {int(8 * CHROME["max_start"])}
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY top) = 1""",
    }


SQL = _sql()
