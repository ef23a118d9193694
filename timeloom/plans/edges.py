"""Queries of small projections at the edges of stages: orientation, hints, what is missing, what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.plans.tables import table

STAGES = ("01", "02", "04", "05", "06", "07")
STRIP_PX = 44  # fixed value: lower strips of a sheet cannot be read


def orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored size against a 16:9 or 9:16 frame of the same width after rotation: equal, swapped or other."""
    turned = F.pmod(F.abs("rotation"), F.lit(180)) == 90
    w, h = F.when(turned, F.col("height")).otherwise(F.col("width")), F.when(turned, F.col("width")).otherwise(F.col("height"))
    said = F.when((w == F.col("width")) & (h == F.col("height")), "equal").when((w == F.col("height")) & (h == F.col("width")), "swapped").otherwise("other")
    return table(spark, sf_dir, "videos").select("slug", said.alias("orientation"))


def missing_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages expected of each video of which no review span tells."""
    seen = table(spark, sf_dir, "review_spans").groupBy("slug").agg(F.collect_set(F.get(F.split("reason", ":", 2), F.lit(0))).alias("s"))
    return seen.select("slug", F.array_join(F.array_except(F.array(*map(F.lit, STAGES)), "s"), ",").alias("missing"))


def reading_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was read of a screen, as the lines of a question; blanks where nothing was."""
    line = lambda label, c: F.concat(F.lit(label + ": "), F.coalesce(c, F.lit("")))
    rows = table(spark, sf_dir, "readings")
    return rows.select("reading_id", F.concat_ws("\n", line("title", F.col("name")), line("tabs", F.array_join("tabs", " | ")), line("section", F.col("section"))).alias("hints"))


def reading_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as identities, with why a reading cannot be used."""
    rows = table(spark, sf_dir, "readings")
    why = F.when(F.coalesce("unreadable", F.lit("")) != "", F.col("unreadable")).when(F.coalesce(F.trim("name"), F.lit("")) == "", F.lit("no name was read"))
    return rows.select("reading_id", "name", "module", F.size("tabs").alias("tabs"), F.col("structure").alias("description"), why.alias("why"))


def unreadable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video: readings, unreadable ones, those without a name, and the share of them."""
    rows = table(spark, sf_dir, "readings")
    nameless = F.coalesce(F.trim("name"), F.lit("")) == ""
    return rows.groupBy("slug").agg(
        F.count("*").alias("readings"), F.count("unreadable").alias("unreadable"), F.count_if(nameless).alias("nameless"), F.bround(F.avg(nameless.cast("double")), 4).alias("nameless_share")
    )


def derived_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of screens of which there is a reading (a semi join), by video."""
    members = table(spark, sf_dir, "screens").select("slug", F.explode("frame_ids").alias("frame_id")).distinct()
    return members.join(table(spark, sf_dir, "readings").select("slug", "frame_id"), ["slug", "frame_id"], "left_semi").groupBy("slug").agg(F.count("*").alias("frames"))


def legible_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos whose band, scaled to a sheet of 1568 pixels, stays high enough to be read."""
    strip = F.bround(F.lit(190.0) * 1568 / F.col("width")).cast("int")
    return table(spark, sf_dir, "videos").select("slug", strip.alias("strip_px")).filter(F.col("strip_px") >= STRIP_PX)


def span_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review spans as messages."""
    message = F.format_string("%s: %s (%d ms)", F.col("slug"), F.col("reason"), F.col("t_ms_end") - F.col("t_ms_start"))
    return table(spark, sf_dir, "review_spans").filter("t_ms_start <= t_ms_end").select("span_id", message.alias("message"))


QUERIES = {f.__name__: f for f in (orientation, missing_stages, reading_hints, reading_identity, unreadable_counts, derived_frames, legible_sheets, span_messages)}

_W, _H = "CASE WHEN abs(rotation) % 180 = 90 THEN height ELSE width END", "CASE WHEN abs(rotation) % 180 = 90 THEN width ELSE height END"
SQL = {
    "orientation": f"SELECT slug, CASE WHEN {_W} = width AND {_H} = height THEN 'equal' WHEN {_W} = height AND {_H} = width THEN 'swapped' ELSE 'other' END AS orientation FROM videos",
    "missing_stages": f"""WITH s AS (SELECT slug, list(DISTINCT split_part(reason, ':', 1)) AS seen FROM review_spans GROUP BY slug)
        SELECT slug, array_to_string(list_filter([{", ".join(f"'{s}'" for s in STAGES)}], lambda x: NOT list_contains(seen, x)), ',') AS missing FROM s""",
    "reading_hints": "SELECT reading_id, 'title: ' || coalesce(name, '') || chr(10) || 'tabs: ' || coalesce(array_to_string(tabs, ' | '), '') || chr(10) || 'section: ' || coalesce(section, '') AS hints FROM readings",
    "reading_identity": """SELECT reading_id, name, module, len(tabs)::INT AS tabs, structure AS description,
        CASE WHEN coalesce(unreadable, '') <> '' THEN unreadable WHEN coalesce(trim(name), '') = '' THEN 'no name was read' END AS why FROM readings""",
    "unreadable_counts": """SELECT slug, count(*) AS readings, count(unreadable) AS unreadable, count(*) FILTER (coalesce(trim(name), '') = '') AS nameless,
        CAST(round_even(avg(CASE WHEN coalesce(trim(name), '') = '' THEN 1.0 ELSE 0.0 END::DOUBLE), 4) AS DOUBLE) AS nameless_share FROM readings GROUP BY slug""",
    "derived_frames": """WITH m AS (SELECT DISTINCT slug, unnest(frame_ids) AS frame_id FROM screens)
        SELECT slug, count(*) AS frames FROM m WHERE (slug, frame_id) IN (SELECT (slug, frame_id) FROM readings WHERE frame_id IS NOT NULL) GROUP BY slug""",
    "legible_sheets": f"SELECT slug, strip_px FROM (SELECT slug, CAST(round_even(190.0::DOUBLE * 1568 / width, 0) AS INT) AS strip_px FROM videos) WHERE strip_px >= {STRIP_PX}",
    "span_messages": "SELECT span_id, slug || ': ' || reason || ' (' || (t_ms_end - t_ms_start) || ' ms)' AS message FROM review_spans WHERE t_ms_start <= t_ms_end",
}
