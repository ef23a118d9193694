"""What a run tells people: catalogue, build queue and review list as numbered lines of Markdown for each video."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions.timecode import format_timecode
from timeloom.operators.numbering import numbered_within
from timeloom.sources.documents import markdown_cell

NOTHING, UNREAD, UNASSIGNED = "—", "**unread**", "Unassigned"
QUEUED = ("partial", "new")  # in this order


def fixed2(value: Column) -> Column:
    """Two digits, rounded half to even on the binary value; null stays null."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else f"{v:.2f}" for v in values.to_pylist()], pa.string())

    return run(value.cast("double"))


def _filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def confidence_cell(score: Column, verdict: Column) -> Column:
    return F.coalesce(F.concat(fixed2(score), F.when(verdict == "accepted", "").otherwise(" ⚠️")), F.lit(NOTHING))


def content_cell(tabs: Column, dialog: Column, description: Column) -> Column:
    seen = F.when(F.size(tabs) > 0, F.concat(F.lit("tabs: "), F.array_join(tabs, ", ")))
    said = F.concat_ws("; ", seen, F.concat(F.lit("dialog: "), _filled(dialog)), _filled(description))
    return F.coalesce(_filled(said), F.lit(NOTHING))


def module_of(read: Column, entry: Column, otherwise: str) -> Column:
    return F.coalesce(_filled(read), _filled(entry), F.lit(otherwise))


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(c.cast("string")) for c in cells)), F.lit(" |"))


def catalogue(screens: DataFrame) -> DataFrame:
    """(slug, n, line): every screen in the order of the footage."""
    placed = numbered_within(screens.select("slug", "t_ms_start", "id", "name", "module", "entry_module", "bucket", "confidence", "tabs", "dialog", "description"), "slug", "t_ms_start", "id", name="n")
    name = F.coalesce(_filled(F.col("name")), F.lit(UNREAD))
    cells = (
        F.col("n") + 1, format_timecode(F.col("t_ms_start")), name, module_of(F.col("module"), F.col("entry_module"), NOTHING), F.coalesce("bucket", F.lit(NOTHING)),
        confidence_cell(F.col("confidence.score"), F.col("confidence.verdict")), content_cell(F.col("tabs"), F.col("dialog"), F.col("description")),
    )
    return placed.select("slug", (F.col("n") + 1).alias("n"), _row(*cells).alias("line"))


def queue(screens: DataFrame) -> DataFrame:
    """(slug, n, bucket, module, line): what is to be built, partial ones first, by module, in the order of the footage."""
    rows = screens.filter(F.col("bucket").isin(*QUEUED)).select(
        "slug", F.when(F.col("bucket") == QUEUED[0], 0).otherwise(1).alias("rank"), module_of(F.col("module"), F.col("entry_module"), UNASSIGNED).alias("module"), "t_ms_start", "id",
        "bucket", "name", "representative_frame", "route", "possible_label", "confidence",
    )
    placed = numbered_within(rows, "slug", "rank", "module", "t_ms_start", "id", name="n")
    line = F.concat_ws(
        "; ", F.concat(F.lit("- "), F.coalesce(_filled(F.col("name")), F.lit(UNREAD)), F.lit(" at "), format_timecode(F.col("t_ms_start")), F.lit(", frame "), F.coalesce("representative_frame", F.lit(NOTHING))),
        F.concat(F.lit("route "), _filled(F.col("route"))), F.concat(F.lit("resembles "), F.col("possible_label")),
        F.when(F.col("confidence.verdict") == "review", F.lit("see review")),
    )
    return placed.select("slug", (F.col("n") + 1).alias("n"), "bucket", "module", line.alias("line"))


def review(spans: DataFrame) -> DataFrame:
    """(slug, n, line): every span in the order of the footage; spans without a start come last."""
    rows = spans.select("slug", F.col("t_ms_start").isNull().alias("unplaced"), "t_ms_start", "reason", "t_ms_end", "detail", "frames")
    placed = numbered_within(rows, "slug", "unplaced", "t_ms_start", "reason", "t_ms_end", "detail", "frames", name="n")
    end = F.when(F.col("t_ms_end") > F.col("t_ms_start"), F.concat(F.lit("–"), format_timecode(F.col("t_ms_end"))))
    window = F.concat(F.coalesce(format_timecode(F.col("t_ms_start")), F.lit(NOTHING)), F.coalesce(end, F.lit("")))
    parts = F.split("reason", ":", 2)
    return placed.select("slug", (F.col("n") + 1).alias("n"), _row(window, F.get(parts, F.lit(1)), F.get(parts, F.lit(0)), F.col("detail"), F.col("frames")).alias("line"))


def warnings(told: DataFrame) -> DataFrame:
    """(slug, n, line): the warnings of a run by stage."""
    placed = numbered_within(told.select("slug", "stage", "message"), "slug", "stage", "message", name="n")
    return placed.select("slug", (F.col("n") + 1).alias("n"), F.concat(F.lit("- stage "), "stage", F.lit(": "), "message").alias("line"))


def frames_shown(frame_ids: Column, most: int = 12) -> Column:
    """The first frames of a list, and how many more there are."""
    more = F.when(F.size(frame_ids) > most, F.format_string(" (+%d more)", F.size(frame_ids) - most)).otherwise("")
    return F.coalesce(F.concat(F.array_join(F.slice(frame_ids, 1, most), ", "), more), F.lit(""))
