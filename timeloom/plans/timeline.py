"""Timeline queries: events are the frames of a user's recording."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import timecode
from timeloom.operators import confidence, folds, numbering, timeline
from timeloom.plans.tables import FRAMES_SQL, frames, k_of, table

FPS = 2.0
DAY = 86_400_000
SKIP = [(2 * DAY, 5 * DAY), (20 * DAY, 21 * DAY)]
PINS = [(DAY, 2 * DAY), (DAY + 1000, 4 * DAY), (9 * DAY, 9 * DAY)]
THRESHOLD, WEIGHT, MIN_GAP = 45.0, 0.3, 2
WINDOW, MAX_SPAN = 9, 2
JUMP = {"diagonal": 500.0, "max_jump": 0.10, "min_confidence": 0.2, "after": 3}


def frame_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = timeline.grid(frames(spark, sf_dir).select("user_id", "event_id", "idx"), "idx", FPS)
    return out.withColumn("stamp", timecode.format_stamp(F.col("t_ms")))


def skip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.skip_ranges(frames(spark, sf_dir), "t_ms", SKIP)


def manual_pins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).withColumn("pin", timeline.first_range(F.col("t_ms"), PINS)).filter("pin is not null")


def sample_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos: samples expected at 1 fps, samples taken under a cap of 600, and whether the cap cut any off."""
    expected = timeline.expected_samples(F.col("duration_s"), 1.0)
    return table(spark, sf_dir, "videos").select(
        "slug", expected.alias("expected"), F.least(expected, F.lit(600)).alias("taken"), (expected > 600).alias("truncated")
    )


def video_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Width and height as shown, after rotation."""
    turned = F.pmod(F.abs("rotation"), F.lit(180)) == 90
    return table(spark, sf_dir, "videos").select(
        "slug", F.when(turned, F.col("height")).otherwise(F.col("width")).alias("shown_width"), F.when(turned, F.col("width")).otherwise(F.col("height")).alias("shown_height")
    )


def _folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir, "value", "props").withColumn("k", k_of())
    return folds.last_kept(rows, "user_id", ["idx"], "idx", "value", "k", THRESHOLD, WEIGHT, MIN_GAP, "event_id", in_order=True)


def last_kept_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).drop("segment")


def gap_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).filter("suppressed").select("user_id", "event_id", "distance")


def build_screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens: from each kept frame to the next, with its frames in order."""
    seen = folds.segments(_folded(spark, sf_dir), "user_id", "idx", "event_id")
    return seen.select("user_id", F.format_string("s_%03d", "segment").alias("id"), "first_idx", "last_idx", "n", "representative", F.col("members").alias("frames"))


def corroborating_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last frame of a screen other than the one that stands for it."""
    return _folded(spark, sf_dir).filter("not kept").groupBy("user_id", "segment").agg(F.max_by("event_id", "idx").alias("event_id"))


def contiguous_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir, "event_type").filter("event_type in ('error', 'click')")
    return timeline.islands(rows, ["user_id", "event_type"], "idx")


def median_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir, "value", "event_type").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    out = timeline.median_smooth(rows, "user_id", "idx", "value", WINDOW, F.col("event_type") == "purchase")
    return out.select("user_id", "idx", "smoothed")


def interpolate_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir, "value", "event_type").withColumn("value", F.when(~F.col("event_type").isin("error", "click"), F.col("value")))
    out = timeline.interpolate_gaps(rows, "user_id", "idx", "value", MAX_SPAN)
    return out.select("user_id", "idx", F.bround("filled", 6).alias("filled"), "interpolated")


def jump_reanchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir, "value", "props", "event_type").select(
        "user_id", "idx", "event_id", F.col("value").alias("x"), k_of().cast("double").alias("y"),
        F.when(F.col("event_type") == "error", 0.1).otherwise(0.9).alias("sure"), (F.col("event_type") == "signup").alias("by_hand"),
    )
    return folds.reanchored(rows, "user_id", ["idx"], "event_id", "x", "y", "sure", "by_hand", in_order=True, **JUMP)


def rejected_jumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: positions by method, and the share not found."""
    return jump_reanchor(spark, sf_dir).groupBy("user_id").agg(
        *(F.count_if(F.col("method") == m).alias(m) for m in ("manual", "auto", "reanchor", "jump", "weak")),
        F.avg((F.col("x").isNull()).cast("double")).alias("lost_share"),
    )


def montage_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in sheets of 20 rows."""
    return numbering.chunked(table(spark, sf_dir, "documents").select("doc_id"), 20, "doc_id")


def timecode_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frames(spark, sf_dir).withColumn("t", F.col("t_ms") - 3_600_000)
    return rows.select("event_id", timecode.format_timecode(F.col("t")).alias("clock"), timecode.format_stamp(F.col("t")).alias("stamp"))


def timecode_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fixture_screens").select("fixture_id", timecode.parse_timecode(F.col("t")).alias("t_ms"))


def framing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    method = F.when(F.col("event_type") == "signup", "manual").when(F.col("event_type") == "view", "interpolated").when(F.col("value") < 400, "auto").otherwise("failed")
    framing = F.when(F.col("value") > 2, "full").when(F.col("value") > 0.5, "partial").otherwise("lost")
    return confidence.framing_quality(rows, "user_id", method, framing)


QUERIES = {
    f.__name__: f
    for f in (
        frame_grid, skip_ranges, manual_pins, sample_cap, video_display, last_kept_dedupe, gap_suppressed, build_screens, corroborating_frame,
        contiguous_spans, median_smooth, interpolate_gaps, jump_reanchor, rejected_jumps, montage_chunks, timecode_format, timecode_parse, framing_quality,
    )
}

_FOLD = f"""{FRAMES_SQL}, fold AS (
    SELECT user_id, event_id, idx, NULL::DOUBLE AS distance, true AS kept, false AS suppressed, idx AS ref, value AS band, k AS whole
    FROM frames WHERE idx = 0
    UNION ALL
    SELECT user_id, event_id, idx, d, keep, differs AND NOT keep, CASE WHEN keep THEN idx ELSE ref END, CASE WHEN keep THEN value ELSE band END, CASE WHEN keep THEN k ELSE whole END
    FROM (SELECT *, differs AND idx - ref >= {MIN_GAP} AS keep FROM (SELECT *, d > {THRESHOLD} AS differs FROM (
        SELECT f.user_id, f.event_id, f.idx, f.value, f.k, ref, band, whole,
            CAST(round_even(abs(f.value - band) + {WEIGHT} * abs(f.k - whole), 4) AS DOUBLE) AS d
        FROM fold JOIN frames f ON f.user_id = fold.user_id AND f.idx = fold.idx + 1))))"""
_SEGMENTS = f"{_FOLD}, segs AS (SELECT *, sum(kept::INT) OVER (PARTITION BY user_id ORDER BY idx) - 1 AS segment FROM fold)"
_BUDGET = JUMP["diagonal"] * JUMP["max_jump"]
_TRACK = f"""{FRAMES_SQL}, seen AS (SELECT user_id, idx, event_id, value AS x, k::DOUBLE AS y, event_type = 'error' AS weak, event_type = 'signup' AS hand FROM frames),
    nothing AS (SELECT []::STRUCT(e BIGINT, x DOUBLE, y DOUBLE)[] AS held, []::STRUCT(e BIGINT, m VARCHAR, x DOUBLE, y DOUBLE)[] AS said),
    track AS (
        SELECT DISTINCT user_id, -1::BIGINT AS idx, NULL::DOUBLE AS lx, NULL::DOUBLE AS ly, held, said FROM frames, nothing
        UNION ALL
        SELECT user_id, idx, CASE WHEN hand OR method IN ('auto', 'reanchor') THEN x ELSE lx END, CASE WHEN hand OR method IN ('auto', 'reanchor') THEN y ELSE ly END,
            CASE WHEN method = 'held' THEN more ELSE more[1:0] END,
            CASE method WHEN 'held' THEN said[1:0] WHEN 'reanchor' THEN list_transform(more, lambda h: {{'e': h.e, 'm': 'reanchor', 'x': h.x, 'y': h.y}})
                ELSE list_append(list_transform(held, lambda h: {{'e': h.e, 'm': 'jump', 'x': NULL::DOUBLE, 'y': NULL::DOUBLE}}),
                    {{'e': event_id, 'm': method, 'x': CASE WHEN method <> 'weak' THEN x END, 'y': CASE WHEN method <> 'weak' THEN y END}}) END
        FROM (SELECT *, CASE WHEN hand THEN 'manual' WHEN weak THEN 'weak' WHEN lx IS NULL OR sqrt((x - lx) * (x - lx) + (y - ly) * (y - ly)) <= {_BUDGET} THEN 'auto'
                WHEN len(more) >= {JUMP["after"]} AND list_bool_and(list_transform(range(2, len(more) + 1), lambda i:
                    sqrt((more[i].x - more[i - 1].x) * (more[i].x - more[i - 1].x) + (more[i].y - more[i - 1].y) * (more[i].y - more[i - 1].y)) <= {_BUDGET})) THEN 'reanchor' ELSE 'held' END AS method
              FROM (SELECT s.*, t.lx, t.ly, t.held, t.said, list_append(t.held, {{'e': s.event_id, 'x': s.x, 'y': s.y}}) AS more
                    FROM track t JOIN seen s ON s.user_id = t.user_id AND s.idx = t.idx + 1))),
    told AS (SELECT user_id, unnest(said) AS u FROM track UNION ALL
        SELECT user_id, unnest(list_transform(held, lambda h: {{'e': h.e, 'm': 'jump', 'x': NULL::DOUBLE, 'y': NULL::DOUBLE}}))
        FROM track QUALIFY idx = max(idx) OVER (PARTITION BY user_id)),
    methods AS (SELECT user_id, u.e AS event_id, u.m AS method, u.x AS x, u.y AS y FROM told)"""


def _stamp(t: str) -> str:
    s = f"(greatest({t}, 0) // 1000)"
    return f"CASE WHEN {s} >= 3600 THEN format('{{}}h{{:02d}}m{{:02d}}s', {s} // 3600, {s} % 3600 // 60, {s} % 60) ELSE format('{{:02d}}m{{:02d}}s', {s} // 60, {s} % 60) END"


def _clock(t: str) -> str:
    s = f"(greatest({t}, 0) // 1000)"
    return f"CASE WHEN {s} >= 3600 THEN format('{{}}:{{:02d}}:{{:02d}}', {s} // 3600, {s} % 3600 // 60, {s} % 60) ELSE format('{{:02d}}:{{:02d}}', {s} // 60, {s} % 60) END"


def _sql() -> dict[str, str]:
    from timeloom.plans.general import timecode_sql

    skipped = " OR ".join(f"(t_ms >= {s} AND t_ms < {e})" for s, e in SKIP)
    pins = " ".join(f"WHEN t_ms BETWEEN {s} AND {e} THEN {i}" for i, (s, e) in enumerate(PINS))
    quality = "least(CASE WHEN event_type = 'signup' THEN 1.0 WHEN event_type = 'view' THEN 0.7 WHEN value < 400 THEN 1.0 ELSE 0.0 END::DOUBLE, CASE WHEN value > 2 THEN 1.0 WHEN value > 0.5 THEN 0.25 ELSE 0.0 END::DOUBLE)"
    near = f"ROWS BETWEEN {WINDOW // 2} PRECEDING AND {WINDOW // 2} FOLLOWING"
    return {
        "frame_grid": f"WITH {FRAMES_SQL}, g AS (SELECT user_id, event_id, idx, CAST(round_even(idx * 1000.0 / {FPS}, 0) AS BIGINT) AS t_ms FROM frames) SELECT *, format('f_{{:06d}}', idx) AS frame_id, {_stamp('t_ms')} AS stamp FROM g",
        "skip_ranges": f"WITH {FRAMES_SQL} SELECT user_id, event_id, idx, t_ms FROM frames WHERE NOT ({skipped})",
        "manual_pins": f"WITH {FRAMES_SQL}, p AS (SELECT user_id, event_id, idx, t_ms, CASE {pins} END AS pin FROM frames) SELECT * FROM p WHERE pin IS NOT NULL",
        "sample_cap": "SELECT slug, e AS expected, least(e, 600) AS taken, e > 600 AS truncated FROM (SELECT slug, greatest(CAST(floor(duration_s) AS BIGINT) + 1, 0) AS e FROM videos)".replace("greatest(CAST(floor(duration_s) AS BIGINT) + 1, 0)", "coalesce(greatest(CAST(floor(duration_s) AS BIGINT) + 1, 0), 0)"),
        "video_display": "SELECT slug, CASE WHEN abs(rotation) % 180 = 90 THEN height ELSE width END AS shown_width, CASE WHEN abs(rotation) % 180 = 90 THEN width ELSE height END AS shown_height FROM videos",
        "last_kept_dedupe": f"WITH RECURSIVE {_FOLD} SELECT user_id, event_id, idx, distance, kept, suppressed FROM fold",
        "gap_suppressed": f"WITH RECURSIVE {_FOLD} SELECT user_id, event_id, distance FROM fold WHERE suppressed",
        "build_screens": f"""WITH RECURSIVE {_SEGMENTS} SELECT user_id, format('s_{{:03d}}', segment::BIGINT) AS id, min(idx) AS first_idx, max(idx) AS last_idx, count(*) AS n,
            arg_min(event_id, idx) AS representative, string_agg(event_id::VARCHAR, ',' ORDER BY idx) AS frames FROM segs GROUP BY user_id, segment""",
        "corroborating_frame": f"WITH RECURSIVE {_SEGMENTS} SELECT user_id, segment::BIGINT AS segment, arg_max(event_id, idx) AS event_id FROM segs WHERE NOT kept GROUP BY user_id, segment",
        "contiguous_spans": f"""WITH {FRAMES_SQL}, i AS (SELECT user_id, event_type, idx, idx - row_number() OVER (PARTITION BY user_id, event_type ORDER BY idx) AS g FROM frames WHERE event_type IN ('error', 'click'))
            SELECT user_id, event_type, min(idx) AS first, max(idx) AS last, count(*) AS n FROM i GROUP BY user_id, event_type, g""",
        "median_smooth": f"""WITH {FRAMES_SQL}, v AS (SELECT user_id, idx, event_type, CASE WHEN event_type <> 'error' THEN value END AS v FROM frames)
            SELECT user_id, idx, CASE WHEN v IS NULL OR event_type = 'purchase' OR count(v) OVER w < 2 THEN v ELSE median(v) OVER w END AS smoothed FROM v WINDOW w AS (PARTITION BY user_id ORDER BY idx {near})""",
        "interpolate_gaps": f"""WITH {FRAMES_SQL}, v AS (SELECT user_id, idx, CASE WHEN event_type NOT IN ('error', 'click') THEN value END AS v FROM frames),
            n AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN v IS NOT NULL THEN idx END IGNORE NULLS) OVER b AS pi,
                first_value(v IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN v IS NOT NULL THEN idx END IGNORE NULLS) OVER a AS ni FROM v
                WINDOW b AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
            f AS (SELECT *, coalesce(v IS NULL AND ni - pi - 1 <= {MAX_SPAN}, false) AS interpolated FROM n)
            SELECT user_id, idx, interpolated, CAST(round_even(CASE WHEN interpolated THEN (1 - (idx - pi) / (ni - pi)) * pv + ((idx - pi) / (ni - pi)) * nv ELSE v END, 6) AS DOUBLE) AS filled FROM f""",
        "jump_reanchor": f"WITH RECURSIVE {_TRACK} SELECT * FROM methods",
        "rejected_jumps": f"""WITH RECURSIVE {_TRACK} SELECT user_id, {", ".join(f"count(*) FILTER (method = '{m}') AS {m}" for m in ("manual", "auto", "reanchor", "jump", "weak"))},
            avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE) AS lost_share FROM methods GROUP BY user_id""",
        "montage_chunks": "SELECT doc_id, (n // 20)::BIGINT AS sheet, (n % 20)::BIGINT AS row FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents)",
        "timecode_format": f"WITH {FRAMES_SQL} SELECT event_id, {_clock('t_ms - 3600000')} AS clock, {_stamp('t_ms - 3600000')} AS stamp FROM frames",
        "timecode_parse": f"SELECT fixture_id, {timecode_sql('t')} AS t_ms FROM fixture_screens",
        "framing_quality": f"SELECT user_id, min({quality}) AS framing_quality FROM events GROUP BY user_id",
    }


SQL = _sql()
