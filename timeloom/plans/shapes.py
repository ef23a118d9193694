"""Queries of geometry, parsing, state changes and lookups over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import geometry
from timeloom.functions.labels import normalise_label
from timeloom.functions.timecode import format_timecode, parse_range, parse_timecode
from timeloom.operators import numbering, resolve, state, verify
from timeloom.plans import matching, review, run
from timeloom.plans.tables import k_of, table
from timeloom.sources import documents

RECT = (0, 100, 1600, 900)
BANDS = {"title": (0.0, 0.4, 0.0, 0.5), "tabs": (0.5, 1.0, 0.1, 1.0), "none": (0.3, 0.3, 0.0, 1.0)}
SHEET_ROWS = 20


def quad_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quadrilaterals spanned by the values of each event, their corners given out of order: centre, area, aspect, whether they
    touch the edge of a 700 x 260 frame, and the first corner once ordered."""
    v, k = F.col("value"), k_of().cast("double")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    corners = F.array(point(v + 110, k + 70), point(v, k), point(v - 3, k + 60), point(v + 100, k + 5))
    rows = table(spark, sf_dir, "events").select("event_id", geometry.order_corners(corners).alias("q"))
    centre = geometry.centre(F.col("q"))
    return rows.select(
        "event_id", F.bround(centre["x"], 6).alias("x"), F.bround(centre["y"], 6).alias("y"), F.bround(geometry.area(F.col("q")), 4).alias("area"), F.bround(geometry.aspect(F.col("q")), 6).alias("aspect"),
        geometry.touches_border(F.col("q"), F.lit(700.0), F.lit(260.0)).alias("touches"), F.bround(F.get("q", F.lit(0))["x"], 6).alias("first_x"),
        F.bround(geometry.distance(F.get("q", F.lit(0)), F.get("q", F.lit(2))), 6).alias("diagonal"),
    )


def crop_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle cut to each video's frame, and its bands that are not empty."""
    rows = table(spark, sf_dir, "videos").select("slug", "width", geometry.crop_bounds(RECT, F.col("width"), F.col("height")).alias("c"))
    bands = geometry.band_rects(F.col("c.y"), F.col("c.y") + F.col("c.h"), F.col("width"), BANDS)
    long = rows.select("slug", "c.w", "c.h", F.explode(bands).alias("band", "r"))
    return long.select("slug", "w", "h", "band", F.concat_ws(",", "r.x", "r.y", "r.w", "r.h").alias("rect"))


def parsed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missed spans with two readable time codes in order, as ranges."""
    rows = table(spark, sf_dir, "missed_spans").filter(parse_timecode(F.col("from_")) < parse_timecode(F.col("to_")))
    return rows.select("missed_id", parse_range(F.col("from_"), F.col("to_")).alias("r")).select("missed_id", "r.*")


def tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tolerance in time of a video against a fixture taken at 1 frame a second, and against one at its own rate."""
    return table(spark, sf_dir, "videos").select("slug", verify.tolerance_of(F.col("fps"), F.lit(1.0)).alias("to_fixture_ms"), verify.tolerance_of(F.col("fps"), F.lit(None)).alias("own_ms"))


def probe_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers of a container probe, written from the videos, read back: rates as fractions, durations at two places,
    rotations signed or as tags, a sound stream first."""
    v = table(spark, sf_dir, "videos")
    text = F.format_string(
        '{"streams":[{"codec_type":"audio"},{"codec_type":"video","codec_name":%s,"width":%d,"height":%d,"avg_frame_rate":"0/0","r_frame_rate":"%d/1000","duration":"N/A",%s}],"format":{"duration":"%s"}}',
        F.coalesce(F.concat(F.lit('"'), "codec", F.lit('"')), F.lit("null")), "width", "height", F.bround(F.col("fps") * 1000).cast("bigint"),
        F.when(F.col("rotation") >= 180, F.format_string('"side_data_list":[{"rotation":%d}]', F.col("rotation") - 360)).otherwise(F.format_string('"tags":{"rotate":"%d"}', "rotation")),
        F.coalesce(F.col("duration_s").cast("string"), F.lit("")),
    )
    return v.select("slug", documents.parse_probe(text).alias("p")).select("slug", "p.width", "p.height", "p.fps", "p.duration_s", "p.rotation", "p.codec")


def fixture_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture entry that each screen would have, names quoted."""
    once = review.screens_once(spark, sf_dir)
    return documents.fixture_lines(once).select("slug", "t_ms_start", "block")


def upserted_screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens as first delivered, those delivered again put in their place."""
    rows = table(spark, sf_dir, "screens").groupBy("slug", "id").agg(F.min("received_at").alias("first"), F.max("received_at").alias("last"))
    again = rows.filter("last > first").select("slug", "id", F.col("last").alias("received_at"))
    return state.upsert(rows.select("slug", "id", F.col("first").alias("received_at")), again, "slug", "id")


def cascade_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left per stage when stage 05 and all after it are taken back."""
    spans = table(spark, sf_dir, "review_spans").withColumn("stage", state.owner_of_reason())
    return state.cascade_delete(spans, "stage", "05").groupBy("stage").agg(F.count("*").alias("spans"))


def orientation_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos whose frames, were they as stored, would not have the size they are shown at."""
    videos = table(spark, sf_dir, "videos")
    sizes = videos.select("slug", F.col("width").alias("frame_width"), F.col("height").alias("frame_height"))
    return run.sample(run.probe(videos).rows, 1.0, 10_000, [], sizes).spans.filter("reason = '01:orientation-mismatch'").select("slug", "t_ms_start", "t_ms_end", "detail")


def shadowed_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names read, proposed as aliases of the first entry of their module: those that are the label of another entry."""
    entries = table(spark, sf_dir, "inventory_list")
    labels = matching.names(spark, sf_dir).filter("name_ord = 0").select("norm", "entry_ord", "name_ord")
    owner = entries.groupBy("module").agg(F.min("entry_id").alias("entry_ord"))
    read = table(spark, sf_dir, "readings").select("module", normalise_label(F.col("name")).alias("norm")).filter("norm <> ''").distinct()
    proposed = read.join(owner, "module").select("norm", "entry_ord", F.lit(1).alias("name_ord"))
    return resolve.shadowing_aliases(labels.unionByName(proposed))


def unresolved_screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run.unresolved(review.screens_once(spark, sf_dir), False).select("slug", "id")


def corroborating_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last other frame of a screen that was read says, brought back to its screen."""
    screens = table(spark, sf_dir, "screens").select("slug", "id", "representative_frame", F.posexplode("frame_ids").alias("place", "frame_id"))
    others = screens.filter("frame_id is not null and (representative_frame is null or frame_id <> representative_frame)")
    reads = table(spark, sf_dir, "readings").filter("frame_id is not null").groupBy("slug", "frame_id").agg(F.max_by("name", "reading_id").alias("name"))
    last = others.join(reads.select("slug", "frame_id"), ["slug", "frame_id"], "left_semi").groupBy("slug", "id").agg(F.max(F.struct("place", "frame_id")).alias("m"))
    return last.select("slug", "id", "m.frame_id").join(reads, ["slug", "frame_id"]).select("slug", "id", "frame_id", "name")


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slug, t_ms, status, subject, detail) of everything in which a run and its fixture differ."""
    matched = review.fixture_match(spark, sf_dir)
    points = review._points(spark, sf_dir)
    lost = points.join(matched.select(F.col("fixture_id").alias("key")), "key", "left_anti").select(F.col("entity").alias("slug"), F.col("t").alias("t_ms"), F.lit("regression").alias("status"), F.col("key").cast("string").alias("subject"), F.lit("no longer seen").alias("detail"))
    differing = review.field_diff(spark, sf_dir).join(points.select("key", F.col("entity").alias("slug"), F.col("t").alias("t_ms")), "key")
    detail = F.concat_ws("", "field", F.lit(": "), "expected", F.lit(" is "), F.coalesce("actual", F.lit("nothing")))
    differing = differing.select("slug", "t_ms", "status", F.col("key").cast("string").alias("subject"), detail.alias("detail"))
    extra = review.unfixtured(spark, sf_dir).select("slug", F.col("t_ms_start").alias("t_ms"), F.lit("unfixtured").alias("status"), F.col("id").alias("subject"), F.lit("not in the fixture").alias("detail"))
    return lost.unionByName(differing).unionByName(extra)


def findings_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings of each video in the order of the footage, as messages."""
    placed = numbering.numbered_within(_findings(spark, sf_dir).filter("slug is not null"), "slug", "t_ms", "status", "subject", "detail", name="n")
    message = F.concat(format_timecode(F.col("t_ms")), F.lit(" "), "status", F.lit(" "), "subject", F.lit(": "), "detail")
    return placed.select("slug", (F.col("n") + 1).alias("n"), message.alias("message"))


def finding_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video: findings by kind, and whether any is a regression."""
    return _findings(spark, sf_dir).groupBy("slug").agg(
        F.count_if(F.col("status") == "regression").alias("regressions"), F.count_if(F.col("status") == "unfixtured").alias("unfixtured"), F.bool_or(F.col("status") == "regression").alias("failed")
    )


def sheet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video: sheets of its screens, and those of which every screen has been read already."""
    once = review.screens_once(spark, sf_dir)
    frames = table(spark, sf_dir, "screens").groupBy("slug", "id").agg(F.min_by("representative_frame", F.struct("received_at", "t_ms_start", "t_ms_end")).alias("frame_id"))
    placed = numbering.numbered_within(once.select("slug", "t_ms_start", "id").join(frames, ["slug", "id"]), "slug", "t_ms_start", "id", name="n")
    read = table(spark, sf_dir, "readings").select("slug", "frame_id").distinct().withColumn("read", F.lit(True))
    sheets = placed.join(read, ["slug", "frame_id"], "left").groupBy("slug", F.floor(F.col("n") / SHEET_ROWS).alias("sheet")).agg(F.bool_and(F.coalesce("read", F.lit(False))).alias("cached"))
    return sheets.groupBy("slug").agg(F.count("*").alias("sheets"), F.count_if("cached").alias("cached"))


def strip_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of each screen's strip on a sheet, and the paths of its frame in the sets of frames."""
    once = table(spark, sf_dir, "screens").groupBy("slug", "id").agg(F.min(F.struct("received_at", "t_ms_start", "t_ms_end", "representative_frame")).alias("d")).select("slug", "id", "d.*")
    raw = F.concat(F.lit("frames/raw/"), "slug", F.lit("/"), "representative_frame", F.lit(".png"))
    label = F.concat("id", F.lit(" · "), format_timecode(F.col("t_ms_start")))
    return once.select("slug", "id", label.alias("label"), documents.sibling_path(raw, "kept").alias("kept"), documents.sibling_path(raw, "rect").alias("rect"))


QUERIES = {
    f.__name__: f
    for f in (
        quad_shapes, crop_rects, parsed_ranges, tolerances, probe_parse, fixture_blocks, upserted_screens, cascade_deleted, orientation_spans, shadowed_proposals, unresolved_screens,
        corroborating_names, findings_sorted, finding_flags, sheet_counts, strip_labels,
    )
}


def _sql() -> dict[str, str]:
    from timeloom.plans.general import timecode_sql
    from timeloom.plans.timeline import _clock

    rnd = lambda e, n: f"CAST(round_even({e}, {n}) AS DOUBLE)"
    dist = lambda i, j: f"sqrt((q[{i}].x - q[{j}].x) * (q[{i}].x - q[{j}].x) + (q[{i}].y - q[{j}].y) * (q[{i}].y - q[{j}].y))"
    cross = lambda i, j: f"(q[{i}].x * q[{j}].y - q[{j}].x * q[{i}].y)"
    once, greedy = review.GREEDY["once"], review.GREEDY["greedy"]
    cut = f"SELECT slug, width, least({max(RECT[0], 0)}, width) AS x, least({max(RECT[1], 0)}, height) AS y, least({RECT[0] + RECT[2]}, width) AS r, least({RECT[1] + RECT[3]}, height) AS b FROM videos"
    bands = " UNION ALL ".join(
        f"""SELECT slug, w, h, '{n}' AS band, CAST(round_even(width * {x0}::DOUBLE, 0) AS INT) AS bx, y + CAST(round_even(h * {y0}::DOUBLE, 0) AS INT) AS byy,
            CAST(round_even(width * {x1}::DOUBLE, 0) AS INT) - CAST(round_even(width * {x0}::DOUBLE, 0) AS INT) AS bw, CAST(round_even(h * {y1}::DOUBLE, 0) AS INT) - CAST(round_even(h * {y0}::DOUBLE, 0) AS INT) AS bh FROM c"""
        for n, (y0, y1, x0, x1) in BANDS.items()
    )
    quoted = lambda c: f"""coalesce('"' || replace(replace({c}, '\\', '\\\\'), '"', '\\"') || '"', 'null')"""
    findings = f"""{greedy}, findings AS (
        SELECT pts.slug, t AS t_ms, 'regression' AS status, fixture_id::VARCHAR AS subject, 'no longer seen' AS detail FROM pts WHERE fixture_id NOT IN (SELECT fixture_id FROM matched)
        UNION ALL SELECT pts.slug, t, status, key::VARCHAR, field || ': ' || expected || ' is ' || coalesce(actual, 'nothing') FROM differing JOIN pts ON pts.fixture_id = key
        UNION ALL SELECT slug, t_ms_start, 'unfixtured', id, 'not in the fixture' FROM extra)"""
    w = "CASE WHEN abs(rotation) % 180 = 90 THEN height ELSE width END"
    h = "CASE WHEN abs(rotation) % 180 = 90 THEN width ELSE height END"
    return {
        "quad_shapes": f"""WITH c AS (SELECT event_id, value AS v, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
            q AS (SELECT event_id, [{{'x': v, 'y': k}}, {{'x': v + 100, 'y': k + 5}}, {{'x': v + 110, 'y': k + 70}}, {{'x': v - 3, 'y': k + 60}}] AS q FROM c)
            SELECT event_id, {rnd("(q[1].x + q[2].x + q[3].x + q[4].x) / 4", 6)} AS x, {rnd("(q[1].y + q[2].y + q[3].y + q[4].y) / 4", 6)} AS y,
                {rnd(f"abs({cross(1, 2)} + {cross(2, 3)} + {cross(3, 4)} + {cross(4, 1)}) / 2", 4)} AS area,
                {rnd(f"(({dist(1, 2)} + {dist(4, 3)}) / 2) / (({dist(1, 4)} + {dist(2, 3)}) / 2)", 6)} AS aspect,
                list_bool_or(list_transform(q, lambda p: p.x <= 2 OR p.y <= 2 OR p.x >= 697 OR p.y >= 257)) AS touches, {rnd("q[1].x", 6)} AS first_x, {rnd(dist(1, 3), 6)} AS diagonal FROM q""",
        "crop_rects": f"""WITH cut AS ({cut}), c AS (SELECT slug, width, y, greatest(r, x) - x AS w, greatest(b, y) - y AS h FROM cut), bands AS ({bands})
            SELECT slug, w, h, band, bx || ',' || byy || ',' || bw || ',' || bh AS rect FROM bands WHERE bw >= 1 AND bh >= 1""",
        "parsed_ranges": f"SELECT missed_id, s AS t_ms_start, e AS t_ms_end FROM (SELECT missed_id, {timecode_sql('from_')} AS s, {timecode_sql('to_')} AS e FROM missed_spans) WHERE s < e",
        "tolerances": """SELECT slug, CASE WHEN least(fps, 1.0) > 0 THEN CAST(trunc(2000.0 / least(fps, 1.0)) AS BIGINT) ELSE 2000 END AS to_fixture_ms,
            CASE WHEN fps > 0 THEN CAST(trunc(2000.0 / fps) AS BIGINT) ELSE 2000 END AS own_ms FROM videos""",
        "probe_parse": """SELECT slug, width, height, CASE WHEN fps > 0 THEN CAST(round_even(fps * 1000, 0) AS DOUBLE) / 1000 END AS fps, CASE WHEN duration_s > 0 THEN duration_s END AS duration_s,
            rotation % 360 AS rotation, codec FROM videos""",
        "fixture_blocks": f"""WITH {once} SELECT slug, t_ms_start, concat_ws(chr(10), '  - t: ' || {quoted(_clock("t_ms_start"))}, '    name: ' || {quoted("name")}, '    module: ' || {quoted("module")}) AS block FROM once""",
        "upserted_screens": "SELECT slug, id, max(received_at) AS received_at FROM screens GROUP BY slug, id",
        "cascade_deleted": "SELECT split_part(reason, ':', 1) AS stage, count(*) AS spans FROM review_spans WHERE split_part(reason, ':', 1) < '05' GROUP BY 1",
        "orientation_spans": f"""SELECT slug, 0::BIGINT AS t_ms_start, CAST(floor(duration_s) AS BIGINT) * 1000 AS t_ms_end,
            'frames are ' || width || 'x' || height || ' where ' || {w} || 'x' || {h} || ' was due (' || CASE WHEN {w} = height AND {h} = width THEN 'swapped' ELSE 'other' END || ')' AS detail
            FROM videos WHERE duration_s >= 0 AND NOT ({w} = width AND {h} = height)""",
        "shadowed_proposals": f"""WITH l AS (SELECT entry_id AS label_ord, {matching.norm_sql("label")} AS norm FROM inventory_list), o AS (SELECT module, min(entry_id) AS alias_ord FROM inventory_list GROUP BY module)
            SELECT DISTINCT norm, alias_ord, label_ord FROM (SELECT DISTINCT module, {matching.norm_sql("name")} AS norm FROM readings) r JOIN o USING (module) JOIN l USING (norm) WHERE norm <> '' AND alias_ord <> label_ord""",
        "unresolved_screens": f"WITH {once} SELECT slug, id FROM once WHERE name IS NULL",
        "corroborating_names": """WITH m AS (SELECT slug, id, representative_frame, unnest(frame_ids) AS frame_id, generate_subscripts(frame_ids, 1) AS place FROM screens),
            r AS (SELECT slug, frame_id, name FROM readings WHERE frame_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slug, frame_id ORDER BY reading_id DESC) = 1)
            SELECT m.slug, id, m.frame_id, name FROM m JOIN r ON r.slug = m.slug AND r.frame_id = m.frame_id WHERE representative_frame IS NULL OR m.frame_id <> representative_frame
            QUALIFY row_number() OVER (PARTITION BY m.slug, id ORDER BY place DESC, m.frame_id DESC) = 1""",
        "findings_sorted": f"""WITH RECURSIVE {findings} SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY t_ms, status, subject, detail) AS n,
            {_clock("t_ms")} || ' ' || status || ' ' || subject || ': ' || detail AS message FROM findings WHERE slug IS NOT NULL""",
        "finding_flags": f"""WITH RECURSIVE {findings} SELECT slug, count(*) FILTER (status = 'regression') AS regressions, count(*) FILTER (status = 'unfixtured') AS unfixtured,
            bool_or(status = 'regression') AS failed FROM findings GROUP BY slug""",
        "sheet_counts": f"""WITH o AS (SELECT slug, id, t_ms_start, representative_frame AS frame_id FROM screens QUALIFY row_number() OVER (PARTITION BY slug, id ORDER BY received_at, t_ms_start, t_ms_end) = 1),
            p AS (SELECT *, (row_number() OVER (PARTITION BY slug ORDER BY t_ms_start, id) - 1) // {SHEET_ROWS} AS sheet FROM o),
            s AS (SELECT p.slug, sheet, bool_and(r.slug IS NOT NULL) AS cached FROM p LEFT JOIN (SELECT DISTINCT slug, frame_id FROM readings) r ON r.slug = p.slug AND r.frame_id = p.frame_id GROUP BY p.slug, sheet)
            SELECT slug, count(*) AS sheets, count(*) FILTER (cached) AS cached FROM s GROUP BY slug""",
        "strip_labels": f"""SELECT slug, id, id || ' · ' || {_clock("t_ms_start")} AS label, 'frames/kept/' || slug || '/' || representative_frame || '.png' AS kept,
            'frames/rect/' || slug || '/' || representative_frame || '.png' AS rect FROM screens QUALIFY row_number() OVER (PARTITION BY slug, id ORDER BY received_at, t_ms_start, t_ms_end) = 1""",
    }


SQL = _sql()
