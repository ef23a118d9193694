"""Queries of the stages: sampling of the videos, framing of the recorded tracks, classification, and the documents of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.plans import documents, matching, run
from timeloom.plans.tables import frames, k_of, table
from timeloom.plans.timeline import _TRACK, JUMP, _clock
from timeloom.session import materialise

FPS, CAP, SKIP = 1.0, 240, [(60_000, 90_000)]
SIZE, WINDOW = (300, 100), 9
SCOPE = ["Yard", "utilities", "Finance  Desk", "Visitors", "Stores", "QUAYSIDE"]
PARTIAL = ["sawmill 1 calibration", "Cold-Store Calibration", "No Such Screen"]


def screens_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens without repeated deliveries, with all that documents show of them."""
    rows = table(spark, sf_dir, "screens").select("slug", "id", F.struct("received_at", "t_ms_start", "t_ms_end", "representative_frame", "identity", "confidence").alias("d"))
    once = rows.groupBy("slug", "id").agg(F.min("d").alias("d"))
    shown = ("name", "module", "tabs", "dialog", "description")
    return once.select("slug", "id", "d.t_ms_start", "d.t_ms_end", "d.representative_frame", *(F.col(f"d.identity.{c}").alias(c) for c in shown), "d.confidence")


def _sample(spark: SparkSession, sf_dir: str) -> run.Result:
    return run.sample(run.probe(table(spark, sf_dir, "videos")).rows, FPS, CAP, SKIP)


def sampled_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).rows


def sample_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(spark, sf_dir).spans


def _rectified(spark: SparkSession, sf_dir: str) -> run.Result:
    rows = frames(spark, sf_dir, "value", "props", "event_type").select(
        F.col("user_id").cast("string").alias("slug"), F.col("idx").alias("position"), "idx", "t_ms", F.format_string("f_%06d", "idx").alias("frame_id"),
        F.col("value").alias("x"), k_of().cast("double").alias("y"), F.when(F.col("event_type") == "error", 0.1).otherwise(0.9).alias("sure"), (F.col("event_type") == "signup").alias("by_hand"),
    )
    return run.rectify(rows, None, SIZE, WINDOW, JUMP["diagonal"], JUMP["max_jump"], JUMP["min_confidence"], JUMP["after"], in_order=True)


def framed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rectified(spark, sf_dir).rows.select("slug", "idx", "method", "framing")


def framing_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of frames without a screen or with one that leaves the frame, and where a track was found again elsewhere."""
    return _rectified(spark, sf_dir).spans


def _classified(spark: SparkSession, sf_dir: str) -> run.Result:
    return run.classify(screens_whole(spark, sf_dir), table(spark, sf_dir, "inventory_list"), matching.CORRECTIONS, matching.THRESHOLD, matching.MARGIN, SCOPE, PARTIAL)


def bucket_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every screen with its match, its bucket under scope and partial labels, and what the match says for its reading."""
    return _classified(spark, sf_dir).rows.select("slug", "id", "match_kind", "match_score", "matched_label", "possible_label", "bucket", "evidence", "inventory_match")


def classify_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).spans.select("slug", "t_ms_start", "reason", "detail", "frames")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.catalogue(_classified(spark, sf_dir).rows)


def build_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.queue(_classified(spark, sf_dir).rows)


def emit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video: screens by bucket, those accepted, and the first that needs review."""
    rows = _classified(spark, sf_dir).rows
    return rows.groupBy("slug").agg(
        *(F.count_if(F.col("bucket") == b).alias(b) for b in ("built", "partial", "new", "other")), F.count_if(F.col("confidence.verdict") == "accepted").alias("accepted"),
        F.min(F.when(F.col("confidence.verdict") == "review", F.col("t_ms_start"))).alias("first_review_ms"),
    )


def review_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review list of every video, spans without a start at the end; repeated spans stand as often as they were delivered."""
    spans = table(spark, sf_dir, "review_spans").filter("slug is not null")
    return documents.review(materialise(spans.select("slug", "t_ms_start", "t_ms_end", "reason", "detail", documents.frames_shown(F.col("frame_ids")).alias("frames"))))


QUERIES = {
    f.__name__: f
    for f in (sampled_frames, sample_spans, framed_frames, framing_spans, bucket_full, classify_spans, catalogue, build_queue, emit_counts, review_document)
}


def _sql() -> dict[str, str]:
    grid = f"""counted AS (SELECT slug, duration_s, coalesce(greatest(CAST(floor(duration_s * {FPS}) AS BIGINT) + 1, 0), 0) AS expected FROM videos),
        grid AS (SELECT slug, i AS idx, CAST(round_even(i * 1000.0 / {FPS}, 0) AS BIGINT) AS t_ms, format('f_{{:06d}}', i) AS frame_id FROM counted, range(0, least(expected, {CAP})) r(i))"""
    skipped = " OR ".join(f"(t_ms >= {s} AND t_ms < {e})" for s, e in SKIP)
    near = f"ROWS BETWEEN {WINDOW // 2} PRECEDING AND {WINDOW // 2} FOLLOWING"
    smooth = lambda c: f"CASE WHEN {c} IS NULL OR method = 'manual' OR count({c}) OVER w < 2 THEN {c} ELSE median({c}) OVER w END AS s{c}"
    beside = lambda c: f"last_value(s{c} IGNORE NULLS) OVER b AS p{c}, first_value(s{c} IGNORE NULLS) OVER a AS n{c}"
    fill = lambda c: f"CASE WHEN filled THEN (1 - (idx - pi) / (ni - pi)) * p{c} + ((idx - pi) / (ni - pi)) * n{c} ELSE s{c} END AS {c}"
    framed = f"""{_TRACK}, placed AS (SELECT m.user_id, f.idx, f.t_ms, m.method, m.x, m.y FROM methods m JOIN frames f ON f.user_id = m.user_id AND f.event_id = m.event_id),
        smoothed AS (SELECT *, {smooth("x")}, {smooth("y")} FROM placed WINDOW w AS (PARTITION BY user_id ORDER BY idx {near})),
        sided AS (SELECT *, {beside("x")}, {beside("y")}, last_value(CASE WHEN sx IS NOT NULL THEN idx END IGNORE NULLS) OVER b AS pi, first_value(CASE WHEN sx IS NOT NULL THEN idx END IGNORE NULLS) OVER a AS ni
            FROM smoothed WINDOW b AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        whole AS (SELECT user_id, idx, t_ms, method AS track, filled, {fill("x")}, {fill("y")} FROM (SELECT *, coalesce(sx IS NULL AND ni - pi - 1 <= {WINDOW}, false) AS filled FROM sided)),
        framed AS (SELECT user_id::VARCHAR AS slug, idx, t_ms, track, CASE WHEN x IS NULL THEN 'failed' WHEN track = 'manual' THEN 'manual' WHEN filled THEN 'interpolated' ELSE 'auto' END AS method,
            CASE WHEN x IS NULL THEN 'lost' WHEN least(x, y) <= 2 OR x >= {SIZE[0] - 3} OR y >= {SIZE[1] - 3} THEN 'partial' ELSE 'full' END AS framing FROM whole),
        kinds AS (SELECT slug, idx, t_ms, framing AS kind FROM framed WHERE framing <> 'full' UNION ALL SELECT slug, idx, t_ms, 'reanchor' FROM framed WHERE track = 'reanchor'),
        placed_runs AS (SELECT *, idx - row_number() OVER (PARTITION BY slug, kind ORDER BY idx) AS g FROM kinds),
        pieces AS (SELECT *, CASE WHEN kind = 'reanchor' THEN (row_number() OVER (PARTITION BY slug, kind, g ORDER BY idx) - 1) // {max(JUMP["after"], 2)} ELSE 0 END AS piece FROM placed_runs),
        runs AS (SELECT slug, kind, min(idx) AS first, max(idx) AS last, count(*) AS n, arg_min(t_ms, idx) AS t_ms_start, arg_max(t_ms, idx) AS t_ms_end FROM pieces GROUP BY slug, kind, g, piece)"""
    once = """once AS (SELECT slug, id, t_ms_start, t_ms_end, representative_frame, identity.name AS name, identity.module AS module, identity.tabs AS tabs, identity.dialog AS dialog,
        identity.description AS description, confidence.score AS score, confidence.verdict AS verdict FROM screens QUALIFY row_number() OVER (PARTITION BY slug, id ORDER BY received_at, t_ms_start, t_ms_end) = 1)"""
    scope = ", ".join(f"'{run.normalise_label_text(m)}'" for m in SCOPE)
    partial = ", ".join(f"'{run.normalise_label_text(p)}'" for p in PARTIAL)
    known = f"""{once}, {matching.cascade_sql(f"SELECT slug || '/' || id AS reading_id, {matching.norm_sql('name')} AS norm FROM once")},
        entries AS (SELECT *, CASE WHEN coalesce({matching.norm_sql("module")}, '') NOT IN ({scope}) THEN 'other' WHEN status IN ('built', 'lookup_scoped', 'patient_scoped') THEN
            CASE WHEN {matching.norm_sql("label")} IN ({partial}) THEN 'partial' ELSE 'built' END ELSE 'new' END AS entry_bucket FROM inventory_list),
        classified AS (SELECT o.*, m.norm, match_kind, match_score, matched_ord, e.label AS matched_label, possible_label, coalesce(entry_bucket, 'new') AS bucket, e.route, e.module AS entry_module,
            CASE WHEN matched_ord IS NULL THEN NULL ELSE concat_ws(' · ', e.status, nullif(e.source, '')) END AS evidence
            FROM once o JOIN matched m ON m.reading_id = o.slug || '/' || o.id LEFT JOIN entries e ON e.entry_id = m.matched_ord)"""
    cell = lambda c: f"regexp_replace(replace(coalesce({c}, '—'), '|', '\\|'), '\\s*\\n\\s*', ' ', 'g')"
    row = lambda *cells: "'| ' || " + " || ' | ' || ".join(cell(c) for c in cells) + " || ' |'"
    clock = _clock("t_ms_start")
    content = """coalesce(nullif(concat_ws('; ', CASE WHEN len(tabs) > 0 THEN 'tabs: ' || array_to_string(tabs, ', ') END, 'dialog: ' || nullif(dialog, ''), nullif(description, '')), ''), '—')"""
    sure = "format('{:.2f}', score) || CASE WHEN verdict = 'accepted' THEN '' ELSE ' ⚠️' END"
    asks = f"""asks AS (SELECT slug, 'near-miss' AS question, CASE WHEN coalesce(name, '') <> '' THEN norm ELSE id END AS subject, t_ms_start, id, representative_frame AS frames,
            CASE WHEN match_kind = 'subset' THEN '07:contained-name' ELSE '07:near-miss-match' END AS reason, 'read as ' || coalesce(name, '') || '; nearest entry ' || possible_label AS detail
            FROM classified WHERE matched_ord IS NULL AND possible_label IS NOT NULL AND (match_kind = 'subset' OR match_score >= {matching.THRESHOLD} - {matching.MARGIN})
        UNION ALL SELECT slug, 'confirm-partial', {matching.norm_sql("matched_label")}, t_ms_start, id, representative_frame, '07:confirm-partial',
            matched_label || ' is built; seen: ' || coalesce(array_to_string(tabs, ', '), '') || '; ' || coalesce(dialog, '') FROM classified WHERE bucket = 'built' AND (len(tabs) > 0 OR coalesce(dialog, '') <> ''))"""
    shown = "coalesce(array_to_string(frame_ids[1:12], ', ') || CASE WHEN len(frame_ids) > 12 THEN ' (+' || (len(frame_ids) - 12) || ' more)' ELSE '' END, '')"
    window = f"CASE WHEN t_ms_start IS NULL THEN '—' ELSE {clock} END || CASE WHEN t_ms_end > t_ms_start THEN '–' || {_clock('t_ms_end')} ELSE '' END"
    return {
        "sampled_frames": f"WITH {grid} SELECT slug, idx, t_ms, frame_id FROM grid WHERE NOT ({skipped})",
        "sample_spans": f"""WITH {grid} SELECT slug, CAST(round_even({CAP} * 1000.0 / {FPS}, 0) AS BIGINT) AS t_ms_start, CAST(round_even(duration_s * 1000, 0) AS BIGINT) AS t_ms_end,
            '01:not-sampled' AS reason, '{CAP} of ' || expected || ' frames are sampled' AS detail, NULL::VARCHAR AS frames FROM counted WHERE expected > {CAP}""",
        "framed_frames": f"WITH RECURSIVE {framed} SELECT slug, idx, method, framing FROM framed",
        "framing_spans": f"""WITH RECURSIVE {framed} SELECT slug, t_ms_start, t_ms_end,
            CASE kind WHEN 'lost' THEN '02:screen-not-found' WHEN 'partial' THEN '02:screen-partial' ELSE '02:reanchor' END AS reason,
            CASE WHEN kind = 'reanchor' THEN 'found again elsewhere: was the camera moved?' ELSE n || ' frames' END AS detail,
            CASE WHEN first = last THEN format('f_{{:06d}}', first) ELSE format('f_{{:06d}}–f_{{:06d}}', first, last) END AS frames FROM runs""",
        "bucket_full": f"""WITH {known} SELECT slug, id, match_kind, match_score, matched_label, possible_label, bucket, evidence,
            CASE WHEN match_kind = 'none' THEN CASE WHEN possible_label IS NOT NULL THEN {run.UNMATCHED_LIKELY}::DOUBLE ELSE {run.UNMATCHED_UNLIKE}::DOUBLE END ELSE match_score END AS inventory_match FROM classified""",
        "classify_spans": f"""WITH {known}, {asks} SELECT slug, t_ms_start, reason, detail, frames FROM asks
            QUALIFY row_number() OVER (PARTITION BY slug, question, subject ORDER BY t_ms_start, id) = 1""",
        "catalogue": f"""WITH {known}, placed AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY t_ms_start, id) AS n FROM classified)
            SELECT slug, n, {row("n::VARCHAR", clock, "coalesce(nullif(name, ''), '**unread**')", "coalesce(nullif(module, ''), nullif(entry_module, ''), '—')", "bucket", sure, content)} AS line FROM placed""",
        "build_queue": f"""WITH {known}, queued AS (SELECT * REPLACE (coalesce(nullif(module, ''), nullif(entry_module, ''), 'Unassigned') AS module), CASE WHEN bucket = 'partial' THEN 0 ELSE 1 END AS rank FROM classified WHERE bucket IN ('partial', 'new'))
            SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY rank, module, t_ms_start, id) AS n, bucket, module,
                concat_ws('; ', '- ' || coalesce(nullif(name, ''), '**unread**') || ' at ' || {clock} || ', frame ' || coalesce(representative_frame, '—'), 'route ' || nullif(route, ''), 'resembles ' || possible_label,
                    CASE WHEN verdict = 'review' THEN 'see review' END) AS line FROM queued""",
        "emit_counts": f"""WITH {known} SELECT slug, {", ".join(f"count(*) FILTER (bucket = '{b}') AS {b}" for b in ("built", "partial", "new", "other"))},
            count(*) FILTER (verdict = 'accepted') AS accepted, min(t_ms_start) FILTER (verdict = 'review') AS first_review_ms FROM classified GROUP BY slug""",
        "review_document": f"""WITH listed AS (SELECT slug, t_ms_start, t_ms_end, reason, detail, {shown} AS frames FROM review_spans WHERE slug IS NOT NULL),
            placed AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY t_ms_start IS NULL, t_ms_start, reason, t_ms_end NULLS FIRST, detail NULLS FIRST, frames NULLS FIRST) AS n FROM listed)
            SELECT slug, n, {row(window, "CASE WHEN contains(reason, ':') THEN reason[strpos(reason, ':') + 1:] END", "split_part(reason, ':', 1)", "detail", "frames")} AS line FROM placed""",
    }


SQL = _sql()
