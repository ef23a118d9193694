"""Review queries: a run against recorded truth, state tables, and what goes into the review documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timeloom.functions.timecode import format_timecode, parse_timecode
from timeloom.operators import numbering, state, verify
from timeloom.plans.tables import table

TOLERANCE = verify.tolerance_ms(1.0)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fixture_screens").select(F.col("fixture_id").alias("key"), F.col("slug").alias("entity"), F.col("fixture_id").alias("ord"), parse_timecode(F.col("t")).alias("t")).filter("t is not null")


def screens_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens without repeated deliveries."""
    rows = table(spark, sf_dir, "screens").select("slug", "id", "t_ms_start", "t_ms_end", F.col("identity.name").alias("name"), F.col("identity.module").alias("module"), "confidence", "received_at")
    return rows.groupBy("slug", "id").agg(F.min(F.struct("received_at", "t_ms_start", "t_ms_end", "name", "module", "confidence")).alias("d")).select("slug", "id", "d.*")


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screens_once(spark, sf_dir).select(F.col("slug").alias("entity"), "id", F.col("t_ms_start").alias("span_ord"), F.col("t_ms_start").alias("t_start"), F.col("t_ms_end").alias("t_end"))


def fixture_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.greedy_match(_points(spark, sf_dir), _spans(spark, sf_dir), TOLERANCE).select(F.col("key").alias("fixture_id"), F.col("entity").alias("slug"), "id", "distance")


def unfixtured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screens no fixture row claims."""
    return screens_once(spark, sf_dir).select("slug", "id", "t_ms_start").join(fixture_match(spark, sf_dir).select("slug", "id"), ["slug", "id"], "left_anti")


def near_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a fixture row and a screen within the tolerance."""
    return verify.near_pairs(_points(spark, sf_dir), _spans(spark, sf_dir), TOLERANCE).select(F.col("key").alias("fixture_id"), "id", "distance")


def gap_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = table(spark, sf_dir, "missed_spans").select(F.col("missed_id").alias("key"), F.col("slug").alias("entity"), parse_timecode(F.col("from_")).alias("t_start"), parse_timecode(F.col("to_")).alias("t_end"))
    gaps = gaps.filter("t_start <= t_end")
    return verify.covered_gaps(gaps, _spans(spark, sf_dir), TOLERANCE).select(F.col("key").alias("missed_id"), "covered")


def field_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected name and module of each fixture row against those of the screen it claims."""
    expected = table(spark, sf_dir, "fixture_screens").select("fixture_id", F.col("name").alias("x_name"), F.col("module").alias("x_module"))
    actual = screens_once(spark, sf_dir).select("slug", "id", "name", "module")
    pairs = fixture_match(spark, sf_dir).join(expected, "fixture_id").join(actual, ["slug", "id"]).withColumnRenamed("fixture_id", "key")
    return verify.field_differences(pairs, {"name": ("x_name", "name", "regression"), "module": ("x_module", "module", "regression")})


def delivery_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and module of a reading against the screen its frame stands for."""
    reads = table(spark, sf_dir, "readings").select(F.col("reading_id").alias("key"), "slug", "frame_id", F.col("name").alias("x_name"), F.col("module").alias("x_module"))
    shown = table(spark, sf_dir, "screens").select("slug", F.col("representative_frame").alias("frame_id"), F.col("identity.name").alias("name"), F.col("identity.module").alias("module"))
    shown = shown.groupBy("slug", "frame_id").agg(F.min("name").alias("name"), F.min("module").alias("module"))
    return verify.field_differences(reads.join(shown, ["slug", "frame_id"]), {"name": ("x_name", "name", "regression"), "module": ("x_module", "module", "drift")})


def finding_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all kinds by status: missing screens, differences, screens not in the fixture, gaps open and closed."""
    matched = fixture_match(spark, sf_dir)
    lost = _points(spark, sf_dir).join(matched.select(F.col("fixture_id").alias("key")), "key", "left_anti").select(F.lit("regression").alias("status"))
    differing = field_diff(spark, sf_dir).select("status")
    extra = unfixtured(spark, sf_dir).select(F.lit("unfixtured").alias("status"))
    gaps = gap_closure(spark, sf_dir).select(F.when(F.col("covered"), "closed").otherwise("gap").alias("status"))
    return lost.unionByName(differing).unionByName(extra).unionByName(gaps).groupBy("status").agg(F.count("*").alias("findings"))


def replace_by_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review spans after stage 02 ran again and found only one span per slug; counted by owner."""
    spans = table(spark, sf_dir, "review_spans").select("slug", "t_ms_start", "t_ms_end", "reason")
    again = spans.groupBy("slug").agg(F.min("t_ms_start").alias("t_ms_start"), F.max("t_ms_end").alias("t_ms_end")).withColumn("reason", F.lit("02:screen-not-found"))
    now = state.replace_by_owner(spans, again, state.owner_of_reason(), "02")
    return now.groupBy(state.owner_of_reason().alias("owner")).agg(F.count("*").alias("spans"), F.min("t_ms_start").alias("first_ms"))


def stale_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects whose recorded module digests are not those of the newest export of all."""
    rows = table(spark, sf_dir, "inventory_snapshots").filter("module is not null")
    digest = F.left(F.sha2(F.array_join(F.array_sort(F.collect_set("route")), ","), 256), F.lit(16)).alias("digest")
    recorded = rows.groupBy("project", F.col("module").alias("section")).agg(digest)
    current = rows.groupBy(F.col("module").alias("section")).agg(digest)
    return state.stale(recorded, current, ["project"], "section", "digest")


def review_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review spans numbered in the order of the review list, with their reason taken apart and their first frames."""
    rows = table(spark, sf_dir, "review_spans").filter("t_ms_start is not null").select("span_id", "t_ms_start", "reason", "frame_ids")
    ordered = numbering.numbered(rows.select("t_ms_start", "reason", "span_id"), "t_ms_start", "reason", "span_id")
    shown = F.concat(F.array_join(F.slice("frame_ids", 1, 12), ", "), F.when(F.size("frame_ids") > 12, F.format_string(" (+%d more)", F.size("frame_ids") - 12)).otherwise(""))
    return ordered.join(rows.select("span_id", F.coalesce(shown, F.lit("")).alias("frames")), "span_id").select(
        "span_id", F.col("position") + 1, format_timecode(F.col("t_ms_start")).alias("at"), F.get(F.split("reason", ":", 2), F.lit(0)).alias("stage"), F.get(F.split("reason", ":", 2), F.lit(1)).alias("why"), "frames"
    ).withColumnRenamed("(position + 1)", "n")


def queue_by_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries to build per module: stubs and disabled ones, numbered by label."""
    rows = table(spark, sf_dir, "inventory_list").filter("status in ('stub', 'disabled')")
    module = F.coalesce(F.nullif("module", F.lit("")), F.lit("Unassigned"))
    evidence = F.concat_ws(" · ", "status", F.nullif("source", F.lit("")))
    placed = numbering.numbered_within(rows.select(module.alias("module"), "label", "entry_id", evidence.alias("evidence")), "module", "label", "entry_id", name="n")
    return placed.select("module", (F.col("n") + 1).cast("int").alias("n"), "label", "evidence")


def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "fixture_screens").groupBy(F.coalesce("bucket", F.lit("unclassified")).alias("bucket")).agg(F.count("*").alias("screens"), F.count("name").alias("named"))


def header_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per video: screens, those named and accepted, and the first that needs review."""
    return screens_once(spark, sf_dir).groupBy("slug").agg(
        F.count("*").alias("screens"), F.count("name").alias("named"), F.count_if(F.col("confidence.verdict") == "accepted").alias("accepted"),
        F.min(F.when(F.col("confidence.verdict") == "review", F.col("t_ms_start"))).alias("first_review_ms"),
    )


def screen_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of each screen taken out of its list, against the readings of these frames."""
    members = table(spark, sf_dir, "screens").select("slug", "id", F.explode("frame_ids").alias("frame_id")).distinct()
    reads = table(spark, sf_dir, "readings").select("slug", "frame_id", "reading_id")
    return members.join(reads, ["slug", "frame_id"]).groupBy("slug", "id").agg(F.count("*").alias("readings"), F.max("reading_id").alias("last_reading"))


def commit_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a project's snapshots in a row: whether their commits agree as far as both are given (7 digits at least)."""
    snaps = table(spark, sf_dir, "inventory_snapshots").groupBy("project", "exported_at").agg(F.min(F.lower("generated_from.commit")).alias("commit"))
    before = F.lag("commit").over(Window.partitionBy("project").orderBy("exported_at"))
    rows = snaps.withColumn("previous", before)
    same = state.commits_agree(F.col("commit"), F.col("previous"))
    return rows.select("project", "exported_at", F.when(same.isNull(), "unknown").when(same, "same").otherwise("moved").alias("state"))


QUERIES = {
    f.__name__: f
    for f in (
        fixture_match, unfixtured, near_fixtures, gap_closure, field_diff, delivery_diff, finding_counts, replace_by_owner, stale_stages, review_sorted,
        queue_by_module, bucket_counts, header_counts, screen_members, commit_freshness,
    )
}


def _greedy() -> dict[str, str]:
    """CTEs that other queries use too: ``once``, and (recursive) the claims of fixture rows with what follows from them."""
    from timeloom.plans.general import timecode_sql

    once = """once AS (SELECT * FROM (SELECT slug, id, t_ms_start, t_ms_end, identity.name AS name, identity.module AS module, confidence, received_at FROM screens)
        QUALIFY row_number() OVER (PARTITION BY slug, id ORDER BY received_at, t_ms_start, t_ms_end) = 1)"""
    pts = f"pts AS (SELECT * FROM (SELECT fixture_id, slug, {timecode_sql('t')} AS t FROM fixture_screens) WHERE t IS NOT NULL)"
    greedy = f"""{once}, {pts}, near AS (
            SELECT fixture_id, pts.slug, id, t_ms_start, CASE WHEN t BETWEEN t_ms_start AND t_ms_end THEN 0 ELSE least(abs(t - t_ms_start), abs(t - t_ms_end)) END AS distance
            FROM pts JOIN once ON pts.slug = once.slug WHERE t BETWEEN t_ms_start - {TOLERANCE} AND t_ms_end + {TOLERANCE}),
        asked AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY fixture_id) AS n FROM (
            SELECT slug, fixture_id, list(id ORDER BY distance, t_ms_start, id) AS wanted FROM near GROUP BY slug, fixture_id)),
        claims AS (
            SELECT DISTINCT slug, 0::BIGINT AS n, []::VARCHAR[] AS taken, NULL::BIGINT AS fixture_id, NULL::VARCHAR AS id FROM asked
            UNION ALL
            SELECT slug, n, CASE WHEN pick IS NULL THEN taken ELSE list_append(taken, pick) END, fixture_id, pick
            FROM (SELECT a.slug, a.n, a.fixture_id, c.taken, list_filter(a.wanted, lambda w: NOT list_contains(c.taken, w))[1] AS pick
                  FROM claims c JOIN asked a ON a.slug = c.slug AND a.n = c.n + 1)),
        matched AS (SELECT fixture_id, slug, id, distance FROM claims JOIN near USING (fixture_id, slug, id)),
        extra AS (SELECT slug, id, t_ms_start FROM once WHERE (slug, id) NOT IN (SELECT (slug, id) FROM matched)),
        compared AS (SELECT fixture_id, f.name AS x_name, f.module AS x_module, o.name, o.module FROM matched JOIN fixture_screens f USING (fixture_id) JOIN once o ON o.slug = matched.slug AND o.id = matched.id),
        differing AS (
            SELECT fixture_id AS key, 'name' AS field, 'regression' AS status, x_name AS expected, name AS actual FROM compared WHERE coalesce(x_name, '') <> '' AND x_name IS DISTINCT FROM name
            UNION ALL SELECT fixture_id, 'module', 'regression', x_module, module FROM compared WHERE coalesce(x_module, '') <> '' AND x_module IS DISTINCT FROM module)"""
    return {"once": once, "pts": pts, "greedy": greedy}


GREEDY = _greedy()


def _sql() -> dict[str, str]:
    from timeloom.plans.general import timecode_sql
    from timeloom.plans.timeline import _clock

    once, pts, greedy = GREEDY["once"], GREEDY["pts"], GREEDY["greedy"]
    gaps = f"gaps AS (SELECT * FROM (SELECT missed_id, slug, {timecode_sql('from_')} AS s, {timecode_sql('to_')} AS e FROM missed_spans) WHERE s <= e)"
    closed = f"{gaps}, closing AS (SELECT missed_id, EXISTS (SELECT 1 FROM once o WHERE o.slug = gaps.slug AND t_ms_start <= e + {TOLERANCE} AND t_ms_end >= s - {TOLERANCE}) AS covered FROM gaps)"
    differs = lambda n, s: f"SELECT reading_id AS key, '{n}' AS field, '{s}' AS status, r.{n} AS expected, p.{n} AS actual FROM readings r JOIN p USING (slug, frame_id) WHERE coalesce(r.{n}, '') <> '' AND r.{n} IS DISTINCT FROM p.{n}"
    return {
        "fixture_match": f"WITH RECURSIVE {greedy} SELECT * FROM matched",
        "unfixtured": f"WITH RECURSIVE {greedy} SELECT * FROM extra",
        "field_diff": f"WITH RECURSIVE {greedy} SELECT * FROM differing",
        "finding_counts": f"""WITH RECURSIVE {greedy}, {closed} SELECT status, count(*) AS findings FROM (
            SELECT 'regression' AS status FROM pts WHERE fixture_id NOT IN (SELECT fixture_id FROM matched) UNION ALL SELECT status FROM differing
            UNION ALL SELECT 'unfixtured' FROM extra UNION ALL SELECT CASE WHEN covered THEN 'closed' ELSE 'gap' END FROM closing) GROUP BY status""",
        "near_fixtures": f"""WITH {once}, {pts} SELECT fixture_id, id, CASE WHEN t BETWEEN t_ms_start AND t_ms_end THEN 0 ELSE least(abs(t - t_ms_start), abs(t - t_ms_end)) END AS distance
            FROM pts JOIN once USING (slug) WHERE t BETWEEN t_ms_start - {TOLERANCE} AND t_ms_end + {TOLERANCE}""",
        "gap_closure": f"WITH {once}, {gaps} SELECT missed_id, EXISTS (SELECT 1 FROM once o WHERE o.slug = gaps.slug AND t_ms_start <= e + {TOLERANCE} AND t_ms_end >= s - {TOLERANCE}) AS covered FROM gaps",
        "delivery_diff": f"""WITH p AS (SELECT slug, representative_frame AS frame_id, min(identity.name) AS name, min(identity.module) AS module FROM screens GROUP BY ALL)
            {differs("name", "regression")} UNION ALL {differs("module", "drift")}""",
        "replace_by_owner": """WITH n AS (SELECT t_ms_start, split_part(reason, ':', 1) AS owner FROM review_spans WHERE split_part(reason, ':', 1) <> '02'
            UNION ALL SELECT min(t_ms_start), '02' FROM review_spans GROUP BY slug) SELECT owner, count(*) AS spans, min(t_ms_start) AS first_ms FROM n GROUP BY owner""",
        "stale_stages": """WITH r AS (SELECT project, module, left(sha256(coalesce(string_agg(DISTINCT route, ',' ORDER BY route), '')), 16) AS d FROM inventory_snapshots WHERE module IS NOT NULL GROUP BY ALL),
            c AS (SELECT module, left(sha256(coalesce(string_agg(DISTINCT route, ',' ORDER BY route), '')), 16) AS d FROM inventory_snapshots WHERE module IS NOT NULL GROUP BY ALL)
            SELECT project, string_agg(module, ',' ORDER BY module) AS stale_sections FROM r JOIN c USING (module) WHERE r.d <> c.d GROUP BY project""",
        "review_sorted": f"""SELECT span_id, row_number() OVER (ORDER BY t_ms_start, reason, span_id) AS n, {_clock("t_ms_start")} AS at, split_part(reason, ':', 1) AS stage,
            CASE WHEN contains(reason, ':') THEN reason[strpos(reason, ':') + 1:] END AS why,
            coalesce(array_to_string(frame_ids[1:12], ', ') || CASE WHEN len(frame_ids) > 12 THEN ' (+' || (len(frame_ids) - 12) || ' more)' ELSE '' END, '') AS frames
            FROM review_spans WHERE t_ms_start IS NOT NULL""",
        "queue_by_module": """SELECT coalesce(nullif(module, ''), 'Unassigned') AS module, row_number() OVER (PARTITION BY coalesce(nullif(module, ''), 'Unassigned') ORDER BY label, entry_id)::INT AS n, label,
            concat_ws(' · ', status, nullif(source, '')) AS evidence FROM inventory_list WHERE status IN ('stub', 'disabled')""",
        "bucket_counts": "SELECT coalesce(bucket, 'unclassified') AS bucket, count(*) AS screens, count(name) AS named FROM fixture_screens GROUP BY 1",
        "header_counts": f"""WITH {once} SELECT slug, count(*) AS screens, count(name) AS named, count(*) FILTER (confidence.verdict = 'accepted') AS accepted,
            min(t_ms_start) FILTER (confidence.verdict = 'review') AS first_review_ms FROM once GROUP BY slug""",
        "screen_members": """WITH m AS (SELECT DISTINCT slug, id, unnest(frame_ids) AS frame_id FROM screens)
            SELECT slug, id, count(*) AS readings, max(reading_id) AS last_reading FROM m JOIN readings USING (slug, frame_id) GROUP BY slug, id""",
        "commit_freshness": """WITH s AS (SELECT project, exported_at, min(lower(generated_from.commit)) AS c FROM inventory_snapshots GROUP BY ALL),
            p AS (SELECT *, lag(c) OVER (PARTITION BY project ORDER BY exported_at) AS b FROM s)
            SELECT project, exported_at, CASE WHEN c IS NULL OR b IS NULL THEN 'unknown' WHEN least(length(c), length(b)) >= 7 AND left(c, least(length(c), length(b))) = left(b, least(length(c), length(b))) THEN 'same' ELSE 'moved' END AS state FROM p""",
    }


SQL = _sql()
