"""Queries of the general operators: snapshot changes (p1) and interval periods (p3)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.labels import normalise_label
from timeloom.functions.timecode import parse_timecode
from timeloom.operators import intervals, snapshot_diff
from timeloom.session import checkpoint_dir, materialise

MAX_GAP_MS = 600_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry_digest() -> Column:
    """Hash of what counts of an inventory entry: status (old spelling renewed), set of aliases, route, module."""
    status = F.when(F.col("status") == "patient_scoped", "lookup_scoped").otherwise(F.col("status"))
    aliases = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.coalesce("aliases", F.array().cast("array<string>"))))), "\x02")
    return snapshot_diff.value_hash(status, aliases, F.col("route"), F.col("module"))


def inventory_index(rows: DataFrame) -> DataFrame:
    key = normalise_label(F.col("label"), underscore_breaks=True)
    return snapshot_diff.snapshot_index(rows, F.col("project"), F.col("exported_at"), key, F.col("row_id"), entry_digest(), F.col("label"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff.diff_history(inventory_index(_table(spark, sf_dir, "inventory_snapshots"))).select("row_id", "change")


def p1_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes with old and new values, fetched only for changed entries."""
    rows = _table(spark, sf_dir, "inventory_snapshots")
    found = materialise(snapshot_diff.diff_history(inventory_index(rows)))
    wide = snapshot_diff.fetch_values(found, rows, "row_id", "label", "status", "route", "module")
    return wide.select(
        "row_id", "change", F.col("old_values.label").alias("old_label"), F.col("new_values.label").alias("new_label"),
        F.col("old_values.status").alias("old_status"), F.col("new_values.status").alias("new_status"),
        F.col("old_values.route").alias("old_route"), F.col("new_values.route").alias("new_route"),
    )


def p1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivery of every project against the one before, by the stored index: swap in, probe, swap."""
    index = materialise(inventory_index(_table(spark, sf_dir, "inventory_snapshots")))
    times = index.groupBy("entity").agg(F.sort_array(F.collect_set("snapshot"), asc=False).alias("t"))  # one time per snapshot
    at = lambda n: index.join(times.select("entity", F.get("t", F.lit(n)).alias("snapshot")), ["entity", "snapshot"], "left_semi")
    kept = snapshot_diff.SnapshotIndex(spark, f"{checkpoint_dir(spark)}/snapshot-index-{uuid.uuid4().hex}", buckets=16)
    kept.swap(at(1))
    last = at(0)
    changes = materialise(kept.probe(last).select("row_id", "change"))
    kept.swap(last)
    return changes


def p3_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    review = _table(spark, sf_dir, "review_spans").select("slug", "t_ms_start", "t_ms_end")
    missed = _table(spark, sf_dir, "missed_spans").select("slug", parse_timecode(F.col("from_")).alias("t_ms_start"), parse_timecode(F.col("to_")).alias("t_ms_end"))
    return review.unionByName(missed)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.periods_and_gaps(p3_intervals(spark, sf_dir), "slug", "t_ms_start", "t_ms_end", MAX_GAP_MS)


def p3_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per slug: number of periods and of gaps, and the milliseconds covered."""
    found = p3_found(spark, sf_dir)
    return found.groupBy("slug").agg(
        F.count_if(F.col("kind") == "period").alias("periods"), F.count_if(F.col("kind") == "gap").alias("gaps"),
        F.sum(F.when(F.col("kind") == "period", F.col("t_ms_end") - F.col("t_ms_start")).otherwise(0)).alias("covered_ms"),
    )


QUERIES = {f.__name__: f for f in (p1_found, p1_changes, p1_latest, p3_found, p3_coverage)}

_INDEX = """
    keyed AS (
        SELECT project, exported_at, row_id, label, status, route, module,
            trim(regexp_replace(lower(strip_accents(label)), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g')) AS k,
            concat_ws('|', CASE WHEN status = 'patient_scoped' THEN 'lookup_scoped' ELSE coalesce(status, '~') END,
                array_to_string(list_sort(list_distinct(coalesce(aliases, []))), '^'), coalesce(route, '~'), coalesce(module, '~')) AS v
        FROM inventory_snapshots WHERE label IS NOT NULL AND exported_at IS NOT NULL),
    entries AS (SELECT project, exported_at, k, min(row_id) AS row_id, arg_min(v, row_id) AS v FROM keyed GROUP BY ALL),
    gens AS (SELECT project, exported_at, row_number() OVER (PARTITION BY project ORDER BY exported_at) AS gen,
                lead(exported_at) OVER (PARTITION BY project ORDER BY exported_at) IS NULL AS final
             FROM (SELECT DISTINCT project, exported_at FROM entries)),
    placed AS (SELECT e.*, gen, final FROM entries e JOIN gens g ON e.project IS NOT DISTINCT FROM g.project AND e.exported_at = g.exported_at),
    pairs AS (
        SELECT o.row_id AS old_id, n.row_id AS new_id, o.v AS old_v, n.v AS new_v
        FROM (SELECT * FROM placed WHERE NOT final) o FULL JOIN (SELECT * FROM placed WHERE gen > 1) n
            ON o.project IS NOT DISTINCT FROM n.project AND o.k = n.k AND n.gen = o.gen + 1),
    changes AS (
        SELECT coalesce(new_id, old_id) AS row_id, old_id, new_id,
            CASE WHEN old_id IS NULL THEN 'added' WHEN new_id IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM pairs WHERE old_id IS NULL OR new_id IS NULL OR old_v <> new_v)
"""

_TIMECODE = """
    CASE WHEN regexp_full_match(trim({0}, E' \\t\\n\\r\\f\\v'), '(?:(\\d+):)?(\\d{{1,2}}):(\\d{{1,2}})(?:\\.(\\d{{1,3}}))?') THEN
        (coalesce(try_cast(nullif(regexp_extract(trim({0}, E' \\t\\n\\r\\f\\v'), '^(?:(\\d+):)?(\\d{{1,2}}):(\\d{{1,2}})', 1), '') AS BIGINT), 0) * 3600
         + regexp_extract(trim({0}, E' \\t\\n\\r\\f\\v'), '^(?:(\\d+):)?(\\d{{1,2}}):(\\d{{1,2}})', 2)::BIGINT * 60
         + regexp_extract(trim({0}, E' \\t\\n\\r\\f\\v'), '^(?:(\\d+):)?(\\d{{1,2}}):(\\d{{1,2}})', 3)::BIGINT) * 1000
         + rpad(regexp_extract({0}, '\\.(\\d{{1,3}})', 1), 3, '0')::BIGINT
    WHEN regexp_full_match(trim({0}, E' \\t\\n\\r\\f\\v'), '\\d+(\\.\\d{{1,3}})?') THEN
        regexp_extract({0}, '(\\d+)', 1)::BIGINT * 1000 + rpad(regexp_extract({0}, '\\.(\\d{{1,3}})', 1), 3, '0')::BIGINT
    END"""


def timecode_sql(column: str) -> str:
    return _TIMECODE.format(column)


_PERIODS = f"""
    spans AS (
        SELECT slug, t_ms_start AS s, t_ms_end AS e FROM review_spans
        UNION ALL SELECT slug, {timecode_sql("from_")}, {timecode_sql("to_")} FROM missed_spans),
    ordered AS (
        SELECT slug, s, e, max(e) OVER (PARTITION BY slug ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM spans WHERE slug IS NOT NULL AND s <= e),
    numbered AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS p FROM ordered),
    periods AS (SELECT slug, p, min(s) AS s, max(e) AS e FROM numbered GROUP BY slug, p),
    found AS (
        SELECT slug, 'period' AS kind, s AS t_ms_start, e AS t_ms_end FROM periods
        UNION ALL SELECT slug, 'gap', e, following FROM (SELECT *, lead(s) OVER (PARTITION BY slug ORDER BY p) AS following FROM periods)
        WHERE following - e <= {MAX_GAP_MS})
"""

SQL = {
    "p1_found": f"WITH {_INDEX} SELECT row_id, change FROM changes",
    "p1_changes": f"""WITH {_INDEX} SELECT c.row_id, c.change, o.label AS old_label, n.label AS new_label, o.status AS old_status,
        n.status AS new_status, o.route AS old_route, n.route AS new_route
        FROM changes c LEFT JOIN inventory_snapshots o ON o.row_id = c.old_id LEFT JOIN inventory_snapshots n ON n.row_id = c.new_id""",
    "p1_latest": f"""WITH {_INDEX}, last_gen AS (SELECT project, max(gen) AS g FROM gens GROUP BY project),
        o AS (SELECT placed.* FROM placed JOIN last_gen l ON placed.project IS NOT DISTINCT FROM l.project AND gen = g - 1),
        n AS (SELECT placed.* FROM placed JOIN last_gen l ON placed.project IS NOT DISTINCT FROM l.project AND gen = g AND g > 1)
        SELECT coalesce(n.row_id, o.row_id) AS row_id,
            CASE WHEN o.row_id IS NULL THEN 'added' WHEN n.row_id IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM o FULL JOIN n ON o.project IS NOT DISTINCT FROM n.project AND o.k = n.k
        WHERE o.row_id IS NULL OR n.row_id IS NULL OR o.v <> n.v""",
    "p3_found": f"WITH {_PERIODS} SELECT * FROM found",
    "p3_coverage": f"""WITH {_PERIODS} SELECT slug, count(*) FILTER (kind = 'period') AS periods, count(*) FILTER (kind = 'gap') AS gaps,
        sum(CASE WHEN kind = 'period' THEN t_ms_end - t_ms_start ELSE 0 END)::BIGINT AS covered_ms FROM found GROUP BY slug""",
}
