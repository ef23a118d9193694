"""Queries of the training-data operators, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.timecode import parse_timecode
from timeloom.llm import ledger, lookalike, matching, mixture, nearest, runs, tokens
from timeloom.plans.general import timecode_sql
from timeloom.session import materialise

TOLERANCE_MS = 2_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match_names(_table(spark, sf_dir, "readings"), _table(spark, sf_dir, "inventory_list"), "reading_id", "name")


def p2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names that stand for no entry, in comparable form, with how often each was read."""
    readings = _table(spark, sf_dir, "readings")
    none = p2_found(spark, sf_dir).filter("entry_id = -1").select("reading_id")
    plain = F.trim(F.lower(F.regexp_replace("name", r"[^\p{L}\p{N}]+", " ")))
    found = readings.select("reading_id", plain.alias("name")).join(none, "reading_id")
    return found.groupBy("name").agg(F.count("*").alias("readings"), F.min("reading_id").alias("first_reading_id"))


def p2_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct name as it is searched for, with all entries within reach and their cost."""
    return matching.name_candidates(_table(spark, sf_dir, "readings"), _table(spark, sf_dir, "inventory_list"), "reading_id", "name")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = runs.collapse(_table(spark, sf_dir, "screens"))
    return found.select(F.col("entity").alias("slug"), F.col("first_id").alias("first_screen_id"), F.col("last_id").alias("last_screen_id"))


def p4_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapsed_runs(_table(spark, sf_dir, "screens"))


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "fixture_screens").select(F.col("fixture_id").alias("key"), F.col("slug").alias("entity"), parse_timecode(F.col("t")).alias("t"))
    screens = _table(spark, sf_dir, "screens").select(F.col("slug").alias("entity"), "id", F.col("t_ms_start").alias("t_start"), F.col("t_ms_end").alias("t_end"))
    return nearest.nearest(rows, screens, TOLERANCE_MS)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(spark, sf_dir).select(F.col("key").alias("fixture_id"), F.col("entity").alias("slug"), F.col("id").alias("screen_id"))


def p5_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per slug: fixture rows paired, how many inside their screen, and the largest distance."""
    return _nearest(spark, sf_dir).groupBy(F.col("entity").alias("slug")).agg(
        F.count("*").alias("paired"), F.count_if(F.col("distance") == 0).alias("inside"), F.max("distance").alias("largest_ms")
    )


DELIVERIES = 2  # batches in which the rows are added to the ledger, one after the other in the order of their ids


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ledger.Ledger]:
    """Keyed rows of both tables and the ledger to which they were added delivery by delivery, opened anew for each."""
    tables = {
        "identities": (F.col("identity_id"), ledger.identity_key("identities")),
        "fixture_screens": (F.col("fixture_id"), ledger.flat_key("fixture_screens", "slug", "t", "name", "module", "bucket", "note")),
    }
    parts = [_table(spark, sf_dir, name).select(F.lit(name).alias("table_name"), key.alias("key"), row_id.alias("id")) for name, (row_id, key) in tables.items()]
    keyed = materialise(parts[0].unionByName(parts[1]))
    last = {r.table_name: r.last for r in keyed.groupBy("table_name").agg(F.max("id").alias("last")).collect()}
    number = F.lit(0)
    for name, most in last.items():
        number = F.when(F.col("table_name") == name, F.floor(F.col("id") * DELIVERIES / F.lit((most or 0) + 1))).otherwise(number)
    kept = ledger.Ledger(spark)
    for n in range(DELIVERIES):
        kept = ledger.Ledger(spark, kept.path)
        kept.add(keyed.filter(F.greatest(number, F.lit(0)) == n))
    return keyed, kept


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed, kept = _ledger(spark, sf_dir)
    return ledger.copies(keyed, kept.read(), "table_name").select("table_name", "first_id", "copy_id")


def p6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record once: its smallest row id and its number of copies."""
    keyed, kept = _ledger(spark, sf_dir)
    firsts = kept.read().select("key", F.col("first_id").alias("id"), F.col("n").alias("copies"))
    return keyed.join(firsts, ["key", "id"]).select("table_name", F.col("id").alias("first_id"), "copies").distinct()


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_table(spark, sf_dir, "documents"))


def p7_source_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.with_token_counts(_table(spark, sf_dir, "documents").select("source", "text"))
    return counted.groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


def p7_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its path appended: its tokens then and before, and the characters encoded again for it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.concat(F.lit("\n"), F.coalesce("path", F.lit(""))).alias("more"))
    return tokens.appended(docs, "doc_id", "text", "more")


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1]


def p8_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every source, language and topic was to have of the tokens, and has."""
    return mixture.mixture_with_marginals(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[2]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_pairs(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalike_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (p2_found, p2_unmatched, p2_candidates, p4_found, p4_runs, p5_found, p5_distances, p6_found, p6_records, p7_ids, p7_source_tokens, p7_appended, p8_mixture, p8_shares, p8_marginals, p9_found, p9_classes)
    return {f.__name__: f for f in found}


def _bare(column: str) -> str:
    return f"regexp_replace(replace(lower({column}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


_NEAREST = f"""
    WITH asked AS (SELECT fixture_id, slug, {timecode_sql("t")} AS t FROM fixture_screens),
    near AS (
        SELECT fixture_id, a.slug, id, t_ms_start, greatest(0, t_ms_start - t, t - t_ms_end) AS distance
        FROM asked a JOIN screens s ON a.slug = s.slug AND t BETWEEN t_ms_start - {TOLERANCE_MS} AND t_ms_end + {TOLERANCE_MS}),
    found AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY fixture_id ORDER BY distance, t_ms_start, id) = 1)
"""

_RECORDS = f"""
    WITH keyed AS (
        SELECT 'identities' AS table_name, identity_id AS id, [{_bare("slug")}, {_bare("frame_id")}, {_bare("name")},
            {", ".join(_bare(f"other_fields::JSON ->> '{c}'") for c in ("record", "module", "section", "dialog", "description"))},
            CASE WHEN json_type(other_fields::JSON, 'tabs') = 'ARRAY'
                THEN array_to_string(list_transform(other_fields::JSON ->> '$.tabs[*]', lambda x: '/' || {_bare("x")}), '') END] AS key
        FROM identities
        UNION ALL SELECT 'fixture_screens', fixture_id, [{", ".join(_bare(c) for c in ("slug", "t", "name", "module", "bucket", "note"))}] FROM fixture_screens),
    records AS (SELECT table_name, key, min(id) AS first_id, count(*) AS copies FROM keyed GROUP BY table_name, key)
"""


def oracle_sql() -> dict[str, str]:
    forms = f"(SELECT doc_id, text, {lookalike.canonical_sql('text')} AS form FROM documents WHERE text IS NOT NULL)"
    seen = f"forms AS (SELECT * FROM {forms} WHERE regexp_matches(form, '{lookalike.VISIBLE}'))"
    return {
        "p5_found": f"{_NEAREST} SELECT fixture_id, slug, id AS screen_id FROM found",
        "p5_distances": f"""{_NEAREST} SELECT slug, count(*) AS paired, count(*) FILTER (distance = 0) AS inside, max(distance) AS largest_ms
            FROM found GROUP BY slug""",
        "p6_found": f"""{_RECORDS} SELECT k.table_name, first_id, id AS copy_id FROM keyed k JOIN records r
            ON k.table_name = r.table_name AND k.key = r.key WHERE id <> first_id""",
        "p6_records": f"{_RECORDS} SELECT table_name, first_id, copies FROM records",
        "p9_found": f"""WITH {seen} SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM forms a JOIN forms b
            ON a.form = b.form AND a.text <> b.text AND a.doc_id < b.doc_id""",
        "p9_classes": f"""WITH {seen} SELECT doc_id, min(doc_id) OVER w AS class_id, count(*) OVER w AS members,
            (SELECT count(DISTINCT text) FROM forms i WHERE i.form = forms.form) AS spellings FROM forms WINDOW w AS (PARTITION BY form)""",
    }
