"""Signal queries: hashes of grids, distances, agreement, words put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions import hashes
from timeloom.operators import confidence, numbering, state, timeline
from timeloom.plans.similarity_sql import SCORED
from timeloom.plans.tables import table

COLS, ROWS, FLAT = 7, 8, 0.05
WEIGHTS = {"ocr_agreement": 0.3, "cross_frame": 0.3, "legibility": 0.2, "framing": 0.2}
THRESHOLD = 0.45
LEAST = 0.4


def _hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", hashes.difference_hash(grid, COLS, ROWS, FLAT).alias("hash"))


def perceptual_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 grids."""
    return _hashes(spark, sf_dir).select("vec_id", "hash")


def hash_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each grid to the one before it of the same label."""
    rows = numbering.with_previous(_hashes(spark, sf_dir), "label", "hash", "vec_id")
    return rows.select("vec_id", hashes.hamming_distance(F.col("hash"), F.coalesce("previous", F.lit(""))).alias("distance"))


def combined_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    return rows.select("l_orderkey", "l_linenumber", hashes.combined_distance(F.col("l_quantity"), F.bround(F.col("l_tax") * 800), 0.3).alias("distance"))


def hash_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid of a hash over the whole frame of each video, and over its top band."""
    rows = table(spark, sf_dir, "videos")
    whole, band = hashes.grid_for(F.col("height"), F.col("width")), hashes.grid_for(F.lit(190), F.col("width"))
    return rows.select("slug", whole["cols"].alias("cols"), whole["rows"].alias("rows"), band["cols"].alias("band_cols"), band["rows"].alias("band_rows"))


def signals_of() -> dict[str, Column]:
    """Line items as measured signals, some of them missing."""
    return {
        "ocr_agreement": F.when(F.col("l_returnflag") != "R", F.col("l_discount") * 10),
        "cross_frame": F.when(F.col("l_quantity") <= 20, F.col("l_tax") * 12.5),
        "legibility": F.col("l_quantity") / 50,
        "framing": F.when(F.col("l_linestatus") != "O", F.lit(1.0)),
    }


def confidence_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    said = confidence.combine(signals_of(), WEIGHTS, THRESHOLD, F.when(F.col("l_linenumber") == 7, "glare"))
    return rows.select("l_orderkey", "l_linenumber", said.alias("c")).select("l_orderkey", "l_linenumber", "c.score", "c.coverage", "c.verdict", F.array_join("c.missing", ",").alias("missing"))


def cross_frame_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How alike the names read on the frames of a video are."""
    return confidence.cross_frame_agreement(table(spark, sf_dir, "readings"), "slug", "name", "reading_id")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tabs of a screen as words with boxes: every fourth gap is wide, confidence falls with length."""
    tabs = F.filter(F.flatten(F.transform(F.coalesce("identity.tabs", F.array().cast("array<string>")), lambda t: F.split(t, " "))), lambda w: w != "")
    word = lambda w, i: F.struct(w.alias("text"), (i * 100).alias("left"), (i * 100 + F.when(i % 4 == 3, 60).otherwise(95)).alias("right"), (F.length(w) + 14).alias("height"), (1.0 - F.length(w) / 12.0).alias("confidence"))
    return table(spark, sf_dir, "screens").select("slug", "id", "identity", F.transform(tabs, word).alias("words"))


def join_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("slug", "id", timeline.join_words(F.col("words"), LEAST).alias("j")).select("slug", "id", "j.text", "j.confidence").distinct()


def group_by_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _words(spark, sf_dir).select("slug", "id", F.array_join(timeline.labels_by_gaps(F.col("words"), LEAST), "|").alias("labels")).distinct()


def text_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "readings")
    return rows.select("reading_id", confidence.text_agreement(F.col("name"), F.col("record")).alias("agreement"))


def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of even id as cached answers, keyed by text and language; which documents they answer."""
    docs = table(spark, sf_dir, "documents").select("doc_id", state.cache_key(F.coalesce("lang", F.lit("")), F.coalesce("text", F.lit(""))).alias("key"))
    cache = docs.filter("doc_id % 2 = 0").select("key", F.col("doc_id").cast("string").alias("payload"))
    return state.cache_split(docs, cache, "key").select("doc_id", F.col("payload").isNotNull().alias("hit"))


def source_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256).alias("sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        perceptual_hash, hash_pairs, hash_grid, combined_distance, confidence_combine, cross_frame_agreement, text_agreement, join_words, group_by_gaps,
        cache_hits, source_digest,
    )
}

_BITS = f"""bits AS (SELECT vec_id, label, list_concat(
        list_transform(range(0, {ROWS * COLS}), lambda i: (embedding[i // {COLS} * {COLS + 1} + i % {COLS} + 2]::DOUBLE - embedding[i // {COLS} * {COLS + 1} + i % {COLS} + 1]::DOUBLE > {FLAT})::INT),
        list_transform(range(0, {ROWS * COLS}), lambda i: (embedding[i // {COLS} * {COLS + 1} + i % {COLS} + 2]::DOUBLE - embedding[i // {COLS} * {COLS + 1} + i % {COLS} + 1]::DOUBLE < -{FLAT})::INT)) AS b FROM embeddings)"""
_TABS = """tabs AS (SELECT DISTINCT slug, id, list_filter(flatten(list_transform(coalesce(identity.tabs, []), lambda t: string_split(t, ' '))), lambda w: w <> '') AS w FROM screens),
    placed AS (SELECT slug, id, i, w[i + 1] AS text, i * 100 AS l, i * 100 + CASE WHEN i % 4 = 3 THEN 60 ELSE 95 END AS r, length(w[i + 1]) + 14 AS h, 1.0::DOUBLE - length(w[i + 1]) / 12.0::DOUBLE AS c FROM tabs, range(0, len(w)) g(i))"""
_SIGNALS = {
    "ocr_agreement": "CASE WHEN l_returnflag <> 'R' THEN l_discount * 10 END", "cross_frame": "CASE WHEN l_quantity <= 20 THEN l_tax * 12.5::DOUBLE END",
    "legibility": "l_quantity / 50", "framing": "CASE WHEN l_linestatus <> 'O' THEN 1.0::DOUBLE END",
}
_MEASURED = " + ".join(f"CASE WHEN {n} IS NOT NULL THEN {WEIGHTS[n]}::DOUBLE ELSE 0 END" for n in WEIGHTS)
_WEIGHED = " + ".join(f"coalesce({n} * {WEIGHTS[n]}::DOUBLE, 0)" for n in WEIGHTS)

def _readings_sql() -> dict[str, str]:
    from timeloom.plans.matching import norm_sql

    return {
        "text_agreement": f"""WITH pairs AS (SELECT reading_id AS id, CASE WHEN coalesce(name, '') <> '' AND coalesce(record, '') <> '' THEN {norm_sql("name")} END AS a, {norm_sql("record")} AS b FROM readings), {SCORED}
            SELECT id AS reading_id, score AS agreement FROM scored""",
        "cross_frame_agreement": f"""WITH named AS (SELECT slug, reading_id, name, {norm_sql("name")} AS norm FROM readings WHERE coalesce(name, '') <> ''),
            votes AS (SELECT slug, norm, count(*) AS n, min(reading_id) AS seen FROM named GROUP BY ALL),
            modal AS (SELECT slug, norm AS modal, (SELECT count(*) FROM named i WHERE i.slug = votes.slug) AS names FROM votes QUALIFY row_number() OVER (PARTITION BY slug ORDER BY n DESC, seen) = 1),
            pairs AS (SELECT reading_id AS id, slug, norm AS a, modal AS b FROM named JOIN modal USING (slug) WHERE names >= 2), {SCORED}
            SELECT slug, modal, names, CAST(round_even(sum(round_even(score * 10000, 0))::DOUBLE / count(*), 0) AS DOUBLE) / 10000 AS agreement FROM scored JOIN pairs USING (id) JOIN modal USING (slug) GROUP BY slug, modal, names""",
    }


SQL = {
    **_readings_sql(),
    "perceptual_hash": f"WITH {_BITS} SELECT vec_id, '{COLS}x{ROWS}:' || array_to_string(list_transform(range(0, {2 * ROWS * COLS // 4}), lambda j: format('{{:x}}', b[4 * j + 1] * 8 + b[4 * j + 2] * 4 + b[4 * j + 3] * 2 + b[4 * j + 4])), '') AS hash FROM bits",
    "hash_pairs": f"""WITH {_BITS}, p AS (SELECT vec_id, b, lag(b) OVER (PARTITION BY label ORDER BY vec_id) AS a FROM bits)
        SELECT vec_id, CASE WHEN a IS NULL THEN 64 ELSE CAST(round_even(64.0 * list_sum(list_transform(range(1, len(b) + 1), lambda i: (a[i] <> b[i])::INT)) / {2 * ROWS * COLS}, 0) AS INT) END AS distance FROM p""",
    "combined_distance": "SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity + 0.3::DOUBLE * round_even(l_tax * 800, 0), 4) AS DOUBLE) AS distance FROM lineitem",
    "hash_grid": """WITH r AS (SELECT slug, greatest(1, CAST(round_even(sqrt(128 / greatest(width / greatest(height, 1), 1e-6)), 0) AS INT)) AS rows,
        greatest(1, CAST(round_even(sqrt(128 / greatest(width / 190, 1e-6)), 0) AS INT)) AS band_rows FROM videos)
        SELECT slug, greatest(2, CAST(round_even(128 / rows, 0) AS INT)) AS cols, rows, greatest(2, CAST(round_even(128 / band_rows, 0) AS INT)) AS band_cols, band_rows FROM r""",
    "confidence_combine": f"""WITH s AS (SELECT l_orderkey, l_linenumber, {", ".join(f"{e} AS {n}" for n, e in _SIGNALS.items())} FROM lineitem),
        m AS (SELECT *, {_MEASURED} AS measured, {_WEIGHED} AS weighed FROM s),
        c AS (SELECT *, CASE WHEN measured > 0 THEN CAST(round_even(weighed / measured * 10000, 0) AS DOUBLE) / 10000 ELSE 0 END AS score, CAST(round_even(measured * 10000, 0) AS DOUBLE) / 10000 AS coverage FROM m)
        SELECT l_orderkey, l_linenumber, score, coverage, CASE WHEN l_linenumber = 7 OR coverage < 0.5 OR score < {THRESHOLD} THEN 'review' ELSE 'accepted' END AS verdict,
            array_to_string(list_sort(list_filter([{", ".join(f"CASE WHEN {n} IS NULL THEN '{n}' END" for n in WEIGHTS)}], lambda x: x IS NOT NULL)), ',') AS missing FROM c""",
    "join_words": f"""WITH {_TABS} SELECT slug, id, string_agg(text, ' ' ORDER BY l) FILTER (c >= {LEAST}) AS text, CAST(round_even(avg(c) FILTER (c >= {LEAST}), 4) AS DOUBLE) AS confidence
        FROM tabs LEFT JOIN placed USING (slug, id) GROUP BY slug, id""",
    "group_by_gaps": f"""WITH {_TABS}, sure AS (SELECT slug, id, i, text, l, l - lag(r) OVER (PARTITION BY slug, id ORDER BY l) AS gap, h FROM placed WHERE c >= {LEAST}),
        med AS (SELECT slug, id, median(h) AS m FROM sure GROUP BY ALL),
        joined AS (SELECT s.slug, s.id, l, CASE WHEN gap IS NULL THEN '' WHEN gap > m THEN '|' ELSE ' ' END || text AS piece FROM sure s JOIN med USING (slug, id))
        SELECT slug, id, coalesce(string_agg(piece, '' ORDER BY l), '') AS labels FROM tabs LEFT JOIN joined USING (slug, id) GROUP BY slug, id""",
    "cache_hits": """WITH d AS (SELECT doc_id, sha256(coalesce(lang, '') || chr(10) || coalesce(text, '')) AS key FROM documents)
        SELECT doc_id, key IN (SELECT key FROM d WHERE doc_id % 2 = 0) AS hit FROM d""",
    "source_digest": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents",
}
