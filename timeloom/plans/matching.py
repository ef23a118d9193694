"""Matching queries: names read against the inventory, and the inventory against itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timeloom.functions.labels import normalise_label
from timeloom.functions.similarity import similarity, words
from timeloom.operators import resolve, state
from timeloom.plans.similarity_sql import SCORED
from timeloom.plans.tables import table
from timeloom.session import materialise

THRESHOLD, MARGIN = 0.82, 0.15
CORRECTIONS = {"Confirm deletion": "Foundry Intake", "low BATTERY": "Silo Tariff", "Kennel Allocation Wizard": "No Such Screen"}
# Bucket of a matched entry by its status.
STATUS_BUCKET = {"built": "built", "lookup_scoped": "built", "patient_scoped": "built", "disabled": "new", "stub": "new"}


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.reference_names(table(spark, sf_dir, "inventory_list"), "entry_id", "label", "aliases")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "readings").select("reading_id", normalise_label(F.col("name")).alias("norm"))


def normalise_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads(spark, sf_dir)


def token_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of entries where all words of a label or alias of one are among the words of one of the other, either way."""
    return contained_names(names(spark, sf_dir))


def contained_names(listed: DataFrame) -> DataFrame:
    """(entry_ord, other_ord, norm, other) with entry_ord < other_ord: names whose words are properly contained, either way.

    All words of the contained name are in the containing one, so its rarest word is: each name is looked up by its rarest
    word only, among the names that hold it, and containment is checked after that. Equal names are compared once.
    """
    owned = materialise(listed.filter("entry_ord is not null").select("entry_ord", "norm").distinct())
    split = owned.select("norm").distinct().select("norm", words(F.col("norm")).alias("w"))
    holds = materialise(split.select("norm", "w", F.explode("w").alias("word")))
    counts = holds.groupBy("word").agg(F.count("*").alias("n"))
    rarest = holds.join(counts, "word").groupBy("norm").agg(F.min(F.struct("n", "word", "w")).alias("m"))
    small = rarest.select(F.col("norm").alias("small"), F.col("m.w").alias("small_w"), F.col("m.word").alias("word"))
    large = holds.select(F.col("norm").alias("large"), F.col("w").alias("large_w"), "word")
    inside = (F.size("small_w") < F.size("large_w")) & (F.size(F.array_except("small_w", "large_w")) == 0)
    pairs = small.join(large, "word").filter(inside).select("small", "large")
    a = owned.select(F.col("norm").alias("small"), F.col("entry_ord").alias("a"))
    b = owned.select(F.col("norm").alias("large"), F.col("entry_ord").alias("b"))
    both = pairs.join(a, "small").join(b, "large").filter("a <> b")
    first = F.col("a") < F.col("b")
    return both.select(
        F.least("a", "b").alias("entry_ord"), F.greatest("a", "b").alias("other_ord"),
        F.when(first, F.col("small")).otherwise(F.col("large")).alias("norm"), F.when(first, F.col("large")).otherwise(F.col("small")).alias("other"),
    )


def contained_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of :func:`contained_names`, whatever words they begin with."""
    return contained_names(names(spark, sf_dir))


def token_set_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a name against the section and the module on the same screen."""
    return table(spark, sf_dir, "readings").select("reading_id", similarity(F.col("name"), F.col("module")).alias("to_module"), similarity(F.col("name"), F.col("section")).alias("to_section"))


def match_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_exact(reads(spark, sf_dir), names(spark, sf_dir)).select("reading_id", "entry_ord", "label")


def match_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_corrected(reads(spark, sf_dir), names(spark, sf_dir), CORRECTIONS).select("reading_id", "corrected", "entry_ord")


def match_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.match_nearest(reads(spark, sf_dir), names(spark, sf_dir))


def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve.match_cascade(reads(spark, sf_dir), names(spark, sf_dir), CORRECTIONS, THRESHOLD)
    return out.select("reading_id", "match_kind", "match_score", "matched_ord", "possible_label")


def near_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reviewer is asked, once per name: contained names and scores just under the threshold."""
    found = resolve.match_cascade(reads(spark, sf_dir), names(spark, sf_dir), CORRECTIONS, THRESHOLD)
    asked = found.filter("possible_label is not null").filter((F.col("match_kind") == "subset") | (F.col("match_score") >= THRESHOLD - MARGIN))
    return resolve.ask_once(asked.withColumn("question", F.lit("near-miss")), "question", "norm", "reading_id").select("reading_id", "norm", "match_kind", "match_score", "possible_label")


def classify_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket of each exactly matched reading by the entry's status, counted; unmatched ones are new."""
    entries = table(spark, sf_dir, "inventory_list").select(F.col("entry_id").alias("entry_ord"), "status")
    bucket = F.create_map(*(F.lit(x) for kv in STATUS_BUCKET.items() for x in kv))
    found = resolve.match_exact(reads(spark, sf_dir), names(spark, sf_dir)).join(entries, "entry_ord", "left")
    return found.groupBy(F.coalesce(F.get(F.transform(F.array("status"), lambda s: bucket[s]), F.lit(0)), F.lit("new")).alias("bucket")).agg(F.count("*").alias("readings"))


def inventory_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.duplicate_labels(table(spark, sf_dir, "inventory_snapshots"), "row_id", "label")


def alias_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases of snapshot entries that are the label of another entry in the same project."""
    rows = table(spark, sf_dir, "inventory_snapshots").filter("label is not null")
    labels = rows.select("project", normalise_label(F.col("label")).alias("norm")).distinct()
    long = rows.select("project", normalise_label(F.col("label")).alias("own"), F.explode("aliases").alias("alias"))
    aliases = long.select("project", "own", normalise_label(F.col("alias")).alias("norm")).distinct()
    return aliases.filter("norm <> '' and norm <> own").join(labels, ["project", "norm"])


def reading_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as answers per video, the representative frames of screens as what was asked."""
    answers = table(spark, sf_dir, "readings").filter("frame_id is not null")
    asked = table(spark, sf_dir, "screens").select("slug", F.col("representative_frame").alias("frame_id")).filter("frame_id is not null")
    return state.attribute(answers, asked, "slug", "frame_id", "reading_id", "name")


QUERIES = {
    f.__name__: f
    for f in (
        normalise_labels, token_subset, contained_labels, token_set_similarity, match_exact, match_alias, match_nearest, match_cascade, near_miss, classify_bucket,
        inventory_duplicates, alias_collisions, reading_attribution,
    )
}


def norm_sql(column: str) -> str:
    """The normal form of a label in DuckDB, for labels in Latin letters (compatibility forms aside)."""
    return f"trim(regexp_replace(regexp_replace(lower(strip_accents({column})), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))"


_LISTED = f"""names AS (SELECT * FROM (
        SELECT entry_id AS entry_ord, label, 0 AS name_ord, {norm_sql("label")} AS norm FROM inventory_list
        UNION ALL SELECT entry_id, label, i, {norm_sql("aliases[i]")} FROM inventory_list, range(1, len(coalesce(aliases, [])) + 1) r(i)) WHERE norm <> ''),
    firsts AS (SELECT norm, entry_ord, name_ord, label FROM names QUALIFY row_number() OVER (PARTITION BY norm ORDER BY entry_ord, name_ord) = 1)"""
_READS = f"reads AS (SELECT reading_id, {norm_sql('name')} AS norm FROM readings)"
_NAMES = f"{_LISTED}, {_READS}"
# every distinct name against every name of the list
_SCORES = f"""asked AS (SELECT DISTINCT {{0}} AS norm FROM {{1}} WHERE {{0}} <> ''), pairs AS (
        SELECT row_number() OVER () AS id, a.norm AS a, f.norm AS b, f.entry_ord, f.name_ord, f.label FROM asked a CROSS JOIN firsts f), {SCORED},
    near AS (SELECT a AS norm, score, entry_ord, label FROM pairs JOIN scored USING (id) WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, entry_ord, name_ord) = 1)"""
_FIXED = "CASE r.norm " + " ".join(f"WHEN '{k.lower()}' THEN '{v.lower()}'" for k, v in CORRECTIONS.items()) + " ELSE r.norm END"

_WORDS_OF = "list_distinct(string_split({0}, ' '))"
_STEPS = f"""told AS (SELECT reading_id, r.norm, {_FIXED} AS corrected FROM reads r),
    twice AS (SELECT t.*, e.entry_ord AS e_ord, c.entry_ord AS c_ord FROM told t LEFT JOIN firsts e ON e.norm = t.norm LEFT JOIN firsts c ON c.norm = t.corrected),
    {_SCORES.format("corrected", "(SELECT * FROM twice WHERE e_ord IS NULL AND c_ord IS NULL)")},
    seen AS (SELECT b.*, n.score, n.entry_ord AS n_ord, n.label AS n_label, coalesce(n.score >= {THRESHOLD} AND
            list_has_all({_WORDS_OF.format("n.norm")}, {_WORDS_OF.format(norm_sql("n.label"))}) <> list_has_all({_WORDS_OF.format(norm_sql("n.label"))}, {_WORDS_OF.format("n.norm")}), false) AS inside
        FROM twice b LEFT JOIN near n ON n.norm = b.corrected AND e_ord IS NULL AND c_ord IS NULL),
    cascade AS (SELECT *, CASE WHEN coalesce(norm, '') = '' THEN 'none' WHEN e_ord IS NOT NULL THEN 'exact' WHEN c_ord IS NOT NULL THEN 'alias'
            WHEN score >= {THRESHOLD} AND NOT inside THEN 'fuzzy' WHEN inside THEN 'subset' ELSE 'none' END AS match_kind FROM seen),
    matched AS (SELECT reading_id, norm, match_kind, CASE WHEN match_kind IN ('exact', 'alias') THEN 1.0::DOUBLE ELSE coalesce(score, 0.0) END AS match_score,
            CASE match_kind WHEN 'exact' THEN e_ord WHEN 'alias' THEN c_ord WHEN 'fuzzy' THEN n_ord END AS matched_ord,
            CASE WHEN match_kind IN ('none', 'subset') THEN n_label END AS possible_label FROM cascade)"""
_CASCADE = f"{_NAMES}, {_STEPS}"


def cascade_sql(reads: str) -> str:
    """CTEs up to ``matched`` (reading_id, norm, match_kind, match_score, matched_ord, possible_label) for a CTE ``reads`` (reading_id, norm)."""
    return f"{_LISTED}, reads AS ({reads}), {_STEPS}"


SQL = {
    "match_nearest": f"WITH {_NAMES}, {_SCORES.format('norm', 'reads')} SELECT norm, score, entry_ord, label FROM near",
    "match_cascade": f"WITH {_CASCADE} SELECT reading_id, match_kind, match_score, matched_ord, possible_label FROM matched",
    "near_miss": f"""WITH {_CASCADE} SELECT reading_id, norm, match_kind, match_score, possible_label FROM matched
        WHERE possible_label IS NOT NULL AND (match_kind = 'subset' OR match_score >= {THRESHOLD} - {MARGIN}) QUALIFY row_number() OVER (PARTITION BY norm ORDER BY reading_id) = 1""",
    "normalise_labels": f"SELECT reading_id, {norm_sql('name')} AS norm FROM readings",
    "token_subset": f"""WITH {_NAMES}, w AS (SELECT *, list_distinct(string_split(norm, ' ')) AS w, split_part(norm, ' ', 1) AS head FROM names)
        SELECT DISTINCT a.entry_ord, b.entry_ord AS other_ord, a.norm, b.norm AS other FROM w a JOIN w b ON a.head = b.head AND a.entry_ord < b.entry_ord
        WHERE list_has_all(a.w, b.w) <> list_has_all(b.w, a.w)""",
    "contained_labels": f"""WITH {_NAMES}, w AS (SELECT *, list_distinct(string_split(norm, ' ')) AS w FROM names)
        SELECT DISTINCT a.entry_ord, b.entry_ord AS other_ord, a.norm, b.norm AS other FROM w a JOIN w b ON a.entry_ord < b.entry_ord
        WHERE list_has_all(a.w, b.w) <> list_has_all(b.w, a.w)""",
    "token_set_similarity": f"""WITH pairs AS (
        SELECT reading_id * 2 AS id, {norm_sql("name")} AS a, {norm_sql("module")} AS b FROM readings UNION ALL SELECT reading_id * 2 + 1, {norm_sql("name")}, {norm_sql("section")} FROM readings), {SCORED}
        SELECT reading_id, m.score AS to_module, s.score AS to_section FROM readings JOIN scored m ON m.id = reading_id * 2 JOIN scored s ON s.id = reading_id * 2 + 1""",
    "match_exact": f"WITH {_NAMES} SELECT reading_id, entry_ord, label FROM reads r LEFT JOIN firsts USING (norm)",
    "match_alias": f"WITH {_NAMES}, f AS (SELECT reading_id, {_FIXED} AS corrected FROM reads r) SELECT reading_id, corrected, entry_ord FROM f LEFT JOIN firsts ON corrected = norm",
    "classify_bucket": f"""WITH {_NAMES} SELECT CASE WHEN status IN ('built', 'lookup_scoped', 'patient_scoped') THEN 'built' ELSE 'new' END AS bucket, count(*) AS readings
        FROM reads r LEFT JOIN firsts f USING (norm) LEFT JOIN inventory_list i ON i.entry_id = f.entry_ord GROUP BY 1""",
    "inventory_duplicates": f"""SELECT coalesce({norm_sql("label")}, '') AS norm, count(*) AS entries, min(row_id) AS first_ord FROM inventory_snapshots GROUP BY 1 HAVING count(*) > 1 OR norm = ''""",
    "alias_collisions": f"""WITH l AS (SELECT DISTINCT project, {norm_sql("label")} AS norm FROM inventory_snapshots WHERE label IS NOT NULL),
        a AS (SELECT DISTINCT project, {norm_sql("label")} AS own, {norm_sql("a")} AS norm FROM (SELECT project, label, unnest(aliases) AS a FROM inventory_snapshots WHERE label IS NOT NULL))
        SELECT project, norm, own FROM a JOIN l USING (project, norm) WHERE norm <> '' AND norm <> own""",
    "reading_attribution": """WITH a AS (SELECT slug, frame_id, arg_max(name, reading_id) AS name, max(reading_id) AS m FROM readings WHERE frame_id IS NOT NULL GROUP BY ALL),
        l AS (SELECT slug, frame_id, r.name FROM a JOIN readings r USING (slug, frame_id) WHERE r.reading_id = a.m),
        e AS (SELECT DISTINCT slug, representative_frame AS frame_id FROM screens WHERE representative_frame IS NOT NULL)
        SELECT coalesce(l.slug, e.slug) AS slug, coalesce(l.frame_id, e.frame_id) AS frame_id, l.name,
            CASE WHEN l.frame_id IS NULL THEN 'missing' WHEN e.frame_id IS NULL THEN 'foreign' ELSE 'ok' END AS status
        FROM l FULL JOIN e ON l.slug = e.slug AND l.frame_id = e.frame_id""",
}
