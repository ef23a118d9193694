"""Resolving names against a reference list: exact, by correction, by nearest similarity, with contained names escalated."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.functions.labels import normalise_label, normalise_label_text
from timeloom.functions.similarity import nearest_of
from timeloom.operators.blocks import in_blocks
from timeloom.session import materialise

BLOCK = 20_000  # names of the reference list in one block


def reference_names(entries: DataFrame, ord_: str, label: str, aliases: str) -> DataFrame:
    """(norm, entry_ord, name_ord, label): label and aliases of every entry, null and empty ones left out."""
    names = F.concat(F.array(label), F.coalesce(F.col(aliases), F.array().cast("array<string>")))
    long = entries.select(F.col(ord_).alias("entry_ord"), F.col(label).alias("label"), F.posexplode(names).alias("name_ord", "name"))
    return long.withColumn("norm", normalise_label(F.col("name"))).filter("norm <> ''").select("norm", "entry_ord", "name_ord", "label")


def first_by_name(names: DataFrame) -> DataFrame:
    """One row per normalised name: that of the first entry, and of its first name."""
    return names.groupBy("norm").agg(F.min(F.struct("entry_ord", "name_ord", "label")).alias("m")).select("norm", "m.*")


def match_exact(reads: DataFrame, names: DataFrame, norm: str = "norm") -> DataFrame:
    """``reads`` with entry_ord and label of the entry of the same normalised name, or nulls."""
    index = first_by_name(names).select(F.col("norm").alias(norm), "entry_ord", "label")
    return reads.join(index, norm, "left")


def match_corrected(reads: DataFrame, names: DataFrame, corrections: dict[str, str], norm: str = "norm") -> DataFrame:
    """Like :func:`match_exact` after a correction table (a parameter; keys compare normalised and the last wins)."""
    table = {normalise_label_text(k): normalise_label_text(v) for k, v in corrections.items()}
    fixed = F.col(norm)
    if table:
        pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
        fixed = F.coalesce(F.get(F.transform(F.array(F.col(norm)), lambda n: pairs[n]), F.lit(0)), F.col(norm))
    index = first_by_name(names).select(F.col("norm").alias("corrected"), "entry_ord", "label")
    return reads.withColumn("corrected", fixed).join(index, "corrected", "left")


def match_nearest(reads: DataFrame, names: DataFrame, norm: str = "norm", block: int = BLOCK) -> DataFrame:
    """(norm, score, entry_ord, label) for each distinct name in ``reads``: the entry with the most similar name, the
    earliest of equally similar ones, with its score above 0; a name like none has no row.

    Any two names with a letter in common are somewhat alike, so no join finds the nearest one: the distinct names are held
    against the reference list in blocks of bounded size, where bounds leave few pairs to be scored.
    """
    asked = materialise(reads.select(F.col(norm).alias("norm")).filter("norm <> ''").distinct())
    listed = materialise(names.filter("norm <> ''").groupBy("norm").agg(F.min(F.struct("entry_ord", "name_ord", "label")).alias("f")).select("norm", "f.*"))

    def run(own: pa.Table, theirs: pa.Table) -> pa.Table:
        places = list(zip(theirs.column("entry_ord").to_pylist(), theirs.column("name_ord").to_pylist(), strict=True))
        order = np.empty(len(places), np.int64)
        order[sorted(range(len(places)), key=lambda i: (places[i][0] is None, places[i]))] = np.arange(len(places))
        score, at = nearest_of(own.column("norm").to_pylist(), theirs.column("norm").to_pylist(), order)
        found = np.flatnonzero(at >= 0)
        near = theirs.take(pa.array(at[found]))
        return pa.table({"norm": own.column("norm").take(pa.array(found)), "score": pa.array(score[found]), **{c: near.column(c) for c in ("entry_ord", "name_ord", "label")}})

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in listed.schema.fields if f.name != "norm")
    scored = in_blocks(asked, listed, run, f"norm string, score double, {kinds}", block)
    best = scored.groupBy("norm").agg(F.min(F.struct((-F.col("score")).alias("minus"), "entry_ord", "name_ord", "label")).alias("b"))
    return best.select("norm", (-F.col("b.minus")).alias("score"), "b.entry_ord", "b.label")


def match_cascade(reads: DataFrame, names: DataFrame, corrections: dict[str, str], threshold: float, norm: str = "norm") -> DataFrame:
    """``reads`` with match_kind, match_score, matched_ord, matched_label, possible_label.

    A blank name is ``none``; the same name is ``exact``; a corrected one ``alias``; else the nearest is ``fuzzy`` from
    ``threshold`` on, unless the words of one are all in the other (``subset``: recorded as possible only), else ``none``.
    Only names that neither the name nor its correction resolves are scored.
    """
    from timeloom.functions.similarity import is_token_subset

    exact = match_exact(reads, names, norm).withColumnsRenamed({"entry_ord": "e_ord", "label": "e_label"})
    both = match_corrected(exact, names, corrections, norm).withColumnsRenamed({"entry_ord": "c_ord", "label": "c_label"})
    open_ = both.filter("e_ord is null and c_ord is null").select("corrected")
    near = match_nearest(open_, names, "corrected").select(F.col("norm").alias("corrected"), "score", F.col("entry_ord").alias("n_ord"), F.col("label").alias("n_label"))
    near = near.withColumn("subset", is_token_subset(F.col("corrected"), normalise_label(F.col("n_label"))) & (F.col("score") >= threshold))
    all_ = both.join(near, "corrected", "left")
    fuzzy = (F.col("score") >= threshold) & ~F.col("subset")
    kind = (
        F.when(F.coalesce(F.col(norm), F.lit("")) == "", "none").when(F.col("e_ord").isNotNull(), "exact").when(F.col("c_ord").isNotNull(), "alias")
        .when(fuzzy, "fuzzy").when(F.col("subset"), "subset").otherwise("none")
    )
    score = F.when(F.col("match_kind").isin("exact", "alias"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))
    pick = lambda e, c, n: F.when(F.col("match_kind") == "exact", F.col(e)).when(F.col("match_kind") == "alias", F.col(c)).when(F.col("match_kind") == "fuzzy", F.col(n))
    return (
        all_.withColumn("match_kind", kind).withColumn("match_score", score)
        .withColumn("matched_ord", pick("e_ord", "c_ord", "n_ord")).withColumn("matched_label", pick("e_label", "c_label", "n_label"))
        .withColumn("possible_label", F.when(F.col("match_kind").isin("none", "subset"), F.col("n_label")))
        .drop("e_ord", "e_label", "c_ord", "c_label", "n_ord", "n_label", "score", "subset", "corrected")
    )


def duplicate_labels(entries: DataFrame, ord_: str, label: str) -> DataFrame:
    """(norm, entries, first_ord) of labels that several entries have once normalised, or that are empty then."""
    normed = entries.select(F.col(ord_).alias("o"), F.coalesce(normalise_label(F.col(label)), F.lit("")).alias("norm"))
    return normed.groupBy("norm").agg(F.count("*").alias("entries"), F.min("o").alias("first_ord")).filter("entries > 1 or norm = ''")


def shadowing_aliases(names: DataFrame) -> DataFrame:
    """(norm, alias_ord, label_ord) where an alias of one entry is the label of another."""
    labels = names.filter("name_ord = 0").select("norm", F.col("entry_ord").alias("label_ord"))
    aliases = names.filter("name_ord > 0").select("norm", F.col("entry_ord").alias("alias_ord"))
    return aliases.join(labels, "norm").filter("alias_ord <> label_ord").distinct()


def ask_once(df: DataFrame, question: str, subject: str, *order: str) -> DataFrame:
    """The first row in ``order`` for each question and subject."""
    rest = [c for c in df.columns if c not in (question, subject, *order)]
    first = df.groupBy(question, subject).agg(F.min(F.struct(*order, *rest)).alias("_f"))  # reduced before the shuffle
    return first.select(question, subject, *(F.col("_f")[c].alias(c) for c in (*order, *rest))).select(*df.columns)
