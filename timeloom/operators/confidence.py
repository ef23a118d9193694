"""Agreement of independently measured signals; what was not measured does not count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timeloom.functions.labels import normalise_label
from timeloom.functions.similarity import similarity

# Least share of the weights that must be measured; quality of how and how well a frame was framed.
MIN_COVERAGE = 0.5
METHOD_QUALITY = {"manual": 1.0, "auto": 1.0, "interpolated": 0.7, "failed": 0.0}
FRAMING_QUALITY = {"full": 1.0, "partial": 0.25, "lost": 0.0}


def round4(value: Column) -> Column:
    """Four digits, half to even on the binary value."""
    return F.rint(value * 10000) / 10000


def combine(signals: dict[str, Column], weights: dict[str, float], threshold: float, unreadable: Column | None = None) -> Column:
    """struct(score, coverage, verdict, missing): weighted mean of the signals that are not null and have a weight."""
    used = {n: w for n, w in weights.items() if w > 0}
    value = {n: signals.get(n, F.lit(None)).cast("double") for n in used}
    share = lambda f: sum((F.when(value[n].isNotNull(), f(n)).otherwise(0.0) for n in used), F.lit(0.0))
    measured = share(lambda n: F.lit(used[n]))
    total = sum(used.values())
    score = F.when(measured > 0, round4(share(lambda n: value[n] * used[n]) / measured)).otherwise(0.0)
    coverage = round4(measured / total) if total > 0 else F.lit(0.0)
    missing = F.array_sort(F.array_compact(F.array(*(F.when(value[n].isNull(), F.lit(n)) for n in used)))) if used else F.array().cast("array<string>")
    blocked = (F.coalesce(unreadable, F.lit("")) != "") if unreadable is not None else F.lit(False)
    verdict = F.when(blocked | (coverage < MIN_COVERAGE) | (score < threshold), "review").otherwise("accepted")
    return F.struct(score.alias("score"), coverage.alias("coverage"), verdict.alias("verdict"), missing.alias("missing"))


def reason_of(combined: Column, unreadable: Column, threshold: float) -> Column:
    """Why a result of :func:`combine` is for review, the first reason that holds; null where it is accepted."""
    missing = F.array_join(combined["missing"], ", ")
    return (
        F.when(combined["verdict"] == "accepted", F.lit(None))
        .when(F.coalesce(unreadable, F.lit("")) != "", unreadable)
        .when(combined["coverage"] < MIN_COVERAGE, F.concat(F.lit("too little was measured, without: "), missing))
        .when(combined["score"] < threshold, F.format_string("score %.4f", combined["score"]))
    )


def text_agreement(read: Column, seen: Column) -> Column:
    """Similarity of two readings; null where either is missing or empty."""
    return F.when((F.coalesce(read, F.lit("")) != "") & (F.coalesce(seen, F.lit("")) != ""), similarity(read, seen))


def cross_frame_agreement(df: DataFrame, key: str, name: str, *order: str) -> DataFrame:
    """(key, modal, agreement, names): mean similarity of the names of a key to the most frequent of them (the first seen
    of equally frequent ones); keys with fewer than two names are left out."""
    named = df.filter(F.coalesce(F.col(name), F.lit("")) != "").select(F.col(key), F.col(name).alias("_name"), F.struct(*order).alias("_o"))
    named = named.withColumn("_norm", normalise_label(F.col("_name")))
    votes = named.groupBy(key, "_norm").agg(F.count("*").alias("_n"), F.min("_o").alias("_first"))
    modal = votes.groupBy(key).agg(F.min(F.struct((-F.col("_n")).alias("n"), "_first", "_norm")).alias("m"), F.sum("_n").alias("names")).filter("names >= 2")
    per = named.groupBy(key, "_name").agg(F.count("*").alias("_c"))
    scored = per.join(modal.select(key, F.col("m._norm").alias("modal"), "names"), key).withColumn("_s", similarity(F.col("_name"), F.col("modal")))
    return scored.groupBy(key, "modal", "names").agg(
        (F.rint(F.sum(F.rint(F.col("_s") * 10000) * F.col("_c")) / F.sum("_c")) / 10000).alias("agreement")  # whole units: exact in any order
    )


def framing_quality(df: DataFrame, key: str, method: Column, framing: Column) -> DataFrame:
    """(key, framing_quality): the least over a key's frames of the worse of method and framing quality."""
    worth = lambda table, c: F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[c]
    return df.groupBy(key).agg(F.min(F.least(worth(METHOD_QUALITY, method), worth(FRAMING_QUALITY, framing))).alias("framing_quality"))
