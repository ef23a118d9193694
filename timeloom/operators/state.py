"""State tables: replace by owner, staleness, content-keyed results, attribution of answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_by_owner(table: DataFrame, rows: DataFrame, owner: Column, own: str) -> DataFrame:
    """``table`` without what ``own`` wrote before, with ``rows`` in its place."""
    return table.filter(~owner.eqNullSafe(F.lit(own))).unionByName(rows)


def owner_of_reason(reason: str = "reason") -> Column:
    """The stage before the first colon of a reason."""
    return F.get(F.split(reason, ":", 2), F.lit(0))


def cascade_delete(table: DataFrame, stage: str, since: str) -> DataFrame:
    """Without the rows of ``since`` and later stages."""
    return table.filter(F.col(stage) < since)


def upsert(table: DataFrame, rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` and those of ``table`` whose keys they do not have."""
    return table.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows)


def stale(recorded: DataFrame, current: DataFrame, keys: list[str], section: str, digest: str) -> DataFrame:
    """(keys, stale_sections): the recorded rows with a section whose digest is not the present one."""
    now = current.select(section, F.col(digest).alias("_now"))
    differs = recorded.join(now, section, "left").filter(~F.col(digest).eqNullSafe(F.col("_now")))
    return differs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(section)), ",").alias("stale_sections"))


LEAST_COMMIT_DIGITS = 7  # fixed value: shorter commits are compared with nothing


def commits_agree(a: Column, b: Column) -> Column:
    """Whether two commits agree as far as both are given, in any case; null where one is missing."""
    n = F.least(F.length(a), F.length(b))
    return F.when(a.isNotNull() & b.isNotNull(), (n >= LEAST_COMMIT_DIGITS) & (F.lower(F.left(a, n)) == F.lower(F.left(b, n))))


def cache_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *parts), 256)


def cache_split(asked: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """``asked`` with the cached payload, null where it has to be computed; of repeated cache rows the largest."""
    held = cache.groupBy(key).agg(F.max("payload").alias("payload"))
    return asked.join(held, key, "left")


def attribute(answers: DataFrame, expected: DataFrame, group: str, row: str, place: str, value: str) -> DataFrame:
    """(group, row, value, status): answers to the rows asked for (``ok``, the last of repeated ones), answers to other
    rows (``foreign``) and rows without an answer (``missing``)."""
    last = answers.groupBy(group, row).agg(F.max_by(value, place).alias(value), F.lit(True).alias("_answered"))
    both = expected.select(group, row).distinct().withColumn("_asked", F.lit(True)).join(last, [group, row], "full_outer")
    status = F.when(F.col("_answered").isNull(), "missing").when(F.col("_asked").isNull(), "foreign").otherwise("ok")
    return both.select(group, row, value, status.alias("status"))
