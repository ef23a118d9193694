from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from timeloom.operators.numbering import chunked, numbered, numbered_within, with_previous
from timeloom.operators.ordered import join_unique, prefix_scan


@given(st.lists(st.integers(-5, 5), max_size=40))
def test_prefix_scan_is_a_running_fold(items):
    want = [sum(items[: i + 1]) for i in range(len(items))]
    assert prefix_scan(items, lambda a, b: a + b) == want
    words = [str(i) for i in items]
    assert prefix_scan(words, lambda a, b: a + b) == ["".join(words[: i + 1]) for i in range(len(words))]


def test_numbered_gives_every_place_once(spark):
    values = [random.Random(1).randint(0, 50) for _ in range(500)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(7)
    rows = numbered(df, "v", "i").collect()
    want = {i: n for n, (_, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))}
    assert {r.i: r.position for r in rows} == want


def test_places_within_keys_of_any_size(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b", None]), rng.randint(0, 9), i) for i in range(700)]
    df = spark.createDataFrame([(v, k, i) for k, v, i in rows], "v int, k string, i int").repartition(3)
    found = {r.i: r.idx for r in numbered_within(df, "k", "v", "i").collect()}
    want = {}
    for key in {k for k, _, _ in rows}:
        want |= {i: n for n, (_, i) in enumerate(sorted((v, i) for k, v, i in rows if k == key))}
    assert found == want and numbered_within(df.limit(0), "k", "v").collect() == []


def test_previous_within_keys(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 5 + ["a", "b"]), i, rng.choice([None, "x", "y"])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, v string").repartition(3)
    found = {r.i: r.previous for r in with_previous(df, "k", "v", "i").collect()}
    want, last = {}, {}
    for k, i, v in rows:
        want[i], last[k] = last.get(k), v
    assert found == want and with_previous(df.limit(0), "k", "v", "i").collect() == []


def test_numbered_of_nothing(spark):
    assert numbered(spark.createDataFrame([], "v int"), "v").collect() == []


def test_chunks(spark):
    rows = chunked(spark.range(45), 20, "id").orderBy("id").collect()
    assert [(r.sheet, r.row) for r in rows][19:22] == [(0, 19), (1, 0), (1, 1)]


def test_join_unique_keeps_all_rows_of_hot_and_cold_keys(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 300).cast("string"))).alias("key"), "id")
    unique = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    out = join_unique(rows, unique, "key", "n", 1000, parts=10)
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    assert out.filter("key = 'hot'").select("first").distinct().count() == 1
