"""The interval map: any order of insertion, many chunks, gaps kept up to date."""

from __future__ import annotations

import random

import pytest

from timeloom.operators.intervals import DisjointIntervals
from tests.test_general import brute


@pytest.mark.parametrize("size", [1, 2, 3, 8, 512])
def test_any_order_and_chunk_size(size):
    rng = random.Random(size)
    for n in (1, 5, 60, 400):
        spans = [(s := rng.randint(0, 40 * n), s + rng.choice([0, 0, 1, 9, 60, 20 * n if rng.random() < 0.02 else 3])) for _ in range(n)]
        held, seen = DisjointIntervals(size), []
        for s, e in spans:
            before = set(held.periods())
            start, end, swallowed = held.insert(s, e)
            seen.append(("e", s, e))
            assert set(held.periods()) == before - set(swallowed) | {(start, end)}
        want = brute(seen)
        assert [("e", "period", *p) for p in held.periods()] == [w for w in want if w[1] == "period"]
        assert [("e", "gap", *g) for g in held.gaps()] == sorted(w for w in want if w[1] == "gap")
        assert all(0 < len(starts) <= 2 * size for starts, _ in held.chunks())


def test_order_does_not_matter():
    rng = random.Random(2)
    spans = [(s := rng.randint(0, 9000), s + rng.randint(0, 40)) for _ in range(500)]
    results = set()
    for order in (spans, sorted(spans), sorted(spans, reverse=True), sorted(spans, key=lambda s: s[1])):
        held = DisjointIntervals(4)
        for s, e in order:
            held.insert(s, e)
        results.add((tuple(held.periods()), tuple(held.gaps())))
    assert len(results) == 1


def test_streamed_changes_add_up_to_the_batch(spark, tmp_path):
    from timeloom.operators.intervals import periods_and_gaps
    from timeloom.streaming import keyed
    from tests.test_streaming import drained

    rng = random.Random(8)
    rows = [(rng.choice("ab"), s := rng.randint(0, 900), s + rng.randint(0, 12)) for _ in range(120)]
    schema = "slug string, s bigint, e bigint"
    for part in range(6):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sent = drained(keyed.interval_stream(stream, "slug", "s", "e", 10_000), "changes", "update")
    held = {}
    for r in sent:
        held[r.slug, r.kind, r.s, r.e] = held.get((r.slug, r.kind, r.s, r.e), 0) + (-1 if r.gone else 1)
    want = periods_and_gaps(spark.createDataFrame(rows, schema), "slug", "s", "e").collect()
    assert set(held.values()) <= {0, 1} and {k for k, n in held.items() if n} == {tuple(r) for r in want}


def test_streamed_periods_close_and_late_ones_are_told(spark, tmp_path):
    from timeloom.streaming import keyed
    from tests.test_streaming import drained

    for part in ([(0, 10), (20, 30)], [(500, 510)], [(25, 40), (100, 120)]):
        spark.createDataFrame([("a", *r) for r in part], "slug string, s bigint, e bigint").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("slug string, s bigint, e bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sent = [tuple(r)[1:] for r in drained(keyed.interval_stream(stream, "slug", "s", "e", 100), "closing", "update")]
    assert {("period", 0, 10, True, False), ("gap", 10, 20, True, False), ("period", 20, 30, True, False), ("late", 25, 40, True, False)} <= set(sent)
    assert ("gap", 30, 500, False, True) in sent and ("gap", 30, 100, True, False) in sent
