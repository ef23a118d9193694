from __future__ import annotations

import datetime as dt
import random

from hypothesis import given
from hypothesis import strategies as st

from timeloom.operators.intervals import DisjointIntervals, periods_and_gaps
from timeloom.operators.snapshot_diff import SnapshotIndex
from timeloom.plans import general

SNAPSHOT = (
    "row_id bigint, project string, exported_at timestamp, ingested_at timestamp, generated_from struct<commit:string,sources:array<string>>, label string, status string, "
    "aliases array<string>, route string, module string, source string, component_paths array<string>, entity string, key string, digest int"
)


def day(n):
    return dt.datetime(2026, 1, n)


def snap(row_id, project, at, label, status="built", aliases=None, route=None, module=None):
    return (row_id, project, at, at, None, label, status, aliases, route, module, None, None, "clash", "clash", 1)


def changes(spark, rows):
    df = spark.createDataFrame(rows, SNAPSHOT)
    found = general.snapshot_diff.diff_history(general.inventory_index(df)).select("row_id", "change").collect()
    return sorted((r.row_id, r.change) for r in found)


def test_added_removed_changed(spark):
    rows = [
        snap(1, "a", day(1), "Silo  Tariff"), snap(2, "a", day(1), "Gone"), snap(3, "a", day(1), "Same", aliases=["x", "y"]),
        snap(4, "a", day(2), " SILO – tarîff", status="stub"), snap(5, "a", day(2), "New"), snap(6, "a", day(2), "same.", aliases=["y", "x", "y"]),
        snap(7, "a", day(3), "New", aliases=[]), snap(8, "a", day(3), "Gone"), snap(9, "a", day(3), "same"), snap(10, "b", day(2), "first of b"),
    ]
    assert changes(spark, rows) == [(2, "removed"), (4, "changed"), (4, "removed"), (5, "added"), (8, "added"), (9, "changed")]


def test_snapshot_edges(spark):
    old = [snap(1, None, day(1), "A", "patient_scoped"), snap(2, None, day(1), "a", "stub"), snap(3, None, day(1), None), snap(4, None, None, "B")]
    new = [snap(9, None, day(2), "A", "lookup_scoped", aliases=[]), snap(8, None, day(2), "C"), snap(7, None, day(2), "c"), snap(7, None, day(2), "c")]
    assert changes(spark, old + new) == [(7, "added")]
    assert changes(spark, []) == []


def test_stored_index_agrees_with_history(spark, tmp_path):
    rng = random.Random(3)
    rows, n = [], 0
    for d in (1, 2, 3, 4):
        for project in "ab":
            for label in rng.sample("PQRSTUVW", 5):
                n += 1
                rows.append(snap(n, project, day(d), label, rng.choice(["built", "stub"])))
    index = general.inventory_index(spark.createDataFrame(rows, SNAPSHOT)).cache()
    kept = SnapshotIndex(spark, str(tmp_path), buckets=4)
    found = []
    for d in (1, 2, 3, 4):
        new = index.filter(index.snapshot == day(d))
        found += [(r.row_id, r.change) for r in kept.probe(new).collect()]
        kept.swap(new)
    assert sorted(found) == changes(spark, rows)


def brute(intervals, most=None):
    by = {}
    for e, s, t in intervals:
        if e is not None and s is not None and t is not None and s <= t:
            by.setdefault(e, []).append((s, t))
    out = []
    for e, spans in by.items():
        merged = []
        for s, t in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], t)
            else:
                merged.append([s, t])
        out += [(e, "period", s, t) for s, t in merged]
        out += [(e, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:], strict=False) if most is None or b[0] - a[1] <= most]
    return sorted(out)


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8)), max_size=30))
def test_interval_map_merges(spans):
    held = DisjointIntervals()
    for s, n in spans:
        held.insert(s, s + n)
    want = brute([("e", s, s + n) for s, n in spans])
    assert [("e", "period", s, t) for s, t in zip(held.starts, held.ends, strict=True)] == [w for w in want if w[1] == "period"]
    assert [("e", "gap", s, t) for s, t in held.gaps()] == sorted(w for w in want if w[1] == "gap")


def test_periods_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), s := rng.randint(0, 4000), s + rng.choice([0, 1, 5, 30, 900, -3])) for _ in range(600)]
    rows += [("x", None, 5), ("x", 5, None), (None, 1, 2), ("y", 7, 7), ("y", 7, 7), ("long", 0, 100000), *(("long", i * 10, i * 10) for i in range(300))]
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "slug string, a bigint, b bigint, entity string, start int")
    for most in (None, 20):
        found = sorted(tuple(r) for r in periods_and_gaps(df, "slug", "a", "b", most).collect())
        assert found == brute(rows, most)


def test_no_intervals(spark):
    assert periods_and_gaps(spark.createDataFrame([], "slug string, a bigint, b bigint"), "slug", "a", "b").collect() == []
