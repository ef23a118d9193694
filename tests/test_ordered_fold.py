"""Folds over keys that span partitions decide as one task would."""

from __future__ import annotations

import random

import pytest

from timeloom.operators import folds
from tests.test_operators import kept_by_hand

RUNS = {
    "noise": lambda rng, i: (rng.randint(0, 40) / 4, float(rng.randint(0, 30))),
    "still": lambda rng, i: (1.0 + (i >= 700) * 50, 2.0),  # many partitions without a kept row
    "slow": lambda rng, i: (i / 7, 0.0),
    "two screens": lambda rng, i: (i // 3 % 2 * 20.0, 0.0),
    "gaps": lambda rng, i: (None if rng.random() < 0.3 else rng.random() * 9, 1.0),
}


@pytest.mark.parametrize("kind", RUNS)
def test_one_key_over_many_partitions(spark, kind):
    rng = random.Random(kind)
    rows = [(i, *RUNS[kind](rng, i)) for i in range(900)]
    other = [(i, float(i % 5), 0.0) for i in range(7)]
    data = [("hot", i + 5000, *r) for i, r in enumerate(rows)] + [(k, i, *r) for k in ("a", "z") for i, r in enumerate(other)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, id bigint, idx bigint, b double, f double").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        found = folds.last_kept(df, "k", ["idx"], "idx", "b", "f", 4.0, 0.3, 2, "id")
        got = {k: sorted((r.idx, r.distance, r.kept, r.suppressed) for r in found.collect() if r.k == k) for k in ("a", "hot", "z")}
        assert got == {"hot": kept_by_hand(rows, 4.0, 0.3, 2), "a": kept_by_hand(other, 4.0, 0.3, 2), "z": kept_by_hand(other, 4.0, 0.3, 2)}
        members = {(r.k, r.segment): (r.first_idx, r.last_idx, r.n, r.representative, r.members) for r in folds.segments(found, "k", "idx", "id").collect()}
        want = {}
        for k, kept in got.items():
            segment = -1
            for idx, _, keep, _ in kept:
                segment += keep
                want.setdefault((k, segment), []).append(idx)
        base = {"hot": 5000, "a": 0, "z": 0}
        assert members == {(k, s): (m[0], m[-1], len(m), m[0] + base[k], ",".join(str(i + base[k]) for i in m)) for (k, s), m in want.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def track_by_hand(rows, diagonal, max_jump, sure_from, after):
    """The rule as it is told: candidates are held until one settles what they were."""
    near = lambda a, b: ((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5 <= diagonal * max_jump
    out, last, held = {}, None, []
    for i, x, y, sure, hand in rows:
        if hand or x is None or sure < sure_from or last is None or near(last, (x, y)):
            out.update({h: "jump" for h, _ in held})
            held = []
            if hand or not (x is None or sure < sure_from):
                last, out[i] = (x, y), "manual" if hand else "auto"
            else:
                out[i] = "weak"
            continue
        held.append((i, (x, y)))
        if len(held) >= max(after, 2) and all(near(a[1], b[1]) for a, b in zip(held, held[1:], strict=False)):
            last = held[-1][1]
            out.update({h: "reanchor" for h, _ in held})
            held = []
    return out | {h: "jump" for h, _ in held}


@pytest.mark.parametrize("after", [2, 3, 5])
def test_track_over_many_partitions(spark, after):
    rng = random.Random(after)
    rows, place = [], 0.0
    for i in range(600):
        place = place + rng.uniform(-3, 3) if rng.random() < 0.9 else rng.uniform(0, 400)
        rows.append((i, None if rng.random() < 0.03 else place + (rng.random() < 0.1) * 200, 1.0, rng.choice([0.9, 0.9, 0.9, 0.1]), False))
        if rng.random() < 0.02 and rows[-1][1] is not None:
            rows[-1] = (*rows[-1][:4], True)
    df = spark.createDataFrame([("hot", *r) for r in rows], "k string, i bigint, x double, y double, sure double, hand boolean").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        found = folds.reanchored(df, "k", ["i"], "i", "x", "y", "sure", "hand", 100.0, 0.10, 0.5, after).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r.i: r.method for r in found} == track_by_hand(rows, 100.0, 0.10, 0.5, after) and len(found) == len(rows)
