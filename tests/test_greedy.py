"""Claims in turn: in rounds, by one task, and by hand."""

from __future__ import annotations

import random

import pytest

from timeloom.operators.verify import greedy_match


def by_hand(points, spans, tolerance):
    out, taken = set(), set()
    for key, entity, order, t in sorted((p for p in points if p[3] is not None), key=lambda p: (p[1], p[2], p[0])):
        near = sorted((0 if s <= t <= e else min(abs(t - s), abs(t - e)), s, i) for i, whose, s, e in spans if whose == entity and s - tolerance <= t <= e + tolerance and s <= e)
        free = next((n for n in near if (entity, n[2]) not in taken), None)
        if free:
            taken.add((entity, free[2]))
            out.add((key, entity, free[2], free[0]))
    return out


@pytest.mark.parametrize("rest", [0, 150, 10_000])
def test_claims_in_rounds_and_in_turn(spark, rest):
    rng = random.Random(4)
    points = [(i, rng.choice("aab"), rng.randint(0, 30), rng.choice([None, *range(0, 3000, 7)])) for i in range(120)]
    spans = [(f"s{i}", rng.choice("aab"), s := rng.randint(0, 3000), s + rng.choice([0, 30, 200, -5])) for i in range(90)]
    p = spark.createDataFrame(points, "key bigint, entity string, ord bigint, t bigint")
    s = spark.createDataFrame([(i, e, a, a, b) for i, e, a, b in spans], "id string, entity string, span_ord bigint, t_start bigint, t_end bigint")
    found = greedy_match(p, s, 60, rest=rest)
    assert {tuple(r) for r in found.collect()} == by_hand(points, spans, 60) and found.columns == ["key", "entity", "id", "distance"]
    assert greedy_match(p.limit(0), s, 60, rest=rest).collect() == []
