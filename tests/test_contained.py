from __future__ import annotations

from timeloom.plans import matching


def by_hand(rows):
    found = set()
    for i, a in rows:
        for j, b in rows:
            x, y = set(a.split()), set(b.split())
            if i < j and x and y and (x < y or y < x):
                found.add((i, j, a, b))
    return found


def test_contained_names_need_not_begin_alike(spark):
    rows = [
        (1, "sawmill clearance"), (2, "overnight sawmill clearance"), (3, "provisional aqueduct tariff"), (4, "aqueduct tariff"), (5, "tariff"),
        (6, "clearance sawmill"), (2, "sawmill"), (7, "sawmill"), (7, "sawmill"), (8, "tariff tariff"), (9, "silo tariff"), (None, "silo"),
    ]
    found = [tuple(r) for r in matching.contained_names(spark.createDataFrame(rows, "entry_ord bigint, norm string")).collect()]
    assert len(found) == len(set(found)) and set(found) == by_hand([r for r in rows if r[0] is not None])
    assert (1, 2, "sawmill clearance", "overnight sawmill clearance") in found and (3, 4, "provisional aqueduct tariff", "aqueduct tariff") in found


def test_token_subset_finds_all_pairs_of_the_inventory(spark, sf):
    rows = [(r.entry_ord, r.norm) for r in matching.names(spark, sf).select("entry_ord", "norm").distinct().collect()]
    found = [tuple(r) for r in matching.token_subset(spark, sf).select("entry_ord", "other_ord", "norm", "other").collect()]
    assert len(found) == len(set(found)) and set(found) == by_hand(rows)
    assert any(a.split()[0] != b.split()[0] for _, _, a, b in found)
