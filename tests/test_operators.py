from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from timeloom.operators import confidence, folds, resolve, state, timeline, verify


def kept_by_hand(rows, threshold, weight, gap):
    out, last = [], None
    for i, b, f in rows:
        if b is None:
            continue
        if last is None:
            out.append((i, None, True, False))
            last = (i, b, f)
            continue
        d = round(abs(b - last[1]) + weight * abs(f - last[2]), 4)
        keep = d > threshold and i - last[0] >= gap
        out.append((i, d, keep, d > threshold and not keep))
        last = (i, b, f) if keep else last
    return out


def test_last_kept_fold(spark):
    rng = random.Random(2)
    rows = {k: [(i, None if rng.random() < 0.1 else rng.randint(0, 40) / 4, rng.randint(0, 30)) for i in range(60)] for k in "abc"}
    df = spark.createDataFrame([(k, i, b, f, f"{k}{i}") for k, v in rows.items() for i, b, f in v], "k string, idx bigint, b double, f bigint, id string").repartition(5)
    found = folds.last_kept(df, "k", ["idx"], "idx", "b", "f", 4.0, 0.3, 2, "id").collect()
    for k, v in rows.items():
        assert sorted((r.idx, r.distance, r.kept, r.suppressed) for r in found if r.k == k) == kept_by_hand(v, 4.0, 0.3, 2)
    assert folds.last_kept(df.limit(0), "k", ["idx"], "idx", "b", "f", 4.0, 0.3, 2, "id").collect() == []


def methods(spark, track):
    df = spark.createDataFrame([("v", i, f"f{i}", *t) for i, t in enumerate(track)], "k string, idx bigint, id string, x double, y double, sure double, hand boolean")
    out = folds.reanchored(df, "k", ["idx"], "id", "x", "y", "sure", "hand", 2203.0, 0.10, 0.55, 3).collect()
    return [r.method for r in sorted(out, key=lambda r: int(r.id[1:]))]


def test_track_reanchors_on_agreement(spark):
    at = lambda x, y=500.0, sure=0.9, hand=False: (float(x), y, sure, hand)
    assert methods(spark, [at(900), at(1500), at(1510), at(1505), at(1500)]) == ["auto", "reanchor", "reanchor", "reanchor", "auto"]
    assert methods(spark, [at(900), at(1500), at(905), at(1500), at(1500, sure=0.1)]) == ["auto", "jump", "auto", "jump", "weak"]
    assert methods(spark, [at(900), at(200), at(1600), at(300), at(1500, hand=True), at(1490)]) == ["auto", "jump", "jump", "jump", "manual", "auto"]


def test_skip_and_pins(spark):
    df = spark.createDataFrame([(t,) for t in (0, 9, 10, 19, 20)], "t bigint")
    assert [r.t for r in timeline.skip_ranges(df, "t", [(10, 20)]).collect()] == [0, 9, 20]
    assert [r[0] for r in df.select(timeline.first_range(F.col("t"), [(9, 10), (10, 20)])).collect()] == [None, 0, 0, 1, 1]


@pytest.mark.parametrize("size", [1_000_000, 3])
def test_interpolation_and_median(spark, size):
    values = [1.0, None, 3.0, None, None, None, 7.0, None]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i bigint, v double")
    out = timeline.interpolate_gaps(df, "k", "i", "v", 2, size=size).orderBy("i").collect()
    assert [r.filled for r in out] == [1.0, 2.0, 3.0, None, None, None, 7.0, None] and out[1].interpolated and not out[3].interpolated
    smooth = timeline.median_smooth(df, "k", "i", "v", 5, size=size).orderBy("i").collect()
    assert [r.smoothed for r in smooth] == [2.0, None, 2.0, None, None, None, 7.0, None]


@pytest.mark.parametrize("size", [1_000_000, 1, 4, 7])
def test_islands_in_slabs(spark, size):
    rng = random.Random(11)
    places = sorted(rng.sample(range(80), 55))
    df = spark.createDataFrame([("k", p) for p in places], "k string, p bigint")
    want = []
    for p in places:
        if want and p == want[-1][1] + 1:
            want[-1] = (want[-1][0], p, want[-1][2] + 1)
        else:
            want.append((p, p, 1))
    assert sorted((r['first'], r['last'], r.n) for r in timeline.islands(df, ["k"], "p", size).collect()) == want


def test_words(spark):
    words = [("b", 50, 90, 20, 0.9), ("a", 0, 40, 20, 0.8), ("no", 100, 130, 20, 0.1), ("c", 150, 190, 20, 0.7)]
    df = spark.createDataFrame([(words,), ([],)], "w array<struct<text:string,left:int,right:int,height:int,confidence:double>>")
    rows = df.select(timeline.join_words(F.col("w"), 0.4).alias("j"), timeline.labels_by_gaps(F.col("w"), 0.4).alias("g")).collect()
    assert (rows[0].j.text, rows[0].j.confidence, rows[0].g) == ("a b c", 0.8, ["a b", "c"])
    assert (rows[1].j.text, rows[1].j.confidence, rows[1].g) == (None, None, [])


def entries(spark):
    rows = [(1, "Task List", None), (2, "Medication Reconciliation", ["Med Rec"]), (3, "Bed Board", []), (4, "task  list", None)]
    return spark.createDataFrame(rows, "ord bigint, label string, aliases array<string>")


def test_cascade(spark):
    names = resolve.reference_names(entries(spark), "ord", "label", "aliases")
    reads = spark.createDataFrame([(i, n) for i, n in enumerate(["task list", "med rec", "bed boad", "medication", "zzz qqq", "", None, "drugs"])], "i int, norm string")
    out = {r.i: (r.match_kind, r.matched_ord, r.possible_label) for r in resolve.match_cascade(reads, names, {"Drugs": "med rec"}, 0.82).collect()}
    assert out[0] == ("exact", 1, None) and out[1] == ("exact", 2, None) and out[2] == ("fuzzy", 3, None) and out[7] == ("alias", 2, None)
    assert out[3] == ("subset", None, "Medication Reconciliation") and out[4][0] == "none" and out[5] == ("none", None, None) and out[6] == ("none", None, None)


def test_nearest_in_blocks_is_the_same(spark):
    names = resolve.reference_names(entries(spark), "ord", "label", "aliases")
    reads = spark.createDataFrame([("bed boad",), ("list of tasks",), ("rec",)], "norm string")
    whole = sorted(tuple(r) for r in resolve.match_nearest(reads, names).collect())
    assert whole == sorted(tuple(r) for r in resolve.match_nearest(reads, names, block=2).collect())


def test_inventory_checks(spark):
    assert [(r.norm, r.entries) for r in resolve.duplicate_labels(entries(spark), "ord", "label").collect()] == [("task list", 2)]
    shadow = spark.createDataFrame([(1, "A", ["b"]), (2, "B", None)], "ord bigint, label string, aliases array<string>")
    assert [(r.alias_ord, r.label_ord) for r in resolve.shadowing_aliases(resolve.reference_names(shadow, "ord", "label", "aliases")).collect()] == [(1, 2)]


@pytest.mark.parametrize(
    ("signals", "score", "verdict"),
    [((0.0, None, 1.0, 1.0), 0.5714, "review"), ((1.0, None, 0.94, 1.0), 0.9829, "accepted"), ((1.0, None, None, None), 1.0, "review"), ((None,) * 4, 0.0, "review")],
)
def test_combined_confidence(spark, signals, score, verdict):
    names = ("ocr_agreement", "cross_frame", "legibility", "framing")
    weights = dict(zip(names, (0.3, 0.3, 0.2, 0.2), strict=True))
    c = spark.range(1).select(confidence.combine({n: F.lit(s) for n, s in zip(names, signals, strict=True)}, weights, 0.75).alias("c")).first().c
    assert (c.score, c.verdict, "cross_frame" in c.missing) == (score, verdict, True)


def test_cross_frame_votes_first_seen(spark):
    df = spark.createDataFrame([("s", 1, "Orders"), ("s", 2, "Results"), ("s", 3, None), ("t", 1, "x"), ("u", 1, "A b"), ("u", 2, "a-b")], "k string, i int, name string")
    out = {r.k: (r.modal, r.agreement, r.names) for r in confidence.cross_frame_agreement(df, "k", "name", "i").collect()}
    assert out["s"][0] == "orders" and out["u"] == ("a b", 1.0, 2) and "t" not in out


def greedy_by_hand(points, spans, tol):
    taken, out = set(), []
    for key, t in points:
        best = None
        for order, (sid, s, e) in enumerate(spans):
            if sid in taken or not s - tol <= t <= e + tol:
                continue
            d = 0 if s <= t <= e else min(abs(t - s), abs(t - e))
            if best is None or (d, order) < best[:2]:
                best = (d, order, sid)
        if best:
            taken.add(best[2])
            out.append((key, best[2], best[0]))
    return sorted(out)


def test_greedy_match_is_the_serial_order(spark):
    rng = random.Random(7)
    spans = [(f"s{i:02d}", i * 1500, i * 1500 + rng.randint(0, 2500)) for i in range(60)]
    points = [(i, rng.randint(-1000, 95000)) for i in range(120)]
    ps = spark.createDataFrame([(k, "v", k, t) for k, t in points], "key bigint, entity string, ord bigint, t bigint")
    ss = spark.createDataFrame([("v", i, o, s, e) for o, (i, s, e) in enumerate(spans)], "entity string, id string, span_ord bigint, t_start bigint, t_end bigint")
    found = sorted((r.key, r.id, r.distance) for r in verify.greedy_match(ps, ss, 2000).collect())
    assert found == greedy_by_hand(points, spans, 2000)


@pytest.mark.parametrize(("run", "fixture", "ms"), [(2.0, 1.0, 2000), (2.0, None, 1000), (1.0, 1.0, 2000), (0.0, None, 2000)])
def test_tolerance(run, fixture, ms):
    assert verify.tolerance_ms(run, fixture) == ms


def test_gap_and_field_findings(spark):
    gaps = spark.createDataFrame([(1, "v", 1000, 2000), (2, "v", 500000, 510000)], "key bigint, entity string, t_start bigint, t_end bigint")
    spans = spark.createDataFrame([("v", "s", 3500, 9000)], "entity string, id string, t_start bigint, t_end bigint")
    assert {r.key: r.covered for r in verify.covered_gaps(gaps, spans, 2000).collect()} == {1: True, 2: False}
    pairs = spark.createDataFrame([(1, "A", "B", None, "m"), (2, "A", None, "m", "m")], "key bigint, xn string, n string, xm string, m string")
    out = verify.field_differences(pairs, {"name": ("xn", "n", "regression"), "module": ("xm", "m", "drift")}).collect()
    assert sorted((r.key, r.field, r.actual) for r in out) == [(1, "name", "B"), (2, "name", None)]


def test_state_tables(spark):
    table = spark.createDataFrame([("02:a", 1), ("04:b", 2), (None, 3)], "reason string, n int")
    again = spark.createDataFrame([("02:c", 9)], "reason string, n int")
    assert sorted(r.n for r in state.replace_by_owner(table, again, state.owner_of_reason(), "02").collect()) == [2, 3, 9]
    assert sorted(r.n for r in state.upsert(table, spark.createDataFrame([("04:b", 8)], "reason string, n int"), "reason").collect()) == [1, 3, 8]
    answers = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 2, "y"), (1, "z", 3, "q")], "g int, r string, p int, v string")
    asked = spark.createDataFrame([(1, "a"), (1, "b")], "g int, r string")
    assert sorted((x.r, x.v, x.status) for x in state.attribute(answers, asked, "g", "r", "p", "v").collect()) == [("a", "y", "ok"), ("b", None, "missing"), ("z", "q", "foreign")]
