from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from timeloom.functions import geometry, hashes, timecode
from timeloom.functions.labels import normalise_label_text
from timeloom.functions.similarity import Nearest, is_token_subset, similarity, token_set_score


@pytest.mark.parametrize(
    ("text", "ms"),
    [
        ("14:02", 842000), ("1:14:02", 4442000), ("14:02.5", 842500), ("902", 902000), (" 00:04.051\t", 4051), ("123456:00:00", 123456 * 3600000), ("12.34", 12340),
        ("9:9:9:9", None), ("", None), ("n/a", None), ("00:xx", None), ("-5", None), ("5.", None), ("1.2345", None), (None, None), ("99999999999999999999", None),
    ],
)
def test_parse_timecode(spark, text, ms):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(timecode.parse_timecode(F.col("t"))).first()[0] == ms


def test_strict_timecodes_and_ranges_raise(spark):
    df = spark.createDataFrame([("4:10", "3:00")], "a string, b string")
    with pytest.raises(Exception, match="range ends before"):
        df.select(timecode.parse_range(F.col("a"), F.col("b"))).collect()
    with pytest.raises(Exception, match="cannot parse"):
        df.select(timecode.parse_timecode_strict(F.concat("a", F.lit("x")))).collect()
    assert df.select(timecode.parse_range(F.col("b"), F.col("a")).alias("r")).first().r.asDict() == {"t_ms_start": 180000, "t_ms_end": 250000}


def test_format_timecode(spark):
    rows = spark.createDataFrame([(0,), (59_999,), (3_600_000,), (-5,), (None,)], "t bigint").select(timecode.format_timecode(F.col("t")), timecode.format_stamp(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [("00:00", "00m00s"), ("00:59", "00m59s"), ("1:00:00", "1h00m00s"), ("00:00", "00m00s"), (None, None)]


def test_normal_labels():
    assert normalise_label_text("  Dépôt – Planner!! ") == "depot planner"
    assert normalise_label_text("STRASSE_ß") == "strasse_ss"


@pytest.mark.parametrize(
    ("a", "b", "score"),
    [
        ("search for a patient", "patient crm", 0.78), ("patient encounter selection", "encounter", 1.0), ("orders", "anc orders", 1.0), ("report viewer", "report viewr", 0.96),
        ("settings", "report viewr", 0.30), ("snapboard", "snap board", 0.53), ("", "x", 0.0),
    ],
)
def test_token_set_score(a, b, score):
    assert abs(token_set_score(a, b) - score) <= 0.005
    assert token_set_score(a, b) == token_set_score(b, a)


def test_similarity_and_subset_columns(spark):
    df = spark.createDataFrame([("Task List Signed In", "task list"), ("Task List", "list task"), ("", "a"), (None, "a")], "a string, b string")
    rows = df.select(similarity(F.col("a"), F.col("b")), is_token_subset(F.lower("a"), F.col("b"))).collect()
    assert [r[0] for r in rows] == [1.0, 1.0, 0.0, None]
    assert [r[1] for r in rows][:3] == [True, False, False]


def test_hash_distances(spark):
    rows = [("2x2:ff", "2x2:0f"), ("2x2:ff", "2x2:ff"), ("2x2:ff", "4x1:ff"), ("", "2x2:ff"), ("2x2:zz", "2x2:ff"), ("2x2:ff", None), ("32x4:" + "f" * 64, "32x4:" + "0" * 64), ("7x1:fffc", "7x1:0000")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(hashes.hamming_distance(F.col("a"), F.col("b"))).collect()] == [32, 0, 64, 64, 64, 64, 64, 64]


def test_grid_for(spark):
    r = spark.range(1).select(hashes.grid_for(F.lit(190), F.lit(1600)).alias("band"), hashes.grid_for(F.lit(1000), F.lit(1600)).alias("full")).first()
    assert (r.band.cols, r.band.rows, r.full.cols, r.full.rows) == (32, 4, 14, 9)


def quad(points):
    return F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points))


def test_geometry(spark):
    q = quad([(0, 0), (40, 0), (40, 20), (0, 20)])
    r = spark.range(1).select(
        geometry.area(q).alias("area"), geometry.aspect(q).alias("aspect"), geometry.centre(q).alias("c"), geometry.touches_border(q, F.lit(100), F.lit(100)).alias("t"),
        F.transform(geometry.order_corners(quad([(40, 20), (0, 0), (0, 20), (40, 0)])), lambda p: F.concat_ws(",", p["x"].cast("int").cast("string"), p["y"].cast("int").cast("string"))).alias("o"),
    ).first()
    assert (r.area, r.aspect, tuple(r.c), r.t, r.o) == (800.0, 2.0, (20.0, 10.0), True, ["0,0", "40,0", "40,20", "0,20"])


@pytest.mark.parametrize(
    ("a", "b", "jump", "ok"),
    [((900, 500), (908, 506), 0.10, True), ((400, 300), (1500, 800), 0.10, False), ((900, 500), (1200, 500), 0.10, False), ((900, 500), (1200, 500), 0.20, True)],
)
def test_jumps(spark, a, b, jump, ok):
    point = lambda p: F.struct(F.lit(p[0]).alias("x"), F.lit(p[1]).alias("y"))
    diagonal = F.hypot(F.lit(1920), F.lit(1080))
    assert spark.range(1).select(geometry.plausible_successor(point(a), point(b), diagonal, jump)).first()[0] is ok
    assert spark.range(1).select(geometry.plausible_successor(point(a), point(b), F.lit(0), jump)).first()[0] is True


@pytest.mark.parametrize(
    ("run", "ok"),
    [([(951, 421), (852, 403), (846, 430), (848, 436)], True), ([(200, 200), (900, 600), (1600, 200), (500, 900)], False), ([(1, 1)], False)],
)
def test_settled(spark, run, ok):
    assert spark.range(1).select(geometry.settled(quad(run), F.lit(2203.0), 0.10)).first()[0] is ok


def test_band_rects(spark):
    r = spark.range(1).select(geometry.band_rects(F.lit(0), F.lit(100), F.lit(1600), {"a": (0, 0.4, 0, 0.5), "b": (1, 1.4, 0, 0.5), "none": (0, 0.001, 0, 1)}).alias("m")).first().m
    assert {k: tuple(v) for k, v in r.items()} == {"a": (0, 0, 800, 40), "b": (0, 100, 800, 40)}


def test_nearest_is_the_first_best_score():
    import random

    rng = random.Random(1)
    name = lambda: " ".join("".join(rng.choices("abcd", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 3)))
    names = [name() for _ in range(80)]
    nearest = Nearest(names)
    for _ in range(200):
        read = name()
        scores = [token_set_score(read, n) for n in names]
        best = max(scores)
        assert nearest.find(read) == ((best, scores.index(best)) if best > 0 else (0.0, None))
