"""The nine stages over small tables: what each gives, what it escalates, and what the documents say."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from timeloom.plans import config, run
from timeloom.plans.stages import Pipeline, Stage

WORD = "struct<text:string,left:int,right:int,height:int,confidence:double>"


@pytest.fixture(scope="module")
def tables(spark):
    videos = [("v1", 30.0, 1920, 1080, 0), ("v2", 19.0, 1920, 1080, 90), ("v3", None, 10, 10, 0)]
    detections, measures = [], []
    for i in range(20):
        lost = 5 <= i < 8 or i in (18, 19)
        far = i >= 12
        if not lost:
            detections.append(("v1", i, 1900.0 if far else 800.0, 500.0, 0.9, False))
        measures.append(("v1", i, 0.0 if i < 10 else 50.0, 0.0))
    for i in range(19):
        detections.append(("v2", i, 400.0, 0.0 if 3 <= i <= 9 else 300.0, 0.9, i == 0))
        measures.append(("v2", i, {0: 0.0, 1: 99.0}.get(i, 0.0), 0.0))
    words = [("v1", "f_000000", "title", [("Silo", 0, 40, 10, 0.9), ("Planner", 50, 90, 10, 0.8)]), ("v2", "f_000000", "title", [("blur", 0, 9, 9, 0.1)])]
    readings = [("v1", "f_000000", "Silo Planner", "Yard", ["A"], None, "grid", 1), ("v1", "f_000010", "Silo Plannr", None, None, None, None, 2), ("v1", "f_000999", "Else", None, None, None, None, 3), ("v2", "f_000000", None, None, None, None, None, 4)]
    inventory = [(1, "Silo Planner", "built", None, "/silo", "Yard", "src", ["a.tsx"]), (2, "Vat", "stub", None, None, "Cellar", None, None)]
    make = spark.createDataFrame
    return {
        "videos": make(videos, "slug string, duration_s double, width int, height int, rotation int"),
        "sizes": make([("v1", 1920, 1080), ("v2", 1920, 1080)], "slug string, frame_width int, frame_height int"),
        "detections": make(detections, "slug string, idx bigint, x double, y double, sure double, by_hand boolean"),
        "measures": make(measures, "slug string, idx bigint, band double, whole double"),
        "words": make(words, f"slug string, frame_id string, region string, words array<{WORD}>"),
        "readings": make(readings, "slug string, frame_id string, name string, module string, tabs array<string>, dialog string, description string, at bigint"),
        "corroborating": make([("v1", "s_000", "Silo  planner")], "slug string, id string, other_name string"),
        "inventory": make(inventory, "entry_id bigint, label string, status string, aliases array<string>, route string, module string, source string, component_paths array<string>"),
    }


SETTINGS = {"sample": {"max_frames": 20}, "rectify": {"canonical_size": [1903, 1000], "smooth_window": 3, "max_jump_fraction": 0.05}}


@pytest.fixture(scope="module")
def done(spark, tables, tmp_path_factory):
    p = Pipeline(spark, str(tmp_path_factory.mktemp("run")), config.resolve(SETTINGS))
    run.stages(p, tables)
    return p, p.result("08")


def spans_of(p, stage):
    return sorted((r.slug, r.reason[3:], r.t_ms_start, r.t_ms_end) for r in p.result(stage)["spans"].collect())


def test_probe_and_sample(done):
    p, _ = done
    assert [(r.slug, r.stage) for r in p.result("00")["warnings"].collect()] == [("v2", "00")]
    assert {r.slug: r["count"] for r in p.result("01")["rows"].groupBy("slug").count().collect()} == {"v1": 20, "v2": 20}
    assert spans_of(p, "01") == [("v1", "not-sampled", 20_000, 30_000), ("v2", "orientation-mismatch", 0, 19_000)]


def test_rectify_escalates_runs(done):
    p, _ = done
    rows = {(r.slug, r.idx): (r.method, r.framing) for r in p.result("02")["rows"].collect()}
    assert rows["v1", 6] == ("interpolated", "full") and rows["v1", 19] == ("failed", "lost") and rows["v2", 0] == ("manual", "full") and rows["v2", 19] == ("failed", "lost")
    assert spans_of(p, "02") == [
        ("v1", "reanchor", 12_000, 14_000), ("v1", "screen-not-found", 18_000, 19_000), ("v1", "screen-partial", 12_000, 17_000),
        ("v2", "reanchor", 3_000, 5_000), ("v2", "reanchor", 10_000, 12_000), ("v2", "screen-not-found", 19_000, 19_000), ("v2", "screen-partial", 3_000, 9_000),
    ]


def test_dedupe_names_what_came_too_early(done):
    p, _ = done
    screens = {(r.slug, r.id): (r.t_ms_start, r.t_ms_end, r.representative_frame) for r in p.result("04")["rows"].collect()}
    assert screens == {("v1", "s_000"): (0, 9_000, "f_000000"), ("v1", "s_001"): (10_000, 17_000, "f_000010"), ("v2", "s_000"): (0, 18_000, "f_000000")}
    assert spans_of(p, "04") == [("v2", "gap-suppressed", 1_000, 1_000)]


def test_text_identity_and_agreement(done):
    p, _ = done
    assert {(r.slug, r.id): r.title for r in p.result("05")["rows"].collect()} == {("v1", "s_000"): "Silo Planner", ("v1", "s_001"): None, ("v2", "s_000"): None}
    assert spans_of(p, "05") == [("v1", "title-unreadable", 10_000, 17_000), ("v2", "title-unreadable", 0, 18_000)]
    rows = {(r.slug, r.id): r for r in p.result("06")["rows"].collect()}
    assert rows["v1", "s_000"].confidence.verdict == "accepted" and rows["v1", "s_000"].confidence.score == 0.925  # three frames are interpolated
    assert rows["v2", "s_000"].unreadable == "the title could not be read"
    assert spans_of(p, "06") == [("v1", "low-confidence", 10_000, 17_000), ("v2", "low-confidence", 0, 18_000)]
    assert [(r.slug, r.message[:1]) for r in p.result("06")["warnings"].collect()] == [("v1", "1")]
    assert {r.id for r in run.unresolved(p.result("06")["rows"], False).collect()} == {"s_000"} and run.unresolved(p.result("06")["rows"], True).count() == 3


def test_classification_and_documents(done):
    p, out = done
    rows = {(r.slug, r.id): r for r in p.result("07")["rows"].collect()}
    assert (rows["v1", "s_000"].bucket, rows["v1", "s_000"].match_kind, rows["v1", "s_000"].evidence) == ("built", "exact", "built · src")
    assert rows["v1", "s_001"].match_kind == "fuzzy" and rows["v2", "s_000"].bucket == "new" and rows["v2", "s_000"].inventory_match == 0.5
    assert spans_of(p, "07") == [("v1", "confirm-partial", 0, 9_000)]
    lines = [r.line for r in out["catalogue"].orderBy("slug", "n").collect()]
    assert lines[0] == "| 1 | 00:00 | Silo Planner | Yard | built | 0.93 | tabs: A; grid |" and lines[2].startswith("| 1 | 00:00 | **unread** | — | new | 0.25 ⚠️ | — |")
    assert [(r.slug, r.module, r.line) for r in out["queue"].collect()] == [("v2", "Unassigned", "- **unread** at 00:00, frame f_000000; see review")]
    review = [(r.slug, r.n, r.line) for r in out["review"].orderBy("slug", "n").collect()]
    assert len(review) == sum(len(spans_of(p, s)) for s in ("01", "02", "04", "05", "06", "07")) and review[0][2].startswith("| 00:00–00:09 | confirm-partial | 07 |")
    assert {r.line[:10] for r in out["warnings"].collect()} >= {"- stage 00", "- stage 01", "- stage 02", "- stage 04", "- stage 05", "- stage 06"}


def test_scope_and_partial_labels(spark, tables):
    rows = tables["inventory"].select("label", run.bucket_of(F.col("status"), F.col("module"), F.col("label"), ["yard"], ["SILO planner"]).alias("b")).collect()
    assert [tuple(r) for r in rows] == [("Silo Planner", "partial"), ("Vat", "other")]


def test_results_are_kept_until_configuration_or_sources_change(spark, tables, done, tmp_path):
    p, _ = done
    again = Pipeline(spark, p.root, config.resolve(SETTINGS))
    assert run.stages(again, tables).stale() == [] and again.result("08")["counts"].count() == 2 and again.ran == []
    changed = run.stages(Pipeline(spark, p.root, config.resolve(SETTINGS, {"classify": {"fuzzy_threshold": 0.99}})), tables)
    assert changed.stale() == ["07", "08"]
    source = tmp_path / "in"
    spark.range(3).write.parquet(str(source))
    of = lambda: Pipeline(spark, str(tmp_path / "out"), config.resolve(), {"01": Stage("01", lambda i, c: spark.read.parquet(str(source)), sources=(str(source),))})
    assert of().result("01").count() == 3 and of().stale() == []
    time.sleep(0.01)
    spark.range(4).write.mode("append").parquet(str(source))
    assert of().stale() == ["01"] and of().result("01").count() == 7


def test_nothing_to_work_on_is_an_error(spark, tables):
    with pytest.raises(ValueError, match="no screens"):
        run.emit(spark.createDataFrame([], "slug string"), None, None, [], [])
    missing = run.emit(
        spark.createDataFrame([("v", "s", 0, "n", None, None, "new", (0.5, "review"), None, None, None, "f", None, None)], "slug string, id string, t_ms_start bigint, name string, module string, entry_module string, bucket string, confidence struct<score:double,verdict:string>, tabs array<string>, dialog string, description string, representative_frame string, route string, possible_label string"),
        spark.createDataFrame([("v", None, None, "02:x|y", "a|b\nc", None)], run.SPAN), spark.createDataFrame([], run.WARNING), ["01", "02"], ["01", "02", "03"],
    )
    assert [r.line for r in missing["warnings"].collect()] == ["- stage 08: stages that have not run: 03"]
    assert [r.line for r in missing["review"].collect()] == ["| — | x\\|y | 02 | a\\|b c | — |"]


def test_project_profile_and_roots(tmp_path):
    (tmp_path / "p.yaml").write_text("name: yard\ninventory: data/inventory.json\npublish_to: docs\nclassify:\n  fuzzy_threshold: 0.9\n")
    profile, sections = config.load_project(tmp_path / "p.yaml")
    assert profile == config.Profile("yard", tmp_path / "data/inventory.json", None, None, tmp_path / "docs") and config.resolve(sections)["classify"].fuzzy_threshold == 0.9
    (tmp_path / "q.yaml").write_text("name: yard\n")
    with pytest.raises(ValueError, match="inventory"):
        config.load_project(tmp_path / "q.yaml")
    assert config.root_of({}, "out", "/base/") == "/base/out" and config.root_of({"timeloom.out.root": "/x"}, "out", "/base") == "/x"
    assert os.sep


def test_documents_are_written_side_by_side(spark, done, tmp_path):
    from timeloom.sources.documents import write_documents

    _, out = done
    lines = None
    for name in ("catalogue", "queue", "review", "warnings"):
        part = out[name].select("slug", F.lit(name).alias("document"), "n", "line")
        lines = part if lines is None else lines.unionByName(part)
    write_documents(lines, str(tmp_path / "out"), {"catalogue": "# Screens", "review": "# Review"})
    read = lambda slug, name: [line for f in sorted((tmp_path / "out" / f"slug={slug}" / f"document={name}").glob("part-*")) for line in f.read_text().splitlines()]
    assert read("v1", "catalogue")[0] == "# Screens" and [line.split(" | ")[0] for line in read("v1", "catalogue")[1:]] == ["| 1", "| 2"]
    assert read("v2", "review")[0] == "# Review" and len(read("v2", "review")) == 1 + out["review"].filter("slug = 'v2'").count()
    assert not (tmp_path / "out" / "slug=v1" / "document=queue").exists() and read("v2", "queue") == ["- **unread** at 00:00, frame f_000000; see review"]
