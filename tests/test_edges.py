from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from timeloom.functions import pixels
from timeloom.plans import config, driver
from timeloom.plans.stages import Pipeline, Stage
from timeloom.sources import documents, engines, grid, images


def frame(top=0, bottom=110, height=1000, width=160):
    image = np.full((height, width, 3), 235, np.uint8)
    image[top:bottom] = (200, 60, 20)
    return image


@pytest.mark.parametrize(("band", "found"), [((0, 110), (0, 110)), ((14, 120), (14, 120)), ((0, 0), None), ((0, 8), None), ((500, 640), None)])
def test_chrome_band(band, found):
    assert pixels.chrome_extent(frame(*band)) == found


def test_topmost_chrome_band_wins():
    image = frame(0, 60)
    image[200:340] = (200, 60, 20)
    assert pixels.chrome_extent(image) == (0, 60)


def test_png_round_trip_and_ppm():
    rng = np.random.default_rng(1)
    for shape in ((7, 9), (5, 4, 3)):
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (pixels.decode(pixels.encode_png(image)) == image).all()
    assert pixels.decode(b"P6\n# c\n2 1\n255\n" + bytes(range(6))).tolist() == [[[0, 1, 2], [3, 4, 5]]]
    with pytest.raises(Exception):
        pixels.decode(b"not an image")


def test_hash_tells_screens_apart():
    rng = np.random.default_rng(2)
    image = np.kron(rng.integers(0, 256, (9, 16)), np.ones((20, 20))).astype(np.uint8)
    noisy = np.clip(image.astype(int) + rng.integers(-1, 2, image.shape), 0, 255).astype(np.uint8)
    assert pixels.difference_hash(image).startswith("15x9:") or ":" in pixels.difference_hash(image)
    assert pixels.difference_hash(image) != pixels.difference_hash(image[::-1])
    a, b = pixels.difference_hash(image).split(":")[1], pixels.difference_hash(noisy).split(":")[1]
    assert bin(int(a, 16) ^ int(b, 16)).count("1") < 12
    assert pixels.difference_hash(image[:3]) == ""


def test_warp_shift_and_detect():
    image = np.full((120, 200), 20, np.uint8)
    image[20:100, 40:170] = 220
    quad, sure = pixels.detect_quad(image)
    assert np.abs(quad - [[40, 20], [169, 20], [169, 99], [40, 99]]).max() <= 2 and sure > 0.8
    assert pixels.warp(image, quad, 64, 40).mean() > 200
    rng = np.random.default_rng(3)
    texture = pixels.blur(rng.integers(0, 256, (128, 128)), 1.0)
    texture = np.clip(texture, 0, 255).astype(np.uint8)
    dx, dy, response = pixels.shift_between(texture, np.roll(texture, (2, -1), axis=(0, 1)))
    assert (dx, dy) == (-1.0, 2.0) and response > pixels.MIN_RESPONSE
    moved, done = pixels.align(np.roll(texture, (2, -1), axis=(0, 1)), texture)
    assert done and np.abs(moved[8:-8, 8:-8].astype(int) - texture[8:-8, 8:-8]).mean() < 1


def test_enhancement_keeps_shape_and_range():
    image = frame()
    for out in (pixels.suppress_glare(image, 0.3), pixels.equalise(image), pixels.prepare_for_reading(image[:40])):
        assert out.dtype == np.uint8 and out.ndim in (2, 3)
    assert pixels.legibility(np.full((20, 20), 7, np.uint8)) == 0.0
    assert pixels.changed_share(image, image) == 0.0 and pixels.changed_share(image, image[:5]) == 1.0
    assert pixels.contrast(np.zeros((0, 3), np.uint8)) == 0.0


def test_images_as_source(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f_{i:06d}.png").write_bytes(pixels.encode_png(np.full((8, 10), i * 40, np.uint8)))
    files = images.read_files(spark, str(tmp_path), "*.png")
    assert sorted((r.w, r.h) for r in files.select(images.sizes(F.col("content")).alias("s")).select("s.*").collect()) == [(10, 8)] * 3
    assert files.select("sha256").distinct().count() == 3
    sheets = images.montage(files.withColumn("sheet", F.lit(0)), "sheet", "path", "content", 32, 8)
    first = sheets.first()
    assert first.rows == 3 and pixels.decode(first.content).shape == (24, 32) and sheets.first().sha256 == first.sha256


def test_cleaning_aligns_to_the_frame_before(spark):
    rng = np.random.default_rng(5)
    base = np.clip(pixels.blur(rng.integers(0, 256, (64, 96)), 1.0), 0, 255).astype(np.uint8)
    rows = [("v", i, bytearray(pixels.encode_png(np.roll(base, i % 2, axis=0)))) for i in range(3)] + [("v", 3, None)]
    frames = spark.createDataFrame(rows, "slug string, idx int, content binary")
    steps = {"align": True, "clahe": {"on": False}, "deglare": {"on": False}, "moire": {"on": False}}
    out = images.cleaned(frames, "slug", "idx", "content", steps).orderBy("idx").collect()
    assert [r.aligned for r in out] == [False, True, True]
    assert np.abs(pixels.decode(out[1].content)[6:-6].astype(int) - base[6:-6]).mean() < 1
    every = {"align": False, "clahe": {"on": True, "clip": 2.0, "tiles": 4}, "deglare": {"on": True, "amount": 0.3}, "moire": {"on": True, "sigma": 0.6}}
    assert images.cleaned(frames, "slug", "idx", "content", every).count() == 3


def test_driver_steps(spark, tmp_path):
    videos = spark.createDataFrame([("v", "aa", 1.0)], "slug string, sha256 string, duration_s double")
    added = driver.register(videos, "w", {"duration_s": 2.0}, "bb")
    assert added.count() == 2 and driver.register(added, "w", {"duration_s": 3.0}, "bb").count() == 2
    with pytest.raises(ValueError, match="not the one registered"):
        driver.register(videos, "v", {}, "cc")
    assert driver.register(videos, "v", {}, "cc", force=True).first().sha256 == "cc"
    with pytest.raises(ValueError, match="not a slug"):
        driver.check_slug("Bad Slug")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "config.yaml").write_text(driver.config_template(609.2))
    assert driver.listed(str(tmp_path)) == ["b"] and config.resolve(config.load_layer(tmp_path / "b" / "config.yaml"))["sample"].max_frames == 611
    assert driver.same_commit("ABCDEF1", "abcdef1234") and not driver.same_commit("abc", "abc") and not driver.same_commit(None, "abcdef1")
    with pytest.raises(ValueError, match="the inventory was made at"):
        driver.require_fresh(None, "abcdef1")
    driver.run_exporter("true", str(tmp_path))
    with pytest.raises(RuntimeError, match="boom"):
        driver.run_exporter("sh -c 'echo boom >&2; exit 3'", str(tmp_path))
    assert driver.head_commit(str(tmp_path / "none")) is None


def test_grid_source(spark):
    grid.register(spark)
    rows = spark.read.format("timeloom_grid").options(slug="v", duration_s=10.2, fps=2, rowsPerPartition=4, max_frames=15).load()
    assert rows.count() == 15 and rows.rdd.getNumPartitions() == 4
    assert [tuple(r) for r in rows.orderBy("idx").take(2)] == [("v", 0, "f_000000", 0), ("v", 1, "f_000001", 500)]


def test_manifest_round_trip(spark, tmp_path):
    manifest = {"schema_version": 1, "video": {"slug": "v", "fps": 30.0}, "frames": [{"id": "f_000000", "t_ms": 0}], "screens": [{"id": "s_000", "frame_ids": ["f_000000"], "identity": {"name": "A", "tabs": []}}]}
    (tmp_path / "in.json").write_text(json.dumps(manifest, indent=2))
    read = documents.read_manifests(spark, str(tmp_path / "in.json"))
    documents.write_manifests(read, str(tmp_path / "out"))
    again = documents.read_manifests(spark, str(tmp_path / "out"))
    assert documents.entity(again, "screens").select("slug", "id", "identity.name").first() == ("v", "s_000", "A")
    (tmp_path / "bad.json").write_text("{nope")
    with pytest.raises(Exception):
        documents.read_manifests(spark, str(tmp_path / "bad.json")).collect()


def test_inventory_contract(spark, tmp_path):
    entry = {"label": "Task List", "status": "patient_scoped", "aliases": [], "unknown_field": 1}
    (tmp_path / "inv.json").write_text(json.dumps({"project": "p", "generated_from": {"commit": "abc"}, "entries": [entry, {"label": "B", "status": "stub"}]}))
    rows = documents.read_inventory(spark, str(tmp_path / "inv.json"))
    documents.check_inventory(rows)
    assert [(r.entry_ord, r.status) for r in rows.orderBy("entry_ord").collect()] == [(0, "lookup_scoped"), (1, "stub")]
    with pytest.raises(ValueError, match="not unique"):
        documents.check_inventory(rows.unionByName(rows.withColumn("label", F.lit("task, LIST"))))
    with pytest.raises(ValueError, match="unknown status"):
        documents.check_inventory(rows.withColumn("status", F.lit("nope")))


def test_probe(spark):
    said = {"streams": [{"codec_type": "audio"}, {"codec_type": "video", "codec_name": "h264", "width": 1920, "height": 1080, "avg_frame_rate": "30000/1001", "r_frame_rate": "30/1", "duration": "N/A", "side_data_list": [{"rotation": -90}]}], "format": {"duration": "609.2"}}
    r = spark.createDataFrame([(json.dumps(said),)], "j string").select(documents.parse_probe(F.col("j")).alias("p")).first().p
    assert (r.width, round(r.fps, 3), r.duration_s, r.rotation, r.codec) == (1920, 29.97, 609.2, 270, "h264")


def test_fixture_yaml_last_key_wins(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "f.yaml").write_text('slug: v\nscreens:\n  - t: "00:12"\n    name: "Task"\nmissed_spans:\n  - {from: "0:01", to: "0:02"}\nmissed_spans:\n  - {from: "0:03", to: "0:05", note: x}\n')
    screens, gaps = documents.read_fixture(spark, str(tmp_path / "f.yaml"))
    assert [(r.t_ms, r.name, r.module) for r in screens.collect()] == [(12000, "Task", None)]
    assert [(r.t_ms_start, r.t_ms_end) for r in gaps.collect()] == [(3000, 5000)]


def test_markdown_sink(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b|c"), (1, None), (3, "x\ny")], "n int, name string")
    lines = documents.markdown_table(rows, {"n": F.col("n"), "name": F.col("name")}, "n")
    assert [r.value for r in lines.collect()] == ["| n | name |", "| --- | --- |", "| 1 | — |", "| 2 | b\\|c |", "| 3 | x y |"]
    assert documents.publish(lines, str(tmp_path / "out")) is None
    assert documents.publish(lines, "nosuchfs://x/y") is not None


class Stub:
    label = "stub"

    def ask(self, payload: bytes, prompt: str) -> tuple[str, str]:
        return ("refusal", "no") if payload == b"bad" else ("reading", payload.decode() + prompt)


def test_engine_is_asked_once_and_refusals_are_not_cached(spark):
    questions = spark.createDataFrame([(1, bytearray(b"a"), "?"), (2, bytearray(b"a"), "?"), (3, bytearray(b"bad"), "?")], "id int, payload binary, prompt string")
    empty = spark.createDataFrame([], "key string, answer string")
    answers, fresh = engines.answer(questions, empty, Stub)
    assert sorted((r.id, r.status, r.answer) for r in answers.collect()) == [(1, "reading", "a?"), (2, "reading", "a?"), (3, "refusal", "no")]
    assert fresh.count() == 1
    again, more = engines.answer(questions, fresh, Stub)
    assert sorted(r.status for r in again.collect()) == ["cached", "cached", "refusal"] and more.count() == 0
    other, _ = engines.answer(questions, fresh, Stub, version="2")
    assert "cached" not in {r.status for r in other.collect()}


def test_config_layers():
    found = config.resolve({"sample": {"fps": 2.0, "skip_ranges": [1]}, "classify": {"aliases": {"a": "b"}}}, {"sample": {"skip_ranges": [2, 3]}, "classify": {"aliases": {"c": "d"}}})
    assert found["sample"].fps == 2.0 and found["sample"].skip_ranges == (2, 3) and found["classify"].aliases == {"a": "b", "c": "d"}
    assert config.digest(found["ocr"]) == config.digest(config.resolve()["ocr"]) != config.digest(found["sample"])
    for bad in ({"sample": {"fps": 0}}, {"nope": {}}, {"sample": {"nope": 1}}, {"rectify": {"smooth_window": 4}}, {"rectify": {"aspect_bounds": [2, 1]}}):
        with pytest.raises(ValueError):
            config.resolve(bad)


def test_stages_run_again_only_for_changed_sections(spark, tmp_path):
    def pipeline(**over):
        p = Pipeline(spark, str(tmp_path), config.resolve(over))
        p.add(Stage("01", lambda _, c: spark.range(c["sample"].max_frames), (), ("sample",)))
        p.add(Stage("04", lambda i, c: i["01"].filter(F.col("id") % c["dedupe"].min_gap_frames == 0), ("01",), ("dedupe",)))
        return p

    first = pipeline(sample={"max_frames": 10})
    assert first.stale() == ["01", "04"] and first.result("04").count() == 5 and first.ran == ["01", "04"]
    same = pipeline(sample={"max_frames": 10})
    assert same.result("04").count() == 5 and same.ran == []
    other = pipeline(sample={"max_frames": 10}, dedupe={"min_gap_frames": 5})
    assert other.stale() == ["04"] and other.result("04").count() == 2 and other.ran == ["04"]
    with pytest.raises(ValueError, match="requires"):
        other.add(Stage("09", lambda i, c: i, ("nope",)))
