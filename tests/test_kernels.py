"""Kernels against plain versions and known answers."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest

from timeloom.functions import pixels
from timeloom.sources import images


def filtered(image, mode):
    """A PNG of ``image`` with every line filtered by ``mode``, as the format says."""
    height, width = image.shape[:2]
    channels = 1 if image.ndim == 2 else image.shape[2]
    flat = image.reshape(height, -1).astype(int)
    rows = []
    for y in range(height):
        row = [mode]
        for x in range(width * channels):
            left = flat[y, x - channels] if x >= channels else 0
            up = flat[y - 1, x] if y else 0
            corner = flat[y - 1, x - channels] if y and x >= channels else 0
            p = left + up - corner
            near = min((abs(p - left), 0, left), (abs(p - up), 1, up), (abs(p - corner), 2, corner))[2]
            row.append((flat[y, x] - [0, left, up, (left + up) // 2, near][mode]) & 255)
        rows.append(bytes(row))
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 0 if channels == 1 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("mode", range(5))
@pytest.mark.parametrize("shape", [(9, 13), (7, 5, 3), (1, 1)])
def test_png_filters(mode, shape):
    image = np.random.default_rng(mode).integers(0, 256, shape).astype(np.uint8)
    data = filtered(image, mode)
    assert np.array_equal(pixels.decode(data), image) and pixels.png_size(data) == (shape[1], shape[0])
    assert pixels.png_size(b"GIF89a" + b"0" * 30) is None


def test_closing_is_spread_and_drawn_back():
    rng = np.random.default_rng(5)
    mask = rng.random((40, 50)) < 0.1
    plain = np.zeros_like(mask)
    for y, x in np.argwhere(mask):
        plain[max(y - 4, 0) : y + 5, max(x - 4, 0) : x + 5] = True
    back = np.array([[plain[max(y - 4, 0) : y + 5, max(x - 4, 0) : x + 5].all() for x in range(50)] for y in range(40)])
    assert np.array_equal(pixels.closed(mask), back)


def screen(corners, shape=(240, 400), inside=210, outside=30):
    return np.where(pixels.inside_of(np.array(corners, float), *shape), inside, outside).astype(np.uint8)


@pytest.mark.parametrize("corners", [[(60, 40), (330, 40), (330, 200), (60, 200)], [(80, 50), (330, 30), (340, 200), (70, 190)], [(8, 9), (200, 12), (198, 120), (9, 118)]])
def test_screens_are_found_to_parts_of_a_pixel(corners):
    quad, sure = pixels.detect_quad(screen(corners))
    assert np.abs(quad - np.array(corners)).max() < 1.6 and sure > 0.9
    split = screen(corners)
    split[:, 150:156] = 30  # a bright screen with a dark bar that closing fills
    quad, _ = pixels.detect_quad(split)
    assert np.abs(quad - np.array(corners)).max() < 1.6


def test_lamps_larger_than_the_screen_do_not_hide_it():
    image = np.full((300, 500), 20, np.uint8)
    v, u = np.mgrid[0:300, 0:500]
    for x, y in ((70, 70), (200, 70), (330, 70), (70, 220), (430, 70)):  # five round ones, each larger than the screen
        image[(u - x) ** 2 + (v - y) ** 2 < 55**2] = 240
    image[200:260, 250:350] = 200
    quad, _ = pixels.detect_quad(image)
    assert np.abs(quad - [[250, 200], [349, 200], [349, 259], [250, 259]]).max() < 2
    assert pixels.detect_quad(np.full((50, 80), 7, np.uint8))[1] == 0.0  # the whole frame has no outside
    assert pixels.detect_quad(image[:150, :150]) is None


def test_cubic_sampling_keeps_pixels_and_smooth_images():
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, (20, 30)).astype(np.uint8)
    v, u = np.mgrid[0:20, 0:30].astype(float)
    assert np.allclose(pixels.sample_cubic(image, u, v), image)
    wave = 128 + 100 * np.sin(np.arange(60) / 6)[None, :] * np.ones((20, 1))
    x = np.linspace(5, 50, 200)[None, :]
    error = lambda f: np.abs(f(wave, x, np.full_like(x, 9.0)) - (128 + 100 * np.sin(x / 6))).max()
    assert error(pixels.sample_cubic) < 1.5
    colour = np.dstack([image] * 3)
    assert np.allclose(pixels.sample_cubic(colour, u + 0.3, v)[..., 1], pixels.sample_cubic(image, u + 0.3, v))


def test_shifts_to_parts_of_a_pixel():
    rng = np.random.default_rng(3)
    base = pixels.blur(rng.integers(0, 256, (128, 128)).astype(np.uint8), 2.5)
    v, u = np.mgrid[0:128, 0:128].astype(float)
    for dx, dy in ((1.5, -0.5), (-2.25, 1.0), (0.0, 0.0)):
        moved = pixels.sample_cubic(base, u - dx, v - dy)
        fx, fy, _ = pixels.shift_between(base, moved, fine=True)
        assert abs(fx - dx) < 0.4 and abs(fy - dy) < 0.4


def test_frames_that_stand_for_screens(spark):
    image = np.arange(48, dtype=np.uint8).reshape(6, 8)
    rows = [("v", f"f{i}", bytearray(pixels.encode_png(image + i))) for i in range(3)] + [("v", "none", None)]
    frames = spark.createDataFrame(rows, "slug string, frame_id string, image binary")
    screens = spark.createDataFrame([("v", "f1"), ("v", "f1"), ("w", "f2"), ("v", None)], "slug string, representative_frame string")
    assert [r.frame_id for r in images.kept_frames(frames, screens).collect()] == ["f1"]
    full = {r.frame_id: r for r in images.full_frames(frames, "image").collect()}
    assert np.array_equal(pixels.decode(bytes(full["f2"].content)), image + 2) and len(full["f2"].sha256) == 64 and full["none"].content is None
    assert [tuple(r.s) if r.s else None for r in frames.orderBy("frame_id").select(images.sizes(frames.image).alias("s")).collect()] == [(8, 6)] * 3 + [None]


def test_lightness_is_equalised_and_colours_stay():
    rng = np.random.default_rng(6)
    image = rng.integers(0, 256, (40, 60, 3)).astype(np.uint8)
    assert np.abs(pixels.from_lab(pixels.to_lab(image)).astype(int) - image).max() <= 1
    assert np.allclose(pixels.to_lab(np.array([[[255, 255, 255], [0, 0, 0], [255, 0, 0]]], np.uint8))[0], [[100, 0, 0], [0, 0, 0], [53.24, 80.09, 67.2]], atol=0.05)
    dull = (90 + image / 8).astype(np.uint8)
    clear = pixels.equalise(dull, 40.0, 2)
    before, after = pixels.to_lab(dull), pixels.to_lab(clear)
    assert after[..., 0].std() > 2 * before[..., 0].std() and np.abs(after[..., 1:] - before[..., 1:]).mean() < 2
    level = np.clip(np.rint(before[..., 0] * 2.55), 0, 255).astype(np.uint8)
    inside = (clear > 0).all(axis=-1) & (clear < 255).all(axis=-1)
    assert np.abs(after[..., 0] * 2.55 - pixels.equalise(level, 40.0, 2))[inside].mean() < 2
