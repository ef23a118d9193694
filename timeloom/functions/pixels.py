"""Pixel kernels in numpy, for use inside Arrow and pandas UDFs: images are uint8 arrays (h, w) or (h, w, 3)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

Image = np.ndarray
# Fixed values of the kernels.
TARGET_CELLS, MIN_SIDE, FLAT = 128, 4, 2
MIN_RESPONSE, MAX_SHIFT = 0.05, 0.02
SEPARATION_SCALE, SHARPNESS_SCALE, CONTRAST_SCALE = 0.5, 500.0, 64.0
OCR_HEIGHT, MAX_UPSCALE = 96, 4.0


def decode(data: bytes) -> Image:
    """PNG (8 bit grey, RGB, RGBA; not interlaced) and binary PGM or PPM; anything else is an error, never skipped."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return _decode_png(data)
    if data[:2] in (b"P5", b"P6"):
        fields, at = [], 2
        while len(fields) < 3:
            while data[at : at + 1].isspace():
                at += 1
            if data[at : at + 1] == b"#":
                at = data.index(b"\n", at)
                continue
            end = at
            while not data[end : end + 1].isspace():
                end += 1
            fields.append(int(data[at:end]))
            at = end
        width, height, _ = fields
        channels = 3 if data[:2] == b"P6" else 1
        pixels = np.frombuffer(data, np.uint8, width * height * channels, at + 1)
        return pixels.reshape((height, width, 3) if channels == 3 else (height, width))
    try:
        import io

        from PIL import Image as Pillow
    except ImportError:
        raise NotImplementedError("only PNG, PGM and PPM can be decoded here") from None
    return np.asarray(Pillow.open(io.BytesIO(data)))


def _decode_png(data: bytes) -> Image:
    at, packed, head = 8, [], None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    if head is None or head[2] != 8 or head[6] or head[3] not in (0, 2, 6):
        raise ValueError("unsupported PNG")
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), np.uint8)
    above = np.zeros(width * channels, np.uint8)
    for y in range(height):
        above = out[y] = _unfiltered(raw[y, 1:], int(raw[y, 0]), above, channels)
    image = out.reshape(height, width, channels)
    return image[:, :, 0] if channels == 1 else image[:, :, :3]


def _unfiltered(line: np.ndarray, mode: int, above: np.ndarray, channels: int) -> np.ndarray:
    """A line of a PNG with its filter undone. Bytes add modulo 256, so whole lines are summed; only the guesses that are
    not sums of their neighbours (mean, nearest) go from byte to byte."""
    if mode == 0:
        return line
    if mode == 2:
        return line + above
    if mode == 1:
        return np.cumsum(line.reshape(-1, channels), axis=0, dtype=np.uint8).ravel()
    done, up = [0] * channels + line.tolist(), [0] * channels + above.tolist()
    for x in range(channels, len(done)):
        left, top = done[x - channels], up[x]
        if mode == 3:
            guess = (left + top) // 2
        else:
            corner = up[x - channels]
            p, q = top - corner, left - corner
            guess = left if abs(p) <= abs(q) and abs(p) <= abs(p + q) else top if abs(q) <= abs(p + q) else corner
        done[x] = (done[x] + guess) & 255
    return np.array(done[channels:], np.uint8)


def png_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) of a PNG from its head; nothing is decoded. None for other data."""
    return struct.unpack(">II", data[16:24]) if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24 else None


def encode_png(image: Image) -> bytes:
    """The same bytes for the same pixels."""
    height, width = image.shape[:2]
    rows = np.concatenate([np.zeros((height, 1), np.uint8), image.reshape(height, -1)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if image.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def gray(image: Image) -> Image:
    return image if image.ndim == 2 else np.rint(image.astype(float) @ [0.299, 0.587, 0.114]).astype(np.uint8)


def shrink(image: Image, width: int, height: int) -> np.ndarray:
    """Mean of the source pixels under each target cell, edges counted by the share they cover."""

    def weights(size: int, target: int) -> np.ndarray:
        edges = np.linspace(0, size, target + 1)
        low, high = np.maximum.outer(edges[:-1], np.arange(size)), np.minimum.outer(edges[1:], np.arange(1, size + 1))
        cover = np.clip(high - low, 0, None)
        return cover / cover.sum(axis=1, keepdims=True)

    return weights(image.shape[0], height) @ image.astype(float) @ weights(image.shape[1], width).T


def grid_for(height: int, width: int) -> tuple[int, int]:
    shape = max(width / max(height, 1), 1e-6)
    rows = max(1, round((TARGET_CELLS / shape) ** 0.5))
    return max(2, round(TARGET_CELLS / rows)), rows


def difference_hash(image: Image) -> str:
    """``"<cols>x<rows>:<hex>"``; empty for a region too small to measure."""
    if image.size == 0 or min(image.shape[:2]) < MIN_SIDE:
        return ""
    cols, rows = grid_for(*image.shape[:2])
    cells = np.rint(shrink(gray(image), cols + 1, rows)).astype(int)
    steps = np.diff(cells, axis=1).ravel()
    return f"{cols}x{rows}:{np.packbits(np.r_[steps > FLAT, steps < -FLAT]).tobytes().hex()}"


def changed_share(a: Image, b: Image, least: int = 16) -> float:
    """Share of pixels that differ by more than ``least``; 1 for images that cannot be compared."""
    if a.shape != b.shape or a.size == 0:
        return 1.0
    return round(float((np.abs(gray(a).astype(int) - gray(b).astype(int)) > least).mean()), 4)


def contrast(image: Image) -> float:
    return round(min(float(gray(image).std()) / CONTRAST_SCALE, 1.0), 4) if image.size else 0.0


def otsu(image: Image) -> tuple[int, float]:
    """Threshold that separates dark from bright best, and the distance of the two means as a share of 255."""
    counts = np.bincount(gray(image).ravel(), minlength=256).astype(float)
    below, levels = np.cumsum(counts), np.arange(256)
    mass = np.cumsum(counts * levels)
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        low, high = mass / below, (mass[-1] - mass) / above
        between = np.nan_to_num(below * above * (low - high) ** 2)
    at = int(between.argmax())
    apart = abs(high[at] - low[at]) / 255 if below[at] and above[at] else 0.0
    return at, float(apart)


def legibility(image: Image) -> float:
    """The lesser of how far text and ground are apart and how sharp the edges are, each in [0, 1]."""
    g = gray(image).astype(float)
    if min(g.shape) < 3:
        return 0.0
    edges = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return round(min(min(otsu(image)[1] / SEPARATION_SCALE, 1.0), min(float(edges.var()) / SHARPNESS_SCALE, 1.0)), 4)


def saturation(image: Image) -> np.ndarray:
    wide = image.astype(int)
    return (wide.max(axis=2) - wide.min(axis=2)).astype(float)


def chrome_extent(image: Image, threshold: float = 40, coverage: float = 0.5, min_height: int = 20, search: float = 0.35, margin: float = 0.06, max_start: float = 0.03) -> tuple[int, int] | None:
    """(top, bottom) of the first coloured band near the top that begins early enough and is high enough."""
    height, width = image.shape[:2]
    if not height or not width:
        return None
    cut = int(width * margin)
    rows = (saturation(image)[:, cut : width - cut or None] > threshold).mean(axis=1) >= coverage
    rows = rows[: max(1, int(height * search))].astype(int)
    edges = np.flatnonzero(np.diff(np.r_[0, rows, 0]))
    for top, bottom in edges.reshape(-1, 2).tolist():
        if top <= int(height * max_start) and bottom - top >= min_height:
            return top, bottom
    return None


def blur(image: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian, borders repeated."""
    if sigma <= 0:
        return image.astype(float)
    reach = max(1, int(3 * sigma + 0.5))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    out = image.astype(float)
    for axis in (0, 1):
        pad = [(0, 0)] * out.ndim
        pad[axis] = (reach, reach)
        wide = np.pad(out, pad, mode="edge")
        size = out.shape[axis]
        out = sum(k * np.take(wide, np.arange(i, i + size), axis=axis) for i, k in enumerate(kernel))
    return out


def suppress_glare(image: Image, amount: float, sigma_share: float = 0.08) -> Image:
    """Evens the illumination out, by at most ``amount`` up or down."""
    light = blur(gray(image), sigma_share * max(image.shape[:2]) / 3)
    gain = np.clip(np.median(light) / np.maximum(light, 1.0), 1 - amount, 1 + amount)
    return np.clip(np.rint(image * (gain[..., None] if image.ndim == 3 else gain)), 0, 255).astype(np.uint8)


# Linear sRGB to XYZ, and the white it is relative to.
_XYZ = np.array([[0.4124564, 0.3575761, 0.1804375], [0.2126729, 0.7151522, 0.0721750], [0.0193339, 0.1191920, 0.9503041]])
_WHITE = _XYZ.sum(axis=1)


def to_lab(image: Image) -> np.ndarray:
    """Lightness (0 to 100) and two colour axes of a red-green-blue image."""
    c = image.astype(float) / 255
    linear = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    t = linear @ _XYZ.T / _WHITE
    f = np.where(t > (6 / 29) ** 3, np.cbrt(t), t / (3 * (6 / 29) ** 2) + 4 / 29)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], axis=-1)


def from_lab(lab: np.ndarray) -> Image:
    y = (lab[..., 0] + 16) / 116
    f = np.stack([y + lab[..., 1] / 500, y, y - lab[..., 2] / 200], axis=-1)
    t = np.where(f > 6 / 29, f**3, 3 * (6 / 29) ** 2 * (f - 4 / 29)) * _WHITE
    linear = np.clip(t @ np.linalg.inv(_XYZ).T, 0, 1)
    c = np.where(linear <= 0.0031308, 12.92 * linear, 1.055 * linear ** (1 / 2.4) - 0.055)
    return np.clip(np.rint(c * 255), 0, 255).astype(np.uint8)


def equalise(image: Image, clip: float = 2.0, tiles: int = 8) -> Image:
    """Contrast-limited histogram equalisation of tiles, blended between tile centres: of grey values, or of the lightness of a
    coloured image, whose colours stay."""
    if image.ndim == 3:
        lab = to_lab(image)
        level = np.clip(np.rint(lab[..., 0] * 2.55), 0, 255).astype(np.uint8)
        lab[..., 0] = equalise(level, clip, tiles) / 2.55
        return from_lab(lab)
    g = image
    height, width = g.shape
    ys, xs = np.linspace(0, height, tiles + 1).astype(int), np.linspace(0, width, tiles + 1).astype(int)
    tables = np.empty((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            part = g[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
            counts = np.bincount(part.ravel(), minlength=256).astype(float)
            limit = max(clip * part.size / 256, 1.0)
            spare = np.maximum(counts - limit, 0).sum()
            counts = np.minimum(counts, limit) + spare / 256
            tables[i, j] = np.cumsum(counts) * 255 / counts.sum()
    at = lambda n, size: np.clip((np.arange(size) + 0.5) * n / size - 0.5, 0, n - 1)
    y, x = at(tiles, height), at(tiles, width)
    y0, x0 = np.minimum(y.astype(int), tiles - 2 if tiles > 1 else 0), np.minimum(x.astype(int), tiles - 2 if tiles > 1 else 0)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    wy, wx = (y - y0)[:, None], (x - x0)[None, :]
    look = lambda a, b: tables[a[:, None], b[None, :], g]
    out = (look(y0, x0) * (1 - wx) + look(y0, x1) * wx) * (1 - wy) + (look(y1, x0) * (1 - wx) + look(y1, x1) * wx) * wy
    return np.rint(out).astype(np.uint8)


def homography(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """3 x 3 matrix that takes four source corners to four target corners."""
    rows, right = [], []
    for (x, y), (u, v) in zip(source, target, strict=True):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return np.r_[np.linalg.solve(np.array(rows, float), np.array(right, float)), 1.0].reshape(3, 3)


def sample(image: Image, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bilinear values at fractional places, borders repeated."""
    height, width = image.shape[:2]
    x, y = np.clip(x, 0, width - 1), np.clip(y, 0, height - 1)
    x0, y0 = np.minimum(x.astype(int), max(width - 2, 0)), np.minimum(y.astype(int), max(height - 2, 0))
    x1, y1 = np.minimum(x0 + 1, width - 1), np.minimum(y0 + 1, height - 1)
    wx, wy = x - x0, y - y0
    if image.ndim == 3:
        wx, wy = wx[..., None], wy[..., None]
    return (image[y0, x0] * (1 - wx) + image[y0, x1] * wx) * (1 - wy) + (image[y1, x0] * (1 - wx) + image[y1, x1] * wx) * wy


def sample_cubic(image: Image, x: np.ndarray, y: np.ndarray, sharp: float = -0.75) -> np.ndarray:
    """Values at fractional places by cubic convolution over 4 x 4 pixels, borders repeated."""
    height, width = image.shape[:2]
    x0, y0 = np.floor(x).astype(int), np.floor(y).astype(int)

    def weight(d: np.ndarray) -> np.ndarray:
        d = np.abs(d)
        near = ((sharp + 2) * d - (sharp + 3)) * d * d + 1
        return np.where(d <= 1, near, np.where(d < 2, ((d - 5) * d + 8) * d * sharp - 4 * sharp, 0.0))

    out = 0.0
    for j in range(-1, 3):
        for i in range(-1, 3):
            w = weight(x - (x0 + i)) * weight(y - (y0 + j))
            out = out + image[np.clip(y0 + j, 0, height - 1), np.clip(x0 + i, 0, width - 1)] * (w[..., None] if image.ndim == 3 else w)
    return out


def warp(image: Image, corners: np.ndarray, width: int, height: int) -> Image:
    """The quadrilateral ``corners`` (clockwise from top left) as an upright image."""
    back = homography(np.array([[0, 0], [width - 1, 0], [width - 1, height - 1], [0, height - 1]], float), np.asarray(corners, float))
    v, u = np.mgrid[0:height, 0:width]
    x, y, w = np.tensordot(back, np.stack([u, v, np.ones_like(u)]).astype(float), axes=1)
    return np.clip(np.rint(sample_cubic(image, x / w, y / w)), 0, 255).astype(np.uint8)


def shift_between(a: Image, b: Image, fine: bool = False) -> tuple[float, float, float]:
    """(dx, dy, response): how far ``b`` is moved against ``a``, by phase correlation under a Hann window; ``fine``: to parts of
    a pixel, by the centre of mass around the peak."""
    g, h = gray(a).astype(float), gray(b).astype(float)
    window = np.outer(np.hanning(g.shape[0]), np.hanning(g.shape[1]))
    cross = np.fft.rfft2(h * window) * np.conj(np.fft.rfft2(g * window))
    peak = np.fft.irfft2(cross / np.maximum(np.abs(cross), 1e-12), g.shape)
    y, x = np.unravel_index(int(peak.argmax()), peak.shape)
    signed = lambda at, size: at - size if at > size // 2 else at
    dx, dy = float(signed(x, g.shape[1])), float(signed(y, g.shape[0]))
    if fine:
        around = np.arange(-2, 3)
        mass = np.maximum(peak[np.ix_((y + around) % g.shape[0], (x + around) % g.shape[1])], 0.0)
        dx, dy = dx + float(mass.sum(axis=0) @ around) / mass.sum(), dy + float(mass.sum(axis=1) @ around) / mass.sum()
    return dx, dy, float(peak.max())


def align(image: Image, base: Image) -> tuple[Image, bool]:
    """``image`` moved onto ``base``; left alone where the shift is unsure or too large."""
    dx, dy, response = shift_between(base, image, fine=True)
    if response < MIN_RESPONSE or abs(dx) > MAX_SHIFT * image.shape[1] or abs(dy) > MAX_SHIFT * image.shape[0]:
        return image, False
    v, u = np.mgrid[0 : image.shape[0], 0 : image.shape[1]]
    return np.clip(np.rint(sample(image, u + dx, v + dy)), 0, 255).astype(np.uint8), True


def prepare_for_reading(image: Image) -> Image:
    """Enlarged to a readable height, then black and white."""
    g = gray(image)
    scale = min(max(OCR_HEIGHT / max(g.shape[0], 1), 1.0), MAX_UPSCALE)
    height, width = round(g.shape[0] * scale), round(g.shape[1] * scale)
    v, u = np.mgrid[0:height, 0:width]
    large = np.rint(sample(g, (u + 0.5) / scale - 0.5, (v + 0.5) / scale - 0.5)).astype(np.uint8)
    return np.where(large > otsu(large)[0], 255, 0).astype(np.uint8)


def order_corners(points: np.ndarray) -> np.ndarray:
    """Clockwise around the centroid, from the corner of least x + y."""
    middle = points.mean(axis=0)
    ring = points[np.argsort(np.arctan2(points[:, 1] - middle[1], points[:, 0] - middle[0]), kind="stable")]
    return np.roll(ring, -int(ring.sum(axis=1).argmin()), axis=0)


CLOSING, EPSILON, DOMINANT = 9, 0.02, 0.5  # fixed values: pixels closed, tolerance of a polygon by its length, a share that settles the search


def closed(mask: np.ndarray, size: int = CLOSING) -> np.ndarray:
    """``mask`` with gaps narrower than ``size`` pixels filled: spread, then drawn back (sums over windows)."""

    def spread(m: np.ndarray, outside: bool) -> np.ndarray:
        half = size // 2
        padded = np.pad(m, half, constant_values=outside).astype(np.int32)
        total = np.pad(padded.cumsum(axis=0).cumsum(axis=1), ((1, 0), (1, 0)))
        return (total[size:, size:] - total[:-size, size:] - total[size:, :-size] + total[:-size, :-size]) > 0

    return ~spread(~spread(mask, False), False)


def outline(part: np.ndarray) -> np.ndarray:
    """The convex outline (x, y) of a region: of the first and last pixel of each row, those that turn one way."""
    rows = np.flatnonzero(part.any(axis=1))
    first, last = part[rows].argmax(axis=1), part.shape[1] - 1 - part[rows, ::-1].argmax(axis=1)
    points = sorted({*zip(first.tolist(), rows.tolist(), strict=True), *zip(last.tolist(), rows.tolist(), strict=True)})

    def half(order: list) -> list:
        kept: list = []
        for p in order:
            while len(kept) > 1 and (kept[-1][0] - kept[-2][0]) * (p[1] - kept[-2][1]) <= (kept[-1][1] - kept[-2][1]) * (p[0] - kept[-2][0]):
                kept.pop()
            kept.append(p)
        return kept[:-1]

    return np.array(half(points) + half(points[::-1]), float).reshape(-1, 2) if len(points) > 2 else np.array(points, float).reshape(-1, 2)


def simplified(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """The corners of a closed polygon from which no other point of it is farther than ``tolerance``."""
    start = int(np.linalg.norm(ring - ring[0], axis=1).argmax())
    ring = np.roll(ring, -start, axis=0)
    across = int(np.linalg.norm(ring - ring[0], axis=1).argmax())
    keep, open_ = {0, across}, [(0, across), (across, len(ring))]
    while open_:
        low, high = open_.pop()
        a, b = ring[low], ring[high % len(ring)]
        between = ring[low + 1 : high]
        if not len(between):
            continue
        along = b - a
        away = np.abs(along[0] * (between[:, 1] - a[1]) - along[1] * (between[:, 0] - a[0])) / max(float(np.hypot(*along)), 1e-12)
        far = int(away.argmax())
        if away[far] > tolerance:
            keep.add(low + 1 + far)
            open_ += [(low, low + 1 + far), (low + 1 + far, high)]
    return ring[sorted(keep)]


def refined(corners: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Corners to parts of a pixel: where the lines through the outline's pixels along each side meet."""
    lines = []
    for a, b in zip(corners, np.roll(corners, -1, axis=0), strict=True):
        along = (b - a) / max(float(np.hypot(*(b - a))), 1e-12)
        off = (edge - a) @ np.array([-along[1], along[0]])
        at = (edge - a) @ along
        near = edge[(np.abs(off) <= 2) & (at > 3) & (at < np.hypot(*(b - a)) - 3)]
        if len(near) < 4:
            return corners
        middle = near.mean(axis=0)
        _, _, axes = np.linalg.svd(near - middle, full_matrices=False)
        lines.append((middle, axes[0]))
    out = []
    for (p, d), (q, e) in zip([lines[-1], *lines[:-1]], lines, strict=True):
        turn = d[0] * e[1] - d[1] * e[0]
        if abs(turn) < 1e-6:
            return corners
        out.append(p + d * (((q - p)[0] * e[1] - (q - p)[1] * e[0]) / turn))
    moved = np.array(out)
    return moved if np.abs(moved - corners).max() <= 5 else corners


def _area(quad: np.ndarray) -> float:
    x, y = quad[:, 0], quad[:, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


def inside_of(quad: np.ndarray, height: int, width: int) -> np.ndarray:
    """The pixels inside a convex quadrilateral given clockwise, its edges included."""
    v, u = np.mgrid[0:height, 0:width]
    held = np.ones((height, width), bool)
    for a, b in zip(quad, np.roll(quad, -1, axis=0), strict=True):
        held &= (b[0] - a[0]) * (v - a[1]) - (b[1] - a[1]) * (u - a[0]) >= -0.5 * np.hypot(*(b - a))
    return held


def detect_quad(image: Image, aspect: tuple[float, float] = (1.3, 2.2), full_contrast: float = 128.0) -> tuple[np.ndarray, float] | None:
    """Corners and confidence of the bright region that is most surely a quadrilateral of a likely shape, or None.

    Small gaps are closed; then all regions are looked at, the largest first, up to a likely one over half of the frame.
    Confidence is how much of the quadrilateral the region fills times the contrast between inside and outside, which is
    full at ``full_contrast`` levels.
    """
    g = np.rint(blur(gray(image), 1.1)).astype(np.uint8)
    parts = regions(closed(g > otsu(g)[0]))
    sizes = np.bincount(parts.ravel())[1:]
    best = None
    for label in (np.argsort(-sizes, kind="stable") + 1).tolist():
        if sizes[label - 1] < 16:  # too small to have four sides; all that follow are smaller
            break
        part = parts == label
        ring = outline(part)
        length = float(np.linalg.norm(ring - np.roll(ring, -1, axis=0), axis=1).sum())
        quad = simplified(ring, EPSILON * length) if len(ring) >= 4 else ring
        if len(quad) != 4:
            continue
        rows = np.flatnonzero(part.any(axis=1))
        columns = np.flatnonzero(part.any(axis=0))
        border = np.concatenate([
            np.stack([part[rows].argmax(axis=1), rows], axis=1), np.stack([part.shape[1] - 1 - part[rows, ::-1].argmax(axis=1), rows], axis=1),
            np.stack([columns, part[:, columns].argmax(axis=0)], axis=1), np.stack([columns, part.shape[0] - 1 - part[::-1, columns].argmax(axis=0)], axis=1),
        ]).astype(float)
        quad = order_corners(refined(order_corners(quad), border))
        area, sides = _area(quad), np.linalg.norm(quad - np.roll(quad, -1, axis=0), axis=1)
        if area <= 0 or min(sides) < 2 or not aspect[0] <= (sides[0] + sides[2]) / (sides[1] + sides[3]) <= aspect[1]:
            continue
        inside = inside_of(quad, *g.shape)
        contrast = float(g[inside].mean() - g[~inside].mean()) / full_contrast if inside.any() and not inside.all() else 0.0
        confidence = round(min(float(part.sum()) / area, 1.0) * min(max(contrast, 0.0), 1.0), 4)
        if best is None or confidence > best[1]:
            best = quad, confidence
        if best[1] > 0 and area > DOMINANT * g.size:
            break
    return best


def regions(mask: np.ndarray) -> np.ndarray:
    """Numbers of the 4-connected regions of a mask (0 outside), by joining the runs of neighbouring rows."""
    out = np.zeros(mask.shape, np.int64)
    parent = [0]

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    above: list[tuple[int, int, int]] = []
    for y, row in enumerate(mask):
        edges = np.flatnonzero(np.diff(np.r_[0, row.astype(np.int8), 0])).reshape(-1, 2)
        runs = []
        for low, high in edges.tolist():
            touching = [root(n) for a, b, n in above if a < high and b > low]
            if touching:
                n = min(touching)
                for t in touching:
                    parent[t] = n
            else:
                n = len(parent)
                parent.append(n)
            out[y, low:high] = n
            runs.append((low, high, n))
        above = runs
    names = np.array([root(i) for i in range(len(parent))])
    _, dense = np.unique(names, return_inverse=True)
    return dense[out]
