"""Pixel kernels in numpy, run in Arrow batches (IM1-IM5, IM7, IM9-IM16, IM18-IM23, V12-V13, C14, C17)."""

from __future__ import annotations

from collections.abc import Iterator

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def gray(image: np.ndarray) -> np.ndarray:
    """IM1: weighted sum of blue, green and red."""
    return image if image.ndim == 2 else np.rint(image @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def box_mean(image: np.ndarray, size: int) -> np.ndarray:
    """Mean over a square around each pixel, edges repeated, by an integral image."""
    half = size // 2
    padded = np.pad(image.astype(np.float64), half, mode="edge")
    total = np.pad(padded.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (total[size:, size:] - total[:-size, size:] - total[size:, :-size] + total[:-size, :-size]) / size**2


def binarize_lines(image: np.ndarray, block: int = 35, c: int = -5) -> np.ndarray:
    """IM2: ink of the inverted image that is above its neighbourhood's mean."""
    inverted = 255 - gray(image)
    return (inverted > box_mean(inverted, block) - c).astype(np.uint8)


def running(mask: np.ndarray, size: int, axis: int, grow: bool) -> np.ndarray:
    """Minimum (or with grow maximum) of a mask over runs of `size` along an axis; beyond the edge nothing shrinks or grows."""
    before, after = size // 2, size - 1 - size // 2
    pad = [(0, 0), (0, 0)]
    pad[axis] = (before, after)
    counts = np.pad(mask.astype(np.int64), pad, constant_values=0 if grow else 1).cumsum(axis)
    counts = np.pad(counts, [(1, 0) if k == axis else (0, 0) for k in (0, 1)])
    n = mask.shape[axis]
    span = counts.take(range(size, size + n), axis) - counts.take(range(n), axis)
    return ((span > 0) if grow else (span == size)).astype(np.uint8)


def opened(mask: np.ndarray, size: int, axis: int, times: int = 1) -> np.ndarray:
    for grow in (False, True):
        for _ in range(times):
            mask = running(mask, size, axis, grow)
    return mask


def grid_masks(binary: np.ndarray, floor: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """IM3: horizontal lines, vertical lines, and both, closed over small gaps."""
    k = max(floor, min(binary.shape) // 120)
    across, down = opened(binary, k, 1, 2), opened(binary, k, 0, 2)
    grid = across | down
    for grow in (True, False):
        for axis in (0, 1):
            grid = running(grid, 3, axis, grow)
    return across, down, grid


def component_boxes(mask: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """IM4, IM7: (x, y, w, h, area) of the 8-connected parts of a mask, by union of the runs of its rows."""
    parent: list[int] = []
    found: list[list[int]] = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    last: list[tuple[int, int, int]] = []
    for y, row in enumerate(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8)):
        change = np.diff(row)
        runs = []
        for a, b in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1), strict=True):
            k = len(parent)
            parent.append(k)
            found.append([int(a), y, int(b), y + 1, int(b - a)])
            for c, d, other in last:
                if c <= b and a <= d:
                    parent[root(k)] = root(other)
            runs.append((int(a), int(b), k))
        last = runs
    merged: dict[int, list[int]] = {}
    for k, box in enumerate(found):
        r = root(k)
        if r not in merged:
            merged[r] = box[:]
        else:
            m = merged[r]
            m[0], m[1], m[2], m[3], m[4] = min(m[0], box[0]), min(m[1], box[1]), max(m[2], box[2]), max(m[3], box[3]), m[4] + box[4]
    return sorted((m[0], m[1], m[2] - m[0], m[3] - m[1], m[4]) for m in merged.values())


def smoothed(image: np.ndarray) -> np.ndarray:
    """A 3 by 3 Gaussian blur (1, 2, 1), edges reflected."""
    padded = np.pad(image.astype(np.uint16), 1, mode="reflect" if min(image.shape) > 1 else "edge")
    rows = padded[:-2] + 2 * padded[1:-1] + padded[2:]
    return ((rows[:, :-2] + 2 * rows[:, 1:-1] + rows[:, 2:] + 8) >> 4).astype(np.uint8)


def otsu(image: np.ndarray) -> int:
    """The threshold of greatest variance between dark and light."""
    n = np.bincount(image.reshape(-1), minlength=256).astype(np.float64)
    below, total = n.cumsum(), n.sum()
    mass = (n * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mass[-1] * below / total - mass) ** 2 / (below * (total - below))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def detect_dots(image: np.ndarray, low: int = 3, high: int = 8, circularity: float = 0.7) -> list[tuple[int, int]]:
    """IM7: centres (x, y) of small round blobs, darker than Otsu's threshold."""
    g = smoothed(gray(image))
    if not g.size or g.min() == g.max():
        return []
    dark = (g <= otsu(g)).astype(np.uint8)
    out = []
    for x, y, w, h, area in component_boxes(dark):
        if low <= w <= high and low <= h <= high and area >= circularity * (w - 0.5) * (h - 0.5) * np.pi / 4:
            out.append((x + w // 2, y + h // 2))
    return out


def projections(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """IM5: ink a column and a row."""
    return mask.sum(0), mask.sum(1)


def line_positions(profile: np.ndarray, fraction: float = 0.55, gap: int = 10) -> list[int]:
    """Centres of the runs of ink, near ones merged (half to even)."""
    if not len(profile) or profile.max() <= 0:
        return []
    on = np.diff(np.pad((profile >= fraction * profile.max()).astype(np.int8), 1))
    out: list[int] = []
    for a, b in zip(np.flatnonzero(on == 1), np.flatnonzero(on == -1), strict=True):
        center = round((a + b - 1) / 2)
        if out and center - out[-1] <= gap:
            out[-1] = round((out[-1] + center) / 2)
        else:
            out.append(center)
    return out


def table_boundary(image: np.ndarray, least: int = 200, pad: int = 8) -> tuple[int, int, int, int]:
    """IM11: (x, y, w, h) of the largest grid, padded; the whole image without one of 200 by 200."""
    h, w = image.shape[:2]
    boxes = [b for b in component_boxes(grid_masks(binarize_lines(image))[2]) if b[2] >= least and b[3] >= least]
    if not boxes:
        return 0, 0, w, h
    x, y, bw, bh, _ = max(boxes, key=lambda b: b[2] * b[3])
    x0, y0 = max(0, x - pad), max(0, y - pad)
    return x0, y0, min(w, x + bw + pad) - x0, min(h, y + bh + pad) - y0


def table_lines(image: np.ndarray) -> tuple[list[int], list[int]]:
    """IM12: places of the vertical and the horizontal lines of a table."""
    across, down, _ = grid_masks(binarize_lines(image), 40)
    return line_positions(projections(down)[0]), line_positions(projections(across)[1])


def match_template(image: np.ndarray, template: np.ndarray) -> np.ndarray:
    """IM13: zero-mean normalised cross-correlation at every place, in the frequency domain; 0 where the image is flat."""
    a, t = image.astype(np.float64), template.astype(np.float64)
    if t.shape[0] > a.shape[0] or t.shape[1] > a.shape[1]:
        return np.zeros((0, 0))
    t = t - t.mean()
    n, shape = t.size, (a.shape[0] + t.shape[0] - 1, a.shape[1] + t.shape[1] - 1)
    cross = np.fft.irfft2(np.fft.rfft2(a, shape) * np.fft.rfft2(t[::-1, ::-1], shape), shape)
    cross = cross[t.shape[0] - 1 : a.shape[0], t.shape[1] - 1 : a.shape[1]]
    window = lambda v: (lambda s: s[t.shape[0] :, t.shape[1] :] - s[: -t.shape[0], t.shape[1] :] - s[t.shape[0] :, : -t.shape[1]] + s[: -t.shape[0], : -t.shape[1]])(np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))))
    spread = np.maximum(window(a * a) - window(a) ** 2 / n, 0)
    scale = np.sqrt(spread * (t * t).sum())
    return np.where(scale > 1e-6, cross / np.maximum(scale, 1e-6), 0.0)


def match_difference(image: np.ndarray, template: np.ndarray) -> np.ndarray:
    """IM19: one minus the normalised squared difference at every place; 1 is a perfect fit."""
    a, t = image.astype(np.float64), template.astype(np.float64)
    if t.shape[0] > a.shape[0] or t.shape[1] > a.shape[1]:
        return np.zeros((0, 0))
    shape = (a.shape[0] + t.shape[0] - 1, a.shape[1] + t.shape[1] - 1)
    cross = np.fft.irfft2(np.fft.rfft2(a, shape) * np.fft.rfft2(t[::-1, ::-1], shape), shape)
    cross = cross[t.shape[0] - 1 : a.shape[0], t.shape[1] - 1 : a.shape[1]]
    sums = np.pad((a * a).cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    energy = sums[t.shape[0] :, t.shape[1] :] - sums[: -t.shape[0], t.shape[1] :] - sums[t.shape[0] :, : -t.shape[1]] + sums[: -t.shape[0], : -t.shape[1]]
    scale = np.sqrt(np.maximum(energy, 0) * (t * t).sum())
    return 1 - np.where(scale > 1e-6, np.maximum(energy - 2 * cross + (t * t).sum(), 0) / np.maximum(scale, 1e-6), 1.0)


def resized(image: np.ndarray, scale: float, floor: int = 8) -> np.ndarray:
    """IM22: nearest-neighbour scaling, to no less than 8 pixels a side."""
    h, w = (max(floor, round(s * scale)) for s in image.shape[:2])
    return image[(np.arange(h) * image.shape[0] // h)][:, np.arange(w) * image.shape[1] // w]


@dataclass(frozen=True)
class Template:
    """IM22: a grey template that tasks carry; its scalings are kept once made."""

    name: str
    height: int
    width: int
    pixels: bytes

    @staticmethod
    def of(name: str, image: np.ndarray) -> Template:
        g = gray(image)
        return Template(name, *g.shape, np.ascontiguousarray(g, np.uint8).tobytes())

    def at(self, downscale: float = 1.0) -> np.ndarray:
        """The image, scaled by a factor held between 0.05 and 1."""
        return template_image(self, min(1.0, max(0.05, downscale)))


@lru_cache(maxsize=256)
def template_image(template: Template, scale: float) -> np.ndarray:
    image = np.frombuffer(template.pixels, np.uint8).reshape(template.height, template.width)
    return image if scale == 1.0 else resized(image, scale)


def fraction_box(shape: tuple[int, ...], x0: float = 0.0, x1: float = 1.0, y0: float = 0.0, y1: float = 1.0) -> tuple[int, int, int, int]:
    """IM20: (x0, x1, y0, y1) in pixels of fractions of an image, clamped, in order and of a pixel at least."""
    out = []
    for a, b, n in ((x0, x1, shape[1]), (y0, y1, shape[0])):
        low, high = sorted(min(1.0, max(0.0, f)) for f in (a, b))
        first = min(max(0, round(n * low)), n - 1)
        out += [first, min(n, max(first + 1, round(n * high)))]
    return out[0], out[1], out[2], out[3]


def scale_range(low: float, high: float, step: float, most: int = 2000) -> list[float]:
    """Scales from low to high, the end included."""
    return [low + k * step for k in range(min(most, int((high - low) / step + 1e-9) + 1))]


REGION_SCALES = scale_range(0.5, 2.5, 0.05)


def anchored_band(page: np.ndarray, pairs: list[tuple[Template, Template]], threshold: float = 0.7, scales: list[float] | None = None, pad: int = 60, y_fraction: float = 0.65, x_fraction: float = 1.0) -> dict:
    """IM15: the band between a begin and an end anchor: y0, y1, pair (which of the pairs, in order), confidences; pair null without any.

    The first pair counts of which both reach the threshold and the end lies below the begin. The band is padded and kept
    within the part of the page that is searched.
    """
    g = gray(page)
    x0, x1, y0, y1 = fraction_box(g.shape, 0.0, x_fraction, 0.0, y_fraction)
    part = g[y0:y1, x0:x1]
    for number, (begin, end) in enumerate(pairs):
        hits = [best_hit(part, t.at(), scales or REGION_SCALES) for t in (begin, end)]
        if any(h is None or h["score"] < threshold for h in hits):
            continue
        top, bottom = hits[0]["y"], hits[1]["y"] + hits[1]["h"]
        if bottom > top:
            return {"y0": max(0, top - pad), "y1": min(y1, bottom + pad), "pair": number, "confidences": [h["score"] for h in hits]}
    return {"y0": 0, "y1": 0, "pair": None, "confidences": []}


def head_zone(page: np.ndarray, top: Template, bottom: Template) -> dict:
    """IM16: the older pair of anchors, in the left half: lower threshold, three scales, a wider margin."""
    return anchored_band(page, [(top, bottom)], 0.6, [0.9, 1.0, 1.1], 80, 0.65, 0.5)


def best_hit(image: np.ndarray, template: np.ndarray, scales: list[float], last_wins: bool = False, match=match_template) -> dict | None:
    """IM13, IM15, W12: best place of a template over scales: score, x, y, w, h, scale."""
    best = None
    for scale in scales:
        t = resized(template, scale)
        scores = match(image, t)
        if not scores.size:
            continue
        k = int(scores.argmax())
        y, x = divmod(k, scores.shape[1])
        score = float(scores[y, x])
        if best is None or score > best["score"] or last_wins and score >= best["score"]:
            best = {"score": score, "x": x, "y": y, "w": t.shape[1], "h": t.shape[0], "scale": scale}
    return best


def detect_logo(image: np.ndarray, template: np.ndarray, threshold: float = 0.7, scales: list[float] | None = None, downscale: float = 1.0) -> dict:
    """IM14, IM20: the logo in the upper quarter, 20-80 % across; coordinates are those of the page."""
    g = gray(image)
    h, w = g.shape
    x0, band = int(0.2 * w), g[: max(1, int(0.25 * h)), int(0.2 * w) : int(0.8 * w)]
    hit = best_hit(resized(band, downscale) if downscale != 1 else band, resized(gray(template), downscale) if downscale != 1 else gray(template), scales or [1.0])
    if hit is None:
        return {"detected": False, "confidence": 0.0, "x": None, "y": None, "w": None, "h": None}
    x, y, bw, bh = (round(hit[c] / downscale) for c in ("x", "y", "w", "h"))
    good = hit["score"] >= threshold
    return {"detected": good, "confidence": hit["score"], **({"x": x + x0, "y": y, "w": bw, "h": bh} if good else dict.fromkeys("xywh"))}


def edges(image: np.ndarray, low: int = 60, high: int = 180) -> np.ndarray:
    """IM19: edges by Sobel gradients, thinned across their direction; weak ones stay where they touch strong ones."""
    a = np.pad(image.astype(np.int32), 1, mode="edge")
    across = (a[:-2, 2:] + 2 * a[1:-1, 2:] + a[2:, 2:]) - (a[:-2, :-2] + 2 * a[1:-1, :-2] + a[2:, :-2])
    down = (a[2:, :-2] + 2 * a[2:, 1:-1] + a[2:, 2:]) - (a[:-2, :-2] + 2 * a[:-2, 1:-1] + a[:-2, 2:])
    size = np.abs(across) + np.abs(down)
    sector = np.rint(np.arctan2(down, across) / (np.pi / 4)).astype(int) % 4
    around = np.pad(size, 1)
    h, w = size.shape
    shift = lambda dy, dx: around[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
    kept = np.zeros(size.shape, bool)
    for k, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        kept |= (sector == k) & (size > shift(-dy, -dx)) & (size >= shift(dy, dx))
    weak, strong = kept & (size > low), kept & (size > high)
    while True:  # strong ones grow along weak ones
        grown = strong.astype(np.uint8)
        for axis in (0, 1):
            grown = running(grown, 3, axis, True)
        more = weak & (grown > 0)
        if (more == strong).all():
            return np.where(strong, 255, 0).astype(np.uint8)
        strong = more


def prepared(image: np.ndarray, mode: str) -> np.ndarray:
    """IM19: raw, eq (histogram), blur (3 by 3), otsu or canny."""
    g = gray(image)
    if mode == "eq":
        c = np.bincount(g.reshape(-1), minlength=256).cumsum()
        low = c[c > 0][0]
        return np.rint((c - low) / max(1, c[-1] - low) * 255).clip(0, 255).astype(np.uint8)[g]
    if mode == "blur":
        return smoothed(g)
    if mode == "otsu":
        return np.where(g > otsu(g), 255, 0).astype(np.uint8)
    if mode == "canny":
        return edges(g)
    if mode != "raw":
        raise ValueError(f"unknown mode {mode}")
    return g


MATCHES = {"TM_CCOEFF_NORMED": match_template, "TM_SQDIFF_NORMED": match_difference}


def template_hits(page: np.ndarray, template: Template, modes: list[str], methods: list[str], scales: list[float], box: tuple[float, float, float, float] = (0.0, 1.0, 0.0, 1.0), downscale: float = 1.0, k: int = 10) -> list[dict]:
    """C17, ST5: the best place for each mode and method, the best first, k at most; places are those of the page's part that box cuts out."""
    unknown = [m for m in methods if m not in MATCHES]
    if unknown:
        raise ValueError(f"unknown method {unknown[0]}; known: {', '.join(MATCHES)}")
    x0, x1, y0, y1 = fraction_box(page.shape, *box)
    factor = min(1.0, max(0.05, downscale))
    part, small = gray(page)[y0:y1, x0:x1], template.at(factor)
    part = part if factor == 1.0 else resized(part, factor, 32)
    found = []
    for mode in modes:
        a, t = prepared(part, mode), prepared(small, mode)
        for method in methods:
            hit = best_hit(a, t, [s for s in scales if 0.05 <= s <= 10], match=MATCHES[method])
            if hit is not None:
                found.append({"mode": mode, "method": method, "score": hit["score"], "scale": hit["scale"], **{c: round(hit[c] / factor) for c in "xywh"}})
    return sorted(found, key=lambda r: -r["score"])[:k]


def heat_map(scores: np.ndarray, inverted: bool = False) -> np.ndarray:
    """IM23: scores as 8-bit grey."""
    return np.rint(np.clip(1 - scores if inverted else scores, 0, 1) * 255).astype(np.uint8)


def for_ocr(crop: np.ndarray, least_height: int = 48, border: int = 10) -> np.ndarray:
    """IM18: dark on white, of a least height, with a white border."""
    g = gray(crop)
    g = 255 - g if g.mean() < 128 else g
    if g.shape[0] < least_height:
        g = resized(g, least_height / g.shape[0])
    return np.pad(g, border, constant_values=255)


def is_empty(crop: np.ndarray, least: int = 30) -> bool:
    """Fewer dark pixels than a mark has (30 in a field, 20 in a cell)."""
    return int((gray(crop) < 200).sum()) < least


def evened(image: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """IM9, IM10: contrast-limited adaptive histogram equalisation: a curve for each tile, blended between their centres."""
    h, w = image.shape
    if not h or not w:
        return image
    th, tw = -(-h // tiles), -(-w // tiles)
    full = np.pad(image, ((0, th * tiles - h), (0, tw * tiles - w)), mode="edge")
    blocks = full.reshape(tiles, th, tiles, tw).transpose(0, 2, 1, 3).reshape(tiles * tiles, th * tw)
    counts = np.stack([np.bincount(b, minlength=256) for b in blocks]).astype(np.float64)
    limit = max(1.0, clip * th * tw / 256)
    over = np.maximum(counts - limit, 0).sum(1, keepdims=True)
    curves = ((np.minimum(counts, limit) + over / 256).cumsum(1) * (255 / (th * tw))).reshape(tiles, tiles, 256)

    def nearest(n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = (np.arange(n) + 0.5) / size - 0.5
        low = np.floor(at).astype(int)
        return low.clip(0, tiles - 1), (low + 1).clip(0, tiles - 1), at - low

    (a, b, fy), (c, d, fx) = nearest(h, th), nearest(w, tw)
    at = lambda i, j: curves[i[:, None], j[None, :], image]
    top = at(a, c) * (1 - fx) + at(a, d) * fx
    bottom = at(b, c) * (1 - fx) + at(b, d) * fx
    return np.rint(top * (1 - fy[:, None]) + bottom * fy[:, None]).clip(0, 255).astype(np.uint8)


def denoised(image: np.ndarray, strength: float = 10.0, patch: int = 7, search: int = 21) -> np.ndarray:
    """IM9, IM10: non-local means: each pixel is the mean of those around it, weighted by how alike their patches are."""
    if not image.size:
        return image
    r = search // 2
    a = np.pad(image.astype(np.float64), r, mode="reflect" if min(image.shape) > r else "edge")
    h, w = image.shape
    own, total, weights = image.astype(np.float64), np.zeros((h, w)), np.zeros((h, w))
    for dy in range(search):
        for dx in range(search):
            other = a[dy : dy + h, dx : dx + w]
            weight = np.exp(-box_mean((own - other) ** 2, patch) / strength**2)
            total += weight * other
            weights += weight
    return np.rint(total / weights).clip(0, 255).astype(np.uint8)


def without_dots(image: np.ndarray, low: int = 3, high: int = 8) -> np.ndarray:
    """IM9: small dark blobs, as of a dotted line, painted over with white discs."""
    if image.min() == image.max():
        return image
    out = image.copy()
    least, most = int(np.pi * low**2 / 4), 4 * int(np.pi * high**2 / 4)
    for x, y, w, h, area in component_boxes((image <= otsu(image)).astype(np.uint8)):
        if least <= area <= most and max(w, h) <= 2 * high:
            cx, cy, r = x + (w - 1) / 2, y + (h - 1) / 2, max(2, round(max(w, h) / 2) + 1)
            y0, x0 = max(0, int(cy) - r), max(0, int(cx) - r)
            part = out[y0 : int(cy) + r + 2, x0 : int(cx) + r + 2]
            yy, xx = np.mgrid[: part.shape[0], : part.shape[1]]
            part[np.hypot(yy + y0 - cy, xx + x0 - cx) <= r] = 255
    return out


def without_lines(image: np.ndarray) -> np.ndarray:
    """IM10: long dark runs, across or down, painted white."""
    if image.min() == image.max():
        return image
    dark = (image <= otsu(image)).astype(np.uint8)
    h, w = image.shape
    lines = opened(dark, max(18, w // 18), 1) | opened(dark, max(18, h // 10), 0)
    return np.where(lines > 0, 255, image).astype(np.uint8)


def black_and_white(image: np.ndarray) -> np.ndarray:
    return image if image.min() == image.max() else np.where(image > otsu(image), 255, 0).astype(np.uint8)


def field_image(crop: np.ndarray, dots: bool = True, search: int = 21) -> np.ndarray:
    """IM9: a field's crop as black on white: evened, its dotted line removed (on request), Otsu, denoised."""
    g = evened(gray(crop))
    return denoised(black_and_white(without_dots(g) if dots else g), search=search)


def cell_image(crop: np.ndarray, shave: int = 3, pad: int = 2, search: int = 21) -> np.ndarray:
    """IM10: a cell's crop as black on white, without border and grid lines, cut to its ink."""
    g = gray(crop)
    g = g[shave : max(shave, g.shape[0] - shave), shave : max(shave, g.shape[1] - shave)]
    if not g.size:
        return g
    bw = denoised(black_and_white(without_lines(evened(g))), search=search)
    ys, xs = np.nonzero(bw < 200)
    if not len(ys):
        return bw
    return bw[max(0, ys.min() - pad) : ys.max() + pad + 1, max(0, xs.min() - pad) : xs.max() + pad + 1]


def dotted(crop: np.ndarray, least: int = 5) -> bool:
    """Whether a cell holds a line of dots: at least five, over 40 pixels and 0.35 of its width."""
    xs = [x for x, _ in detect_dots(crop)]
    return len(xs) >= least and max(xs) - min(xs) >= max(40, int(0.35 * crop.shape[1]))


def field_box(y: int, x_start: int, x_end: int, width: int, height: int, side: int = 10, above: int = 60, below: int = 60) -> tuple[int, int, int, int]:
    """IM9, PR20: (x, y, w, h) of the region around a dotted line, within the page."""
    x0, x1 = max(0, min(width, x_start - side)), max(0, min(width, x_end + side))
    y0, y1 = max(0, min(height, y - above)), max(0, min(height, y + below))
    return x0, y0, x1 - x0, y1 - y0


def table_grids(image: np.ndarray, area_fraction: float = 0.02, least: int = 80, most: int = 10, pad: int = 6) -> list[dict]:
    """The tables of a page, the largest first: box and places of its lines, in page coordinates."""
    across, down, grid = grid_masks(binarize_lines(image))
    h, w = image.shape[:2]
    boxes = [b for b in component_boxes(grid) if b[2] >= least and b[3] >= least and b[2] * b[3] >= area_fraction * h * w]
    found = []
    for x, y, bw, bh, _ in sorted(boxes, key=lambda b: (-b[2] * b[3], b[1], b[0]))[:most]:
        x0, y0, x1, y1 = max(0, x - pad), max(0, y - pad), min(w, x + bw + pad), min(h, y + bh + pad)
        xs, ys = line_positions(down[y0:y1, x0:x1].sum(0)), line_positions(across[y0:y1, x0:x1].sum(1))
        found.append({"x": x0, "y": y0, "w": x1 - x0, "h": y1 - y0, "x_lines": [x0 + v for v in xs], "y_lines": [y0 + v for v in ys]})
    return found


def image_of(row: dict) -> np.ndarray:
    """The pixels of a page row (height, width, channels, pixels)."""
    image = np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], -1)
    return image[:, :, 0] if row["channels"] == 1 else image


TABLES = pa.schema([("rel_path", pa.string()), ("page_num", pa.int32()), ("table_index", pa.int32()), *((c, pa.int64()) for c in ("x", "y", "w", "h")), ("x_lines", pa.list_(pa.int64())), ("y_lines", pa.list_(pa.int64()))])


def page_tables(pages: DataFrame) -> DataFrame:
    """C14: a row per table of each page (rel_path, page_num, height, width, channels, pixels): its box and lines; layout.grid_cells gives the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["pixels"] is not None:
                    found = [{"rel_path": r["rel_path"], "page_num": r["page_num"], "table_index": k, **t} for k, t in enumerate(table_grids(image_of(r)))]
                    yield pa.RecordBatch.from_pylist(found, TABLES)

    return pages.select("rel_path", "page_num", "height", "width", "channels", "pixels").mapInArrow(run, "rel_path string, page_num int, table_index int, x long, y long, w long, h long, x_lines array<long>, y_lines array<long>")


HITS = pa.schema([("rel_path", pa.string()), ("page_num", pa.int32()), ("template", pa.string()), ("rank", pa.int32()), ("mode", pa.string()), ("method", pa.string()), ("score", pa.float64()), ("scale", pa.float64()), *((c, pa.int64()) for c in "xywh"), ("accepted", pa.bool_())])


def diagnosed(pages: DataFrame, templates: list[Template], modes: list[str], methods: list[str], scales: list[float], box: tuple[float, float, float, float] = (0.0, 1.0, 0.0, 1.0), downscale: float = 1.0, threshold: float = 0.7) -> DataFrame:
    """C17: the ranked hits of each template on each page, over modes, methods and scales; accepted: the score reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                if r["pixels"] is not None:
                    for t in templates:
                        hits = template_hits(image_of(r), t, modes, methods, scales, box, downscale)
                        yield pa.RecordBatch.from_pylist([{"rel_path": r["rel_path"], "page_num": r["page_num"], "template": t.name, "rank": k + 1, "accepted": h["score"] >= threshold, **h} for k, h in enumerate(hits)], HITS)

    return pages.select("rel_path", "page_num", "height", "width", "channels", "pixels").mapInArrow(run, "rel_path string, page_num int, template string, rank int, mode string, method string, score double, scale double, x long, y long, w long, h long, accepted boolean")
