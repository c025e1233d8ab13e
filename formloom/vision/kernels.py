"""Plain image operations on numpy arrays: uint8, height x width, or with a last axis of 3 (BGR)."""

from __future__ import annotations

import numpy as np


def gray(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2 or image.shape[2] == 1:
        return image.reshape(image.shape[:2])
    return np.rint(image[..., :3].astype(np.float64) @ np.array([0.114, 0.587, 0.299])).astype(np.uint8)


def otsu(image: np.ndarray) -> int:
    """The threshold that parts the histogram best; pixels above it are white."""
    counts = np.bincount(image.ravel(), minlength=256).astype(float)
    weight = np.cumsum(counts)
    mass = np.cumsum(counts * np.arange(256))
    rest = weight[-1] - weight
    with np.errstate(divide="ignore", invalid="ignore"):
        between = weight * rest * (mass / weight - (mass[-1] - mass) / rest) ** 2
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def box_sum(image: np.ndarray, size: int) -> np.ndarray:
    """Sums over a square around each pixel; edges repeat."""
    half = size // 2
    padded = np.pad(image.astype(np.int64), ((half + 1, half), (half + 1, half)), mode="edge")
    total = padded.cumsum(0).cumsum(1)
    h, w = image.shape
    return total[size : size + h, size : size + w] - total[:h, size : size + w] - total[size : size + h, :w] + total[:h, :w]


def gaussian(image: np.ndarray, size: int) -> np.ndarray:
    """A Gaussian average over a square, edges repeated; the width follows the size."""
    sigma = 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    at = np.arange(size) - size // 2
    weight = np.exp(-(at**2) / (2 * sigma**2))
    weight /= weight.sum()
    out = image.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (size // 2, size // 2)
        p = np.pad(out, pad, mode="edge")
        out = sum(w * np.take(p, range(k, k + out.shape[axis]), axis=axis) for k, w in enumerate(weight))
    return out


def opened(mask: np.ndarray, size: int = 3) -> np.ndarray:
    """Without what is thinner than a square."""
    return dilate(~dilate(~mask, size), size)


def adaptive_ink(image: np.ndarray, size: int, c: int) -> np.ndarray:
    """True where a pixel is darker than the mean around it, less c."""
    return image.astype(np.float64) <= np.rint(box_sum(image, size) / (size * size)) - c


def smooth(values: np.ndarray, window: int) -> np.ndarray:
    """A box average with zeros beyond the ends."""
    return np.convolve(values, np.ones(window) / window, mode="same") if window > 1 else values


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, end) of the runs of True in each row."""
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, begin = np.nonzero(edges == 1)
    return row, begin, np.nonzero(edges == -1)[1]


def long_runs(ink: np.ndarray, least: int) -> np.ndarray:
    """What opening by a horizontal segment leaves: runs of the length or more."""
    row, begin, end = runs(ink)
    keep = end - begin >= least
    out = np.zeros((ink.shape[0], ink.shape[1] + 1), np.int8)
    np.add.at(out, (row[keep], begin[keep]), 1)
    np.add.at(out, (row[keep], end[keep]), -1)
    return out.cumsum(axis=1)[:, :-1] > 0


def components(mask: np.ndarray) -> np.ndarray:
    """Boxes (x0, y0, x1, y1) of connected parts, diagonals counted, by a union of runs."""
    row, begin, end = runs(mask)
    parent = np.arange(len(row))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = int(parent[i])
        return i

    first = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        a, b = int(first[y - 1]), int(first[y])
        i, j = a, b
        while i < b and j < first[y + 1]:
            if begin[i] <= end[j] and begin[j] <= end[i]:
                ri, rj = top(i), top(j)
                parent[max(ri, rj)] = min(ri, rj)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.array([top(i) for i in range(len(row))], int)
    kinds, where = np.unique(roots, return_inverse=True)
    boxes = np.zeros((len(kinds), 4), int)
    boxes[:, 0], boxes[:, 1] = mask.shape[1], mask.shape[0]
    for k, (op, values) in enumerate(((np.minimum, begin), (np.minimum, row), (np.maximum, end), (np.maximum, row + 1))):
        op.at(boxes[:, k], where, values)
    return boxes


def lines(ink: np.ndarray, kernel: int, least: int) -> list[int]:
    """Middles (y) of horizontal lines at least so long, after opening by the kernel; top to bottom."""
    boxes = components(long_runs(ink, kernel))
    return sorted(int(y0 + (y1 - y0) // 2) for x0, y0, x1, y1 in boxes if x1 - x0 >= least)


def merge_close(positions: list[int], threshold: int) -> list[int]:
    out: list[int] = []
    for p in sorted(positions):
        if out and p - out[-1] <= threshold:
            out[-1] = int((out[-1] + p) / 2)
        else:
            out.append(p)
    return out


def resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, pixel middles as anchors."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    return _sample(image, y[:, None] + np.zeros(width), x[None, :] + np.zeros((height, 1)))


def _sample(image: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    h, w = image.shape[:2]
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = y - y0, x - x0
    if image.ndim == 3:
        fy, fx = fy[..., None], fx[..., None]
    top = image[y0, x0] * (1 - fx) + image[y0, x1] * fx
    low = image[y1, x0] * (1 - fx) + image[y1, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def rotate(image: np.ndarray, degrees: float) -> np.ndarray:
    """About the middle, same size; edges repeat."""
    h, w = image.shape[:2]
    angle = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(float)
    cy, cx = h / 2, w / 2
    return _sample(image, cy + (x - cx) * np.sin(angle) + (y - cy) * np.cos(angle), cx + (x - cx) * np.cos(angle) - (y - cy) * np.sin(angle))


def gradients(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = np.pad(image.astype(np.int32), 1, mode="edge")
    gx = (p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[1:-1, :-2] + p[2:, :-2])
    gy = (p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:]) - (p[:-2, :-2] + 2 * p[:-2, 1:-1] + p[:-2, 2:])
    return gx, gy


def edges(image: np.ndarray, low: int = 50, high: int = 150) -> np.ndarray:
    """Ridges of the gradient over high, and those over low that touch them."""
    gx, gy = gradients(image)
    size = np.abs(gx) + np.abs(gy)
    p = np.pad(size, 1)
    flat, steep = np.abs(gy) <= 0.4142 * np.abs(gx), np.abs(gy) >= 2.4142 * np.abs(gx)
    same = (gx >= 0) == (gy >= 0)
    beside = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    a = np.where(flat, beside(0, -1), np.where(steep, beside(-1, 0), np.where(same, beside(-1, -1), beside(-1, 1))))
    b = np.where(flat, beside(0, 1), np.where(steep, beside(1, 0), np.where(same, beside(1, 1), beside(1, -1))))
    ridge = (size > a) & (size >= b)
    strong, weak = ridge & (size > high), ridge & (size > low)
    while True:
        grown = weak & dilate(strong, 3)
        if (grown == strong).all():
            return strong
        strong = grown | strong


def dilate(mask: np.ndarray, size: int) -> np.ndarray:
    return box_sum(np.pad(mask, size // 2 + 1), size)[size // 2 + 1 : -(size // 2 + 1), size // 2 + 1 : -(size // 2 + 1)] > 0


def _slide(image: np.ndarray, size: int, op) -> np.ndarray:
    """Minimum or maximum over a square, an axis at a time."""
    half = size // 2
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (half, half)
        p = np.pad(image, pad, mode="edge")
        image = op.reduce([np.take(p, range(k, k + image.shape[axis]), axis=axis) for k in range(size)])
    return image


def top_hat(image: np.ndarray, size: int) -> np.ndarray:
    return image - np.minimum(image, _slide(_slide(image, size, np.minimum), size, np.maximum))


def black_hat(image: np.ndarray, size: int) -> np.ndarray:
    return np.maximum(image, _slide(_slide(image, size, np.maximum), size, np.minimum)) - image


def clahe(image: np.ndarray, clip: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Histogram equalisation in tiles with clipped histograms, mixed between tile middles."""
    h, w = image.shape
    ys, xs = np.linspace(0, h, tiles + 1).astype(int), np.linspace(0, w, tiles + 1).astype(int)
    maps = np.zeros((tiles, tiles, 256))
    for i in range(tiles):
        for j in range(tiles):
            tile = image[ys[i] : max(ys[i + 1], ys[i] + 1), xs[j] : max(xs[j + 1], xs[j] + 1)]
            counts = np.bincount(tile.ravel(), minlength=256).astype(float)
            limit = max(1.0, clip * tile.size / 256)
            extra = np.maximum(counts - limit, 0).sum()
            counts = np.minimum(counts, limit) + extra / 256
            maps[i, j] = np.cumsum(counts) * 255 / max(1, tile.size)
    at = lambda n: np.clip((np.arange(n) + 0.5) * tiles / n - 0.5, 0, tiles - 1)
    y, x = at(h), at(w)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    pick = lambda a, b: maps[a[:, None], b[None, :], image]
    out = (pick(y0, x0) * (1 - fx) + pick(y0, x1) * fx) * (1 - fy) + (pick(y1, x0) * (1 - fx) + pick(y1, x1) * fx) * fy
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def gamma(image: np.ndarray, power: float) -> np.ndarray:
    return np.clip(np.rint(255 * (np.arange(256) / 255) ** power), 0, 255).astype(np.uint8)[image]


def median3(image: np.ndarray) -> np.ndarray:
    p = np.pad(image, 1, mode="edge")
    h, w = image.shape
    return np.median([p[dy : dy + h, dx : dx + w] for dy in range(3) for dx in range(3)], axis=0).astype(np.uint8)


def skew(image: np.ndarray, limit: float = 45.0) -> float:
    """The median angle of long straight edges, in degrees, between -45 and 45; 0 where there is none.

    Votes of edge pixels over angles of one degree and whole pixels of distance; peaks of 100 votes or
    more are lines.
    """
    y, x = np.nonzero(edges(image))
    if not len(y):
        return 0.0
    found = []
    for degree in np.arange(-90, 90):
        a = np.deg2rad(degree)
        votes = np.bincount(np.rint(x * np.cos(a) + y * np.sin(a) + sum(image.shape)).astype(int))
        found += [degree] * int((votes >= 100).sum())
    tilt = np.array([(f + 90 if f <= 0 else f - 90) for f in found], float)
    tilt = tilt[np.abs(tilt) < limit]
    return float(np.median(tilt)) if len(tilt) else 0.0


def corners(mask: np.ndarray, epsilon: float) -> np.ndarray | None:
    """Four corners of a mask's hull after the Douglas-Peucker step, ordered from the top left; null if not four."""
    y, x = np.nonzero(mask)
    if len(y) < 4:
        return None
    hull = _hull(np.unique(np.stack([x, y], axis=1), axis=0))
    length = np.hypot(*(np.roll(hull, -1, axis=0) - hull).T).sum()
    kept = _simplify(hull, epsilon * length)
    if len(kept) != 4:
        return None
    total, diff = kept.sum(axis=1), kept[:, 1] - kept[:, 0]
    return np.array([kept[total.argmin()], kept[diff.argmin()], kept[total.argmax()], kept[diff.argmax()]], float)


def _hull(points: np.ndarray) -> np.ndarray:
    def half(ps):
        out = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ps = [tuple(map(int, p)) for p in points[np.lexsort((points[:, 1], points[:, 0]))]]
    return np.array(half(ps) + half(ps[::-1]), float)


def _simplify(ring: np.ndarray, epsilon: float) -> np.ndarray:
    far = int(np.hypot(*(ring - ring[0]).T).argmax())

    def keep(a: int, b: int) -> list[int]:
        if b - a < 2:
            return []
        p, q = ring[a], ring[b % len(ring)]
        d = np.abs((q[0] - p[0]) * (ring[a + 1 : b, 1] - p[1]) - (q[1] - p[1]) * (ring[a + 1 : b, 0] - p[0])) / max(1e-9, np.hypot(*(q - p)))
        k = int(d.argmax())
        return keep(a, a + 1 + k) + [a + 1 + k] + keep(a + 1 + k, b) if d[k] > epsilon else []

    return ring[[0, *keep(0, far), far, *keep(far, len(ring))]]


def warp(image: np.ndarray, quad: np.ndarray, width: int, height: int) -> np.ndarray:
    """The quad (from the top left, clockwise) as an upright image."""
    target = np.array([[0, 0], [width - 1, 0], [width - 1, height - 1], [0, height - 1]], float)
    rows, values = [], []
    for (u, v), (x, y) in zip(target, quad):
        rows += [[u, v, 1, 0, 0, 0, -x * u, -x * v], [0, 0, 0, u, v, 1, -y * u, -y * v]]
        values += [x, y]
    m = np.append(np.linalg.solve(np.array(rows), np.array(values)), 1).reshape(3, 3)
    v, u = np.mgrid[0:height, 0:width].astype(float)
    w = m[2, 0] * u + m[2, 1] * v + m[2, 2]
    return _sample(image, (m[1, 0] * u + m[1, 1] * v + m[1, 2]) / w, (m[0, 0] * u + m[0, 1] * v + m[0, 2]) / w)
