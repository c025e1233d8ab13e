"""Pages as images: preprocessing, zones, grids and cells."""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from formloom.sources.settings import Settings
from formloom.sources.templates import DEFAULTS
from formloom.vision import kernels as K
from formloom.vision.recognisers import normalised

# preprocessing


def fit_within(width: int, height: int, most_width: int, most_height: int) -> float:
    """The scale, 1 at most, at which a size fits."""
    return min(1.0, most_width / width, most_height / height)


def adaptive_size(width: int, height: int, s: Settings) -> tuple[int, int]:
    """Pages below the least megapixels grow to the target, within the largest width and height."""
    if not s.enable_adaptive_scaling or width * height / 1e6 >= s.adaptive_scaling_min_mp:
        return width, height
    scale = (s.adaptive_scaling_target_mp * 1e6 / (width * height)) ** 0.5
    scale = min(scale, s.adaptive_scaling_max_width / width, s.adaptive_scaling_max_height / height)
    return int(width * scale), int(height * scale)


def straighten(image: np.ndarray, s: Settings) -> np.ndarray:
    """The largest bright part of the page, if it has four valid corners, upright; else the page."""
    plain = K.gray(image)
    bright = K.opened(plain > K.otsu(plain))
    boxes = K.components(bright)
    if not len(boxes):
        return image
    x0, y0, x1, y1 = max(boxes.tolist(), key=lambda b: bright[b[1] : b[3], b[0] : b[2]].sum())
    part = np.zeros_like(bright)
    part[y0:y1, x0:x1] = bright[y0:y1, x0:x1]
    if part.sum() < s.perspective_min_area_ratio * plain.size:
        return image
    quad = K.corners(part, s.perspective_corner_epsilon)
    if quad is None or part.sum() < 0.8 * 0.5 * abs(np.sum(quad[:, 0] * np.roll(quad[:, 1], -1) - np.roll(quad[:, 0], -1) * quad[:, 1])):
        return image  # no four corners, or a part with a bay, whose hull only has four
    sides = np.hypot(*(np.roll(quad, -1, axis=0) - quad).T)
    if sides.min() < s.perspective_min_corner_distance or sides.max() > 0.98 * max(plain.shape) and sides.min() > 0.98 * min(plain.shape):
        return image
    width, height = int(max(sides[0], sides[2])), int(max(sides[1], sides[3]))
    scale = fit_within(width, height, s.perspective_target_width_limit, s.perspective_target_height_limit)
    return K.warp(image, quad, max(1, int(width * scale)), max(1, int(height * scale)))


def deskew(image: np.ndarray) -> tuple[np.ndarray, float]:
    """Turned by its skew where that is 2 to 45 degrees; the angle is 0 where nothing was turned."""
    angle = K.skew(K.gray(image))
    return (K.rotate(image, angle), angle) if 2 <= abs(angle) <= 45 else (image, 0.0)


def enhance(image: np.ndarray, s: Settings) -> np.ndarray:
    """Black on white: scaled, evened out, pale text drawn, thresholded."""
    h, w = image.shape[:2]
    width, height = adaptive_size(w, h, s)
    if (width, height) != (w, h):
        image = K.resize(image, width, height)
    plain = K.clahe(K.gray(image))
    if s.enable_denoising:
        plain = K.median3(plain)
    if s.use_morphological_enhancement:
        drawn = plain.astype(int) + K.top_hat(plain, 15) - K.black_hat(plain, 15)
        plain = K.gamma(K.clahe(np.clip(drawn, 0, 255).astype(np.uint8)), s.gamma_correction)
    if s.enable_illumination_correction:
        light = K.gaussian(plain, s.illumination_kernel)
        plain = np.clip(np.rint(plain / np.maximum(light, 1) * 255), 0, 255).astype(np.uint8)
    if s.binarization_mode == "adaptive":
        white = plain > K.gaussian(plain, s.adaptive_block_size) - s.adaptive_c
        return np.where(white, 255, 0).astype(np.uint8)
    blurred = np.rint(K.gaussian(plain, s.gaussian_blur_kernel)).astype(np.uint8) if s.gaussian_blur_kernel > 1 else plain
    return np.where(blurred > K.otsu(blurred), 255, 0).astype(np.uint8)


def preprocess(image: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    if s.enable_perspective_correction:
        image = straighten(image, s)
    angle = 0.0
    if s.enable_deskew:
        image, angle = deskew(image)
    return enhance(image, s), angle


# zones

Band = tuple[str, int, int, str, float]
Templates = dict[str, list[tuple[str, float, float]]]


def _quiet_line(plain: np.ndarray, low: int, high: int) -> int | None:
    """The row nearest the middle of a range among those with little ink; 0 counts as none."""
    if not 0 <= low < high <= plain.shape[0] or plain[low:high].size == 0:
        return None
    part = plain[low:high]
    ink = K.smooth((part <= K.otsu(part)).sum(axis=1).astype(float), max(3, len(part) // 20))
    rows = np.flatnonzero(ink <= np.percentile(ink, 30))
    return (low + int(rows[np.abs(rows - (high - low) // 2).argmin()]) or None) if len(rows) else None


def _bands(plain: np.ndarray, found: list[int], method: str, confidence: float, s: Settings, template: str, templates: Templates) -> list[Band]:
    height = plain.shape[0]
    heads = [y for y in found if s.region_min_header_ratio <= y / height <= s.region_max_header_ratio]
    low, high = int(height * s.region_min_header_ratio), int(height * s.region_max_header_ratio)
    if not heads:
        line = _quiet_line(plain, low, high)
        heads = [line] if line else []
    if not heads:
        return []
    middle = height * (s.region_min_header_ratio + s.region_max_header_ratio) / 2
    head = min(heads, key=lambda y: abs(y - middle))
    low, high = head + int(height * s.region_min_defects_ratio), min(head + int(height * s.region_max_defects_ratio), height - 1)
    cuts = [y for y in found if y > head and s.region_min_defects_ratio <= (y - head) / height <= s.region_max_defects_ratio]
    if not cuts:
        line = _quiet_line(plain, low, high)
        cuts = [line] if line else []
    if not cuts:
        return []
    cut = min(cuts, key=lambda y: abs(y - (low + high) / 2))
    edges = [0, head, cut, height]
    out = [(name, a, b, method, confidence) for name, a, b in zip(("header", "defects", "analysis"), edges, edges[1:]) if b > a]
    wanted = {name: (a, b) for name, a, b in templates.get(template, [])}
    tolerance = s.region_adaptive_template_tolerance
    off = any(n in wanted and max(abs(a / height - wanted[n][0]), abs(b / height - wanted[n][1])) > tolerance for n, a, b, _, _ in out)
    return [] if off else out


def _by_lines(image: np.ndarray, s: Settings, template: str, templates: Templates) -> list[Band]:
    plain = K.gray(image)
    width = plain.shape[1]
    found = K.lines(K.adaptive_ink(plain, 21, 10), max(10, width // 2), int(np.ceil(s.region_horizontal_line_min_width_ratio * width)))
    return _bands(plain, K.merge_close(found, 10), "adaptive", 0.85, s, template, templates)


def _by_projection(image: np.ndarray, s: Settings, template: str, templates: Templates) -> list[Band]:
    plain = K.gray(image)
    ink = K.smooth((plain <= K.otsu(plain)).sum(axis=1).astype(float), max(5, plain.shape[0] // 50))
    rows = np.flatnonzero(ink <= np.percentile(ink, 20))
    parts = np.split(rows, np.flatnonzero(np.diff(rows) > 1) + 1) if len(rows) else []
    if len(parts) < 2:
        return []
    longest = sorted(parts, key=lambda p: p[0] - p[-1])[:2]
    return _bands(plain, sorted(int((p[0] + p[-1]) / 2) for p in longest), "text_based", 0.75, s, template, templates)


def _by_template(image: np.ndarray, s: Settings, template: str, templates: Templates) -> list[Band]:
    height = image.shape[0]
    rows = templates.get(template) or next(iter(templates.values()))
    return [(n, int(np.rint(height * a)), int(np.rint(height * b)), "template", 1.0) for n, a, b in rows]


def _valid(bands: list[Band], height: int, s: Settings) -> bool:
    covered = sum(b - a for _, a, b, _, _ in bands)
    return bool(bands) and bands[0][1] == 0 and bands[-1][2] == height and covered >= 0.95 * height and min(b[4] for b in bands) >= s.region_min_confidence


def zones(image: np.ndarray, s: Settings, template: str | None = None, templates: Templates = DEFAULTS) -> list[Band]:
    """(name, y_start, y_end, method, confidence): the first strategy with valid bands; the template's bands at last."""
    template = template or s.template_name
    ways = {"adaptive": [_by_lines], "text_based": [_by_projection], "template": [], "auto": [_by_lines, _by_projection]}
    for way in ways.get(s.region_detection_strategy, []) if s.enable_region_detection else []:
        bands = way(image, s, template, templates)
        if _valid(bands, image.shape[0], s):
            return bands
    return _by_template(image, s, template, templates)


# grids and cells


def grid(image: np.ndarray, s: Settings) -> dict | None:
    """Rows and columns of a table's lines with a confidence, or null."""
    if s.table_detection_strategy == "template":
        return None  # no template says where lines are: a strategy that finds none
    plain = K.gray(image)
    h, w = plain.shape
    if min(h, w) < 50:
        return None
    ink = plain <= K.otsu(plain)
    least = s.table_line_min_length_ratio
    rows = K.merge_close(K.lines(ink, max(10, int(w * s.table_h_kernel_ratio)), int(w * least)), s.table_line_merge_threshold)
    cols = K.merge_close(K.lines(ink.T, max(10, int(h * s.table_v_kernel_ratio)), int(h * least)), s.table_line_merge_threshold)
    if min(len(rows), len(cols)) < 2 or min(np.diff(rows).min(), np.diff(cols).min()) < 10:
        return None
    regular = lambda v: 1 / (1 + np.std(np.diff(v)) / np.mean(np.diff(v)))
    sure = (min(len(rows) / 10, 1) + min(len(cols) / 10, 1)) * 0.3 + (regular(rows) + regular(cols)) * 0.2
    return {"rows": rows, "cols": cols, "confidence": float(min(1.0, max(0.0, sure)))}


def cell_boxes(found: dict, width: int, height: int, s: Settings) -> list[tuple[int, int, int, int, int, int]]:
    """(row, column, x0, y0, x1, y1) inside the margin, of cells that are large enough."""
    bounds = lambda lines, size: [0, *((a + b) // 2 for a, b in zip(lines, lines[1:])), size]
    ys, xs, m = bounds(found["rows"], height), bounds(found["cols"], width), s.table_cell_margin
    boxes = [(i, j, xs[j] + m, ys[i] + m, xs[j + 1] - m, ys[i + 1] - m) for i in range(len(ys) - 1) for j in range(len(xs) - 1)]
    return [b for b in boxes if b[4] - b[2] >= s.table_cell_min_width and b[5] - b[3] >= s.table_cell_min_height]


def is_empty(cell: np.ndarray, s: Settings) -> bool:
    """The cheap tests first: variance, white share, edges, parts."""
    if cell.size == 0:
        return True
    plain = K.gray(cell)
    if plain.var() > s.table_empty_variance_threshold or (plain > 240).mean() < s.table_empty_white_pixel_threshold:
        return False
    if K.edges(plain).mean() > s.table_empty_edge_density_threshold:
        return False
    if plain.min() == plain.max():
        return True
    return len(K.components(plain <= K.otsu(plain))) <= s.table_empty_component_threshold


def cell_ready(cell: np.ndarray) -> np.ndarray:
    return K.clahe(K.gray(cell), 2.0, 2)


# columns


def decode(row) -> np.ndarray | None:
    """A row of Spark's image source as an array; null where it could not be read."""
    if row["height"] is None or row["height"] <= 0:
        return None
    return np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["nChannels"])


def _mapped(images: DataFrame, schema: str, make) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in schema.split(", ")]
        for b in batches:
            rows = [r for record in b.to_dict("records") for r in make(record)]
            yield pd.DataFrame(rows, columns=names)

    return images.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(run, schema)


def preprocessed(images: DataFrame, s: Settings = Settings()) -> DataFrame:
    """images(image) -> (origin, status, error, height, width, angle, data): one gray page for each image.

    An image that cannot be read, or fails, gives an error row; the others go on.
    """
    def make(r):
        try:
            image = decode(r)
            if image is None:
                raise ValueError("Unable to read image")
            page, angle = preprocess(image, s)
            return [(r["origin"], "ok", None, page.shape[0], page.shape[1], angle, page.tobytes())]
        except Exception as e:  # a page's failure is a row, not the batch's
            return [(r["origin"], "failed", str(e), None, None, None, None)]

    return _mapped(images, "origin string, status string, error string, height int, width int, angle double, data binary", make)


def zoned(images: DataFrame, s: Settings = Settings()) -> DataFrame:
    """images(image) -> (origin, region_id, y_start, y_end, method, confidence)."""
    def make(r):
        image = decode(r)
        return [] if image is None else [(r["origin"], *band) for band in zones(image, s)]

    return _mapped(images, "origin string, region_id string, y_start int, y_end int, method string, confidence double", make)


def _texts(recogniser, origin: str, region: str, part: np.ndarray, s: Settings) -> list[tuple]:
    """(text, confidence, x0, y0, x1, y1) of a part of a page in its own pixels.

    Parts over the largest size are scaled down and their boxes back up; a RuntimeError is tried again at
    half and a quarter of the size. Detections below the confidence threshold go.
    """
    height, width = part.shape[:2]
    base = min(fit_within(width, height, s.region_max_width, s.region_max_height), 1.0, s.ocr_max_image_dimension / max(width, height))
    for attempt in (1.0, 0.5, 0.25):
        scale = base * attempt
        size = max(1, int(width * scale)), max(1, int(height * scale))
        try:
            got = normalised(recogniser(origin, region, part if scale == 1.0 else K.resize(part, *size)))
            break
        except RuntimeError:
            if attempt == 0.25:
                raise
    return [(text, sure, *(int(v / scale) for v in box)) for text, sure, *box in got if sure >= s.ocr_confidence_threshold]


def _cells(recogniser, origin: str, name: str, part: np.ndarray, found: dict, s: Settings) -> list[dict]:
    """The cells of a grid. The cheap test comes first: an empty cell has the text '' at a confidence of 1.0 and is not
    recognised; one whose recogniser fails is '' at 0.0."""
    out = []
    for i, j, x0, y0, x1, y1 in cell_boxes(found, part.shape[1], part.shape[0], s):
        cell, text, sure = part[y0:y1, x0:x1], "", 1.0
        if not (s.table_enable_empty_cell_detection and is_empty(cell, s)):
            try:
                got = [g for g in normalised(recogniser(origin, f"{name}/{i}/{j}", cell_ready(cell) if s.table_cell_preprocess else cell)) if g[0].strip()]
                text, sure = " ".join(g[0] for g in got), float(np.mean([g[1] for g in got])) if got else 0.0
            except Exception:  # a cell that fails is a cell without text
                text, sure = "", 0.0
        out.append({"row_idx": i, "col_idx": j, "x_start": x0, "y_start": y0, "x_end": x1, "y_end": y1, "text": text, "confidence": sure})
    return out


def usable(found: dict | None) -> bool:
    """A grid of two by two cells or more that is sure enough to be read cell by cell."""
    return bool(found) and found["confidence"] >= 0.3 and min(len(found["rows"]), len(found["cols"])) >= 3


READ = (
    "origin string, status string, error string, seconds double, height int, width int, "
    "zones array<struct<region_id:string,y_start:int,y_end:int,method:string,confidence:double>>, "
    "detections array<struct<region_id:string,text:string,confidence:double,x0:int,y0:int,x1:int,y1:int,top:int>>, "
    "grids array<struct<region_id:string,rows:array<int>,cols:array<int>,confidence:double,"
    "cells:array<struct<row_idx:int,col_idx:int,x_start:int,y_start:int,x_end:int,y_end:int,text:string,confidence:double>>>>"
)


def read_page(image: np.ndarray, origin: str, recogniser, s: Settings, templates: Templates, prepare: bool, by_zone: bool) -> dict:
    page = preprocess(image, s)[0] if prepare else image
    bands = zones(page, s, None, templates) if by_zone else [(None, 0, page.shape[0], "page", 1.0)]
    texts, grids = [], []
    for name, top, low, _, _ in bands:
        part = page[top:low]
        found = grid(part, s) if name == "defects" and s.enable_table_detection else None
        if usable(found):  # a table is read cell by cell, not as running text
            cells = _cells(recogniser, origin, name, part, found, s)
            grids.append({"region_id": name, "rows": list(map(int, found["rows"])), "cols": list(map(int, found["cols"])), "confidence": found["confidence"], "cells": cells})
            texts += [(c["text"], c["confidence"], c["x_start"], c["y_start"], c["x_end"], c["y_end"], name, top) for c in cells if c["text"]]
        else:
            texts += [(*t, name, top) for t in _texts(recogniser, origin, name or "page", part, s)]
    keys = ("text", "confidence", "x0", "y0", "x1", "y1", "region_id", "top")
    return {
        "height": page.shape[0], "width": page.shape[1], "detections": [dict(zip(keys, t)) for t in texts], "grids": grids,
        "zones": [dict(zip(("region_id", "y_start", "y_end", "method", "confidence"), b)) for b in bands] if by_zone else [],
    }


def read_pages(images: DataFrame, recogniser, s: Settings = Settings(), templates: Templates = DEFAULTS, prepare: bool = True, by_zone: bool = True) -> DataFrame:
    """images(image) -> a row for each page, as READ: its zones, detections and grids, and the seconds it took.

    A page is decoded, preprocessed, cut into zones and read in one go, so its pixels never travel. Boxes are in
    the zone's pixels; top is where the zone begins. Without by_zone a page is read as a whole. An image that
    cannot be read, or fails, is a row with an error; the others go on. recogniser: see vision.recognisers.
    """
    schema = images.sparkSession.createDataFrame([], READ).schema
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(k)[i].as_py() for k, n in enumerate(("origin", "height", "width", "nChannels", "data"))}
                began, row = time.perf_counter(), {n: None for n in schema.names}
                try:
                    image = decode(r)
                    if image is None:
                        raise ValueError("Unable to read image")
                    row |= read_page(image, r["origin"], recogniser, s, templates, prepare, by_zone) | {"status": "ok"}
                except Exception as e:  # a page's failure is a row, not the batch's
                    row |= {"status": "failed", "error": str(e)}
                yield pa.RecordBatch.from_pylist([row | {"origin": r["origin"], "seconds": time.perf_counter() - began}], kinds)

    return images.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInArrow(run, READ)


def recognised(images: DataFrame, recogniser, s: Settings = Settings()) -> DataFrame:
    """images(image) -> detections (doc_id, det_idx, ...) of all zones, as read_pages finds them without preprocessing."""
    pages = read_pages(images, recogniser, replace(s, enable_table_detection=False), prepare=False).where("status = 'ok'")
    one = pages.select(F.col("origin").alias("doc_id"), "width", "height", F.posexplode("detections").alias("det_idx", "d"))
    mid = lambda a, b: F.floor((F.col(f"d.{a}") + F.col(f"d.{b}")) / 2).cast("int")
    top = F.col("d.top")
    return one.select(
        "doc_id", "det_idx", "d.text", "d.confidence", mid("x0", "x1").alias("cx"), (mid("y0", "y1") + top).alias("cy"), "d.x0", (F.col("d.y0") + top).alias("y0"), "d.x1",
        (F.col("d.y1") + top).alias("y1"), "d.region_id", "width", "height",
    )


def replay(table: dict[tuple[str, str], list[tuple]]):
    """A recogniser that knows the answers: (origin's end, region) -> detections. For tests and stored results."""
    def known(origin: str, region: str, pixels: np.ndarray):
        return next((rows for (end, name), rows in table.items() if name == region and origin.endswith(end)), [])

    return known


def recognised_cells(images: DataFrame, recogniser, s: Settings = Settings(), region: str = "defects") -> DataFrame:
    """images(image) -> cells of a zone's grid: (doc_id, row_idx, col_idx, x0, y0, x1, y1, text, confidence) in the page's pixels.

    An empty cell has the text '' at a confidence of 1.0 and is not recognised. recogniser(origin, place, pixels)
    yields detections; what a cell yields is joined by spaces at its mean confidence, and a cell whose recogniser
    fails is '' at 0.0. Pages without the zone or without a grid give no rows.
    """
    def make(r):
        image = decode(r)
        if image is None:
            return []
        out = []
        for name, top, low, _, _ in zones(image, s):
            found = grid(image[top:low], s) if name == region and s.enable_table_detection else None
            for c in _cells(recogniser, r["origin"], name, image[top:low], found, s) if usable(found) else ():
                out.append((r["origin"], c["row_idx"], c["col_idx"], c["x_start"], c["y_start"] + top, c["x_end"], c["y_end"] + top, c["text"], c["confidence"]))
        return out

    return _mapped(images, "doc_id string, row_idx int, col_idx int, x0 int, y0 int, x1 int, y1 int, text string, confidence double", make)


def properties(images: DataFrame) -> DataFrame:
    """images(image) -> (origin, height, width, channels, darkest, brightest, mean): what an image looks like before anything is done to it."""
    def make(r):
        image = decode(r)
        return [] if image is None else [(r["origin"], *image.shape, int(image.min()), int(image.max()), float(image.mean()))]

    return _mapped(images, "origin string, height int, width int, channels int, darkest int, brightest int, mean double", make)
