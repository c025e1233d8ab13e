"""Recognisers of text by name, built once for each worker, and what they return in one form.

A recogniser is called with (origin, region, pixels) and returns detections in one of the forms that
``normalised`` reads. The engine ships no model: ``replay:<file>`` gives stored results, ``dots`` reads the dot
code of drawn pages, and ``module:function`` makes any other, with the settings that its arguments name.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import asdict
from importlib import import_module

import numpy as np

from formloom.sources.settings import Settings
from formloom.vision import kernels as K

Recogniser = Callable[[str, str, np.ndarray], object]
#: text, confidence, x0, y0, x1, y1 in the pixels that were given
Detection = tuple[str, float, int, int, int, int]


def dots(origin: str, region: str, pixels: np.ndarray) -> Iterator[Detection]:
    """The number of separate dark squares in each group of them, as digits: a code that needs no model."""
    ink = K.gray(pixels) < 128
    boxes = [b for b in K.components(ink).tolist() if b[2] - b[0] <= 12 and b[3] - b[1] <= 12]
    groups: list[list[list[int]]] = []
    for b in sorted(boxes, key=lambda b: (b[1] // 16, b[0])):
        last = groups[-1][-1] if groups else None
        if last is not None and abs(b[1] - last[1]) < 16 and 0 <= b[0] - last[2] <= 16:
            groups[-1].append(b)
        else:
            groups.append([b])
    for own in groups:
        yield str(len(own)), 0.9, min(b[0] for b in own), min(b[1] for b in own), max(b[2] for b in own), max(b[3] for b in own)


def replay(table: dict) -> Recogniser:
    """Stored results: {end of the file's name: {region: [[text, confidence, x0, y0, x1, y1]]}}."""
    def known(origin: str, region: str, pixels: np.ndarray) -> Iterable:
        return next((regions.get(region, []) for end, regions in table.items() if origin.endswith(end)), [])

    return known


def make(name: str, settings: Settings = Settings()) -> Recogniser:
    """A recogniser by name; a name that nothing is known by is an error."""
    kind, _, rest = name.partition(":")
    if name == "dots":
        return dots
    if kind == "replay" and rest:
        with open(rest, encoding="utf-8") as f:
            return replay(json.load(f))
    if rest:
        maker = getattr(import_module(kind), rest)
        known = asdict(settings)
        wanted = inspect.signature(maker).parameters
        return maker(**{k: known[k] for k in wanted if k in known})
    raise ValueError(f"no recogniser {name!r}: dots, replay:<file> or <module>:<function>")


class Named:
    """A recogniser that travels as its name and is built where it is first called; close() lets it go."""

    def __init__(self, name: str, settings: Settings = Settings()):
        self.name, self.settings, self._made = name, settings, None

    def __getstate__(self):
        return {"name": self.name, "settings": self.settings}

    def __setstate__(self, state):
        self.__dict__.update(state, _made=None)

    def __call__(self, origin: str, region: str, pixels: np.ndarray):
        if self._made is None:
            self._made = make(self.name, self.settings)
        return self._made(origin, region, pixels)

    def close(self) -> None:
        stop = getattr(self._made, "close", None)
        if stop:
            stop()
        self._made = None


def _box(points) -> tuple[int, int, int, int]:
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return int(min(xs)), int(min(ys)), int(max(xs)), int(max(ys))


def normalised(result) -> list[Detection]:
    """Detections from (text, confidence, x0, y0, x1, y1) rows, from pages of parallel lists (rec_texts, rec_scores,
    rec_polys or dt_polys), or from pages of [polygon, (text, score)] pairs.

    Lists of different lengths count as far as the shortest. Entries that cannot be read are left out; null gives none.
    """
    rows = list(result) if isinstance(result, Iterable) and not isinstance(result, dict) else [result] if result else []
    out: list[Detection] = []

    def add(text, score, box) -> None:
        try:
            out.append((str(text), float(score), *(int(v) for v in box)))
        except (TypeError, ValueError):
            pass  # an entry that cannot be read is no detection

    for row in rows:
        if isinstance(row, dict):
            polygons = row.get("rec_polys", row.get("dt_polys", []))
            for text, score, points in zip(row.get("rec_texts", []), row.get("rec_scores", []), polygons):
                try:
                    add(text, score, _box(points))
                except (TypeError, ValueError, IndexError):
                    continue
        elif isinstance(row, tuple | list) and len(row) == 6 and isinstance(row[0], str):
            add(row[0], row[1], row[2:])
        elif isinstance(row, tuple | list):
            for entry in row:
                try:
                    points, (text, score) = entry
                    add(text, score, _box(points))
                except (TypeError, ValueError, IndexError):
                    continue
    return out
