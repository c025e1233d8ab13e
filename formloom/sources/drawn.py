"""Drawn pages: images that stand in for scanned forms, made from ``nation`` by rules that SQL can state.

A page has two lines across it, a grid between them, and the dot code of vision.recognisers: groups of dark
squares, as many as the digit that they stand for. For the page of key k:

* height 1200 + 10 (k mod 5), width 800; lines at ``head`` = 260 + k mod 7 and ``cut`` = head + 480 + k mod 11;
* grid lines across at head + 80 j, j from 1 to 2 + k mod 3, and down at 100, 300, 500, 700;
* the code 1 + (k + g) mod 5 at (60 + 150 g, 40) and, below the cut, 1 + (2 k + g) mod 5 at (60 + 150 g, cut + 50), g from 0 to 2;
* in the corner of the cell in row i and column j of the grid's cells the code (3 i + j + k) mod 4, nothing for 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from formloom.sources import png
from formloom.sources.images import images
from formloom.sources.scratch import scratch
from formloom.sources.sinks import write_files

_DOWN = (100, 300, 500, 700)


def _code(page: np.ndarray, x: int, y: int, n: int) -> None:
    for i in range(n):
        page[y : y + 4, x + 10 * i : x + 10 * i + 4] = 0


def page(k: int) -> np.ndarray:
    height, width = 1200 + 10 * (k % 5), 800
    head, n = 260 + k % 7, 480 + k % 11
    cut = head + n
    out = np.full((height, width), 255, np.uint8)
    across = [80 * j for j in range(1, 3 + k % 3)]
    for y in (head, cut, *(head + r for r in across)):
        out[y - 1 : y + 2, 20 : width - 20] = 0
    for x in _DOWN:
        out[head:cut, x - 1 : x + 2] = 0
    for g in range(3):
        _code(out, 60 + 150 * g, 40, 1 + (k + g) % 5)
        _code(out, 60 + 150 * g, cut + 50, 1 + (2 * k + g) % 5)
    # cells reach from the middle before a line to the middle after it
    lines = [1, *across, n - 1]
    ys, xs = [0, *((a + b) // 2 for a, b in zip(lines, lines[1:]))], [0, *((a + b) // 2 for a, b in zip(_DOWN, _DOWN[1:]))]
    for i, y in enumerate(ys):
        for j, x in enumerate(xs):
            _code(out, x + 8, head + y + 10, (3 * i + j + k) % 4)
    return out


def drawn_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with ``page-<k>.png`` for each row of nation."""
    path = scratch(spark, "pages")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([f"page-{k}.png"]), pa.array([png.encode(page(k))], pa.binary())], ["name", "content"])

    keys = spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr("CAST(n_nationkey AS INT) AS k").distinct()
    write_files(keys.mapInArrow(draw, "name string, content binary"), path)
    return path


def drawn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as Spark's image column, a few for each task."""
    return images(spark, drawn_files(spark, sf_dir)).repartition(8)
