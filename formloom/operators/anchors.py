"""Detections of a page as an array, and searches around anchors in it.

A page's detections meet once, by doc_id; from then on each field is an expression over the
array, and no search needs a join or a shuffle of its own. A page holds hundreds of them at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.geometry import pixels
from formloom.functions.text import has, let

DETECTION = "struct<i:int,text:string,confidence:double,cx:int,cy:int,x0:int,y0:int,x1:int,y1:int>"


def detection() -> Column:
    own = ["text", "confidence", "cx", "cy", "x0", "y0", "x1", "y1"]
    return F.struct(F.col("det_idx").cast("int").alias("i"), *(F.col(c) for c in own)).cast(DETECTION)


def pages(detections: DataFrame) -> DataFrame:
    """One row for each document: width, height, and arrays header, defects and analysis, in the order of det_idx."""
    of = lambda region: F.array_sort(F.collect_list(F.when(F.col("region_id") == region, detection()))).alias(region)
    return detections.groupBy("doc_id").agg(
        F.max("width").alias("width"), F.max("height").alias("height"), of("header"), of("defects"), of("analysis")
    )


def first(array: Column) -> Column:
    return F.get(array, F.lit(0))


def anchor(array: Column, keyword: str) -> Column:
    """The first detection with the keyword."""
    return first(F.filter(array, lambda d: has(d.text, keyword)))


def anchors(array: Column, keywords: list[str]) -> Column:
    def any_(d: Column) -> Column:
        out = F.lit(False)
        for k in keywords:
            out = out | has(d.text, k)
        return out

    return F.filter(array, any_)


def same(a: Column, b: Column) -> Column:
    """Equal in all but their place: a copy of the anchor is the anchor."""
    out = F.lit(True)
    for c in ("text", "confidence", "cx", "cy", "x0", "y0", "x1", "y1"):
        out = out & a[c].eqNullSafe(b[c])
    return out


def by_distance(array: Column, distance: Callable[[Column], Column]) -> Column:
    """Nearest first; ties in the order of the detections."""
    keyed = F.transform(array, lambda d: F.struct(distance(d).alias("distance"), d.i.alias("i"), d.alias("d")))
    return F.transform(F.array_sort(keyed), lambda x: x.d)


def below(array: Column, at: Column, height: Column, dy: Column, dx: Column) -> Column:
    """What stands below an anchor, nearest first. A small overlap (0.3 % of the height) is allowed."""
    def found(a: Column) -> Column:
        gap = lambda d: d.y0 - a.y1
        inside = lambda d: gap(d).between(-pixels(0.3, height), dy) & (F.abs(d.cx - a.cx) <= dx) & ~same(d, a)
        return F.when(a.isNotNull(), by_distance(F.filter(array, inside), lambda d: F.abs(gap(d)))).otherwise(F.array().cast(f"array<{DETECTION}>"))

    return let(at, found)


def right_of(array: Column, at: Column, dx: Column, dy: Column) -> Column:
    """What stands to the right of an anchor on its line, nearest first."""
    gap = lambda d: d.x0 - at.x1
    inside = lambda d: (gap(d) > 0) & (gap(d) <= dx) & (F.abs(d.cy - at.cy) <= dy) & ~same(d, at)
    return by_distance(F.filter(array, inside), gap)


def right_of_any(array: Column, keyword: str, dx: Column, dy: Column) -> Column:
    """The same around every detection with the keyword, nearest of all first."""
    pairs = F.flatten(
        F.transform(
            anchors(array, [keyword]),
            lambda at: F.transform(right_of(array, at, dx, dy), lambda d: F.struct((d.x0 - at.x1).alias("distance"), at.i.alias("at"), d.i.alias("i"), d.alias("d"))),
        )
    )
    return F.transform(F.array_sort(pairs), lambda x: x.d)


def near(array: Column, at: Column, from_x: int, to_x: int, dy: int) -> Column:
    """What stands to the right by from_x to to_x and within dy, both exclusive, in the order of the detections."""
    return F.filter(array, lambda d: (F.abs(d.cy - at.cy) < dy) & (d.cx > at.cx + from_x) & (d.cx < at.cx + to_x))


def below_or_right(array: Column, at: Column, width: Column, height: Column) -> Column:
    """Where a name belongs to a label: 0.6 to 4.3 % lower, and within 8 % of its middle or 2 to 16 % right of its end."""
    def inside(d: Column) -> Column:
        lower = (d.cy > at.cy + pixels(0.6, height)) & (d.cy < at.cy + pixels(4.3, height))
        beside = (d.cx > at.x1 + pixels(2.0, width)) & (d.cx < at.x1 + pixels(16.0, width))
        return lower & ((F.abs(d.cx - at.cx) < pixels(8.0, width)) | beside)

    return F.filter(array, inside)


def field(value: Column, confidence: Column, source: str, corrected: Column | None = None) -> Column:
    """A field value, null where the value is."""
    made = F.struct(
        value.alias("value"), confidence.alias("confidence"), F.lit(source).alias("source"), (F.lit(False) if corrected is None else corrected).alias("corrected")
    )
    return F.when(value.isNotNull(), made)


FIELD = "struct<value:string,confidence:double,source:string,corrected:boolean>"
