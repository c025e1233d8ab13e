"""Zones of a page from lines that lie across it, as expressions over arrays of line positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Names of the zones from the top; more of them are numbered.
NAMES = ("header", "defects", "analysis")


def header_lines(lines: Column, height: Column, low: float = 0.20, high: float = 0.25) -> Column:
    """The lines that may end a header."""
    return F.filter(lines, lambda y: (y / height).between(low, high))


def defects_lines(lines: Column, head: Column, height: Column, low: float = 0.25, high: float = 0.60) -> Column:
    """The lines below the header's that may end the defects."""
    return F.filter(lines, lambda y: (y > head) & ((y - head) / height).between(low, high))


def nearest(lines: Column, spot: Column) -> Column:
    """The line nearest a spot, the first of those as near; null where there is none."""
    ranked = F.array_sort(F.transform(lines, lambda y, i: F.struct(F.abs(y - spot).alias("off"), i.alias("i"), y.alias("y"))))
    return F.get(ranked, F.lit(0)).y


def boundaries(lines: Column, height: Column) -> Column:
    """(header line, defects line) of a page: of those that may be it the nearest to the middle of their range; null parts where there is none."""
    head = nearest(header_lines(lines, height), height * ((0.20 + 0.25) / 2))
    low = head + (height * 0.25).cast("int")
    high = F.least(head + (height * 0.60).cast("int"), height - 1)
    return F.struct(head.alias("head"), nearest(defects_lines(lines, head, height), (low + high) / 2.0).alias("cut"))


def bands(cuts: Column, height: Column) -> Column:
    """[(name, y_start, y_end)] between cuts, which are kept within the page; empty bands are left out."""
    edges = F.concat(F.array(F.lit(0)), F.transform(cuts, lambda y: F.least(F.greatest(y, F.lit(0)), height).cast("int")), F.array(height.cast("int")))
    name = lambda i: F.coalesce(F.get(F.array(*map(F.lit, NAMES)), i), F.concat(F.lit("region_"), (i + 1).cast("string")))
    made = F.transform(F.slice(edges, 1, F.size(edges) - 1), lambda y, i: F.struct(name(i).alias("name"), y.alias("y_start"), F.get(edges, i + 1).alias("y_end")))
    return F.filter(made, lambda b: b.y_end > b.y_start)


def covers(found: Column, height: Column, confidence: Column, least: float = 0.7) -> Column:
    """True for bands that begin at 0, end at the page's end, cover 95 % of it and are sure enough."""
    whole = F.aggregate(found, F.lit(0), lambda a, b: a + b.y_end - b.y_start)
    return F.coalesce(
        (F.size(found) > 0) & (F.get(found, F.lit(0)).y_start == 0) & (F.element_at(found, -1).y_end == height) & (whole >= 0.95 * height) & (confidence >= least), F.lit(False)
    )


def agrees(found: Column, height: Column, template: list[tuple[str, float, float]], tolerance: float = 0.10) -> Column:
    """True where each band lies within the tolerance of its namesake in a template; bands that it lacks count for nothing."""
    wanted = {n: (a, b) for n, a, b in template}

    def near(b: Column) -> Column:
        out = F.lit(True)
        for n, (low, high) in wanted.items():
            out = F.when(b["name"] == n, (F.abs(b.y_start / height - low) <= tolerance) & (F.abs(b.y_end / height - high) <= tolerance)).otherwise(out)
        return out

    return F.forall(found, near)


def with_cells(zones: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Zones (doc_id, region_id, ...) that have cells of a grid, and those that have none."""
    keys = ["doc_id", "region_id"]
    had = cells.select(*keys).distinct()
    return zones.join(had, keys, "left_semi"), zones.join(had, keys, "left_anti")
