"""Grouping by position: blocks, rows, merged lines, runs, moving sums.

The folds look at what they have merged so far, so they are folds over sorted arrays and not
windows: of y = 0, 8, 16, 24 within 10, rows are {0, 8} and {16, 24}.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formloom.functions.geometry import pixels
from formloom.functions.text import let


def block_ids(detections: DataFrame, gap_percent: float = 12.0) -> DataFrame:
    """Adds block: a new one begins where the step in x from the detection before exceeds the gap."""
    order = Window.partitionBy("doc_id").orderBy("cx", "det_idx")
    step = F.col("cx") - F.lag("cx").over(order)
    starts = F.when(step > pixels(gap_percent, F.col("width")), 1).otherwise(0)
    return detections.withColumn("_formloom_start", starts).withColumn("block", F.sum("_formloom_start").over(order).cast("int")).drop("_formloom_start")


def blocks(array: Column, gap: Column) -> Column:
    """The same on an array of detections: an array of blocks, each in the order of x."""
    def split(ordered: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: (k == 0) | (ordered[k].cx - F.get(ordered, k - 1).cx > gap))
        return _parts(ordered, F.when(F.size(ordered) > 0, starts).otherwise(F.array().cast("array<int>")))

    keyed = F.transform(array, lambda d: F.struct(d.cx.alias("cx"), d.i.alias("i"), d.alias("d")))
    return let(F.transform(F.array_sort(keyed), lambda x: x.d), split)


def _parts(ordered: Column, starts: Column) -> Column:
    """ordered, cut before each of the places in starts."""
    until = lambda s, n: F.coalesce(F.get(s, n + 1), F.size(ordered))
    return let(starts, lambda s: F.transform(s, lambda at, n: F.slice(ordered, at + 1, until(s, n) - at)))


def rows(array: Column, tolerance: Column) -> Column:
    """Rows of detections: sorted by y, then x; a row takes what lies within the tolerance of its first member."""
    begin = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("int").alias("y"), F.lit(0).cast("int").alias("k"))

    def step(acc: Column, d: Column) -> Column:
        new = (acc.k == 0) | (F.abs(d.cy - acc.y) > tolerance)
        return F.struct(
            F.when(new, F.concat(acc.starts, F.array(acc.k))).otherwise(acc.starts).alias("starts"), F.when(new, d.cy).otherwise(acc.y).alias("y"), (acc.k + 1).alias("k")
        )

    keyed = F.transform(array, lambda d: F.struct(d.cy.alias("cy"), d.cx.alias("cx"), d.i.alias("i"), d.alias("d")))
    return let(F.transform(F.array_sort(keyed), lambda x: x.d), lambda ordered: _parts(ordered, F.aggregate(ordered, begin, step, lambda acc: acc.starts)))


def merge_positions(positions: Column, tolerance: Column) -> Column:
    """Sorted positions, each merged into the one before within the tolerance as their whole mean."""
    def step(acc: Column, p: Column) -> Column:
        last = F.element_at(acc, -1)
        close = (F.size(acc) > 0) & (p - F.try_element_at(acc, F.lit(-1)) <= tolerance)
        merged = F.floor((F.try_element_at(acc, F.lit(-1)) + p) / 2).cast("int")
        return F.when(close, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(acc, F.array(p.cast("int"))))

    return F.aggregate(F.array_sort(positions), F.array().cast("array<int>"), step)


def runs(indexed: DataFrame, key: str, index: str) -> DataFrame:
    """(key, run_start, run_end): runs of whole numbers without a gap."""
    order = Window.partitionBy(key).orderBy(index)
    island = F.col(index) - F.row_number().over(order)
    return indexed.select(key, index).distinct().withColumn("_formloom_island", island).groupBy(key, "_formloom_island").agg(
        F.min(index).alias("run_start"), F.max(index).alias("run_end")
    ).drop("_formloom_island")


def longest(found: DataFrame, key: str, most: int = 2) -> DataFrame:
    """(key, place, middle) of the longest runs of each key, the first of those as long, in the order of their middles."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("run_start") - F.col("run_end"), "run_start"))
    top = found.withColumn("_formloom_rank", rank).where(F.col("_formloom_rank") <= most).withColumn("middle", (F.col("run_start") + F.col("run_end")) / 2)
    return top.select(key, F.row_number().over(Window.partitionBy(key).orderBy("middle")).alias("place"), "middle")


def quiet(values: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """The rows whose value is at most the share's percentile (between two ranks interpolated) of their keys."""
    limit = values.groupBy(*keys).agg(F.percentile(value, share).alias("_formloom_limit"))
    return values.join(limit, keys).where(F.col(value) <= F.col("_formloom_limit")).drop("_formloom_limit")


def moving_average(values: DataFrame, key: str, index: str, value: str, window: int) -> DataFrame:
    """Adds smooth: a box of ``window`` over the values, with zeros beyond the ends, always divided by ``window``."""
    before, after = window // 2, window - 1 - window // 2
    frame = Window.partitionBy(key).orderBy(index).rowsBetween(-before, after)
    return values.withColumn("smooth", F.sum(value).over(frame) / F.lit(window))


def cell_bounds(lines: Column, size: Column) -> Column:
    """0, the middles of neighbouring lines, and the size: as many cells as lines; the outer lines bound nothing."""
    middles = F.transform(F.sequence(F.lit(1), F.size(lines) - 1), lambda k: F.floor((lines[k - 1] + lines[k]) / 2).cast("int"))
    inner = F.when(F.size(lines) > 1, middles).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array(F.lit(0)), inner, F.array(size.cast("int")))


def regularity(lines: Column) -> Column:
    """1 / (1 + deviation / mean) of the steps between lines; 0 of fewer than two lines."""
    steps = F.transform(F.sequence(F.lit(1), F.size(lines) - 1), lambda k: (lines[k] - lines[k - 1]).cast("double"))
    n = F.size(lines) - 1
    mean = F.aggregate(steps, F.lit(0.0), lambda a, s: a + s) / n
    spread = F.sqrt(F.aggregate(steps, F.lit(0.0), lambda a, s: a + (s - mean) * (s - mean)) / n)
    return F.when(F.size(lines) < 2, 0.0).when(mean == 0, 0.0).otherwise(1.0 / (1.0 + spread / mean))


def grid_confidence(rows_: Column, columns: Column) -> Column:
    """0 to 1, of the number of lines each way and how regular they are."""
    count = lambda lines: F.least(F.size(lines) / 10.0, F.lit(1.0))
    sum_ = (count(rows_) + count(columns)) * 0.3 + (regularity(rows_) + regularity(columns)) * 0.2
    return F.least(F.greatest(sum_, F.lit(0.0)), F.lit(1.0))


def grid_valid(rows_: Column, columns: Column, width: Column, height: Column, least_step: int = 10) -> Column:
    """Two lines or more each way, within the page, and not closer than least_step."""
    def fine(lines: Column, size: Column) -> Column:
        steps = F.forall(F.sequence(F.lit(1), F.size(lines) - 1), lambda k: lines[k] - lines[k - 1] >= least_step)
        return (F.size(lines) >= 2) & F.forall(lines, lambda v: v.between(0, size)) & F.when(F.size(lines) >= 2, steps).otherwise(F.lit(False))

    return fine(rows_, height) & fine(columns, width)
