"""Cells of a grid as rows: their boxes, those that are empty, and what emptiness saves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxes(xs: Column, ys: Column, margin: int = 2, least_width: int = 20, least_height: int = 15) -> Column:
    """[(row_idx, col_idx, x0, y0, x1, y1)] between bounds, inside a margin; cells that are too small are left out."""
    def row(y: Column, i: Column) -> Column:
        return F.transform(
            F.slice(xs, 1, F.size(xs) - 1),
            lambda x, j: F.struct(
                i.alias("row_idx"), j.alias("col_idx"), (x + margin).alias("x0"), (y + margin).alias("y0"), (F.get(xs, j + 1) - margin).alias("x1"), (F.get(ys, i + 1) - margin).alias("y1")
            ),
        )

    made = F.flatten(F.transform(F.slice(ys, 1, F.size(ys) - 1), row))
    return F.filter(made, lambda c: (c.x1 - c.x0 >= least_width) & (c.y1 - c.y0 >= least_height))


def usable_grid(rows: Column, cols: Column, confidence: Column) -> Column:
    """True for a grid of two by two cells or more that is sure enough to be read cell by cell."""
    return (rows >= 2) & (cols >= 2) & (confidence >= 0.3)


def with_empty(recognised: DataFrame, empty: DataFrame) -> DataFrame:
    """Recognised cells and the empty ones, whose text is '' at a confidence of 1.0."""
    blank = empty.withColumn("text", F.lit("")).withColumn("confidence", F.lit(1.0))
    return recognised.unionByName(blank.select(*recognised.columns))


def empty_share(cells: DataFrame, seconds_per_cell: float = 0.1) -> DataFrame:
    """By document: cells, empty ones, their share, and the recognition time that they saved."""
    empty = (F.col("text") == "") & (F.col("confidence") == 1.0)
    return cells.groupBy("doc_id").agg(
        F.count("*").alias("cells"), F.count_if(empty).alias("empty"), (F.count_if(empty) / F.count("*")).alias("share"), (F.count_if(empty) * seconds_per_cell).alias("seconds_saved")
    )


def recognition_counts(cells: DataFrame) -> DataFrame:
    """One row over all documents: cells, those that a recogniser was asked for, those it gave nothing for."""
    empty, failed = (F.col("text") == "") & (F.col("confidence") == 1.0), (F.col("text") == "") & (F.col("confidence") < 1.0)
    return cells.agg(F.count("*").alias("cells"), F.count_if(~empty).alias("asked"), F.count_if(failed).alias("without_text"), F.count_distinct("doc_id").alias("documents"))
