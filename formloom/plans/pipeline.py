"""Detections to documents: correct, validate, extract, summarise, as one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.operators import anchors as A
from formloom.operators import header as H
from formloom.operators import lookup, quality, sections

HEADER = [
    "act_number", "act_date", "template_revision", "quantity_checked", "quantity_passed", "quantity_defective", "quantity_ordered", "control_type",
    "inspector_name", "part_line_number", "part_designation", "part_name", "sticker",
]


_ROW = "struct<row_number:string,parameter:string,defect:string,fact_value:string,deviation:string,quantity:string,confidence:double,source_texts:array<string>>"


def extract(detections: DataFrame, cells: DataFrame | None = None, prefer_table: bool = True) -> DataFrame:
    """One row for each document: header, defects, analysis, validation and metrics, nested.

    cells(doc_id, row_idx, col_idx, text, confidence) of recognised grids take the place of the
    blocks found by position, for documents that have some, unless prefer_table is false.
    """
    pages = H.extract_header(A.pages(detections))
    # all sections are expressions over a page's arrays: one shuffle gathers the page, and nothing is joined but cells
    blocks = F.transform(
        sections.blocks_of(F.col("defects"), F.col("width"), F.col("height")),
        lambda b: F.struct(b.block.alias("block"), b["kind"].alias("kind"), b.title.alias("title"), b.headers.alias("headers"), b.rows.cast(f"array<{_ROW}>").alias("rows")),
    )
    wide = pages.select(
        "doc_id", F.struct(*HEADER).alias("header"), blocks.alias("found"), sections.lines_of(F.col("analysis"), F.col("height")).alias("deviations"),
        sections.decision_of(F.col("analysis")).alias("final_decision"), quality.report_of().alias("validation"), quality.fields_extracted().alias("header_fields"),
    )
    if cells is not None and prefer_table:
        own = sections.defect_rows_of_cells(cells)
        row = F.struct("row_idx", F.struct("row_number", "parameter", F.lit(None).cast("string").alias("defect"), "fact_value", "deviation", "quantity", "confidence", F.array().cast("array<string>").alias("source_texts")).cast(_ROW).alias("r"))
        block = lambda rows: F.struct(F.lit(0).alias("block"), F.lit("other").alias("kind"), F.lit("").alias("title"), F.array().cast("array<string>").alias("headers"), rows.alias("rows"))
        tables = own.groupBy("doc_id").agg(F.array(block(F.array_sort(F.collect_list(row))["r"])).alias("of_table"))
        wide = wide.join(tables, "doc_id", "left").withColumn("found", F.coalesce(F.col("of_table").cast(dict(wide.dtypes)["found"]), F.col("found")))
    defects = F.col("found")
    metrics = F.struct(
        "header_fields", F.size(defects).alias("defect_blocks"), F.aggregate(defects, F.lit(0), lambda a, b: a + F.size(b.rows)).alias("defect_rows"), F.size("deviations").alias("analysis_rows"),
        F.col("validation.missing_count").alias("mandatory_missing"),
    )
    return wide.select("doc_id", "header", defects.alias("defects"), F.struct("deviations", "final_decision").alias("analysis"), "validation", metrics.alias("metrics"))


def corrected_and_validated(detections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detections with corrections and types, summary by document): what re-correcting a recognised document gives."""
    checked = quality.validated(lookup.correct(detections))
    rate = lookup.correction_rate(checked)
    return checked, quality.validation_summary(checked).join(rate, "doc_id")


def run(detections: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Correction, then extraction, with the validation summary beside it."""
    checked, summary = corrected_and_validated(detections)
    return extract(checked, cells).join(summary, "doc_id")
