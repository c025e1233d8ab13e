"""Documents in the nested form in which recognised, corrected and validated ones are kept.

``documents`` gathers detections that are rows. The other functions work within a document's own row, on its
arrays and maps, so that no detection is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import rules as R
from formloom.functions import text as T
from formloom.functions.geometry import round3
from formloom.operators import lookup
from formloom.sources.documents import DETECTION, GRID


def _stored() -> Column:
    """A detection as stored: box as four points, confidence to three decimals."""
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    box = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    return F.struct(
        F.col("det_idx").alias("index"), "text", round3(F.col("confidence")).alias("confidence"), box.alias("bbox"), F.array("cx", "cy").alias("center"),
        F.char_length("text").alias("char_count"), "region_id", "corrected", "original_text",
    )


def documents(checked: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Detections after correction and validation -> one nested row for each document.

    (doc_id, document_info, processing_metrics, text_regions, ocr_results_by_region, corrections_applied,
    validation_results). Without corrections the log is empty; blank texts count in the totals only.
    """
    filled = F.col("field_type").isNotNull()
    wrong = filled & F.col("violation").isNotNull()
    log = F.struct(F.col("det_idx").alias("index"), F.lit("text").alias("field"), F.col("original_text").alias("original"), F.col("text").alias("corrected"), "confidence", F.array("cx", "cy").alias("position"))
    note = lambda message: F.struct(F.col("det_idx").alias("index"), F.col("text").alias("value"), F.col("field_type").alias("type"), F.col(message).alias("message"), "confidence")
    listed = lambda when, what: F.array_sort(F.collect_list(F.when(when, what)))
    by = checked.groupBy("doc_id").agg(
        F.max("width").alias("image_width"), F.max("height").alias("image_height"), F.count("*").alias("n"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean"),
        F.count_if(F.col("confidence") < threshold * 1.2).alias("low"), F.array_sort(F.collect_list(_stored())).alias("text_regions"),
        listed(F.col("corrected"), log).alias("log"), F.count_if(filled & ~wrong).alias("fine"), listed(wrong, note("violation")).alias("errors"),
        listed(F.col("confidence_message").isNotNull(), note("confidence_message")).alias("warnings"),
    )
    regions = F.array_sort(F.array_distinct(F.transform(F.filter("text_regions", lambda d: d.region_id.isNotNull()), lambda d: d.region_id)))
    of_region = F.map_from_entries(F.transform(regions, lambda r: F.struct(r, F.filter("text_regions", lambda d: d.region_id == r))))
    return by.select(
        "doc_id", F.struct("image_width", "image_height").alias("document_info"),
        F.struct(F.col("n").alias("texts_detected"), F.col("mean").alias("average_confidence"), F.lit(threshold).alias("low_confidence_threshold"), F.col("low").alias("low_confidence_count")).alias("processing_metrics"),
        "text_regions", of_region.alias("ocr_results_by_region"), F.struct(F.size("log").alias("count"), F.col("log").alias("corrections")).alias("corrections_applied"),
        F.struct(
            F.col("n").alias("total_fields"), F.col("fine").alias("validated_fields"), F.size("errors").alias("failed_validations"),
            (F.col("fine") / F.col("n")).alias("validation_rate"), "errors", F.col("warnings").alias("low_confidence_warnings"),
        ).alias("validation_results"),
    )


def _detection(d: Column) -> Column:
    """A detection of a page as read (boxes in its zone) in the stored form: on the page, and in the zone beside it."""
    corners = lambda dy: F.array(
        F.array(d.x0, d.y0 + dy), F.array(d.x1, d.y0 + dy), F.array(d.x1, d.y1 + dy), F.array(d.x0, d.y1 + dy)
    )
    middle = lambda dy: F.array(((d.x0 + d.x1 + d.x1 + d.x0) / 4).cast("int"), ((d.y0 + d.y0 + d.y1 + d.y1 + 4 * dy) / 4).cast("int"))
    local = lambda c: F.when(d.region_id.isNotNull(), c)
    zero = F.lit(0)
    return F.struct(
        d.text.alias("text"), round3(d.confidence).alias("confidence"), corners(d.top).alias("bbox"), middle(d.top).alias("center"), F.char_length(d.text).alias("char_count"),
        d.region_id.alias("region_id"), local(corners(zero)).alias("bbox_region"), local(middle(zero)).alias("center_region"), F.lit(None).cast("boolean").alias("corrected"),
        F.lit(None).cast("string").alias("original_text"),
    ).cast(DETECTION)


def of_pages(pages: DataFrame, threshold: float = 0.5, language: str = "ru", engine: str = "formloom") -> DataFrame:
    """Pages as vision.pages.read_pages gives them -> recognised documents, with file_name, status and error; failed pages have nothing else."""
    name = F.element_at(F.split("origin", "/"), -1)
    mean = F.when(F.size("detections") > 0, F.aggregate("detections", F.lit(0.0), lambda a, d: a + d.confidence) / F.size("detections")).otherwise(0.0)
    low = F.size(F.filter("detections", lambda d: d.confidence < threshold * 1.2))
    flat = F.transform("detections", _detection)
    zone = lambda z: F.struct(
        z.region_id.alias("region_id"), (z.y_start / F.col("height")).alias("y_start_norm"), (z.y_end / F.col("height")).alias("y_end_norm"), z.y_start.alias("y_start"), z.y_end.alias("y_end"),
        z.method.alias("detection_method"), round3(z.confidence).alias("confidence"),
    )
    of_zone = F.map_from_entries(F.transform("zones", lambda z: F.struct(z.region_id, F.filter(flat, lambda d: d.region_id == z.region_id))))
    grid = lambda g: F.struct(g.rows.alias("rows"), g.cols.alias("cols"), (F.size(g.rows)).alias("num_rows"), (F.size(g.cols)).alias("num_cols"), g.confidence.alias("confidence")).cast(GRID)
    cell = lambda c: F.struct(
        c.row_idx.alias("row_idx"), c.col_idx.alias("col_idx"), c.x_start.alias("x_start"), c.y_start.alias("y_start"), c.x_end.alias("x_end"), c.y_end.alias("y_end"), c.text.alias("text"),
        c.confidence.alias("confidence"), F.lit(None).cast("string").alias("field_name"),
    )
    tables = F.map_from_entries(F.transform("grids", lambda g: F.struct(g.region_id, F.struct(F.lit("table").alias("type"), F.transform(g.cells, cell).alias("cells"), grid(g).alias("grid")))))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    good = lambda c: F.when(F.col("status") == "ok", c)
    return pages.select(
        name.alias("file_name"), "status", "error", "seconds",
        good(F.struct(name.alias("source_file"), now.alias("processing_date"), F.lit(engine).alias("ocr_engine"), F.lit(language).alias("language"), F.col("width").alias("image_width"), F.col("height").alias("image_height"))).alias("document_info"),
        good(F.struct((F.col("seconds") * 1000).cast("int").alias("total_time_ms"), F.size("detections").alias("texts_detected"), mean.alias("average_confidence"), F.lit(threshold).alias("low_confidence_threshold"), low.alias("low_confidence_count"))).alias("processing_metrics"),
        good(flat).alias("text_regions"), good(F.transform("zones", zone)).alias("regions_detected"), good(of_zone).alias("ocr_results_by_region"), good(tables).alias("table_data_by_region"),
    )


def _fixed(d: Column) -> Column:
    return T.let(lookup.replacement(d.text), lambda found: d.withField("corrected", found.isNotNull()).withField("original_text", F.when(found.isNotNull(), d.text)).withField("text", F.coalesce(found, d.text)))


def corrected(docs: DataFrame) -> DataFrame:
    """docs with text_regions and ocr_results_by_region -> the same with corrections in both, and corrections_applied: how many texts changed in text_regions, and a log of them."""
    def entry(d: Column, i: Column) -> Column:
        made = F.struct(i.alias("index"), F.lit("text").alias("field"), d.original_text.alias("original"), d.text.alias("corrected"), d.confidence.alias("confidence"), d.center.alias("position"))
        return F.when(d.corrected, made)

    out = docs.withColumn("text_regions", F.transform("text_regions", _fixed)).withColumn("ocr_results_by_region", F.transform_values("ocr_results_by_region", lambda _, ds: F.transform(ds, _fixed)))
    log = F.filter(F.transform("text_regions", entry), lambda x: x.isNotNull())
    return out.withColumn("corrections_applied", F.struct(F.coalesce(F.size(log), F.lit(0)).alias("count"), log.alias("corrections")))


def validated(docs: DataFrame) -> DataFrame:
    """docs with text_regions -> the same with validation_results: totals (blank texts count in the first only), errors and warnings."""
    def checked(d: Column, i: Column) -> Column:
        # inside a lambda nothing is computed but where it stands, so each value is bound once; blank texts give null
        note = lambda kind, message: F.struct(i.alias("index"), d.text.alias("value"), kind.alias("type"), message.alias("message"), d.confidence.alias("confidence"))
        wrong = lambda kind: T.let(R.violation(d.text, kind), lambda m: F.when(m.isNotNull(), note(kind, m)))
        low = lambda kind: T.let(R.confidence_check(d.confidence).message, lambda m: F.when(m != "", note(kind, m)))
        return R.of_filled(d.text, lambda kind: F.struct(wrong(kind).alias("error"), low(kind).alias("warning")))

    some = lambda field: F.filter(F.transform("_formloom_checked", lambda x: x[field]), lambda x: x.isNotNull())
    rows = docs.withColumn("_formloom_checked", F.transform(F.coalesce("text_regions", F.array().cast(dict(docs.dtypes)["text_regions"])), checked)).withColumn("_formloom_errors", some("error"))
    n, errors = F.size("_formloom_checked"), F.col("_formloom_errors")
    fine = F.size(F.filter("_formloom_checked", lambda x: x.isNotNull())) - F.size(errors)
    result = F.struct(
        n.alias("total_fields"), fine.alias("validated_fields"), F.size(errors).alias("failed_validations"), F.when(n > 0, fine / n).otherwise(0.0).alias("validation_rate"), errors.alias("errors"),
        some("warning").alias("low_confidence_warnings"),
    )
    return rows.withColumn("validation_results", result).drop("_formloom_checked", "_formloom_errors")
