"""Recognised documents as JSON files: one document in each file, bad files as error rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DETECTION = """struct<text:string,confidence:double,bbox:array<array<int>>,center:array<int>,char_count:int,region_id:string,
bbox_region:array<array<int>>,center_region:array<int>,corrected:boolean,original_text:string>""".replace("\n", "")
CELL = "struct<row_idx:int,col_idx:int,x_start:int,y_start:int,x_end:int,y_end:int,text:string,confidence:double,field_name:string>"
GRID = "struct<rows:array<int>,cols:array<int>,num_rows:int,num_cols:int,confidence:double>"
REGION = "struct<region_id:string,y_start_norm:double,y_end_norm:double,y_start:int,y_end:int,detection_method:string,confidence:double>"
DOCUMENT = f"""document_info struct<source_file:string,processing_date:string,ocr_engine:string,language:string,image_width:int,image_height:int>,
text_regions array<{DETECTION}>, regions_detected array<{REGION}>, ocr_results_by_region map<string,array<{DETECTION}>>,
table_data_by_region map<string,struct<type:string,cells:array<{CELL}>,grid:{GRID}>>, _corrupt_record string""".replace("\n", " ")


def documents(spark: SparkSession, path: str, regions_required: bool = False) -> DataFrame:
    """One row for each file: file_name, status, error and the document's columns.

    status is ``failed`` for files that are no JSON, and with regions_required for those without
    results by region; the other files are not affected.
    """
    read = spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    broken = F.when(F.col("_corrupt_record").isNotNull(), "Invalid JSON")
    if regions_required:
        broken = F.coalesce(broken, F.when(F.col("ocr_results_by_region").isNull(), "No ocr_results_by_region found in document"))
    out = read.withColumn("file_name", F.col("_metadata.file_name")).withColumn("error", broken)
    return out.withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed")).drop("_corrupt_record")


def _flat(d, page) -> list:
    xs, ys = F.transform(d.bbox, lambda p: p[0]), F.transform(d.bbox, lambda p: p[1])
    return [
        d.text.alias("text"), F.coalesce(d.confidence, F.lit(0.0)).alias("confidence"), F.get(d.center, F.lit(0)).alias("cx"), F.get(d.center, F.lit(1)).alias("cy"),
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    ]


def detections(docs: DataFrame, by_region: bool = True) -> DataFrame:
    """The detections of documents that could be read; doc_id is the file's name, det_idx the place in the document."""
    from formloom.functions.geometry import page_height, page_width

    size = [page_width(F.col("document_info.image_width")).alias("width"), page_height(F.col("document_info.image_height")).alias("height")]
    good = docs.where("status = 'ok'").select(F.col("file_name").alias("doc_id"), *size, "text_regions", "ocr_results_by_region")
    if by_region:
        # regions in the order of their names, so that the number of a detection is one for the whole document
        regions = F.array_sort(F.map_entries("ocr_results_by_region"), lambda a, b: F.when(a.key < b.key, -1).when(a.key > b.key, 1).otherwise(0))
        named = F.flatten(F.transform(regions, lambda r: F.transform(r.value, lambda d: F.struct(r.key.alias("region_id"), d.alias("d")))))
        one = good.select("doc_id", "width", "height", F.posexplode(named).alias("det_idx", "x")).select("doc_id", "width", "height", "det_idx", "x.region_id", "x.d")
    else:
        one = good.select("doc_id", "width", "height", F.posexplode("text_regions").alias("det_idx", "d")).withColumn("region_id", F.col("d.region_id"))
    return one.select("doc_id", "det_idx", *_flat(F.col("d"), None), "region_id", "width", "height")


def cells(docs: DataFrame, region: str = "defects") -> DataFrame:
    """Cells of recognised grids: (doc_id, row_idx, col_idx, text, confidence)."""
    found = docs.where("status = 'ok'").select(F.col("file_name").alias("doc_id"), F.explode(F.try_element_at("table_data_by_region", F.lit(region)).cells).alias("c"))
    return found.select("doc_id", "c.row_idx", "c.col_idx", "c.text", "c.confidence")


FIELD = "struct<value:string,confidence:double,source:string,corrected:boolean>"


def header_files(spark: SparkSession, path: str, names: list[str], drop: str = "-data") -> DataFrame:
    """Extracted documents read back: (doc_id, a field for each of names); a file that is no document, or has no header, gives nulls."""
    schema = f"header struct<{','.join(f'{n}:{FIELD}' for n in names)}>, _corrupt_record string"
    read = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), f"{drop}[.]json$", "")
    return read.select(stem.alias("doc_id"), *(F.col(f"header.{n}").alias(n) for n in names))
