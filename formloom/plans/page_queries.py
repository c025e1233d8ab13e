"""Queries over drawn pages: what a page's pixels become, beside the rules by which they were drawn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import cells as C
from formloom.plans import assemble
from formloom.plans.queries import query
from formloom.sources.drawn import drawn_files, drawn_pages
from formloom.sources.images import image_files
from formloom.sources.settings import Settings
from formloom.vision import pages as P
from formloom.vision.recognisers import Named

_S = Settings(template_name="otk_v2", table_cell_preprocess=False, enable_adaptive_scaling=False, enable_perspective_correction=False)
_DOTS = Named("dots")


def _key() -> Column:
    return F.regexp_extract("origin", r"page-(\d+)[.]png$", 1).cast("int").alias("k")


_PAGES = """WITH p AS (SELECT DISTINCT CAST(n_nationkey AS INT) AS k FROM nation),
page AS (SELECT k, 1200 + 10 * (k % 5) AS height, 260 + k % 7 AS head, 480 + k % 11 AS n, 2 + k % 3 AS inner_lines FROM p),
zone AS (SELECT k, 'header' AS region_id, 0 AS y_start, head AS y_end FROM page UNION ALL SELECT k, 'defects', head, head + n FROM page UNION ALL SELECT k, 'analysis', head + n, height FROM page),
lines AS (SELECT *, list_concat([1], list_transform(range(1, inner_lines + 1), lambda j: CAST(80 * j AS INT)), [n - 1]) AS rows, [100, 300, 500, 700] AS cols FROM page),
bounds AS (SELECT *, list_concat([0], list_transform(range(1, len(rows)), lambda j: (rows[j] + rows[j + 1]) // 2), [n]) AS ys, [0, 200, 400, 600, 800] AS xs FROM lines),
cell AS (SELECT k, head, n, CAST(i AS INT) AS i, CAST(j AS INT) AS j, xs[j + 1] + 2 AS x0, ys[i + 1] + 2 AS y0, xs[j + 2] - 2 AS x1, ys[i + 2] - 2 AS y1, (3 * i + j + k) % 4 AS code
  FROM bounds, unnest(range(0, len(rows))) AS a(i), unnest(range(0, 4)) AS b(j))"""


@query(f"{_PAGES} SELECT k, CAST(height AS INT) AS height, 800 AS width, 0 AS darkest, 255 AS brightest FROM page")
def page_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as PNG, read by Spark's image source."""
    return P.properties(drawn_pages(spark, sf_dir)).select(_key(), "height", "width", "darkest", "brightest")


@query("SELECT DISTINCT 'page-' || n_nationkey || '.png' AS name, true AS filled FROM nation")
def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_files(spark, drawn_files(spark, sf_dir)).select("name", (F.col("length") > 0).alias("filled"))


@query(f"{_PAGES} SELECT k, region_id, CAST(y_start AS INT) AS y_start, CAST(y_end AS INT) AS y_end, 'adaptive' AS method, 0.85::DOUBLE AS confidence FROM zone")
def page_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.zoned(drawn_pages(spark, sf_dir), _S).select(_key(), "region_id", "y_start", "y_end", "method", "confidence")


@query(f"{_PAGES} SELECT k, region_id, CAST(round_even(height * lo, 0) AS INT) AS y_start, CAST(round_even(height * hi, 0) AS INT) AS y_end, 'template' AS method "
       "FROM page, (VALUES ('header', 0.0::DOUBLE, 0.28::DOUBLE), ('defects', 0.28::DOUBLE, 0.64::DOUBLE), ('analysis', 0.64::DOUBLE, 1.0::DOUBLE)) AS t(region_id, lo, hi)")  # fmt: skip
def page_template_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    forced = Settings(template_name="otk_v2", region_detection_strategy="template")
    return P.zoned(drawn_pages(spark, sf_dir), forced).select(_key(), "region_id", "y_start", "y_end", "method")


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.read_pages(drawn_pages(spark, sf_dir), _DOTS, _S, prepare=False)


@query(
    f"""{_PAGES}, gaps AS (SELECT *, list_transform(range(1, len(rows)), lambda j: CAST(rows[j + 1] - rows[j] AS DOUBLE)) AS r, [200.0::DOUBLE, 200.0::DOUBLE, 200.0::DOUBLE] AS c FROM lines)
SELECT k, array_to_string(rows, ',') AS rows, array_to_string(cols, ',') AS cols,
  round((least(len(rows) / 10.0::DOUBLE, 1) + 0.4::DOUBLE) * 0.3::DOUBLE + (1 / (1 + list_aggregate(r, 'stddev_pop') / list_aggregate(r, 'avg')) + 1) * 0.2::DOUBLE, 6) AS confidence FROM gaps"""
)
def page_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _read(spark, sf_dir).select(_key(), F.explode("grids").alias("g"))
    return one.select("k", F.array_join(F.col("g.rows").cast("array<string>"), ",").alias("rows"), F.array_join(F.col("g.cols").cast("array<string>"), ",").alias("cols"), F.round("g.confidence", 6).alias("confidence"))


@query(f"{_PAGES} SELECT k, i AS row_idx, j AS col_idx, x0, CAST(y0 + head AS INT) AS y0, x1, CAST(y1 + head AS INT) AS y1, CASE WHEN code = 0 THEN '' ELSE CAST(code AS VARCHAR) END AS text, CASE WHEN code = 0 THEN 0.0::DOUBLE ELSE 0.9::DOUBLE END AS confidence FROM cell")
def page_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.recognised_cells(drawn_pages(spark, sf_dir), _DOTS, _S)
    return found.withColumnRenamed("doc_id", "origin").select(_key(), "row_idx", "col_idx", "x0", "y0", "x1", "y1", "text", F.round("confidence", 9).alias("confidence"))


@query(f"{_PAGES} SELECT count(*) AS cells, count(*) AS asked, CAST(count_if(code = 0) AS BIGINT) AS without_text, count(DISTINCT k) AS documents FROM cell")
def recognition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.recognition_counts(P.recognised_cells(drawn_pages(spark, sf_dir), _DOTS, _S))


_TEXTS = f"""{_PAGES}, spot AS (SELECT k, 'header' AS region_id, g, 40 AS y, 1 + (k + g) % 5 AS code FROM page, unnest(range(0, 3)) AS t(g)
  UNION ALL SELECT k, 'analysis', g, head + n + 50, 1 + (2 * k + g) % 5 FROM page, unnest(range(0, 3)) AS t(g)),
texts AS (SELECT k, region_id, CAST(code AS VARCHAR) AS text, 0.9::DOUBLE AS confidence, CAST(60 + 150 * g AS INT) AS x0, CAST(y AS INT) AS y0, CAST(60 + 150 * g + 10 * code - 6 AS INT) AS x1, CAST(y + 4 AS INT) AS y1 FROM spot)"""


@query(f"{_TEXTS} SELECT *, CAST((x0 + x1) // 2 AS INT) AS cx, CAST((y0 + y1) // 2 AS INT) AS cy FROM texts")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = P.recognised(drawn_pages(spark, sf_dir), _DOTS, _S).where("region_id <> 'defects'").withColumnRenamed("doc_id", "origin")
    return found.select(_key(), "region_id", "text", "confidence", "x0", "y0", "x1", "y1", "cx", "cy")


@query(f"{_TEXTS} SELECT k, text, x0, y0 FROM texts UNION ALL SELECT k, CAST(code AS VARCHAR), CAST(x0 + 6 AS INT), CAST(y0 + head + 8 AS INT) FROM cell WHERE code > 0")
def page_texts_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read in one piece, without zones."""
    one = P.read_pages(drawn_pages(spark, sf_dir), _DOTS, _S, prepare=False, by_zone=False).select(_key(), F.explode("detections").alias("d"))
    return one.select("k", "d.text", "d.x0", "d.y0")


@query(
    f"""{_TEXTS}, had AS (SELECT k, count(*) AS cells, count_if(code > 0) AS filled FROM cell GROUP BY k)
SELECT 'page-' || k || '.png' AS file_name, 'ok' AS status, CAST(6 + filled AS INT) AS texts_detected, 0.9::DOUBLE AS average_confidence, 0 AS low_confidence_count, 3 AS zones, 3 AS header_texts, CAST(filled AS INT) AS table_texts,
  CAST(cells AS INT) AS cells, (SELECT string_agg(text, ' ' ORDER BY x0) FROM texts t WHERE t.k = had.k AND region_id = 'analysis') AS analysis FROM had"""
)
def page_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to recognised documents: zones, tables and texts in one nested row each."""
    docs = assemble.of_pages(_read(spark, sf_dir))
    of = lambda z: F.try_element_at("ocr_results_by_region", F.lit(z))
    cells = F.try_element_at("table_data_by_region", F.lit("defects")).cells
    return docs.select(
        "file_name", "status", "processing_metrics.texts_detected", F.round("processing_metrics.average_confidence", 9).alias("average_confidence"), "processing_metrics.low_confidence_count",
        F.size("regions_detected").alias("zones"), F.size(of("header")).alias("header_texts"), F.size(of("defects")).alias("table_texts"), F.size(cells).alias("cells"),
        F.array_join(F.transform(of("analysis"), lambda d: d.text), " ").alias("analysis"),
    )


@query(f"{_PAGES} SELECT k, 'ok' AS status, CAST(height AS INT) AS height, 800 AS width, 0.0::DOUBLE AS angle, 'adaptive,adaptive,adaptive' AS methods FROM page")
def page_preprocessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preprocessing keeps a straight page as it is, and its zones are found again afterwards."""
    done = P.preprocessed(drawn_pages(spark, sf_dir), _S)
    again = done.select(F.struct("origin", "height", "width", F.lit(1).alias("nChannels"), "data").alias("image"))
    methods = P.zoned(again, _S).groupBy("origin").agg(F.array_join(F.sort_array(F.collect_list("method")), ",").alias("methods"))
    return done.join(methods, "origin").select(_key(), "status", "height", "width", "angle", "methods")
