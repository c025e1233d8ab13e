"""Queries over scalar page functions, zones and cells as columns, and over files that are written and read back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import text as T
from formloom.operators import cells as C
from formloom.operators import lookup, quality, zones
from formloom.plans import assemble, pipeline
from formloom.plans.more_queries import _results
from formloom.plans.queries import _CORRECTED, _DET, ORACLE_SQL, query
from formloom.sources import documents as D
from formloom.sources import sinks, templates
from formloom.sources.detections import detections
from formloom.sources.images import image_files
from formloom.sources.scratch import brief_shuffles, drop, drop_files, scratch


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


# scalars


@query("SELECT l_orderkey, l_linenumber, CAST(printf('%.3f', ((l_partkey * 7 + l_linenumber * 13 + l_suppkey) % 2001) / 2000.0::DOUBLE) AS DOUBLE) AS confidence FROM lineitem")
def rounded_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("((l_partkey * 7 + l_linenumber * 13 + l_suppkey) % 2001) / 2000.0D")
    return _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", G.round3(value).alias("confidence"))


@query(_DET + " SELECT doc_id, det_idx, CASE WHEN det_idx % 3 = 0 THEN 2480 ELSE 1000 + det_idx END AS width, CASE WHEN det_idx % 4 = 0 THEN 3508 ELSE 2000 + det_idx END AS height FROM det")
def page_size_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("det_idx")
    return detections(spark, sf_dir).select("doc_id", "det_idx", G.page_width(F.when(i % 3 != 0, 1000 + i)).alias("width"), G.page_height(F.when(i % 4 != 0, 2000 + i)).alias("height"))


@query(_DET + " SELECT doc_id, det_idx, round(cy / CAST(height AS DOUBLE), 9) AS y, CAST(length(text) AS INT) AS char_count FROM det")
def normalised_y(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("doc_id", "det_idx", F.round(G.normalise_y(F.col("cy"), F.col("height")), 9).alias("y"), F.char_length("text").alias("char_count"))


@query(
    """SELECT page_id, 'form-' || page_id || '-texts.json' AS texts, 'form-' || page_id || '-corrected.json' AS corrected, 'form-' || page_id || '-data.json' AS data FROM pages"""
)
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem = F.concat(F.lit("form-"), F.col("page_id").cast("string"))
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", stem.alias("stem"))
    at = lambda ending, drop, suffix: T.next_file_name(F.concat("stem", F.lit(ending)), drop, suffix)
    return rows.select("page_id", at("-cor.jpg", "-cor", "-texts.json").alias("texts"), at("-texts.json", "-texts", "-corrected.json").alias("corrected"), at("-corrected.json", "-corrected", "-data.json").alias("data"))


@query(_DET + " SELECT doc_id, det_idx, x0 AS left_x, y0 + 7 AS top_y, x1 AS right_x, y1 + 7 AS low_y, CAST(floor((x0 + x1) / 2) AS INT) AS cx, CAST(floor((y0 + y1) / 2) AS INT) + 7 AS cy FROM det")
def cell_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = detections(spark, sf_dir).withColumn("b", G.cell_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), F.lit(7)))
    corner = lambda i, k: F.col("b.polygon")[i][k]
    return c.select("doc_id", "det_idx", corner(0, 0).alias("left_x"), corner(0, 1).alias("top_y"), corner(2, 0).alias("right_x"), corner(2, 1).alias("low_y"), F.col("b.center")[0].alias("cx"), F.col("b.center")[1].alias("cy"))


_SIZES = "sized AS (SELECT l_orderkey, l_linenumber, CAST(200 + (l_partkey * 31 + l_linenumber) % 4000 AS INT) AS w, CAST(200 + (l_orderkey * 17 + l_suppkey) % 3500 AS INT) AS h FROM lineitem)"


@query(
    f"""WITH {_SIZES}, scaled AS (SELECT *, CAST(w AS DOUBLE) * h / 1e6 < 4.0 AS grows, least(sqrt(5e6 / (CAST(w AS DOUBLE) * h)), 3000 / CAST(w AS DOUBLE), 2000 / CAST(h AS DOUBLE)) AS s,
  least(1.0::DOUBLE, 3000 / CAST(greatest(w, h) AS DOUBLE)) AS f, least(1.0::DOUBLE, 3000 / CAST(w AS DOUBLE), 2000 / CAST(h AS DOUBLE)) AS fit FROM sized)
SELECT l_orderkey, l_linenumber, CASE WHEN grows THEN CAST(trunc(w * s) AS INT) ELSE w END AS width, CASE WHEN grows THEN CAST(trunc(h * s) AS INT) ELSE h END AS height, w > 3000 OR h > 2000 AS too_large,
  CAST(trunc(w * f) AS INT) AS read_width, CAST(trunc(h * f) AS INT) AS read_height, round(fit, 9) AS fit FROM scaled"""
)
def page_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.expr("CAST(200 + (l_partkey * 31 + l_linenumber) % 4000 AS INT)"), F.expr("CAST(200 + (l_orderkey * 17 + l_suppkey) % 3500 AS INT)")
    grown, read = G.adaptive_size(w, h), G.longest_side(w, h)
    return _lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", grown.width.alias("width"), grown.height.alias("height"), G.too_large(w, h).alias("too_large"), read.width.alias("read_width"), read.height.alias("read_height"),
        F.round(G.fit_within(w, h, 3000, 2000), 9).alias("fit"),
    )


@query(
    _DET
    + """, m AS (SELECT doc_id, region_id, median(CAST((cx * 7 + cy * 3 + doc_id) % 121 - 60 AS DOUBLE)) AS angle FROM det GROUP BY ALL)
SELECT doc_id, region_id, CASE WHEN abs(angle) BETWEEN 2 AND 45 THEN angle ELSE 0.0::DOUBLE END AS turn FROM m"""
)
def page_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    angles = F.collect_list(F.expr("CAST((cx * 7 + cy * 3 + doc_id) % 121 - 60 AS DOUBLE)"))
    return detections(spark, sf_dir).groupBy("doc_id", "region_id").agg(angles.alias("a")).select("doc_id", "region_id", G.turn_of(F.col("a")).alias("turn"))


_QUAD = [("cx % 90", "cy % 70"), ("60 + x1 % 100", "y0 % 80"), ("60 + x0 % 120", "60 + y1 % 90"), ("cx % 60", "50 + cy % 110")]


def _corner_sql() -> str:
    at = lambda i, k: f"q{i % 4}{'xy'[k]}"
    cols = ", ".join(f"CAST({e} AS DOUBLE) AS q{i}{'xy'[k]}" for i, p in enumerate(_QUAD) for k, e in enumerate(p))
    sides = ", ".join(f"sqrt(({at(i + 1, 0)} - {at(i, 0)}) ** 2 + ({at(i + 1, 1)} - {at(i, 1)}) ** 2)" for i in range(4))
    turns = ", ".join(f"({at(i + 1, 0)} - {at(i, 0)}) * ({at(i + 2, 1)} - {at(i + 1, 1)}) - ({at(i + 1, 1)} - {at(i, 1)}) * ({at(i + 2, 0)} - {at(i + 1, 0)})" for i in range(4))
    return f"{_DET}, q AS (SELECT doc_id, det_idx, {cols} FROM det) SELECT doc_id, det_idx, least({sides}) >= 50 AND (least({turns}) > 0 OR greatest({turns}) < 0) AS ok FROM q"


@query(_corner_sql())
def corner_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    quad = F.array(*(F.array(*(F.expr(f"CAST({e} AS DOUBLE)") for e in p)) for p in _QUAD))
    return detections(spark, sf_dir).withColumn("q", quad).select("doc_id", "det_idx", G.corners_ok(F.col("q")).alias("ok"))


# zones and cells

_LINES = """, l AS (SELECT doc_id, list(DISTINCT (cy * 3 + 11) % 3508 ORDER BY (cy * 3 + 11) % 3508) AS lines FROM det GROUP BY doc_id),
h AS (SELECT *, list_filter(lines, lambda y: y / 3508.0::DOUBLE BETWEEN 0.2::DOUBLE AND 0.25::DOUBLE) AS heads FROM l),
o AS (SELECT *, (SELECT arg_min(y, abs(y - 3508 * ((0.2::DOUBLE + 0.25::DOUBLE) / 2)) + i / 1e6) FROM (SELECT unnest(heads) AS y, unnest(range(len(heads))) AS i)) AS head FROM h),
c AS (SELECT *, head + 877 AS low, least(head + 2104, 3507) AS high, list_filter(lines, lambda y: y > head AND (y - head) / 3508.0::DOUBLE BETWEEN 0.25::DOUBLE AND 0.6::DOUBLE) AS cuts FROM o),
b AS (SELECT *, (SELECT arg_min(y, abs(y - (low + high) / 2.0::DOUBLE) + i / 1e6) FROM (SELECT unnest(cuts) AS y, unnest(range(len(cuts))) AS i)) AS cut FROM c)"""


def _bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    spots = detections(spark, sf_dir).groupBy("doc_id").agg(F.sort_array(F.collect_set((F.col("cy") * 3 + 11) % 3508)).alias("lines"))
    return spots.withColumn("b", zones.boundaries(F.col("lines"), F.lit(3508)))


@query(_DET + _LINES + " SELECT doc_id, CAST(head AS INT) AS head, CAST(cut AS INT) AS cut FROM b")
def zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounded(spark, sf_dir).select("doc_id", "b.head", "b.cut")


@query(
    _DET
    + _LINES
    + """, e AS (SELECT doc_id, unnest(['header', 'defects', 'analysis']) AS name, unnest([0, head, cut]) AS y_start, unnest([head, cut, 3508]) AS y_end, unnest([0.0::DOUBLE, 0.28::DOUBLE, 0.64::DOUBLE]) AS lo,
  unnest([0.28::DOUBLE, 0.64::DOUBLE, 1.0::DOUBLE]) AS hi FROM b WHERE head IS NOT NULL AND cut IS NOT NULL),
v AS (SELECT doc_id, bool_and(abs(y_start / 3508.0::DOUBLE - lo) <= 0.06::DOUBLE AND abs(y_end / 3508.0::DOUBLE - hi) <= 0.06::DOUBLE) AS agrees FROM e GROUP BY doc_id)
SELECT doc_id, name, CAST(y_start AS INT) AS y_start, CAST(y_end AS INT) AS y_end, doc_id % 3 > 0 AS sure, agrees FROM e JOIN v USING (doc_id)"""
)
def zone_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    height, sure = F.lit(3508), F.when(F.col("doc_id") % 3 > 0, 0.85).otherwise(0.65)
    found = _bounded(spark, sf_dir).where("b.head is not null and b.cut is not null").withColumn("z", zones.bands(F.array("b.head", "b.cut"), height))
    checked = found.select("doc_id", "z", zones.covers(F.col("z"), height, sure).alias("sure"), zones.agrees(F.col("z"), height, templates.DEFAULTS["otk_v2"], 0.06).alias("agrees"))
    return checked.select("doc_id", F.explode("z").alias("z"), "sure", "agrees").select("doc_id", "z.name", "z.y_start", "z.y_end", "sure", "agrees")


_BOUNDS = ([0, 24, "60 + doc_id % 17", 200, 260], [0, 18, 40, "60 + doc_id % 9", 300])


@query(
    f"""{_DET}, d AS (SELECT DISTINCT doc_id FROM det), b AS (SELECT doc_id, [{", ".join(map(str, _BOUNDS[0]))}] AS xs, [{", ".join(map(str, _BOUNDS[1]))}] AS ys FROM d),
c AS (SELECT doc_id, CAST(i AS INT) AS row_idx, CAST(j AS INT) AS col_idx, CAST(xs[j + 1] + 2 AS INT) AS x0, CAST(ys[i + 1] + 2 AS INT) AS y0, CAST(xs[j + 2] - 2 AS INT) AS x1, CAST(ys[i + 2] - 2 AS INT) AS y1 FROM b, unnest(range(0, 4)) AS a(i), unnest(range(0, 4)) AS e(j))
SELECT *, row_idx + 1 >= 2 AND col_idx + 1 >= 2 AND doc_id % 10 / 10.0::DOUBLE >= 0.3 AS usable FROM c WHERE x1 - x0 >= 20 AND y1 - y0 >= 15"""
)
def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    xs, ys = (F.array(*(F.expr(f"CAST({e} AS INT)") for e in own)) for own in _BOUNDS)
    one = detections(spark, sf_dir).select("doc_id").distinct().select("doc_id", F.explode(C.boxes(xs, ys)).alias("c")).select("doc_id", "c.*")
    return one.withColumn("usable", C.usable_grid(F.col("row_idx") + 1, F.col("col_idx") + 1, F.col("doc_id") % 10 / 10.0))


@query(_DET + " SELECT doc_id, count(*) AS cells, CAST(count_if(text = '') AS BIGINT) AS empty, round(count_if(text = '') / CAST(count(*) AS DOUBLE), 9) AS share, round(count_if(text = '') * 0.1::DOUBLE, 9) AS seconds_saved FROM det WHERE region_id = 'defects' GROUP BY doc_id")
def empty_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = detections(spark, sf_dir).where("region_id = 'defects'").select("doc_id", "det_idx", "text", "confidence")
    whole = C.with_empty(own.where("text <> ''"), own.where("text = ''").select("doc_id", "det_idx"))
    return C.empty_share(whole).withColumns({c: F.round(c, 9) for c in ("share", "seconds_saved")})


@query(
    _DET
    + """, z AS (SELECT doc_id, region_id, count(*) AS texts FROM det GROUP BY ALL), g AS (SELECT DISTINCT doc_id, region_id FROM det WHERE det_idx % 40 = 7)
SELECT z.*, g.doc_id IS NOT NULL AS has_cells FROM z LEFT JOIN g USING (doc_id, region_id)"""
)
def region_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones apart by whether they have cells, and together again."""
    det = detections(spark, sf_dir)
    parts = [det.where(F.col("region_id") == r).groupBy("doc_id", "region_id").agg(F.count("*").alias("texts")) for r in ("header", "defects", "analysis")]
    with_, without = zones.with_cells(parts[0].unionByName(parts[1]).unionByName(parts[2]), det.where("det_idx % 40 = 7"))
    return with_.withColumn("has_cells", F.lit(True)).unionByName(without.withColumn("has_cells", F.lit(False)))


# nested documents


def _nested(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """Detections as documents ``form-<doc_id>``, nothing corrected yet; with a condition on doc_id, only the documents that meet it."""
    own = detections(spark, sf_dir)
    plain = quality.validated(own if part is None else own.where(part)).withColumn("corrected", F.lit(False)).withColumn("original_text", F.lit(None).cast("string"))
    return assemble.documents(plain).withColumn("doc_id", F.concat(F.lit("form-"), F.col("doc_id").cast("string")))


@query(_CORRECTED + " SELECT 'form-' || doc_id AS doc_id, region_id, count(found) AS corrections, CAST(sum(length(coalesce(found, text))) AS BIGINT) AS chars FROM corrected GROUP BY ALL")
def region_map_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _nested(spark, sf_dir)
    one = assemble.corrected(typed).select("doc_id", F.explode("ocr_results_by_region").alias("region_id", "ds"))
    return one.select("doc_id", "region_id", F.explode("ds").alias("d")).groupBy("doc_id", "region_id").agg(F.count_if("d.corrected").alias("corrections"), F.sum(F.char_length("d.text")).alias("chars"))


@query("""WITH t AS (SELECT item_id, string_split(text || ' Homep дата', ' ') AS ws FROM benchmark), w AS (SELECT item_id, unnest(range(len(ws))) AS position, unnest(ws) AS original FROM t),
""" + ", ".join(p.strip() for p in _CORRECTED[_CORRECTED.index("exact(k, v)") : _CORRECTED.index("corrected AS")].rstrip().rstrip(",").split("\n")) + """
SELECT item_id, CAST(position AS INT) AS position, original, coalesce(e.v, f.v) AS corrected_text FROM w LEFT JOIN exact e ON original = e.k LEFT JOIN folded f ON lower(original) = f.k WHERE coalesce(e.v, f.v) IS NOT NULL""")  # fmt: skip
def list_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.split(F.concat("text", F.lit(" Homep дата")), " ").alias("texts"))
    return lookup.correct_list(texts).select("item_id", "position", "original", "corrected_text")


# files

#: A round of corrected_files has about so many detections, whose files are some 0.6 GB, as long as that makes no more rounds than MOST_ROUNDS: each scans the table.
ROWS_AT_ONCE, MOST_ROUNDS = 600_000, 32


def _corrected_counts(spark: SparkSession, path: str) -> DataFrame:
    schema = "corrections_applied struct<count:int>, validation_results struct<total_fields:int,validated_fields:int,low_confidence_warnings:array<struct<index:int>>>"
    read = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file_name", F.col("_metadata.file_name"))
    return read.select("file_name", F.col("corrections_applied.count").alias("corrections"), "validation_results.total_fields", "validation_results.validated_fields", F.size("validation_results.low_confidence_warnings").alias("warnings"))


@query(
    _DET
    + """ SELECT 'form-' || doc_id || '-texts.json' AS doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY region_id, det_idx) - 1 AS INT) AS det_idx, text, confidence, cx, cy, x0, y0, x1, y1, region_id, width, height FROM det"""
)
def texts_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ``-texts.json`` for each document, read back as detections."""
    path = scratch(spark, "texts")
    sinks.write_documents(_nested(spark, sf_dir), path, "-cor", "-texts.json")
    return D.detections(D.documents(spark, path, regions_required=True))


@query(
    _CORRECTED
    + """ SELECT 'form-' || doc_id || '-corrected.json' AS file_name, CAST(count(found) AS INT) AS corrections, CAST(count(*) AS INT) AS total_fields, CAST(count_if(coalesce(found, text) <> '') AS INT) AS validated_fields,
CAST(count_if(coalesce(found, text) <> '' AND confidence < 0.5) AS INT) AS warnings FROM corrected GROUP BY doc_id"""
)
def corrected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``-texts.json`` corrected and validated into ``-corrected.json``, read back.

    Files take some fifty times the table's size, so the documents are dealt to rounds by a hash; a round's files
    go when what is read back of them is written. Every document has its round, and every file is read.
    """
    counts = scratch(spark, "counts")
    kinds = "file_name string, corrections int, total_fields int, validated_fields int, warnings int"
    spark.createDataFrame([], kinds).write.parquet(counts)
    rounds = min(MOST_ROUNDS, max(1, -(-_lines(spark, sf_dir).count() // ROWS_AT_ONCE)))
    for k in range(rounds):
        texts, path = scratch(spark, "texts"), scratch(spark, "corrected")
        with brief_shuffles(spark), ThreadPoolExecutor(1) as beside:  # it leaves when the files that go beside the reading are gone
            part = _nested(spark, sf_dir, F.pmod(F.xxhash64("doc_id"), F.lit(rounds)) == k)
            written, _ = sinks.write_documents(part, texts, "-cor", "-texts.json")
            if written:
                docs = D.documents(spark, texts).where("status = 'ok'").drop("status", "error").withColumnRenamed("file_name", "doc_id")
                sinks.write_documents(assemble.validated(assemble.corrected(docs)), path, "(-cor)?(-texts)?", "-corrected.json")
                gone = beside.submit(drop_files, spark, texts)
                _corrected_counts(spark, path).write.mode("append").parquet(counts)
                drop_files(spark, path)
                gone.result()
        for done in (texts, path):
            drop(spark, done)
    return spark.read.schema(kinds).parquet(counts)


@query(ORACLE_SQL["summary_fields"])
def data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``-data.json`` of each document; the batch's required fields are picked from the files."""
    path = scratch(spark, "data")
    sinks.write_documents(pipeline.extract(detections(spark, sf_dir)), path, "-corrected", "-data.json")
    header = D.header_files(spark, path, quality.SUMMARY_FIELDS).withColumn("doc_id", F.col("doc_id").cast("long"))
    joined = quality.with_required_fields(_results(spark, sf_dir), header)
    return joined.select("doc_id", "status", F.col("control_type.value").alias("control_type"), F.col("control_type.confidence").alias("confidence"), "control_type.suspicious")


@query(ORACLE_SQL["batch_totals"])
def batch_summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "summary")
    sinks.write_summary(_results(spark, sf_dir), path, "20250101_000000")
    info = "struct<total_files:bigint,successful:bigint,failed:bigint,total_seconds:double,average_seconds:double>"
    read = spark.read.schema(f"batch_info {info}").option("multiLine", True).json(f"{path}/batch_summary_20250101_000000.json").select("batch_info.*")
    return read.withColumns({c: F.round(c, 6) for c in ("total_seconds", "average_seconds")})


@query(
    """SELECT 'd' || item_id || '.json' AS file_name, CASE WHEN item_id % 4 IN (1, 2) THEN 'failed' ELSE 'ok' END AS status,
CASE item_id % 4 WHEN 1 THEN 'Invalid JSON' WHEN 2 THEN 'No ocr_results_by_region found in document' END AS error, CASE WHEN item_id % 4 IN (0, 3) THEN text END AS text FROM benchmark"""
)
def broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are no JSON, or no documents, are rows with an error beside the others."""
    path, kind = scratch(spark, "broken"), F.col("item_id") % 4
    good = F.to_json(F.struct(F.create_map(F.lit("header"), F.array(F.struct("text", F.lit(0.5).alias("confidence")))).alias("ocr_results_by_region")))
    content = F.when(kind == 1, F.concat(F.lit("{broken "), "text")).when(kind == 2, F.lit('{"document_info": {}}')).otherwise(good)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    sinks.write_files(items.select(F.concat(F.lit("d"), F.col("item_id").cast("string"), F.lit(".json")).alias("name"), content.alias("content")), path)
    read = D.documents(spark, path, regions_required=True)
    return read.select("file_name", "status", "error", F.get(F.try_element_at("ocr_results_by_region", F.lit("header")), F.lit(0)).text.alias("text"))


@query(
    """SELECT c_custkey, band, CAST(round_even((1000 + c_custkey % 2500) * lo, 0) AS INT) AS y_start, CAST(round_even((1000 + c_custkey % 2500) * hi, 0) AS INT) AS y_end FROM customer,
(VALUES ('top', 0.0::DOUBLE, 0.3::DOUBLE), ('rest', 0.3::DOUBLE, 0.95::DOUBLE)) AS t(band, lo, hi)"""
)
def template_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands by a template from a file, whose entries out of order or range do not count."""
    text = """{"own": [{"region_id": "top", "y_start_norm": 0, "y_end_norm": 0.3}, {"region_id": "bad", "y_start_norm": 0.9, "y_end_norm": 0.2}, {"region_id": "rest", "y_start_norm": 0.3, "y_end_norm": 0.95},
 {"region_id": 7, "y_start_norm": 0, "y_end_norm": 1}], "empty": []}"""
    path = scratch(spark, "templates")
    sinks.write_files(spark.createDataFrame([("regions.json", text)], "name string, content string"), path)
    own = templates.load_templates(spark, f"{path}/regions.json")["own"]
    each = F.array(*(F.struct(F.lit(n).alias("band"), F.lit(a).alias("start"), F.lit(b).alias("end")) for n, a, b in own))
    pages = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", (1000 + F.col("c_custkey") % 2500).alias("height"))
    spot = G.denormalise(F.col("b.start"), F.col("b.end"), F.col("height"))
    return pages.withColumn("b", F.explode(each)).select("c_custkey", "b.band", spot.start.alias("y_start"), spot.end.alias("y_end"))


@query("""SELECT 'n' || n_nationkey || '.' || ['jpg', 'PNG', 'tiff', 'txt', 'Jpeg', 'gif', 'bmp'][n_nationkey % 7 + 1] AS name, CAST(length(n_name) AS BIGINT) AS length FROM nation WHERE n_nationkey % 7 NOT IN (3, 5)""")
def image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "scan")
    endings = F.array(*map(F.lit, ("jpg", "PNG", "tiff", "txt", "Jpeg", "gif", "bmp")))
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("."), F.get(endings, (F.col("n_nationkey") % 7).cast("int")))
    sinks.write_files(spark.read.parquet(f"{sf_dir}/nation.parquet").select(name.alias("name"), F.col("n_name").alias("content")), path)
    return image_files(spark, path).select("name", "length")
