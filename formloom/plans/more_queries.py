"""Queries over layout, sections and documents as a whole; they register beside those of queries.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import anchors as A
from formloom.operators import header as H
from formloom.operators import layout as L
from formloom.operators import quality, sections
from formloom.plans.queries import _DET, _SAME, _Z, ORACLE_SQL, query
from formloom.sources.detections import detections


def _zone(spark: SparkSession, sf_dir: str, region: str) -> DataFrame:
    return detections(spark, sf_dir).where(F.col("region_id") == region)


# layout

_BLOCKS = """b AS (SELECT *, sum(CASE WHEN cx - before > 297 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY cx, det_idx) AS block
  FROM (SELECT *, lag(cx) OVER (PARTITION BY doc_id ORDER BY cx, det_idx) AS before FROM det WHERE region_id = 'defects'))"""


@query(f"{_DET}, {_BLOCKS} SELECT doc_id, det_idx, CAST(block AS INT) AS block FROM b")
def block_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.block_ids(_zone(spark, sf_dir, "defects")).select("doc_id", "det_idx", "block")


def _rows_sql(source: str, keys: str, order: str = "cy, cx, det_idx") -> str:
    """Rows by a fold over source, apart for each of keys: CTE ``folded`` with line from 0."""
    on = " AND ".join(f"o.{k} = f.{k}" for k in keys.split(", "))
    own = ", ".join(f"o.{k}" for k in keys.split(", "))
    return f"""o AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS k FROM {source}),
folded AS (SELECT {keys}, k, cy AS top, 0 AS line FROM o WHERE k = 1
  UNION ALL SELECT {own}, o.k, CASE WHEN abs(o.cy - f.top) <= 21 THEN f.top ELSE o.cy END, CASE WHEN abs(o.cy - f.top) <= 21 THEN f.line ELSE f.line + 1 END
  FROM folded f JOIN o ON {on} AND o.k = f.k + 1)"""


@query(f"{_Z}, {_rows_sql('z', 'doc_id')} SELECT doc_id, det_idx, line FROM folded JOIN o USING (doc_id, k)")
def row_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.pages(detections(spark, sf_dir)).select("doc_id", F.posexplode(L.rows(F.col("analysis"), F.lit(21))).alias("line", "members"))
    return lines.select("doc_id", "line", F.explode("members.i").alias("det_idx"))


@query(
    f"""{_DET}, o AS (SELECT doc_id, cx, row_number() OVER (PARTITION BY doc_id ORDER BY cx) AS k FROM (SELECT DISTINCT doc_id, cx FROM det WHERE region_id = 'defects')),
m AS (SELECT doc_id, k, [cx] AS merged FROM o WHERE k = 1
  UNION ALL SELECT o.doc_id, o.k, CASE WHEN o.cx - m.merged[-1] <= 100 THEN list_append(m.merged[:len(m.merged) - 1], CAST(floor((m.merged[-1] + o.cx) / 2) AS INT)) ELSE list_append(m.merged, o.cx) END
  FROM m JOIN o ON o.doc_id = m.doc_id AND o.k = m.k + 1)
SELECT doc_id, array_to_string(merged, ',') AS merged FROM m QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k DESC) = 1"""
)
def merge_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _zone(spark, sf_dir, "defects").groupBy("doc_id").agg(F.collect_set("cx").alias("xs"))
    return lines.select("doc_id", F.array_join(L.merge_positions(F.col("xs"), F.lit(100)), ",").alias("merged"))


_RUNS = """r AS (SELECT DISTINCT doc_id, CAST((cy - 44) / 88 AS INT) AS band FROM det WHERE region_id = 'header' AND confidence >= 0.8),
runs AS (SELECT doc_id, min(band) AS run_start, max(band) AS run_end FROM (SELECT *, band - row_number() OVER (PARTITION BY doc_id ORDER BY band) AS island FROM r) GROUP BY doc_id, island)"""


def _bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    strong = _zone(spark, sf_dir, "header").where("confidence >= 0.8")
    return L.runs(strong.withColumn("band", F.floor((F.col("cy") - 44) / 88).cast("int")), "doc_id", "band")


@query(f"{_DET}, {_RUNS} SELECT doc_id, run_start, run_end FROM runs")
def index_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bands(spark, sf_dir)


@query(
    f"""{_DET}, {_RUNS}, top AS (SELECT doc_id, (run_start + run_end) / 2.0::DOUBLE AS middle FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY run_end - run_start DESC, run_start) <= 2)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY middle) AS INT) AS place, middle FROM top"""
)
def longest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.longest(_bands(spark, sf_dir), "doc_id")


@query(f"{_DET} SELECT doc_id, region_id, det_idx FROM det QUALIFY cy <= quantile_cont(cy, 0.2) OVER (PARTITION BY doc_id, region_id)")
def quiet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.quiet(detections(spark, sf_dir), ["doc_id", "region_id"], "cy", 0.2).select("doc_id", "region_id", "det_idx")


@query(f"{_DET} SELECT doc_id, det_idx, round(sum(confidence) OVER (PARTITION BY doc_id ORDER BY det_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) / 5, 9) AS smooth FROM det")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.moving_average(detections(spark, sf_dir), "doc_id", "det_idx", "confidence", 5).select("doc_id", "det_idx", F.round("smooth", 9).alias("smooth"))


@query(f"{_DET} SELECT doc_id, region_id, round(quantile_cont(cy, 0.2), 9) AS low, round(median(confidence), 9) AS middle FROM det GROUP BY doc_id, region_id")
def percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).groupBy("doc_id", "region_id").agg(F.round(F.percentile("cy", 0.2), 9).alias("low"), F.round(F.median("confidence"), 9).alias("middle"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sorted_ = lambda c: F.array_sort(F.collect_set(c))
    return _zone(spark, sf_dir, "header").groupBy("doc_id").agg(sorted_("cy").alias("rows"), sorted_("cx").alias("columns"))


@query(
    f"""{_DET}, x AS (SELECT doc_id, cx, lead(cx) OVER (PARTITION BY doc_id ORDER BY cx) AS after FROM (SELECT DISTINCT doc_id, cx FROM det WHERE region_id = 'header'))
SELECT doc_id, '0,' || coalesce(string_agg(CAST(CAST(floor((cx + after) / 2) AS INT) AS STRING), ',' ORDER BY cx) FILTER (after IS NOT NULL) || ',', '') || '2480' AS bounds FROM x GROUP BY doc_id"""
)
def cell_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", F.array_join(L.cell_bounds(F.col("columns"), F.lit(2480)), ",").alias("bounds"))


_REGULAR = lambda c: f"""(SELECT doc_id, count(*) AS n, CASE WHEN count(*) < 2 OR avg(step) = 0 THEN 0 ELSE 1 / (1 + stddev_pop(step) / avg(step)) END AS reg, min(step) AS least
  FROM (SELECT doc_id, {c} - lag({c}) OVER (PARTITION BY doc_id ORDER BY {c}) AS step FROM (SELECT DISTINCT doc_id, {c} FROM det WHERE region_id = 'header')) GROUP BY doc_id)"""  # noqa: E731


@query(
    f"""{_DET} SELECT r.doc_id, round(least(greatest((least(r.n / 10.0::DOUBLE, 1) + least(c.n / 10.0::DOUBLE, 1)) * 0.3::DOUBLE + (r.reg + c.reg) * 0.2::DOUBLE, 0), 1), 9) AS grid_confidence,
r.n >= 2 AND c.n >= 2 AND coalesce(r.least, 0) >= 10 AND coalesce(c.least, 0) >= 10 AS grid_valid FROM {_REGULAR("cy")} r JOIN {_REGULAR("cx")} c USING (doc_id)"""
)
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, columns = F.col("rows"), F.col("columns")
    return _lines(spark, sf_dir).select(
        "doc_id", F.round(L.grid_confidence(rows, columns), 9).alias("grid_confidence"), L.grid_valid(rows, columns, F.lit(2480), F.lit(3508)).alias("grid_valid")
    )


# sections

_DEFECT_ROWS = f"""{_DET}, {_BLOCKS}, e AS (SELECT *, min(cy) OVER (PARTITION BY doc_id, block) + 50 AS edge FROM b),
titles AS (SELECT doc_id, block, string_agg(text, ' ' ORDER BY cy, cx, det_idx) AS title FROM e WHERE cy < edge GROUP BY doc_id, block),
low AS (SELECT * FROM e WHERE cy >= edge), {_rows_sql('low', 'doc_id, block')},
placed2 AS (SELECT o.*, line, row_number() OVER (PARTITION BY o.doc_id, o.block, line ORDER BY cx, det_idx) AS n FROM folded JOIN o USING (doc_id, block, k)),
kinds AS (SELECT *, CASE WHEN contains(lower(title), 'геометрия') THEN 'geometry' WHEN contains(lower(title), 'отверстия') OR contains(lower(title), 'вал') THEN 'holes'
  WHEN contains(lower(title), 'поверхность') THEN 'surface' ELSE 'other' END AS kind FROM titles)"""
_NTH = lambda k: f"max(text) FILTER (n = {k})"


@query(
    f"""{_DEFECT_ROWS} SELECT p.doc_id, CAST(p.block AS INT) AS block, k.kind, line, {_NTH(1)} AS row_number, CASE WHEN kind <> 'surface' THEN {_NTH(2)} END AS parameter,
CASE WHEN kind = 'surface' THEN {_NTH(2)} END AS defect, CASE WHEN kind <> 'surface' THEN {_NTH(3)} END AS fact_value, CASE WHEN kind <> 'surface' THEN {_NTH(4)} END AS deviation,
CASE WHEN kind = 'surface' THEN {_NTH(3)} ELSE {_NTH(5)} END AS quantity, round(avg(confidence), 9) AS confidence
FROM placed2 p JOIN kinds k ON p.doc_id = k.doc_id AND p.block = k.block WHERE line > 0 GROUP BY p.doc_id, p.block, k.kind, line"""
)
def defect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sections.defect_blocks(A.pages(detections(spark, sf_dir)))
    rows = blocks.select("doc_id", "block", "kind", F.posexplode("rows").alias("line", "r"))
    names = ["row_number", "parameter", "defect", "fact_value", "deviation", "quantity"]
    return rows.select("doc_id", "block", "kind", (F.col("line") + 1).alias("line"), *(F.col(f"r.{n}").alias(n) for n in names), F.round("r.confidence", 9).alias("confidence"))


@query(
    f"""{_DEFECT_ROWS} SELECT p.doc_id, CAST(p.block AS INT) AS block, k.kind, k.title, string_agg(text, '|' ORDER BY n) FILTER (line = 0) AS headers, max(line) AS data_rows
FROM placed2 p JOIN kinds k ON p.doc_id = k.doc_id AND p.block = k.block GROUP BY p.doc_id, p.block, k.kind, k.title""".replace("ORDER BY n) FILTER (line = 0)", "ORDER BY cy, cx, det_idx) FILTER (line = 0)")
)
def defect_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = sections.defect_blocks(A.pages(detections(spark, sf_dir)))
    return blocks.select("doc_id", "block", "kind", "title", F.array_join("headers", "|").alias("headers"), F.size("rows").alias("data_rows"))


@query(
    f"""{_Z}, {_rows_sql('z', 'doc_id')}, placed2 AS (SELECT o.*, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY cx, det_idx) AS n FROM folded JOIN o USING (doc_id, k))
SELECT doc_id, line, {_NTH(1)} AS row_number, {_NTH(2)} AS operation, {_NTH(3)} AS cause, {_NTH(4)} AS responsible, {_NTH(5)} AS decision, round(avg(confidence), 9) AS confidence
FROM placed2 WHERE line > 0 GROUP BY doc_id, line HAVING count(*) >= 2"""
)
def analysis_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.analysis_rows(A.pages(detections(spark, sf_dir))).withColumn("confidence", F.round("confidence", 9))


def _signed(word: str) -> str:
    return rf"""SELECT a.doc_id, arg_max(d.text, a.det_idx) AS name FROM z a JOIN LATERAL (SELECT d.text FROM z d WHERE d.doc_id = a.doc_id AND abs(d.cy - a.cy) < 50 AND d.cx > a.cx + 50 AND d.cx < a.cx + 400
  AND len(string_split(d.text, ' ')) BETWEEN 2 AND 4 AND regexp_matches(d.text, '(^| )\p{{Lu}}') ORDER BY d.det_idx LIMIT 1) d ON true WHERE {word} GROUP BY a.doc_id"""


@query(
    rf"""{_Z}, acts AS (SELECT *, CASE WHEN contains(lower(text), 'не использовать') THEN 'не использовать' WHEN contains(lower(text), 'доработать') THEN 'доработать'
  WHEN contains(lower(text), 'использовать') THEN 'использовать' END AS action FROM z),
d AS (SELECT doc_id, arg_max(action, det_idx) AS action, arg_max(TRY_CAST(regexp_extract(text, '\d+') AS BIGINT), det_idx) FILTER (regexp_matches(text, '\d')) AS quantity FROM acts WHERE action IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, d.action, d.quantity, m.name AS manager_name, o.name AS otk_representative FROM d LEFT JOIN ({_signed("contains(lower(a.text), 'руководитель')")}) m ON d.doc_id = m.doc_id
LEFT JOIN ({_signed("contains(lower(a.text), 'представитель') AND contains(lower(a.text), 'отк')")}) o ON d.doc_id = o.doc_id"""
)
def final_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.final_decision(A.pages(detections(spark, sf_dir)))


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = _zone(spark, sf_dir, "defects")
    return zone.select("doc_id", F.floor((F.col("cy") - 44) / 88).cast("int").alias("row_idx"), F.col("det_idx").alias("col_idx"), "text", "confidence")


@query(
    f"""{_DET}, c AS (SELECT doc_id, CAST((cy - 44) / 88 AS INT) AS row_idx, det_idx, text, confidence FROM det WHERE region_id = 'defects'),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, row_idx ORDER BY det_idx) AS n, min(row_idx) OVER (PARTITION BY doc_id) AS head, max(row_idx) OVER (PARTITION BY doc_id) AS last FROM c)
SELECT doc_id, 'other' AS kind, row_idx, {_NTH(1)} AS row_number, {_NTH(2)} AS parameter, {_NTH(3)} AS fact_value, {_NTH(4)} AS deviation, {_NTH(5)} AS quantity, round(avg(confidence), 9) AS confidence
FROM n WHERE row_idx > head OR head = last GROUP BY doc_id, row_idx"""
)
def grid_defect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.defect_rows_of_cells(_cells(spark, sf_dir)).withColumn("confidence", F.round("confidence", 9))


@query(
    f"""{_DET}, c AS (SELECT doc_id, CAST((cy - 44) / 88 AS INT) AS row_idx, det_idx, text FROM det WHERE region_id = 'defects'),
t(col_idx, name) AS (VALUES (0, 'row_number'), (1, 'parameter'), (2, 'norm'), (3, 'actual'), (4, 'decision'), (5, 'notes'))
SELECT doc_id, row_idx, coalesce(name, 'col_' || det_idx) AS field, text FROM c LEFT JOIN t ON det_idx = col_idx"""
)
def named_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formloom.sources.tables import columns

    named = sections.name_cells(_cells(spark, sf_dir), columns(spark, "otk_v1"))
    return named.select("doc_id", "row_idx", F.explode("fields").alias("field", "v")).select("doc_id", "row_idx", "field", "v.text")


# documents

_FIELDS = f"""(SELECT doc_id, 'act_number' AS field, value, confidence FROM ({ORACLE_SQL["form_number"]})
UNION ALL SELECT doc_id, 'act_number', value, confidence FROM ({ORACLE_SQL["act_number"]}) WHERE doc_id NOT IN (SELECT doc_id FROM ({ORACLE_SQL["form_number"]}))
UNION ALL SELECT doc_id, 'act_date', value, confidence FROM ({ORACLE_SQL["form_date"]})
UNION ALL SELECT doc_id, 'act_date', value, confidence FROM ({ORACLE_SQL["act_date"]}) WHERE doc_id NOT IN (SELECT doc_id FROM ({ORACLE_SQL["form_date"]}))
UNION ALL SELECT doc_id, 'template_revision', value, confidence FROM ({ORACLE_SQL["template_revision"]})
UNION ALL SELECT doc_id, 'quantity_checked', value, confidence FROM ({ORACLE_SQL["quantity_checked"]})
UNION ALL SELECT doc_id, 'control_type', value, confidence FROM ({ORACLE_SQL["control_type"]})
UNION ALL SELECT doc_id, 'inspector_name', value, confidence FROM ({ORACLE_SQL["inspector_name"]})
UNION ALL SELECT doc_id, 'part_line_number', part_line_number, NULL FROM ({ORACLE_SQL["sticker"]})
UNION ALL SELECT doc_id, 'part_line_number', value, confidence FROM ({ORACLE_SQL["part_line"]}) WHERE doc_id NOT IN (SELECT doc_id FROM ({ORACLE_SQL["sticker"]})))"""
_ASKED = "(SELECT unnest(['act_date', 'act_number', 'control_type', 'inspector_name', 'part_line_number', 'quantity_checked', 'template_revision']) AS field)"
_DOCS = f"(SELECT DISTINCT doc_id FROM ({_DET} SELECT doc_id FROM det))"


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.extract_header(A.pages(detections(spark, sf_dir)))


@query(f"SELECT doc_id, field, value FROM {_FIELDS}")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.long_fields(_header(spark, sf_dir), H.MANDATORY).select("doc_id", "field", "value")


@query(f"SELECT d.doc_id, a.field FROM {_DOCS} d CROSS JOIN {_ASKED} a ANTI JOIN {_FIELDS} f ON d.doc_id = f.doc_id AND a.field = f.field")
def mandatory_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.mandatory_missing(_header(spark, sf_dir))


@query(
    f"""SELECT d.doc_id, 7 AS total_fields_validated, CAST(7 - count(DISTINCT f.field) AS INT) AS missing_count, coalesce(string_agg(f.field, ',' ORDER BY f.field) FILTER (confidence < 0.7 AND f.field <> 'part_line_number'), '') AS suspicious
FROM {_DOCS} d LEFT JOIN {_FIELDS} f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""
)
def mandatory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.mandatory_report(_header(spark, sf_dir))
    low = F.filter("suspicious_fields", lambda n: n != "part_line_number")  # its source differs by document; see part_line and sticker
    return report.select("doc_id", "total_fields_validated", "missing_count", F.array_join(low, ",").alias("suspicious"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stand-in for the outcomes of files: one for each document, some of them failed."""
    by = detections(spark, sf_dir).groupBy("doc_id").agg((F.count("*") / 10).alias("seconds"))
    return by.withColumn("status", F.when(F.col("doc_id") % 7 == 3, "failed").otherwise("ok"))


@query(
    f"""{_DET}, r AS (SELECT doc_id, count(*) / 10.0::DOUBLE AS seconds, doc_id % 7 <> 3 AS ok FROM det GROUP BY doc_id)
SELECT count(*) AS total_files, CAST(count_if(ok) AS BIGINT) AS successful, CAST(count_if(NOT ok) AS BIGINT) AS failed, round(sum(seconds), 6) AS total_seconds, round(avg(seconds), 6) AS average_seconds FROM r"""
)
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = quality.batch_totals(_results(spark, sf_dir))
    return totals.withColumns({c: F.round(c, 6) for c in ("total_seconds", "average_seconds")})


@query(
    f"""{_DET}, r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN 'failed' ELSE 'ok' END AS status FROM det GROUP BY doc_id)
SELECT r.doc_id, r.status, f.value AS control_type, coalesce(f.confidence, 0) AS confidence, coalesce(f.confidence < 0.7, false) AS suspicious
FROM r LEFT JOIN ({ORACLE_SQL["control_type"]}) f ON r.doc_id = f.doc_id"""
)
def summary_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = quality.with_required_fields(_results(spark, sf_dir), _header(spark, sf_dir))
    return joined.select("doc_id", "status", F.col("control_type.value").alias("control_type"), "control_type.confidence", "control_type.suspicious")


@query(
    f"""SELECT d.doc_id, CAST(coalesce(f.n, 0) AS INT) AS header_fields, CAST(coalesce(b.blocks, 0) AS INT) AS defect_blocks, CAST(coalesce(b.rows, 0) AS INT) AS defect_rows, CAST(coalesce(a.n, 0) AS INT) AS analysis_rows FROM {_DOCS} d
LEFT JOIN (SELECT doc_id, count(DISTINCT field) AS n FROM {_FIELDS} GROUP BY doc_id) f ON d.doc_id = f.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS blocks, sum(data_rows) AS rows FROM ({ORACLE_SQL["defect_blocks"]}) GROUP BY doc_id) b ON d.doc_id = b.doc_id
LEFT JOIN (SELECT doc_id, count(*) AS n FROM ({ORACLE_SQL["analysis_rows"]}) GROUP BY doc_id) a ON d.doc_id = a.doc_id"""
)
def extraction_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formloom.plans.pipeline import extract

    return extract(detections(spark, sf_dir)).select(
        "doc_id", F.col("metrics.header_fields").alias("header_fields"), F.col("metrics.defect_blocks").alias("defect_blocks"),
        F.col("metrics.defect_rows").alias("defect_rows"), F.col("metrics.analysis_rows").alias("analysis_rows"),
    )
