"""Queries over the synthetic detections and the driver's tables, each beside its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import rules as R
from formloom.functions import text as T
from formloom.functions.dictionary import EXACT, FOLDED
from formloom.operators import anchors as A
from formloom.operators import header as H
from formloom.operators import layout as L
from formloom.operators import lookup, quality, sections
from formloom.sources.detections import DETECTIONS_SQL, detections

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_VALUES = lambda pairs: ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in pairs.items())

_DET = f"WITH RECURSIVE {DETECTIONS_SQL}"
_H = _DET + ", h AS (SELECT * FROM det WHERE region_id = 'header')"
_Z = _DET + ", z AS (SELECT * FROM det WHERE region_id = 'analysis')"
_CORRECTED = (
    _DET
    + f""", exact(k, v) AS (VALUES {_VALUES(EXACT)}), folded(k, v) AS (VALUES {_VALUES(FOLDED)}),
corrected AS (
  SELECT det.*, coalesce(e.v, f.v) AS found FROM det LEFT JOIN exact e ON text = e.k LEFT JOIN folded f ON lower(text) = f.k
)"""
)


# correction


@query(_CORRECTED + " SELECT doc_id, det_idx, coalesce(found, text) AS text, CASE WHEN found IS NOT NULL THEN text END AS original_text, found IS NOT NULL AS corrected FROM corrected")
def correction_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.correct(detections(spark, sf_dir)).select("doc_id", "det_idx", "text", "original_text", "corrected")


@query(_CORRECTED + " SELECT doc_id, count(*) AS texts, count(found) AS corrections, count(found) / CAST(count(*) AS DOUBLE) AS rate FROM corrected GROUP BY doc_id")
def correction_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.correction_rate(lookup.correct(detections(spark, sf_dir)))


@query(_CORRECTED + " SELECT doc_id, det_idx AS index, text AS original, found AS corrected_text, confidence, cx, cy FROM corrected WHERE found IS NOT NULL")
def correction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = lookup.correction_log(lookup.correct(detections(spark, sf_dir)))
    return log.select("doc_id", "index", "original", "corrected_text", "confidence", log["position"][0].alias("cx"), log["position"][1].alias("cy"))


@query(
    f"""WITH exact(k, v) AS (VALUES {_VALUES(EXACT)}), folded(k, v) AS (VALUES {_VALUES(FOLDED)}),
tokens AS (SELECT item_id, unnest(string_split(text || ' Homep дата', ' ')) AS token FROM benchmark)
SELECT item_id, count(*) AS tokens, count(coalesce(e.v, f.v)) AS corrections
FROM tokens LEFT JOIN exact e ON token = e.k LEFT JOIN folded f ON lower(token) = f.k GROUP BY item_id"""
)
def token_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", F.explode(F.split(F.concat("text", F.lit(" Homep дата")), " ")).alias("token"))
    return lookup.correct(words, "token").groupBy("item_id").agg(F.count("*").alias("tokens"), F.count_if("corrected").alias("corrections"))


# rules

_TRIM = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
_TYPE = (
    "CASE "
    + " ".join(f"WHEN regexp_matches({_TRIM}, {_quoted(r.pattern)}) THEN '{n}'" for n, r in R.RULES.items() if r.pattern)
    + " ELSE 'text' END"
)


@query(_DET + f" SELECT doc_id, det_idx, {_TYPE} AS field_type FROM det")
def infer_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).select("doc_id", "det_idx", R.infer_type(F.col("text")).alias("field_type"))


_TYPES = list(R.RULES)


@query(
    _DET
    + f""", asked AS (SELECT *, ['{"', '".join(_TYPES)}'][det_idx % {len(_TYPES)} + 1] AS field_type FROM det)
SELECT doc_id, det_idx, field_type, CASE
  WHEN text = '' THEN CASE WHEN field_type IN ('act_number', 'date') THEN 'Required field is missing' END
  WHEN field_type = 'act_number' AND NOT regexp_matches(text, '^\\d+/\\d+$') THEN 'Value does not match expected pattern. Example: 001/2025'
  WHEN field_type = 'date' AND NOT regexp_matches(text, '^\\d{{1,2}}\\.\\d{{1,2}}\\.\\d{{4}}$') THEN 'Value does not match expected pattern. Example: 15.10.2025'
  WHEN field_type = 'revision' AND NOT regexp_matches(text, '^\\d{{2}}$') THEN 'Value does not match expected pattern. Example: 01'
  WHEN field_type = 'quantity' AND NOT regexp_matches(text, '^\\d+$') THEN 'Value does not match expected pattern. Example: 10'
  WHEN field_type = 'measurement' AND NOT regexp_matches(text, '^\\d+\\.?\\d*$') THEN 'Value does not match expected pattern. Example: 100.05'
  WHEN field_type = 'measurement_with_tolerance' AND NOT regexp_matches(text, '^\\d+\\.?\\d*[±]\\d+\\.?\\d*$') THEN 'Value does not match expected pattern. Example: 100±0.1'
  WHEN field_type = 'status' AND lower(text) NOT IN ('годен', 'брак', 'доработать', 'утилизировать') THEN 'Value must be one of: годен, брак, доработать, утилизировать'
  WHEN field_type = 'defect_code' AND NOT regexp_matches(text, '^[А-ЯA-Z]\\d{{3,}}$') THEN 'Value does not match expected pattern. Example: Д001'
  WHEN field_type = 'inspector' AND NOT regexp_matches(text, '^[А-Яа-я\\s]+\\s+[А-Я]\\.[А-Я]\\.$') THEN 'Value does not match expected pattern. Example: Иванов И.И.'
END AS violation FROM asked"""
)
def validate_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = detections(spark, sf_dir).withColumn("field_type", F.element_at(F.array(*map(F.lit, _TYPES)), F.col("det_idx") % len(_TYPES) + 1))
    return asked.select("doc_id", "det_idx", "field_type", R.violation(F.col("text"), F.col("field_type")).alias("violation"))


@query(
    _DET
    + """ SELECT doc_id, det_idx, confidence >= 0.7 AS critical_ok, confidence >= 0.5 AS high_ok, confidence >= 0.3 AS normal_ok,
CASE WHEN confidence < 0.5 THEN printf('Below recommended confidence for field: %.2f', confidence) ELSE '' END AS normal_message FROM det"""
)
def confidence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("confidence")
    return detections(spark, sf_dir).select(
        "doc_id", "det_idx", *(R.confidence_check(c, k).acceptable.alias(f"{k}_ok") for k in ("critical", "high", "normal")), R.confidence_check(c).message.alias("normal_message")
    )


@query(
    _DET
    + """ SELECT doc_id, count(*) AS total_fields, CAST(count_if(text <> '') AS BIGINT) AS validated_fields, CAST(0 AS BIGINT) AS failed_validations,
count_if(text <> '') / CAST(count(*) AS DOUBLE) AS validation_rate, CAST(count_if(text <> '' AND confidence < 0.5) AS BIGINT) AS warnings FROM det GROUP BY doc_id"""
)
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validation_summary(quality.validated(detections(spark, sf_dir))).drop("errors")


@query(
    _DET
    + """ SELECT doc_id, region_id, count(*) AS texts, round(avg(confidence), 9) AS average_confidence, CAST(count_if(confidence < 0.5 * 1.2) AS BIGINT) AS low_confidence
FROM det WHERE confidence >= 0.5 GROUP BY doc_id, region_id"""
)
def region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.confidence_stats(quality.keep_confident(detections(spark, sf_dir)), ["doc_id", "region_id"]).withColumn("average_confidence", F.round("average_confidence", 9))


@query(
    _DET
    + """, bands(region_id, lo, hi) AS (VALUES ('header', 0.0::DOUBLE, 0.33::DOUBLE), ('defects', 0.33::DOUBLE, 0.66::DOUBLE), ('analysis', 0.66::DOUBLE, 1.0::DOUBLE)),
pixels AS (SELECT region_id AS band, CAST(round_even(3508 * lo, 0) AS INT) AS y_start, CAST(round_even(3508 * hi, 0) AS INT) AS y_end FROM bands)
SELECT band, y_start, y_end, count(*) AS texts FROM det JOIN pixels ON cy >= y_start AND cy < y_end GROUP BY ALL"""
)
def band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from formloom.sources.templates import bands, template

    spans = bands(template(spark, "otk_v1"), F.lit(G.PAGE_HEIGHT))
    return (
        detections(spark, sf_dir).join(F.broadcast(spans), (F.col("cy") >= F.col("y_start")) & (F.col("cy") < F.col("y_end")))
        .groupBy(F.col("band"), "y_start", "y_end").agg(F.count("*").alias("texts"))
    )


# scalars


@query(
    _DET
    + r""", one AS (SELECT doc_id, det_idx, text, regexp_replace(regexp_replace(text, '([0-9])[Il|∣]([0-9])', '\1/\2', 'g'), '([0-9])[Il|∣]([0-9])', '\1/\2', 'g') AS s FROM det),
two AS (SELECT *, CASE WHEN regexp_matches(s, '\d') THEN translate(s, 'OSZgЗОБ', '0529308') ELSE s END AS t FROM one)
SELECT doc_id, det_idx, lpad(regexp_extract(t, '^(\d{1,3})/(\d{1,2})$', 1), 3, '0') || '/' || lpad(regexp_extract(t, '^(\d{1,3})/(\d{1,2})$', 2), 2, '0') AS value, t <> text AS corrected
FROM two WHERE regexp_matches(t, '^\d{1,3}/\d{1,2}$')"""
)
def blank_number_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = detections(spark, sf_dir).withColumn("n", T.blank_number(F.col("text"))).where("n is not null")
    return made.select("doc_id", "det_idx", "n.value", "n.corrected")


@query(
    _DET
    + r""", p AS (SELECT doc_id, det_idx, list_concat(regexp_extract_all(text, '\d+'), CASE det_idx % 3 WHEN 0 THEN ['25'] WHEN 1 THEN ['7', '20', '24'] ELSE [] END) AS parts FROM det),
y AS (SELECT *, CASE WHEN length(parts[3]) = 4 THEN parts[3] WHEN len(parts) >= 4 THEN parts[3] || parts[4] ELSE parts[3] END AS year,
  CASE WHEN len(parts) < 3 THEN '2025' WHEN length(parts[3]) = 2 THEN '20' || parts[3] WHEN length(parts[3]) = 4 THEN parts[3]
       WHEN len(parts) >= 4 THEN parts[3] || parts[4] WHEN length(parts[3]) >= 2 THEN '20' || parts[3][1:2] ELSE '2025' END AS cell_year FROM p),
made AS (SELECT *, CASE WHEN len(parts) >= 2 THEN (CASE WHEN length(parts[1]) < 2 THEN '0' || parts[1] ELSE parts[1] END) || '/' || (CASE WHEN length(parts[2]) < 2 THEN '0' || parts[2] ELSE parts[2] END) END AS dm FROM y)
SELECT doc_id, det_idx, CASE WHEN len(parts) >= 3 THEN dm || '/' || CASE WHEN length(year) = 2 THEN '20' || year ELSE year END END AS plain,
  CASE WHEN regexp_matches(dm || '/' || cell_year, '^\d{2}/\d{2}/\d{4}$') AND CAST(dm[1:2] AS INT) BETWEEN 1 AND 31 AND CAST(dm[4:5] AS INT) BETWEEN 1 AND 12
        AND CAST(cell_year AS INT) BETWEEN 2000 AND 2100 THEN dm || '/' || cell_year END AS cells FROM made"""
)
def date_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.when(F.col("det_idx") % 3 == 0, F.array(F.lit("25"))).when(F.col("det_idx") % 3 == 1, F.array(F.lit("7"), F.lit("20"), F.lit("24"))).otherwise(F.array().cast("array<string>"))
    parts = detections(spark, sf_dir).withColumn("parts", F.concat(T.integers(F.col("text")), more))
    return parts.select("doc_id", "det_idx", T.date_of_parts(F.col("parts")).alias("plain"), T.date_of_cells(F.col("parts")).alias("cells"))


@query(
    _DET
    + r""", d AS (SELECT doc_id, det_idx, CAST(det_idx % 33 AS STRING) || '.' || CAST(det_idx % 14 AS STRING) || '.2025' AS day, text FROM det)
SELECT doc_id, det_idx, CASE WHEN det_idx % 14 NOT BETWEEN 1 AND 12 THEN 'Invalid month: ' || (det_idx % 14) WHEN det_idx % 33 NOT BETWEEN 1 AND 31 THEN 'Invalid day: ' || (det_idx % 33)
  WHEN try_cast('2025-' || lpad(CAST(det_idx % 14 AS STRING), 2, '0') || '-' || lpad(CAST(det_idx % 33 AS STRING), 2, '0') AS DATE) IS NULL THEN 'Invalid date: day is out of range for month' END AS date_message,
  CASE WHEN NOT regexp_matches(text, '^\d+\.?\d*$') THEN 'Must be a valid number' END AS number_message,
  CASE WHEN NOT regexp_matches(text, '^\d+$') THEN 'Must be a valid integer' END AS integer_message FROM d"""
)
def value_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.concat((F.col("det_idx") % 33).cast("string"), F.lit("."), (F.col("det_idx") % 14).cast("string"), F.lit(".2025"))
    made = detections(spark, sf_dir).withColumn("day", day)
    return made.select(
        "doc_id", "det_idx", T.check_dotted_date(F.col("day")).message.alias("date_message"),
        T.check_number(F.col("text")).message.alias("number_message"), T.check_number(F.col("text"), False).message.alias("integer_message"),
    )


@query(
    _DET
    + """ SELECT doc_id, det_idx, CAST(trunc(2.9D / 100 * height) AS INT) AS dy, CAST(trunc(cx * 1.5::DOUBLE) AS INT) + 3 AS left_x, CAST(trunc(y0 * 1.5::DOUBLE) AS INT) + 7 AS top_y,
CAST(trunc((2 * CAST(trunc(cx * 1.5::DOUBLE) AS INT) + 2 * CAST(trunc(x1 * 1.5::DOUBLE) AS INT) + 12) / 4.0) AS INT) AS center_x,
round(cx / CAST(width AS DOUBLE) * 100, 9) AS x_percent FROM det""".replace("2.9D / 100", "(2.9::DOUBLE / 100)")
)
def geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = F.array(F.array("cx", "y0"), F.array("x1", "y0"), F.array("x1", "y1"), F.array("cx", "y1"))
    moved = detections(spark, sf_dir).withColumn("p", G.rescale_polygon(box, F.lit(1.5), F.lit(3), F.lit(7)))
    return moved.select(
        "doc_id", "det_idx", G.pixels(2.9, F.col("height")).alias("dy"), F.col("p.polygon")[0][0].alias("left_x"), F.col("p.polygon")[0][1].alias("top_y"),
        F.col("p.center")[0].alias("center_x"), F.round(G.percent(F.col("cx"), F.col("width")), 9).alias("x_percent"),
    )


# anchors

_SAME = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in ("text", "confidence", "cx", "cy", "x0", "y0", "x1", "y1"))


def _anchor(name: str, table: str, word: str) -> str:
    return f"{name} AS (SELECT * FROM {table} WHERE contains(lower(text), '{word}') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY det_idx) = 1)"


def _below(name: str, table: str, at: str) -> str:
    return f"""{name} AS (SELECT d.*, row_number() OVER (PARTITION BY d.doc_id ORDER BY abs(d.y0 - a.y1), d.det_idx) AS place
  FROM {table} d JOIN {at} a ON d.doc_id = a.doc_id AND d.y0 - a.y1 BETWEEN -10 AND 101 AND abs(d.cx - a.cx) <= 49 AND NOT ({_SAME("d", "a")}))"""


def _listed(spark: SparkSession, sf_dir: str, make: Callable[[Column, Column, Column], Column]) -> DataFrame:
    found = A.pages(detections(spark, sf_dir)).select("doc_id", F.posexplode(make(F.col("header"), F.col("width"), F.col("height"))).alias("place", "d"))
    return found.select("doc_id", (F.col("place") + 1).alias("place"), F.col("d.i").alias("det_idx"), "d.text")


@query(f"{_H}, {_anchor('a', 'h', 'номер')}, {_below('b', 'h', 'a')} SELECT doc_id, CAST(place AS INT) AS place, det_idx, text FROM b")
def anchor_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, lambda h, w, t: A.below(h, A.anchor(h, "Номер"), t, G.pixels(2.9, t), G.pixels(2.0, w)))


@query(
    f"""{_H}, pairs AS (SELECT d.doc_id, d.det_idx, d.text, d.x0 - a.x1 AS gap, a.det_idx AS spot FROM h d JOIN h a ON d.doc_id = a.doc_id AND contains(lower(a.text), 'проверено')
  AND d.x0 - a.x1 > 0 AND d.x0 - a.x1 <= 297 AND abs(d.cy - a.cy) <= 52 AND NOT ({_SAME("d", "a")}))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY gap, spot, det_idx) AS INT) AS place, det_idx, text FROM pairs"""
)
def anchor_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, lambda h, w, t: A.right_of_any(h, "ПРОВЕРЕНО", G.pixels(12.0, w), G.pixels(1.5, t)))


@query(
    f"""{_H}, {_anchor('a', 'h', 'наименование')}
SELECT d.doc_id, CAST(row_number() OVER (PARTITION BY d.doc_id ORDER BY d.det_idx) AS INT) AS place, d.det_idx, d.text FROM h d JOIN a ON d.doc_id = a.doc_id
AND abs(d.cy - a.cy) < 30 AND d.cx > a.cx + 20 AND d.cx < a.cx + 400"""
)
def anchor_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, lambda h, w, t: F.when(A.anchor(h, "наименование").isNotNull(), A.near(h, A.anchor(h, "наименование"), 20, 400, 30)))


_BESIDE = "(d.cy > a.cy + 21 AND d.cy < a.cy + 150 AND (abs(d.cx - a.cx) < 198 OR (d.cx > a.x1 + 49 AND d.cx < a.x1 + 396)))"


@query(
    f"""{_H}, {_anchor('a', 'h', 'контролер')}
SELECT d.doc_id, CAST(row_number() OVER (PARTITION BY d.doc_id ORDER BY d.det_idx) AS INT) AS place, d.det_idx, d.text FROM h d JOIN a ON d.doc_id = a.doc_id AND {_BESIDE}"""
)
def anchor_below_or_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir, lambda h, w, t: F.when(A.anchor(h, "контролер").isNotNull(), A.below_or_right(h, A.anchor(h, "контролер"), w, t)))


# header fields


def _field(spark: SparkSession, sf_dir: str, make: Callable[[Column, Column, Column], Column]) -> DataFrame:
    made = A.pages(detections(spark, sf_dir)).select("doc_id", make(F.col("header"), F.col("width"), F.col("height")).alias("f")).where("f is not null")
    return made.select("doc_id", "f.value", F.round("f.confidence", 9).alias("confidence"))


_FIRST = "QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {}) = 1"


@query(rf"{_H}, {_anchor('a', 'h', 'номер')}, {_below('b', 'h', 'a')} SELECT doc_id, regexp_extract(text, '^\d+') AS value, confidence FROM b WHERE regexp_matches(text, '^\d') {_FIRST.format('place')}")
def act_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.act_number)


@query(
    rf"{_H}, {_anchor('a', 'h', 'рев')}, {_below('b', 'h', 'a')} SELECT doc_id, regexp_extract(text, '([A-ZА-Я])\s*(\d+)', 1) || regexp_extract(text, '([A-ZА-Я])\s*(\d+)', 2) AS value, confidence "
    rf"FROM b WHERE regexp_matches(text, '[A-ZА-Я]\s*\d+') {_FIRST.format('place')}"
)
def template_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.template_revision)


_LIST = r"SELECT doc_id, list(n ORDER BY cx, det_idx, k) AS parts FROM (SELECT doc_id, cx, det_idx, unnest(regexp_extract_all(text, '\d+')) AS n, generate_subscripts(regexp_extract_all(text, '\d+'), 1) AS k FROM p) GROUP BY doc_id"
_PAD = lambda x: f"CASE WHEN length({x}) < 2 THEN '0' || {x} ELSE {x} END"


@query(
    rf"""{_H}, {_anchor('a', 'h', 'номер')}, {_anchor('d', 'h', 'дата')}, {_anchor('r', 'h', 'рев')},
p AS (SELECT x.* FROM h x JOIN d ON x.doc_id = d.doc_id LEFT JOIN a ON x.doc_id = a.doc_id LEFT JOIN r ON x.doc_id = r.doc_id
  WHERE regexp_matches(x.text, '\d') AND abs(x.cy - d.cy) < 70 AND x.cx > coalesce(a.cx, 0) AND x.cx < coalesce(r.cx, 2480)
  AND NOT ({_SAME("x", "d")}) AND NOT coalesce({_SAME("x", "a")}, false) AND NOT coalesce({_SAME("x", "r")}, false)),
l AS ({_LIST}), c AS (SELECT doc_id, avg(confidence) AS confidence FROM p GROUP BY doc_id),
y AS (SELECT *, CASE WHEN length(parts[3]) = 4 THEN parts[3] WHEN len(parts) >= 4 THEN parts[3] || parts[4] ELSE parts[3] END AS year FROM l WHERE len(parts) >= 3)
SELECT doc_id, ({_PAD("parts[1]")}) || '/' || ({_PAD("parts[2]")}) || '/' || CASE WHEN length(year) = 2 THEN '20' || year ELSE year END AS value, round(confidence, 9) AS confidence FROM y JOIN c USING (doc_id)"""
)
def act_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.act_date)


@query(
    rf"""{_H}, {_anchor('k', 'h', 'кол-во')}, pairs AS (SELECT d.*, a.det_idx AS spot, d.x0 - a.x1 AS gap FROM h d JOIN h a ON d.doc_id = a.doc_id AND contains(lower(a.text), 'проверено')
  AND d.x0 - a.x1 > 0 AND d.x0 - a.x1 <= 297 AND abs(d.cy - a.cy) <= 52 AND NOT ({_SAME("d", "a")}) AND regexp_matches(d.text, '^\d+$'))
SELECT p.doc_id, p.text AS value, p.confidence FROM pairs p LEFT JOIN k ON p.doc_id = k.doc_id WHERE k.cx IS NULL OR abs(p.cx - k.cx) < 99
QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY spot, gap, p.det_idx) = 1"""
)
def quantity_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, lambda h, w, t: H.quantity(h, w, t, "ПРОВЕРЕНО"))


_MARKED = " OR ".join(f"contains(lower(text), '{m}')" for m in H.MARKS)
_TYPED = "(" + " OR ".join(f"contains(lower(o.text), '{m}')" for m in H.CONTROL_TYPES) + ")"


@query(
    f"""{_H}, c AS (SELECT d.doc_id, d.det_idx AS spot, 0 AS own, o.det_idx, o.text, o.confidence FROM h d JOIN h o ON d.doc_id = o.doc_id AND abs(o.cy - d.cy) < 50 AND {_TYPED} WHERE ({_MARKED.replace("text", "d.text")})
  UNION ALL SELECT doc_id, det_idx, 1, det_idx, text, confidence FROM h o WHERE {_TYPED})
SELECT doc_id, CASE WHEN contains(lower(text), 'операционный') THEN 'операционный' WHEN contains(lower(text), 'входной') THEN 'входной' ELSE 'выходной' END AS value, confidence FROM c {_FIRST.format("spot, own, det_idx")}"""
)
def control_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, lambda h, w, t: H.control_type(h))


_LABELS = "(" + " OR ".join(f"contains(lower(a.text), '{m}')" for m in H.INSPECTOR_WORDS) + ")"


@query(
    rf"""{_H}, n AS (SELECT d.*, a.det_idx AS spot, string_split_regex(d.text, '\s+') AS words FROM h d JOIN h a ON d.doc_id = a.doc_id AND {_LABELS} AND {_BESIDE} WHERE d.text <> ''),
c AS (SELECT doc_id, text, spot, det_idx, CASE WHEN length(text) >= 2 AND NOT regexp_matches(text, '^\d+$') AND confidence >= 0.4 AND len(words) BETWEEN 1 AND 4 AND len(list_filter(words, lambda x: regexp_matches(x, '^\p{{L}}+$'))) > 0
        THEN 0 WHEN length(text) >= 2 AND confidence >= 0.3 AND len(list_filter(words, lambda x: regexp_matches(x, '^\p{{L}}+$'))) > 0 THEN 1 END AS tier,
      confidence * CASE WHEN len(list_filter(words, lambda x: regexp_matches(x, '^\p{{Lu}}'))) > 0 THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS high, confidence * 0.9::DOUBLE AS low FROM n)
SELECT doc_id, text AS value, round(CASE tier WHEN 0 THEN high ELSE low END, 9) AS confidence FROM c WHERE tier IS NOT NULL {_FIRST.format("tier, CASE tier WHEN 0 THEN high ELSE low END DESC, spot, det_idx")}"""
)
def inspector_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.inspector)


@query(
    rf"""{_H}, a AS (SELECT * FROM h WHERE contains(lower(text), 'строка')), v AS (
  SELECT doc_id, det_idx AS spot, -1 AS det_idx, regexp_extract(text, '\d+') AS value, confidence FROM a WHERE regexp_matches(text, '\d')
  UNION ALL SELECT a.doc_id, a.det_idx, d.det_idx, d.text, d.confidence FROM a JOIN h d ON d.doc_id = a.doc_id AND abs(d.cy - a.cy) < 30 AND d.cx > a.cx + 20 AND d.cx < a.cx + 200 AND regexp_matches(d.text, '^\d+$'))
SELECT doc_id, value, confidence FROM v {_FIRST.format("spot, det_idx")}"""
)
def part_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, lambda h, w, t: H.part_line(h))


def _labelled_sql(words: list[str], longer: int) -> str:
    had = " OR ".join(f"contains(lower(a.text), '{w}')" for w in words)
    return f"""{_H}, v AS (SELECT a.doc_id, a.det_idx AS spot, d.text AS value, d.confidence FROM h a JOIN h d ON d.doc_id = a.doc_id AND ({had}) AND abs(d.cy - a.cy) < 30 AND d.cx > a.cx + 20 AND d.cx < a.cx + 400
  QUALIFY row_number() OVER (PARTITION BY a.doc_id, a.det_idx ORDER BY d.det_idx) = 1)
SELECT doc_id, value, confidence FROM v WHERE length(value) > {longer} {_FIRST.format("spot")}"""


@query(_labelled_sql(["обозначение", "изделие"], 2))
def part_designation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, lambda h, w, t: H.labelled(h, ["обозначение", "изделие"], 2))


@query(_labelled_sql(["наименование"], 1))
def part_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, lambda h, w, t: H.labelled(h, ["наименование"], 1))


_STICKER = " OR ".join(f"contains(lower(text), '{w}')" for w in H.STICKER_WORDS)


@query(
    rf"""{_H}, g AS (SELECT *, lower(text) AS t FROM h WHERE {_STICKER}), s AS (SELECT doc_id,
  arg_max(regexp_extract(t, 'строка[:\s]*(\d+)', 1), det_idx) FILTER (regexp_matches(t, 'строка[:\s]*\d')) AS part_line_number,
  arg_max(regexp_extract(text, '\d+'), det_idx) FILTER (contains(t, 'заказа') AND regexp_matches(text, '\d')) AS order_number,
  arg_max(regexp_extract(text, '\d+\.\d+\.\d+'), det_idx) FILTER (contains(t, 'дата') AND regexp_matches(text, '\d{{1,2}}[.\s]\d{{1,2}}[.\s]\d{{4}}')) AS order_date,
  arg_max(trim(regexp_extract(t, 'клиент[:\s]+(.+)', 1)), det_idx) FILTER (regexp_matches(t, 'клиент[:\s]+.')) AS client
  FROM g GROUP BY doc_id HAVING count(*) >= 2 AND max(cx) - min(cx) <= 396 AND max(cy) - min(cy) <= 298)
SELECT * FROM s WHERE part_line_number IS NOT NULL"""
)
def sticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = A.pages(detections(spark, sf_dir)).select("doc_id", H.sticker(F.col("header"), F.col("width"), F.col("height")).alias("s")).where("s is not null")
    return made.select("doc_id", *(F.col(f"s.{n}.value").alias(n) for n in ("part_line_number", "order_number", "order_date", "client")))


_CORNER = f"{_H}, k AS (SELECT * FROM h WHERE cx / 2480.0::DOUBLE * 100 BETWEEN 70 AND 100 AND cy / 3508.0::DOUBLE * 100 BETWEEN 0 AND 8)"


@query(
    rf"""{_CORNER}, {_anchor('a', 'k', 'номер')}, {_below('b', 'k', 'a')}, p AS (SELECT *, first_value(cy) OVER (PARTITION BY doc_id ORDER BY place) AS y FROM b WHERE confidence >= 0.4 AND regexp_matches(text, '\d')),
j AS (SELECT doc_id, string_agg(text, '' ORDER BY place) AS joined, avg(confidence) AS confidence FROM p WHERE abs(cy - y) <= 175 GROUP BY doc_id),
i AS (SELECT doc_id, confidence, CASE WHEN regexp_matches(joined, '^\d{{3}}\d{{1,2}}$') THEN joined[1:3] || '/' || joined[4:] ELSE joined END AS joined FROM j),
t AS (SELECT doc_id, confidence, regexp_replace(regexp_replace(joined, '([0-9])[Il|∣]([0-9])', '\1/\2', 'g'), '([0-9])[Il|∣]([0-9])', '\1/\2', 'g') AS s FROM i),
u AS (SELECT doc_id, confidence, CASE WHEN regexp_matches(s, '\d') THEN translate(s, 'OSZgЗОБ', '0529308') ELSE s END AS n FROM t)
SELECT doc_id, lpad(regexp_extract(n, '^(\d+)/(\d+)$', 1), 3, '0') || '/' || lpad(regexp_extract(n, '^(\d+)/(\d+)$', 2), 2, '0') AS value, round(confidence, 9) AS confidence FROM u WHERE regexp_matches(n, '^\d{{1,3}}/\d{{1,2}}$')"""
)
def form_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.form_number)


@query(
    rf"""{_CORNER}, {_anchor('a', 'k', 'дата')}, {_below('b', 'k', 'a')}, p AS (SELECT * FROM b WHERE confidence >= 0.4 AND regexp_matches(text, '\d')), l AS ({_LIST}),
c AS (SELECT doc_id, avg(confidence) AS confidence FROM (SELECT doc_id, confidence, unnest(regexp_extract_all(text, '\d+')) FROM p) GROUP BY doc_id),
y AS (SELECT *, CASE WHEN len(parts) < 3 THEN '2025' WHEN length(parts[3]) = 2 THEN '20' || parts[3] WHEN length(parts[3]) = 4 THEN parts[3] WHEN len(parts) >= 4 THEN parts[3] || parts[4]
  WHEN length(parts[3]) >= 2 THEN '20' || parts[3][1:2] ELSE '2025' END AS year FROM l WHERE len(parts) >= 2),
v AS (SELECT doc_id, ({_PAD("parts[1]")}) || '/' || ({_PAD("parts[2]")}) || '/' || year AS value FROM y)
SELECT doc_id, value, round(confidence, 9) AS confidence FROM v JOIN c USING (doc_id) WHERE regexp_matches(value, '^\d{{2}}/\d{{2}}/\d{{4}}$')
AND CAST(value[1:2] AS INT) BETWEEN 1 AND 31 AND CAST(value[4:5] AS INT) BETWEEN 1 AND 12 AND CAST(value[7:10] AS INT) BETWEEN 2000 AND 2100"""
)
def form_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _field(spark, sf_dir, H.form_date)
