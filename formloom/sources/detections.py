"""A synthetic table of detections, made from ``lineitem``.

The driver's tables hold no scanned forms. This adapter gives each line item a text, a place on a
page of 2480 x 3508 and a confidence, by fixed rules that SQL engines agree on, so that queries over
forms can be compared between engines. A document is 32 order keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_Q = "CAST(CAST(floor(l_quantity) AS INT) AS STRING)"

#: SQL for the text of each kind of detection, by number.
TEXTS = [
    "'Homep'", "'Дата'", "'Рев'", "'ПРОВЕРЕНО'", "'годн'", "'Контролер'", f"'Строка: ' || {_Q}", "'A' || CAST(l_linenumber AS STRING)",
    "lpad(CAST(l_partkey % 1000 AS STRING), 3, '0') || '/25'", "lpad(CAST(l_partkey % 1000 AS STRING), 3, '0') || 'I25'", "'Иванов И.И.'", f"{_Q} || '.5'",
    "'15.10.2025'", "'ГЕОМЕТРИЯ'", f"'не использовать ' || {_Q}", "'входной'", "''", "'Длина'", _Q, _Q, "'Номер'", "'КОЛ-ВО'", "'Наименование'", "'Обозначение'",
    "'Кронштейн'", "'Руководитель'", "'Представитель ОТК'", "'использовать'", f"'доработать ' || {_Q}", "'дата: 10.10.2025'", "'№ заказа ' || CAST(l_suppkey AS STRING)",
    "'Клиент: ООО Ромашка'", "'☑'", "'поверхность'", "'2025'", "'Петрова'",
    "'Номер'", "'101/25'", "'Номер'", "'12I24'",
]

#: The adapter as common table expressions ``base`` and ``det``; the same text runs on Spark and DuckDB.
DETECTIONS_SQL = f"""
base AS (
  SELECT *, CAST((l_orderkey - l_orderkey % 32) / 32 AS BIGINT) AS doc_id,
         CAST((l_partkey * 37 + l_linenumber * 5) % 13 AS INT) AS c, CAST((l_suppkey * 53 + l_orderkey * 19) % 39 AS INT) AS r,
         CAST((l_partkey * 7 + l_suppkey * 3 + l_linenumber) % {len(TEXTS)} AS INT) AS kind, 10 + CAST(floor(l_quantity) AS INT) AS hw
  FROM lineitem
), placed AS (
  SELECT *, CASE WHEN r < 13 THEN 1740 + 60 * c ELSE 60 + 14 * c * c END AS cx, r * 88 + 44 AS cy FROM base
), det AS (
  SELECT doc_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
              l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INT) AS det_idx,
         CASE kind {" ".join(f"WHEN {k} THEN {t}" for k, t in enumerate(TEXTS))} END AS text,
         CAST(30 + (l_partkey * 7 + l_linenumber * 13) % 70 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence,
         cx, cy, cx - hw AS x0, cy - 10 AS y0, cx + hw AS x1, cy + 10 AS y1,
         CASE WHEN r < 13 THEN 'header' WHEN r < 26 THEN 'defects' ELSE 'analysis' END AS region_id, 2480 AS width, 3508 AS height
  FROM placed
)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, det_idx, text, confidence, cx, cy, x0, y0, x1, y1, region_id, width, height."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(f"WITH {DETECTIONS_SQL.replace('FROM lineitem', 'FROM {lineitem}')} SELECT * FROM det", lineitem=lineitem)
