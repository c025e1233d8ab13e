"""Table templates: names for the columns of a form's grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column names by template, from the left.
COLUMNS = {
    "otk_v1": ["row_number", "parameter", "norm", "actual", "decision", "notes"],
    "otk_v2": ["row_number", "parameter", "fact_value", "deviation", "quantity"],
}


def columns(spark: SparkSession, name: str) -> DataFrame:
    """(col_idx, field_name) of a template; none for an unknown name."""
    return spark.createDataFrame(list(enumerate(COLUMNS.get(name, []))), "col_idx int, field_name string")
