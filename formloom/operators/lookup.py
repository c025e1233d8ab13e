"""Correction of recognised text by dictionaries, as broadcast joins with fixed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.dictionary import EXACT, FOLDED


def _side(spark, pairs: dict[str, str], key: str, value: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string"))  # tens of rows, fixed


def replacement(text: Column) -> Column:
    """What the dictionaries have for a text, or null: for texts inside arrays, where no join reaches."""
    table = lambda pairs: F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return F.coalesce(F.try_element_at(table(EXACT), text), F.try_element_at(table(FOLDED), F.lower(text)))


def correct(detections: DataFrame, column: str = "text") -> DataFrame:
    """Adds original_text (null where nothing matched) and corrected; the column holds the replacement.

    An exact match wins over a match of the lower-cased text. A match with an equal
    replacement counts as a correction.
    """
    spark = detections.sparkSession
    exact, folded = _side(spark, EXACT, "_exact_key", "_exact"), _side(spark, FOLDED, "_folded_key", "_folded")
    text = F.col(column)
    joined = detections.join(exact, text == F.col("_exact_key"), "left").join(folded, F.lower(text) == F.col("_folded_key"), "left")
    found = F.coalesce("_exact", "_folded")
    return (
        joined.withColumn("corrected", found.isNotNull())
        .withColumn("original_text", F.when(found.isNotNull(), text))
        .withColumn(column, F.coalesce(found, text))
        .drop("_exact_key", "_exact", "_folded_key", "_folded")
    )


def correction_log(corrected: DataFrame) -> DataFrame:
    """One row for each correction, in the order of the detections."""
    return corrected.where("corrected").select(
        "doc_id", F.col("det_idx").alias("index"), F.lit("text").alias("field"), F.col("original_text").alias("original"),
        F.col("text").alias("corrected_text"), "confidence", F.array("cx", "cy").alias("position"),
    )


def correction_rate(corrected: DataFrame) -> DataFrame:
    """(doc_id, texts, corrections, rate)."""
    return corrected.groupBy("doc_id").agg(
        F.count("*").alias("texts"), F.count_if("corrected").alias("corrections"), (F.count_if("corrected") / F.count("*")).alias("rate")
    )


def correct_list(texts: DataFrame, column: str = "texts") -> DataFrame:
    """Corrections of an array of texts by row: (…, position, original, corrected_text), of those that match."""
    spread = texts.select("*", F.posexplode(column).alias("position", "_formloom_item")).drop(column)
    out = correct(spread, "_formloom_item").where("corrected")
    return out.withColumnRenamed("original_text", "original").withColumnRenamed("_formloom_item", "corrected_text").drop("corrected")
