"""Validation summaries, mandatory fields, statistics by document and by batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import rules as R
from formloom.functions import text as T
from formloom.operators.header import MANDATORY

#: Fields of the batch summary, in its order.
SUMMARY_FIELDS = ["act_number", "act_date", "template_revision", "part_line_number", "quantity_checked", "control_type", "inspector_name"]
HEADER_COUNTED = ["act_number", "act_date", "template_revision", "part_line_number", "quantity_checked", "control_type", "inspector_name"]


def validated(detections: DataFrame) -> DataFrame:
    """Adds field_type, violation and confidence_message; null or blank texts have none of them."""
    text, confidence = F.col("text"), F.col("confidence")
    found = lambda kind: F.struct(
        kind.alias("field_type"), R.violation(text, kind).alias("violation"), T.let(R.confidence_check(confidence).message, lambda m: F.when(m != "", m)).alias("confidence_message"),
        R.confidence_check(confidence).acceptable.alias("acceptable"),
    )
    names = ("field_type", "violation", "confidence_message", "acceptable")
    return detections.withColumn("_formloom_found", R.of_filled(text, found)).withColumns({n: F.col(f"_formloom_found.{n}") for n in names}).drop("_formloom_found")


def validation_summary(checked: DataFrame) -> DataFrame:
    """By document: total (blank texts too), validated, failed, rate, warnings, and the failures in order."""
    filled = F.col("field_type").isNotNull()
    fine = filled & F.col("violation").isNull()
    error = F.struct(F.col("det_idx").alias("index"), F.col("text").alias("value"), F.col("field_type").alias("type"), F.col("violation").alias("message"))
    return checked.groupBy("doc_id").agg(
        F.count("*").alias("total_fields"), F.count_if(fine).alias("validated_fields"), F.count_if(filled & ~fine).alias("failed_validations"),
        (F.count_if(fine) / F.count("*")).alias("validation_rate"), F.count("confidence_message").alias("warnings"),
        F.array_sort(F.collect_list(F.when(filled & ~fine, error))).alias("errors"),
    )


def keep_confident(detections: DataFrame, least: float = 0.5) -> DataFrame:
    return detections.where(F.col("confidence") >= least)


def confidence_stats(detections: DataFrame, keys: list[str], threshold: float = 0.5) -> DataFrame:
    """By keys: detections, their mean confidence, and how many are below 1.2 times the threshold."""
    return detections.groupBy(*keys).agg(
        F.count("*").alias("texts"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("average_confidence"), F.count_if(F.col("confidence") < threshold * 1.2).alias("low_confidence")
    )


def long_fields(header: DataFrame, names: list[str]) -> DataFrame:
    """Header columns as rows (doc_id, field, value, confidence, source, corrected); absent fields give none."""
    entries = F.array(*(F.struct(F.lit(n).alias("field"), F.col(n).alias("f")) for n in names))
    return header.select("doc_id", F.explode(entries).alias("e")).where("e.f is not null").select("doc_id", "e.field", "e.f.*")


def mandatory_missing(header: DataFrame) -> DataFrame:
    """(doc_id, field) of mandatory fields that a document lacks: an anti-join of what is asked for with what was found."""
    wanted = header.select("doc_id", F.explode(F.array(*map(F.lit, MANDATORY))).alias("field"))
    return wanted.join(long_fields(header, MANDATORY).select("doc_id", "field"), ["doc_id", "field"], "left_anti")


def _below(confidence: Column, least: float) -> Column:
    """Below the threshold by more than the last digits, in which a mean differs with the order of its sum: three of 0.7 have a mean of 0.7."""
    return F.round(confidence, 9) < least


def report_of(least: float = 0.7) -> Column:
    """(total_fields_validated, mandatory_fields_missing, missing_count, suspicious_fields, errors) of a document's header columns, see mandatory_report."""
    missing = F.filter(F.array(*(F.when(F.col(n).isNull(), n) for n in MANDATORY)), lambda x: x.isNotNull())
    low = F.filter(F.array(*(F.when(_below(F.col(n).confidence, least), n) for n in MANDATORY)), lambda x: x.isNotNull())
    note = lambda n: F.when(F.col(n).isNull(), F.struct(F.lit(n).alias("field"), F.lit("Field is missing").alias("message"), F.lit("error").alias("severity"))).when(
        _below(F.col(n).confidence, least),
        F.struct(F.lit(n).alias("field"), F.format_string("Low confidence: %.3f", F.col(n).confidence).alias("message"), F.lit("warning").alias("severity")),
    )
    errors = F.filter(F.array(*map(note, MANDATORY)), lambda x: x.isNotNull())
    return F.struct(
        F.lit(len(MANDATORY)).alias("total_fields_validated"), missing.alias("mandatory_fields_missing"), F.size(missing).alias("missing_count"),
        low.alias("suspicious_fields"), errors.alias("errors"),
    )


def mandatory_report(header: DataFrame, least: float = 0.7) -> DataFrame:
    """By document: what is missing, what is suspicious (found, but with a low confidence), and the errors, sorted by field."""
    return header.select("doc_id", report_of(least).alias("r")).select("doc_id", "r.*")


def fields_extracted(names: list[str] = HEADER_COUNTED) -> Column:
    return sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in names), F.lit(0))


def batch_totals(results: DataFrame) -> DataFrame:
    """results(status, seconds) -> one row: files, successful, failed, total and average seconds."""
    return results.agg(
        F.count("*").alias("total_files"), F.count_if(F.col("status") == "ok").alias("successful"), F.count_if(F.col("status") != "ok").alias("failed"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"), F.coalesce(F.avg("seconds"), F.lit(0.0)).alias("average_seconds"),
    )


def with_required_fields(results: DataFrame, header: DataFrame) -> DataFrame:
    """results left join header fields by doc_id: each field as (value, confidence, suspicious), defaults where there is none."""
    def shown(n: str) -> Column:
        f = F.col(n)
        return F.struct(f.value.alias("value"), F.coalesce(f.confidence, F.lit(0.0)).alias("confidence"), F.coalesce(_below(f.confidence, 0.7), F.lit(False)).alias("suspicious")).alias(n)

    return results.join(header.select("doc_id", *SUMMARY_FIELDS), "doc_id", "left").select(*results.columns, *map(shown, SUMMARY_FIELDS))
