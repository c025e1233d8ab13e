"""Command line: spark-submit this file, or ``python -m formloom.plans.cli``."""

from __future__ import annotations

import argparse
import datetime
import logging
import os
import sys
from collections.abc import Callable
from logging.handlers import RotatingFileHandler

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.operators import quality
from formloom.plans import assemble, pipeline
from formloom.sources import documents as D
from formloom.sources import images, settings, sinks, templates
from formloom.vision import pages, recognisers

MODES = ["preprocess", "ocr", "correction", "extract", "pipeline", "batch"]
log = logging.getLogger("formloom")
Keep = Callable[[DataFrame], DataFrame]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Forms as tables: recognition, correction, validation and extraction of documents.")
    p.add_argument("--file", help="one page image or recognised document")
    p.add_argument("--batch", "--directory", dest="batch", help="a directory of page images or of recognised documents")
    p.add_argument("--output", help="where results go; the output directory of the settings if not given")
    p.add_argument("--mode", choices=MODES, default="pipeline", help="batch is pipeline over a directory")
    p.add_argument("--recogniser", help="dots, replay:<file> or <module>:<function>; page images need one but for preprocess")
    return p


def set_logging(s: settings.Settings) -> None:
    """To the console and to a file of ten megabytes that is turned over five times."""
    log.setLevel(s.log_level)
    log.propagate = False
    form = logging.Formatter("%(asctime)s - %(levelname)s - %(message)s")
    os.makedirs(s.log_dir, exist_ok=True)
    log.handlers.clear()
    for handler in (logging.StreamHandler(), RotatingFileHandler(f"{s.log_dir}/formloom.log", maxBytes=s.log_max_size_mb << 20, backupCount=5, encoding="utf-8")):
        handler.setFormatter(form)
        log.addHandler(handler)


def write_corrected(docs: DataFrame, output: str, keep: Keep) -> DataFrame:
    """``-corrected.json`` of each document, with its corrections and validation; the documents come back."""
    done = keep(assemble.validated(assemble.corrected(docs.where("status = 'ok'"))))
    kept = done.drop("status", "error", "seconds").withColumnRenamed("file_name", "doc_id")
    sinks.write_documents(kept, output, "(-cor)?(-texts)?", "-corrected.json")
    return done


def write_data(docs: DataFrame, output: str, keep: Keep) -> DataFrame:
    """``-data.json`` of each document; what was extracted comes back, doc_id being the document's file name."""
    data = keep(pipeline.extract(D.detections(docs), D.cells(docs)))
    sinks.write_documents(data, output, "(-cor)?(-texts)?(-corrected)?", "-data.json")
    return data


def summary(files: DataFrame, done: DataFrame | None, data: DataFrame | None) -> DataFrame:
    """A row for each file: (doc_id, status, error, seconds, texts_found, average_confidence, corrections_applied, fields_validated, required_fields)."""
    seconds = F.col("seconds") if "seconds" in files.columns else F.lit(None).cast("double")
    out = files.select(F.col("file_name").alias("doc_id"), "status", "error", F.round(seconds, 3).alias("seconds"))
    if done is not None:
        sizes = done.select(
            F.col("file_name").alias("doc_id"), F.size("text_regions").alias("texts_found"),
            F.round(F.coalesce(F.aggregate("text_regions", F.lit(0.0), lambda a, d: a + F.coalesce(d.confidence, F.lit(0.0))) / F.greatest(F.size("text_regions"), F.lit(1)), F.lit(0.0)), 3).alias("average_confidence"),
            F.col("corrections_applied.count").alias("corrections_applied"), F.col("validation_results.validated_fields").alias("fields_validated"),
        )
        out = out.join(sizes, "doc_id", "left").na.fill(0, ["texts_found", "corrections_applied", "fields_validated"]).na.fill(0.0, ["average_confidence"])
    if data is not None:
        fields = data.select("doc_id", *(F.col(f"header.{n}").alias(n) for n in quality.SUMMARY_FIELDS))
        wide = quality.with_required_fields(out, fields)
        out = wide.withColumn("required_fields", F.struct(*quality.SUMMARY_FIELDS)).drop(*quality.SUMMARY_FIELDS)
    return out


def process(spark: SparkSession, path: str, output: str, mode: str, s: settings.Settings = settings.Settings(), recogniser: str | None = None) -> bool:
    """Run a mode over a file or directory; True if every file could be processed."""
    held: list[DataFrame] = []
    try:
        return _process(spark, path, output, "pipeline" if mode == "batch" else mode, s, recogniser, held)
    finally:
        for df in held:  # a later run over the same folder must see its files as they are then
            df.unpersist()


def _process(spark: SparkSession, path: str, output: str, mode: str, s: settings.Settings, recogniser: str | None, held: list[DataFrame]) -> bool:
    def keep(df: DataFrame) -> DataFrame:
        held.append(df.cache())
        return held[-1]

    found = images.image_files(spark, path).select("name")
    done = data = None
    if mode == "preprocess":
        made = keep(pages.preprocessed(images.images(spark, path), s))
        sinks.write_pages(made, output, s.processed_suffix)
        return made.where("status <> 'ok'").isEmpty()
    if mode in ("ocr", "pipeline") and not found.isEmpty():
        if not recogniser:
            raise ValueError("page images need --recogniser")
        recognisers.make(recogniser, s)  # a name that nothing is known by fails here, not on an executor
        bands = templates.load_templates(spark, s.region_template_file)
        read = pages.read_pages(images.images(spark, path), recognisers.Named(recogniser, s), s, bands)
        files = keep(assemble.of_pages(read, s.ocr_confidence_threshold, s.ocr_language, recogniser))
        kept = files.where("status = 'ok'").drop("status", "error", "seconds").withColumnRenamed("file_name", "doc_id")
        sinks.write_documents(kept, output, s.processed_suffix, "-texts.json")
    elif mode == "ocr":
        raise ValueError("no page images")
    else:
        files = keep(D.documents(spark, path, regions_required=mode != "correction"))
    if mode in ("correction", "pipeline"):
        done = write_corrected(files, output, keep)
    if mode in ("extract", "pipeline"):
        data = write_data(done if done is not None else files, output, keep)
    sinks.write_summary(summary(files, done, data), output, f"{datetime.datetime.now():%Y%m%d_%H%M%S}")
    for r in files.where("status <> 'ok'").select("file_name", "error").toLocalIterator():
        log.error("%s: %s", r.file_name, r.error)
    return files.where("status <> 'ok'").isEmpty()


def main(argv: list[str] | None = None) -> int:
    """0 if all went well or nothing was asked for, 1 if a file failed or the path is missing."""
    args = parser().parse_args(argv)
    path = args.file or args.batch
    if not path:
        parser().print_help()
        return 0
    s = settings.load(env_file=".env")
    set_logging(s)
    spark = SparkSession.builder.appName("formloom").getOrCreate()
    try:
        return 0 if process(spark, path, args.output or s.output_dir, args.mode, s, args.recogniser) else 1
    except Exception as e:  # the exit code tells the caller, the message the reader
        log.error("%s", e)
        return 1


if __name__ == "__main__":
    sys.exit(main())
