"""Results as files: nested JSON, single files by name, and the summary of a batch."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions.text import next_file_name
from formloom.operators.quality import batch_totals
from formloom.sources import png


def write_json(documents: DataFrame, path: str) -> None:
    """A line of JSON for each document; null fields are written."""
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_files(files: DataFrame, path: str) -> tuple[int, int]:
    """files(name, content): a file of that name in the folder for each row; how many files and bytes were written.

    The executors write, through Arrow's file systems, so path may lie wherever these and Spark reach. A
    task that runs again writes the same names again. content: text or binary.
    """
    content = F.col("content").cast("binary")

    whole = path if "://" in path else os.path.abspath(path.removeprefix("file:"))  # as the driver sees a relative path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = fs.FileSystem.from_uri(whole)
        target.create_dir(root, recursive=True)
        for b in batches:
            sizes = []
            for name, data in zip(b.column(0), b.column(1)):
                if name.is_valid and data.is_valid:
                    with target.open_output_stream(f"{root.rstrip('/')}/{name.as_py()}") as out:
                        out.write(data.as_buffer())
                    sizes.append(data.as_buffer().size)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["size"])

    # rows without a name or content are left out here: Spark would move a filter below the columns that make up the content, and make these twice
    written = files.select("name", content.alias("content")).mapInArrow(run, "size bigint")
    return tuple(written.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first())


def as_json(documents: DataFrame, name: Column) -> DataFrame:
    """(name, content): each row, but for doc_id, as a document; null fields are written."""
    own = F.struct(*(c for c in documents.columns if c != "doc_id"))
    return documents.select(name.alias("name"), F.to_json(own, {"ignoreNullFields": "false"}).alias("content"))


def write_documents(documents: DataFrame, path: str, drop: str, suffix: str) -> tuple[int, int]:
    """A JSON file for each document, named after doc_id: its stem less ``drop`` at the end, then suffix."""
    return write_files(as_json(documents, next_file_name(F.col("doc_id"), drop, suffix)), path)


def write_pages(pages: DataFrame, path: str, suffix: str = "-cor") -> tuple[int, int]:
    """Preprocessed pages as PNG files ``<stem><suffix>.png``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            images = [png.encode(np.frombuffer(d, np.uint8).reshape(h, w)) for h, w, d in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(images, pa.binary())], ["name", "content"])

    name = next_file_name(F.element_at(F.split("origin", "/"), -1), "", f"{suffix}.png")
    return write_files(pages.where("status = 'ok'").select(name.alias("name"), "height", "width", "data").mapInArrow(run, "name string, content binary"), path)


def write_summary(results: DataFrame, path: str, stamp: str) -> tuple[int, int] | None:
    """results(doc_id, status, seconds, ...) -> ``batch_summary_<stamp>.json``: totals and a row for each file; nothing for a batch without files."""
    if results.isEmpty():
        return None
    spark = results.sparkSession
    totals = batch_totals(results).withColumn("processing_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).select(F.struct("*").alias("batch_info"))
    lines = results.select(F.to_json(F.struct(*results.columns), {"ignoreNullFields": "false"}).alias("line")).orderBy("line")
    info = totals.select(F.to_json("batch_info")).first()[0]
    # a line for each file of one batch: what a reader of the summary is meant to hold
    body = ",\n    ".join(r.line for r in lines.collect())
    text = f'{{\n  "batch_info": {info},\n  "file_results": [\n    {body}\n  ]\n}}\n'
    return write_files(spark.createDataFrame([(f"batch_summary_{stamp}.json", text)], "name string, content string"), path)
