"""Recognised documents as they arrive: an extension, stateless by document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formloom.plans import pipeline
from formloom.sources import documents as D


def document_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON files below a directory, as rows like those of sources.documents."""
    read = spark.readStream.schema(D.DOCUMENT).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger).json(path)
    broken = F.when(F.col("_corrupt_record").isNotNull(), "Invalid JSON")
    out = read.withColumn("file_name", F.col("_metadata.file_name")).withColumn("error", broken)
    return out.withColumn("status", F.when(F.col("error").isNull(), "ok").otherwise("failed")).drop("_corrupt_record")


def extract_stream(docs: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch goes through extraction and to write(documents, epoch); every file is taken once."""
    def batch(found: DataFrame, epoch: int) -> None:
        write(pipeline.extract(D.detections(found), D.cells(found)), epoch)

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()
