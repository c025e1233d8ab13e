"""Directories of page images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# File endings of images, in any case.
SUFFIXES = ("jpg", "jpeg", "png", "bmp", "tiff", "tif")


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length, content) of the images right below a directory; one that is missing is an error."""
    files = spark.read.format("binaryFile").load(path)
    wanted = F.lower("path").rlike(rf"\.({'|'.join(SUFFIXES)})$")
    return files.where(wanted).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")


def images(spark: SparkSession, path: str) -> DataFrame:
    """Spark's image column for the same files; one that cannot be read has a height of -1."""
    return spark.read.format("image").option("dropInvalid", False).load(path).where(F.lower("image.origin").rlike(rf"\.({'|'.join(SUFFIXES)})$"))
