"""Pieces that several operators share: text units, the held-out fold and lineage cuts."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, _UPPER, _UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model may learn from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the session names none, a temporary folder is set in local mode, as in tests; on a cluster
    that is an error, since the machines would not see each other's files.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="formloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def is_scan(df: DataFrame) -> bool:
    """True where df is files as they lie, with columns chosen and rows filtered at most: each block gives the same rows in the same order whenever it is read."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation" or plan.nodeName().startswith("Relation")


def pin_splits(spark: SparkSession) -> None:
    """Files are split alike from now on: without this, the size of splits of a small input follows the number of executors that are left."""
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession, mb: int = 4) -> None:
    """Texts reach Python in Arrow batches of a few MB, unless the session asks for still smaller ones."""
    most = mb << 20
    now = spark.conf.get(_BATCH_BYTES, "67108864b").strip().lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= most:
        spark.conf.set(_BATCH_BYTES, f"{most}b")


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Arrow batches end by their number of rows alone.

    A limit of bytes is checked by Spark at every row, at some 0.8 microseconds each. rows must be such that their bytes are few.
    """
    before = {k: spark.conf.get(k) for k in (_BATCH_BYTES, _BATCH_ROWS)}
    now = int(before[_BATCH_ROWS])
    spark.conf.set(_BATCH_BYTES, f"{2**31 - 1}b")
    spark.conf.set(_BATCH_ROWS, min(rows, now) if now > 0 else rows)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def slices(batches: Iterable[pa.RecordBatch], text: int, rows: int = 512, text_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches of at most so many rows and, but for one long text, bytes of column text."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > at and (i - at >= rows or held + n > text_bytes):
                yield b.slice(at, i - at)
                at, held = i, 0
            held += n
        if at < b.num_rows:
            yield b.slice(at)


def cut(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: its lineage ends there, and its shuffles' files go. options: of the Parquet writer.

    The files survive the loss of executors. drop_cut deletes them as soon as nothing reads them any
    more; what is left goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/formloom-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options or {}).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._formloom_cut = path
    CUTS.append(path)
    return out


#: Paths of the tables that cut() has made and that have not been dropped.
CUTS: list[str] = []


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table made by cut() that nothing reads any more."""
    path = getattr(df, "_formloom_cut", None)
    if path in CUTS:
        _drop(df.sparkSession, path)


def drop_cuts(spark: SparkSession, since: int, but: DataFrame) -> None:
    """Delete all tables made by cut() since CUTS had that many entries, but one that is still to be read."""
    for path in [p for p in CUTS[since:] if p != getattr(but, "_formloom_cut", None)]:
        _drop(spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    CUTS.remove(path)
