"""Shared helpers of the corpus operators: words, scratch tables, ids.

White space is the ASCII set space, tab, newline, vertical tab, form feed and
carriage return; a word is a maximal run of anything else.  ``bytes.split()``
in Python and ``WS`` in Spark agree on that set.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Java regular expression of the white space between words.
WS = "[ \\t\\n\\x0B\\f\\r]+"
#: The same six characters, as text.
WS_CHARS = " \t\n\x0b\f\r"

#: Spark's setting that deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of the rows that Python gets at a time, and what it is set to.
RECORDS, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of ``text``; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WS), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none (tests, a single machine) a temporary
    folder takes its place.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None:
        own = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="obsflow-shared-")
    return own


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH) -> Iterator[None]:
    """What runs meanwhile hands at most ``rows`` rows at a time to Python; batches
    of whole texts stand in memory on both sides."""
    before = spark.conf.get(RECORDS)
    spark.conf.set(RECORDS, rows if int(before) <= 0 else min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(RECORDS, before)


def release() -> None:
    """Gives a worker's free memory back to the system; Spark keeps idle workers."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's alone
    if trim is not None:
        trim(0)


def written(df: DataFrame, label: str, dictionary: bool = True, group_rows: int | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read again.
    dictionary: False for columns of hashes, which no dictionary makes smaller.
    group_rows: rows of a row group at most, where rows are megabytes: writers look
    at a group's size after 100 rows only, and readers hold a whole group.

    This cuts the lineage: what is read later doesn't hang on shuffle files of
    executors that may be lost.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    # Once the table stands, nothing needs the shuffle files of its making.
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        writer = df.write.option("parquet.enable.dictionary", dictionary)
        (writer if group_rows is None else writer.option("parquet.block.row.count.limit", group_rows)).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._obsflow_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Deletes what ``written`` wrote, once nothing reads it any more."""
    path = getattr(df, "_obsflow_path", None)
    if path is not None:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def id_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def id_mod_py(doc_id: int, n: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % n


def single_threaded() -> None:
    """Spark runs one task a core; libraries with threads of their own must not."""
    for k in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS", "OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS"):
        os.environ[k] = "false" if k == "TOKENIZERS_PARALLELISM" else "1"
