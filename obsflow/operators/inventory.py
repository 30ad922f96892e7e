"""Files under a folder, verified; paths moved; lineage without gaps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are hashed whole in the JVM, larger ones as streams.
WHOLE = 256 << 20
CHUNK = 8 << 20


def _uri(c: Column) -> Column:
    """One spelling of the names of local files."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def _listing(spark: SparkSession, root: str) -> DataFrame:
    """path below root, uri and size of every file; no content is read."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    top = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = files.select(F.col("path").alias("_full"), _uri(F.col("_metadata.file_path")).alias("_uri"), F.col("length").alias("size"))
    # Spark reads nothing of empty files, so they are what its own listing has besides.
    listed = spark.createDataFrame([(u,) for u in files.inputFiles()], "_uri string").select(_uri(F.col("_uri")).alias("_uri"))
    empty = listed.join(found, "_uri", "left_anti")
    full = F.url_decode(F.replace("_uri", F.lit("+"), F.lit("%2B")))
    both = found.unionByName(empty.select(full.alias("_full"), "_uri", F.lit(0).cast("long").alias("size")))
    return both.select(F.substring("_full", len(top) + 2, 1 << 30).alias("path"), "_full", "_uri", "size")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of each file by its full name, a chunk in memory at a time."""
    import hashlib

    from pyarrow import fs

    for b in batches:
        digests = []
        for name in b.column(0).to_pylist():
            scheme, _, rest = name.partition(":")
            system, path = fs.FileSystem.from_uri("file:///" + rest.lstrip("/") if scheme == "file" else name)
            h = hashlib.sha256()
            with system.open_input_stream(path) as f:
                while chunk := f.read(CHUNK):
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digests, pa.string())], names=["_full", "sha256"])


def _digested(spark: SparkSession, root: str, whole: int) -> DataFrame:
    """_full and sha256 of every file; files over ``whole`` bytes are streamed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    small = files.filter(F.col("length") <= whole).select(F.col("path").alias("_full"), F.sha2("content", 256).alias("sha256"))
    large = files.select(F.col("path").alias("_full"), F.col("length").alias("size")).filter(F.col("size") > whole).select("_full")
    return small.unionByName(large.mapInArrow(_streamed, "_full string, sha256 string"))


def _with_digests(spark: SparkSession, listed: DataFrame, root: str, whole: int) -> DataFrame:
    both = listed.join(_digested(spark, root, whole), "_full", "left")
    return both.withColumn("sha256", F.when(F.col("size") == 0, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha256")))


def inventory(spark: SparkSession, root: str, exclude: str | None = None, whole: int = WHOLE) -> DataFrame:
    """path (below root), size and sha256 of every file below root, of any size."""
    listed = _listing(spark, root)
    if exclude:
        listed = listed.filter(~F.col("path").rlike(exclude))
    return _with_digests(spark, listed, root, whole).select("path", "size", "sha256")


def verify(stored: DataFrame, found: DataFrame) -> DataFrame:
    """path and status: ok, missing, extra, size_mismatch or checksum_mismatch."""
    s, f = stored.toDF("path", "size", "sha256"), found.toDF("path", "_size", "_sha256")
    status = F.when(F.col("_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when(F.col("size") != F.col("_size"), "size_mismatch").when(F.col("sha256") != F.col("_sha256"), "checksum_mismatch").otherwise("ok")
    return s.join(f, "path", "full_outer").select("path", status.alias("status"))


def rebase(paths: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """The column moved from below old to below new; rows that lie elsewhere or
    climb with .. stay, flagged in rebased."""
    old, new = old.rstrip("/") + "/", new.rstrip("/") + "/"
    good = F.col(column).startswith(old) & ~F.col(column).rlike(r"(^|/)\.\.(/|$)")
    moved = F.concat(F.lit(new), F.substring(F.col(column), F.lit(len(old) + 1), F.length(column)))
    return paths.withColumns({"rebased": F.coalesce(good, F.lit(False)), column: F.when(good, moved).otherwise(F.col(column))})


def lineage_gaps(runs: DataFrame, manifests: DataFrame) -> DataFrame:
    """batch_id and problem: runs without a landed manifest of the same raw path,
    and batches with several manifests."""
    missing = runs.join(manifests, ["batch_id", "raw_path"], "left_anti").select("batch_id", F.lit("no_manifest").alias("problem"))
    twice = manifests.groupBy("batch_id").count().filter("count > 1").select("batch_id", F.lit("several_manifests").alias("problem"))
    return missing.unionByName(twice)


def verify_raw(spark: SparkSession, manifests: DataFrame, root: str, whole: int = WHOLE) -> DataFrame:
    """manifests: batch_id, raw_path (below root), raw_sha256, record_count.  Digest
    and line count of every landed file against its manifest; files are told
    apart by their full paths."""
    lines = spark.read.option("recursiveFileLookup", "true").text(root).groupBy(_uri(F.col("_metadata.file_path")).alias("_uri")).agg(F.count("*").alias("_lines"))
    files = _with_digests(spark, _listing(spark, root), root, whole).join(lines, "_uri", "left")
    found = files.select(F.col("path").alias("raw_path"), F.col("sha256").alias("_sha256"), F.coalesce("_lines", F.lit(0)).alias("_lines"))
    status = F.when(F.col("_sha256").isNull(), "missing").when(F.col("raw_sha256") != F.col("_sha256"), "digest_mismatch").when(F.col("record_count") != F.col("_lines"), "count_mismatch").otherwise("ok")
    return manifests.join(found, "raw_path", "left").select("batch_id", "raw_path", status.alias("status"))
