"""Lines, manifests, curated rows, extracts and event logs in and out."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.digests import digest_of, row_parts
from ..functions.spec import CURATED_SCHEMA

MANIFEST = """batch_id string, source string, ingested_at string, start string, end string, raw_path string, manifest_path string,
advance_checkpoint boolean, record_count bigint, raw_digest string,
stations array<struct<station_id:string,name:string,latitude:double,longitude:double>>,
windows array<struct<station_id:string,start:string,end:string>>"""


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Untouched lines, blank ones included."""
    return spark.read.text(path)


def read_manifests(spark: SparkSession, path) -> DataFrame:
    """Many manifests at once, one JSON document a file."""
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def manifest_stations(manifests: DataFrame) -> DataFrame:
    return manifests.select("batch_id", "ingested_at", F.explode("stations").alias("s")).select("batch_id", "ingested_at", "s.*")


def manifest_windows(manifests: DataFrame) -> DataFrame:
    return manifests.select("batch_id", F.explode("windows").alias("w")).select("batch_id", "w.*")


def envelopes(payloads: DataFrame) -> DataFrame:
    """One JSON line a payload; raw_json is carried as text, never rewritten."""
    return payloads.select(F.to_json(F.struct("batch_id", "ingested_at", "station_id", "raw_json")).alias("value"))


#: A batch is complete once it has this file, which is written last.
MARKER = "manifest.json"


def lines_of(root: str, batch_id: str) -> str:
    if not batch_id.strip() or "/" in batch_id or batch_id in (".", ".."):
        raise ValueError("a batch id must be a plain path component")
    return f"{root.rstrip('/')}/batch_id={batch_id}/lines"


def land(lines: DataFrame, root: str, batch_id: str) -> str:
    """Publishes a batch's lines once; fails if the batch is there already."""
    path = lines_of(root, batch_id)
    lines.select("value").write.mode("errorifexists").text(path)
    return path


def land_batch(lines: DataFrame, root: str, manifest: dict) -> dict:
    """Lands the lines and then, as the mark that all is there, the manifest with
    the lines' count and digest, both observed while the lines were written."""
    spark, seen = lines.sparkSession, Observation("landed")
    parts = row_parts([F.col("value")])
    path = land(lines.observe(seen, F.count("*").alias("n"), *[F.sum(p).alias(f"digest_{k}") for k, p in enumerate(parts)]), root, manifest["batch_id"])
    n = seen.get
    whole = manifest | {"raw_path": path, "record_count": n["n"], "raw_digest": digest_of(n["n"], [n[f"digest_{k}"] for k in range(len(parts))])}
    write_once(spark, f"{path.rsplit('/', 1)[0]}/{MARKER}", json.dumps(whole))
    return whole


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of all complete batches; folders without one are still landing."""
    pattern = f"{root.rstrip('/')}/batch_id=*/{MARKER}"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    if not (path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []):
        return spark.createDataFrame([], MANIFEST)
    return read_manifests(spark, pattern)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def write_file(lines: DataFrame, path: str) -> None:
    """Lines as one file of this very name; one task writes it."""
    spark, folder = lines.sparkSession, f"{path}.part-{uuid.uuid4().hex}"
    lines.coalesce(1).write.text(folder)
    part, fs = _hadoop(spark, f"{folder}/part-*")
    target, _ = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    moved = fs.rename(fs.globStatus(part)[0].getPath(), target)
    fs.delete(part.getParent(), True)
    if not moved:
        raise OSError(f"could not write {path}")


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all, and is never replaced."""
    target, fs = _hadoop(spark, path)
    jvm = spark._jvm
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_staged-{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(staged, target, rename)
    except Exception as e:
        fs.delete(staged, False)
        if "FileAlreadyExists" in str(e):
            raise FileExistsError(path) from e
        raise


def checksum_failures(rows: DataFrame) -> DataFrame:
    """Rows whose payload doesn't have the recorded sha256."""
    return rows.filter(~F.sha2("raw_json", 256).eqNullSafe(F.col("payload_sha256")))


def write_curated(curated: DataFrame, path: str) -> None:
    curated.withColumn("observation_date", F.to_date("observed_at")).write.mode("overwrite").partitionBy("observation_date").parquet(path)


def read_curated(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(CURATED_SCHEMA).parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """The one row of a report as a JSON document; replaces an earlier one."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def read_event_lines(spark: SparkSession, path) -> DataFrame:
    """line_no and value.  line_no is a struct that orders the lines of a log of many
    files: by the files' times and names, then by the place of the line's part
    in its file, then by the line's place in that part.  So a later append comes
    later, however large its files are."""
    m = F.col("_metadata")
    place = F.struct(m["file_modification_time"].alias("written_at"), m["file_path"].alias("file"), m["file_block_start"].alias("part"), F.monotonically_increasing_id().alias("nth"))
    return spark.read.text(path).select(place.alias("line_no"), "value")


def write_extract(df: DataFrame, path: str, order: list[str]) -> None:
    """Headed CSV files, ordered by name and within; null is an empty cell, empty
    text is "".  Each task writes a range; who wants one file joins the parts."""
    options = {"header": True, "nullValue": "", "emptyValue": '""', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").options(**options).csv(path)


def read_extract(spark: SparkSession, path, schema: str) -> DataFrame:
    """Strict: a wrong header or a bad cell fails."""
    # What stands for an empty cell while reading must differ from empty text.
    options = {"header": True, "enforceSchema": False, "mode": "FAILFAST", "nullValue": "\u0001", "emptyValue": "", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    return spark.read.schema(schema).options(**options).csv(path)


def publish_extracts(views: dict[str, tuple[DataFrame, list[str]]], target: str, before_publish=None) -> int:
    """All extracts or none: written to a folder of their own, then named by a file
    of the next number.  Readers that hold the set before keep it.

    before_publish: called in between (tests read there).
    """
    spark = next(iter(views.values()))[0].sparkSession
    number, folder = _extract_set(spark, target)[0] + 1, f"set-{uuid.uuid4().hex}"
    for name, (df, order) in views.items():
        write_extract(df, f"{target.rstrip('/')}/{folder}/{name}", order)
    if before_publish is not None:
        before_publish()
    write_once(spark, f"{target.rstrip('/')}/current-{number}", folder)
    return number


def _extract_set(spark: SparkSession, target: str) -> tuple[int, str]:
    p, fs = _hadoop(spark, f"{target.rstrip('/')}/current-*")
    number = max((int(f.getPath().getName().split("-")[1]) for f in fs.globStatus(p) or []), default=0)
    return number, spark.read.text(f"{target.rstrip('/')}/current-{number}").first()["value"] if number else ""


def published(spark: SparkSession, target: str) -> str:
    """The folder of the extracts that count now; it stays when others follow."""
    number, folder = _extract_set(spark, target)
    if not number:
        raise FileNotFoundError(f"no extracts were published at {target}")
    return f"{target.rstrip('/')}/{folder}"
