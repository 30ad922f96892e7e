"""Landed batches through validation into curated, quarantine, report and warehouse.

Everything of an attempt lies below ``<out>/batches/batch_id=…/attempt=…``:

    lines/outcome=accepted   accepted versions, before dedup
    lines/outcome=rejected   the quarantine
    curated                  latest versions by observation date
    report                   one JSON document

The lines are read and validated once: one write deals them out to both outcomes,
and the counts and the digest of what was read are observed while they pass.  The
curated write reads the accepted columns alone and observes its own counts.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import digests
from ..functions.spec import CURATED, CURATED_SCHEMA, FEED, MEASURE_COLUMNS, Feed
from ..functions.values import missing_count, station_name, zoned_time
from ..sources import readers
from ..sources.tables import Warehouse
from . import contract, coverage, dedup, load, validate

REJECTED = ("batch_id", "station_id", "ingested_at", "raw_json", "raw_envelope", "reasons")
REJECTED_SCHEMA = "batch_id string, station_id string, ingested_at string, raw_json string, raw_envelope string, reasons array<string>"


@dataclass(frozen=True)
class Attempt:
    """Where an attempt's results lie, and its counts."""

    batch_id: str
    attempt_id: str
    path: str
    counts: dict[str, int]
    raw_digest: str

    @property
    def lines(self) -> str:
        return f"{self.path}/lines"

    @property
    def curated(self) -> str:
        return f"{self.path}/curated"

    @property
    def report(self) -> str:
        return f"{self.path}/report"


def transform_landed(lines: DataFrame, batch_id: str, out: str, allowed: list[str], reference: dt.datetime, feed: Feed = FEED) -> Attempt:
    """Writes accepted and rejected lines and the curated rows of a batch."""
    spark, attempt = lines.sparkSession, uuid.uuid4().hex
    path = f"{out.rstrip('/')}/batches/batch_id={batch_id}/attempt={attempt}"
    classified = validate.classify(lines, allowed, reference, feed)
    good = F.size("reasons") == 0
    columns = [F.when(good, F.col(c)).alias(c) for c, _ in CURATED] + [F.when(~good, F.col(c)).alias(f"rejected_{c}") for c in REJECTED]
    read, kept = Observation("read"), Observation("kept")
    parts = digests.row_parts([F.col("raw_envelope")])
    seen = classified.observe(read, F.count("*").alias("input_count"), F.count_if(~good).alias("rejected_count"), *[F.sum(p).alias(f"digest_{k}") for k, p in enumerate(parts)])
    seen.select(F.when(good, "accepted").otherwise("rejected").alias("outcome"), *columns).write.partitionBy("outcome").parquet(f"{path}/lines")
    accepted = spark.read.schema(", ".join(f"{n} {t}" for n, t in CURATED) + ", outcome string").parquet(f"{path}/lines").filter("outcome = 'accepted'").drop("outcome")
    curated = dedup.curated(accepted).observe(kept, F.count("*").alias("accepted_count"), F.coalesce(F.sum(missing_count()), F.lit(0)).alias("missing_measurement_count"))
    readers.write_curated(curated, f"{path}/curated")
    n, m = read.get, kept.get
    counts = {"input_count": n["input_count"], "accepted_count": m["accepted_count"], "rejected_count": n["rejected_count"]}
    counts |= {"duplicate_count": n["input_count"] - n["rejected_count"] - m["accepted_count"], "missing_measurement_count": int(m["missing_measurement_count"])}
    return Attempt(batch_id, attempt, path, counts, digests.digest_of(n["input_count"], [n[f"digest_{k}"] for k in range(len(parts))]))


def quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The rejected lines of one attempt, or of many by a pattern (their ``lines``
    folders), as they came, for investigation."""
    stored = ", ".join(f"rejected_{c.strip()}" for c in REJECTED_SCHEMA.split(","))
    rows = spark.read.schema(stored + ", outcome string").parquet(path).filter("outcome = 'rejected'")
    return rows.select(*[F.col(f"rejected_{c}").alias(c) for c in REJECTED])


def report(attempt: Attempt, covered: DataFrame) -> DataFrame:
    """One row: the counts, stations without rows and stale ones, and what is
    covered as an array, an entry a station."""
    entry = F.struct("station_id", *[c for c in covered.columns if c != "station_id"])
    one = covered.agg(F.count_if("missing_in_batch").alias("empty_station_count"), F.count_if("stale").alias("stale_station_count"), F.array_sort(F.collect_list(entry)).alias("station_coverage"))
    counts = [F.lit(n).cast("long").alias(c) for c, n in attempt.counts.items()]
    return one.select(F.lit(attempt.batch_id).alias("batch_id"), F.lit(attempt.attempt_id).alias("attempt_id"), *counts, "*")


def manifest_of(batch_id: str, source: str, stations: list[dict], windows: list[dict], start: str, end: str, ingested_at: str, advance_checkpoint: bool = True) -> dict:
    """A manifest as ``readers.land_batch`` takes it; times are ISO texts with zone."""
    return {"batch_id": batch_id, "source": source, "ingested_at": ingested_at, "start": start, "end": end, "advance_checkpoint": advance_checkpoint, "stations": stations, "windows": windows}


def checked(manifests: DataFrame) -> DataFrame:
    """Manifests with their times parsed, and the array issues."""
    times = {f"_{c}": zoned_time(F.col(c)) for c in ("start", "end", "ingested_at")}
    bad = [F.when(F.col(f"_{c}").isNull(), f"invalid_{c}") for c in ("start", "end", "ingested_at")]
    windows = F.exists("windows", lambda w: zoned_time(w["start"]).isNull() | zoned_time(w["end"]).isNull())
    name = ~F.coalesce(F.col("batch_id").rlike(r"^[^/\s][^/]*$") & ~F.col("batch_id").isin(".", ".."), F.lit(False))
    issues = [F.when(name, "invalid_batch_id"), *bad, F.when(F.coalesce(windows, F.lit(True)), "invalid_windows"), F.when(F.coalesce(F.size("stations"), F.lit(0)) < 1, "no_stations")]
    return manifests.withColumns(times).withColumn("issues", F.array_compact(F.array(*issues)))


def counts_of(spark: SparkSession, attempt: Attempt) -> DataFrame:
    """An attempt's counts as the one row that a load takes."""
    return spark.createDataFrame([tuple(attempt.counts[c] for c in contract.COUNTS)], ", ".join(f"{c} bigint" for c in contract.COUNTS))


def curated_of(spark: SparkSession, attempt: Attempt) -> DataFrame:
    """An attempt's curated rows; none where nothing was accepted."""
    if not attempt.counts["accepted_count"]:
        return spark.createDataFrame([], CURATED_SCHEMA)
    return readers.read_curated(spark, attempt.curated)


def batch_of(manifest: Row, manifests: DataFrame, attempt: Attempt) -> load.Batch:
    """An attempt as what ``load.load`` takes."""
    spark = manifests.sparkSession
    own = manifests.filter(F.col("batch_id") == manifest["batch_id"])
    stations = readers.manifest_stations(own).select("station_id", station_name(F.col("name"), F.col("station_id")).alias("station_name"), "latitude", "longitude", zoned_time(F.col("ingested_at")).alias("metadata_ingested_at"))
    windows = readers.manifest_windows(own).select("station_id", zoned_time(F.col("start")).alias("start"), zoned_time(F.col("end")).alias("end"))
    return load.Batch(manifest["batch_id"], manifest["source"], curated_of(spark, attempt), stations, windows, counts_of(spark, attempt), manifest["raw_path"] or "", bool(manifest["advance_checkpoint"]))


def process(warehouse: Warehouse, root: str, out: str, batch_id: str, loaded_at: Column | None = None, feed: Feed = FEED, before_publish=None) -> dict:
    """One landed batch from its lines to the warehouse, its reports and an event.

    A batch whose lines are not those of its manifest, or whose manifest is
    wrong, isn't loaded; the failure is an event too.  The report of a batch, as
    opposed to those of its attempts, is written when the batch is loaded or
    where it has none yet.
    """
    spark = warehouse.spark
    now = dt.datetime.now(dt.UTC).isoformat()
    event = lambda status, error=None: readers.append_events(spark.createDataFrame([(now, status, batch_id, error)], "at string, status string, batch_id string, error string"), f"{out}/events")
    try:
        manifests = readers.read_manifests(spark, f"{root.rstrip('/')}/batch_id={batch_id}/{readers.MARKER}")
        m = checked(manifests).first()
        if m is None or m["issues"] or m["batch_id"] != batch_id:
            raise ValueError(f"the manifest of batch {batch_id} is wrong: {'no manifest' if m is None else ', '.join(m['issues']) or 'another batch'}")
        lines = readers.read_lines(spark, readers.lines_of(root, batch_id))
        attempt = transform_landed(lines, batch_id, out, [s["station_id"] for s in m["stations"]], m["_end"].replace(tzinfo=dt.UTC), feed)
        if m["record_count"] is not None and m["record_count"] != attempt.counts["input_count"]:
            raise ValueError(f"batch {batch_id} has {attempt.counts['input_count']} lines, its manifest says {m['record_count']}")
        if m["raw_digest"] is not None and m["raw_digest"] != attempt.raw_digest:
            raise ValueError(f"the lines of batch {batch_id} are not those that were landed")
        batch = batch_of(m, manifests, attempt)
        covered = coverage.coverage(batch.curated, batch.stations, F.lit(m["_end"]).cast("timestamp_ntz"), feed.gap_minutes)
        made = report(attempt, covered)
        readers.write_report(made, attempt.report)
        result = load.load(warehouse, batch, loaded_at, before_publish)
        last = f"{out.rstrip('/')}/reports/batch_id={batch_id}"
        if result["status"] == "loaded" or not readers.exists(spark, last):
            readers.write_report(spark.read.schema(made.schema).json(attempt.report), last)
    except Exception as e:
        event("failed", str(e)[:1000])
        raise
    event("succeeded")
    return {"attempt": attempt, **result}


def process_all(warehouse: Warehouse, root: str, out: str, loaded_at: Column | None = None, feed: Feed = FEED) -> list[dict]:
    """All complete batches that aren't in the run ledger, in order of their ends.

    Loads of one warehouse follow each other; the driver holds the batch ids that
    are still to be loaded.
    """
    done = warehouse.read("etl_runs").select("batch_id")
    waiting = checked(readers.read_landed(warehouse.spark, root)).join(done, "batch_id", "left_anti")
    todo = [r["batch_id"] for r in waiting.select("batch_id", "_end").orderBy("_end", "batch_id").collect()]
    return [process(warehouse, root, out, b, loaded_at, feed) for b in todo]


def measures_present(curated: DataFrame) -> DataFrame:
    """n_rows and present measures a day of curated rows, by their date folders."""
    present = [F.count(c).alias(c) for c in MEASURE_COLUMNS]
    return curated.groupBy("observation_date").agg(F.count("*").alias("n_rows"), *present)
