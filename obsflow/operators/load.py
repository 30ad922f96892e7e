"""The batch transform and the incremental load, composed."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spec import FEED, Feed
from ..sources.tables import Warehouse, days_of
from . import contract, coverage, dedup, marts, merge, validate


@dataclass
class Transformed:
    curated: DataFrame
    rejected: DataFrame
    counts: DataFrame
    coverage: DataFrame


def transform(lines: DataFrame, allowed: list[str], reference: dt.datetime, feed: Feed = FEED) -> Transformed:
    """Validation, split, normalization, dedup and report of raw lines."""
    classified = validate.classify(lines, allowed, reference, feed)
    curated = dedup.curated(validate.accepted(classified))
    stations = lines.sparkSession.createDataFrame([(s,) for s in allowed], "station_id string")
    now = F.lit(reference.astimezone(dt.UTC).replace(tzinfo=None)).cast("timestamp_ntz")
    return Transformed(curated, validate.rejected(classified), dedup.quality_counts(classified), coverage.coverage(curated, stations, now, feed.gap_minutes))


@dataclass
class Batch:
    """A batch ready to load; frames as ``contract.violations`` takes them.
    stations: also station_name, latitude, longitude, metadata_ingested_at."""

    batch_id: str
    source: str
    curated: DataFrame
    stations: DataFrame
    windows: DataFrame
    report: DataFrame
    raw_path: str = ""
    advance_checkpoint: bool = True

    def fingerprint(self) -> str:
        """Of contents and attributes; where the files lie doesn't matter."""
        parts = contract.table_set_fingerprint({"curated": self.curated, "stations": self.stations, "windows": self.windows, "report": self.report})
        rows = sorted((r["table_name"], r["digest"]) for r in parts.collect())  # 4 rows
        import hashlib

        return hashlib.sha256(repr((self.batch_id, self.source, self.advance_checkpoint, rows)).encode()).hexdigest()


def load(warehouse: Warehouse, batch: Batch, loaded_at: Column | None = None, before_publish=None) -> dict:
    """Loads a batch once: status, and inserted, updated and unchanged counts.

    A batch id that is there with the same fingerprint changes nothing; with
    another one it is an error, and so is a batch that breaks its contract.  Of
    facts and versions the days of the batch alone are read and rewritten.  A load
    that was published since this one began makes it fail, not lose its changes.
    """
    if not batch.batch_id.strip() or "/" in batch.batch_id or batch.batch_id in (".", ".."):
        raise ValueError("a batch id must be a plain path component")
    spark = warehouse.spark
    now = F.lit(dt.datetime.now(dt.UTC).replace(tzinfo=None)).cast("timestamp_ntz") if loaded_at is None else loaded_at
    state, days = warehouse.state(), days_of(batch.curated)
    old = warehouse.snapshot(state, days)
    digest = batch.fingerprint()
    mine = spark.createDataFrame([(batch.batch_id, digest)], "batch_id string, input_fingerprint string")
    status = contract.batch_status(mine, old["etl_runs"]).first()["status"]
    if status == "already_loaded":
        return {"status": status, "inserted_count": 0, "updated_count": 0, "unchanged_count": batch.curated.count()}
    if status == "collision":
        raise ValueError(f"batch {batch.batch_id} was loaded with other content")
    broken = contract.violations(batch.curated, batch.stations, batch.windows, batch.report).filter("violations > 0").collect()  # at most 12 rows
    if broken:
        raise ValueError("the batch breaks its contract: " + ", ".join(r["check_name"] for r in broken))
    elig = merge.eligible(batch.curated, old["observation_versions"])
    fact = merge.stamped(elig, F.lit(batch.batch_id), now)
    counts = merge.load_counts(batch.curated, elig, old["fact_observation"])
    n = counts.first()
    stamps = {"batch_id": batch.batch_id, "input_fingerprint": digest, "source": batch.source, "raw_path": batch.raw_path, **n.asDict()}
    run = batch.report.withColumns({c: F.lit(v) for c, v in stamps.items()} | {"completed_at": now})
    tables = {
        "fact_observation": merge.merge_fact(old["fact_observation"], fact),
        "observation_versions": merge.merge_ledger(old["observation_versions"], elig),
        "dim_station": merge.upsert_stations(old["dim_station"], batch.stations),
        "dim_date": old["dim_date"].unionByName(marts.dim_date(fact, old["dim_date"])),
        "etl_runs": old["etl_runs"].unionByName(run.select(*old["etl_runs"].columns)),
    }
    if batch.advance_checkpoint:
        fresh = merge.checkpoints_of(batch.windows, F.lit(batch.batch_id), now)
        tables["source_checkpoints"] = merge.upsert_checkpoints(old["source_checkpoints"], fresh)
    warehouse.commit(tables, before_publish, state, days)
    return {"status": "loaded", **n.asDict()}
