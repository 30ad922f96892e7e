"""Incremental versions, facts, dimensions and checkpoints as ordinary joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spec import CURATED, KEYS
from .dedup import winners


def eligible(incoming: DataFrame, versions: DataFrame) -> DataFrame:
    """Incoming rows that are new, later than the version seen last, or of the
    same time with a hash not below it."""
    v = versions.select(*KEYS, F.col("source_ingested_at").alias("_seen_at"), F.col("payload_hash").alias("_seen_hash"))
    new = F.col("_seen_at").isNull()
    later = F.col("source_ingested_at") > F.col("_seen_at")
    tie = (F.col("source_ingested_at") == F.col("_seen_at")) & (F.col("payload_hash") >= F.col("_seen_hash"))
    return incoming.join(v, KEYS, "left").filter(new | later | tie).drop("_seen_at", "_seen_hash")


def load_counts(incoming: DataFrame, elig: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: inserted, updated and unchanged (the rest, stale rows included)."""
    old = fact.select(*KEYS, F.col("payload_hash").alias("_old"))
    n = elig.join(old, KEYS, "left").agg(F.count_if(F.col("_old").isNull()).alias("inserted_count"), F.count_if(F.col("_old") != F.col("payload_hash")).alias("updated_count"))
    total = incoming.agg(F.count("*").alias("_n"))
    both = n.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")
    return both.select("inserted_count", "updated_count", (F.col("_n") - F.col("inserted_count") - F.col("updated_count")).alias("unchanged_count"))


def merge_fact(fact: DataFrame, elig: DataFrame) -> DataFrame:
    """Facts after the merge: changed hashes replace whole rows, absent keys are
    inserted, everything else stays.  Both sides have the same columns."""
    rest = [c for c in fact.columns if c not in KEYS]
    old, new = F.struct(*rest).alias("_old"), F.struct(*[F.col(c) for c in rest]).alias("_new")
    both = fact.select(*KEYS, old).join(elig.select(*KEYS, new), KEYS, "full_outer")
    take = F.col("_old").isNull() | (F.col("_new").isNotNull() & (F.col("_new.payload_hash") != F.col("_old.payload_hash")))
    row = F.when(take, F.col("_new")).otherwise(F.col("_old"))
    return both.select(*KEYS, row.alias("_row")).select(*KEYS, "_row.*").select(*fact.columns)


def merge_ledger(versions: DataFrame, elig: DataFrame) -> DataFrame:
    """The version ledger: eligible rows always replace."""
    columns = [*KEYS, "source_ingested_at", "payload_hash"]
    return versions.select(*columns).join(elig.select(*KEYS), KEYS, "left_anti").unionByName(elig.select(*columns))


def upsert_stations(dim: DataFrame, incoming: DataFrame) -> DataFrame:
    """Type 1: metadata of the same or a later time replace all attributes."""
    both = dim.withColumn("_new", F.lit(0)).unionByName(incoming.select(*dim.columns).withColumn("_new", F.lit(1)))
    return winners(both, ["station_id"], [F.desc("metadata_ingested_at"), F.desc("_new")]).drop("_new")


def upsert_checkpoints(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Only a strictly later watermark replaces a checkpoint."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.select(*existing.columns).withColumn("_new", F.lit(1)))
    return winners(both, ["station_id"], [F.desc("watermark"), F.asc("_new")]).drop("_new")


def ordered_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """station_id and watermark of every checkpoint, by station: Spark sorts by ranges."""
    return checkpoints.select("station_id", "watermark").orderBy("station_id")


def checkpoints_of(windows: DataFrame, batch_id: Column, updated_at: Column) -> DataFrame:
    """A checkpoint a station: the end of its latest window."""
    ends = windows.groupBy("station_id").agg(F.max("end").alias("watermark"))
    return ends.select("station_id", "watermark", batch_id.alias("batch_id"), updated_at.alias("updated_at"))


def stamped(curated: DataFrame, batch_id: Column, loaded_at: Column) -> DataFrame:
    """Curated rows as facts: observation date and lineage."""
    return curated.select(*[n for n, _ in CURATED], F.to_date("observed_at").alias("observation_date"), batch_id.alias("batch_id"), loaded_at.alias("loaded_at"))
