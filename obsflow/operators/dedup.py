"""Deterministic winners among rows of one key, and a batch's counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spec import CURATED, KEYS
from ..functions.values import missing_count


def winners(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark limits the groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def curated(accepted: DataFrame) -> DataFrame:
    """The latest version of each observation: by ingest time, then hash."""
    columns = [n for n, _ in CURATED if n in accepted.columns]
    extra = ["batch_id"] if "batch_id" in accepted.columns else []
    return winners(accepted.select(*extra, *columns), extra + KEYS, [F.desc("source_ingested_at"), F.desc("payload_hash")])


def quality_counts(classified: DataFrame, by: str = "batch_id") -> DataFrame:
    """input, accepted, rejected, duplicate and missing counts of each batch.

    One pass: lines are counted by key, rejected ones by batch alone, and the
    latest version of a key brings its missing values along.
    """
    good = F.size("reasons") == 0
    version = F.struct("source_ingested_at", "payload_hash")
    rows = classified.select(by, good.alias("_good"), *[F.when(good, F.col(k)).alias(k) for k in KEYS], version.alias("_version"), missing_count().alias("_missing"))
    by_key = rows.groupBy(by, "_good", *KEYS).agg(F.count("*").alias("_n"), F.max_by("_missing", "_version").alias("_missing"))
    total = lambda condition, what: F.coalesce(F.sum(F.when(condition, what)), F.lit(0)).cast("long")
    out = by_key.groupBy(by).agg(
        F.sum("_n").alias("input_count"), total(~F.col("_good"), F.col("_n")).alias("rejected_count"), F.count_if("_good").alias("accepted_count"),
        total(F.col("_good"), F.col("_missing")).alias("missing_measurement_count"),
    )
    return out.withColumn("duplicate_count", F.col("input_count") - F.col("accepted_count") - F.col("rejected_count"))
