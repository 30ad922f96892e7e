"""Gaps, lag and absence of stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import iso_text, micros


def gaps(obs: DataFrame, minutes: int = 120) -> DataFrame:
    """Stretches of a station without an observation for over ``minutes``.

    The lag is taken within a station's day; each day's first observation is
    compared with the last of the station's day before it, so a large station
    spreads over as many tasks as it has days.
    """
    days = obs.select("station_id", "observed_at", F.to_date("observed_at").alias("day"))
    inside = days.withColumn("previous_at", F.lag("observed_at").over(Window.partitionBy("station_id", "day").orderBy("observed_at")))
    ends = days.groupBy("station_id", "day").agg(F.min("observed_at").alias("observed_at"), F.max("observed_at").alias("last_at"))
    seams = ends.withColumn("previous_at", F.lag("last_at").over(Window.partitionBy("station_id").orderBy("day"))).select("station_id", "observed_at", "previous_at")
    both = inside.filter("previous_at is not null").select("station_id", "observed_at", "previous_at").unionByName(seams.filter("previous_at is not null"))
    seconds = (micros(F.col("observed_at")) - micros(F.col("previous_at"))) / F.lit(1_000_000.0)
    return both.withColumn("gap_seconds", seconds).filter(F.col("gap_seconds") > 60 * minutes)


def coverage(obs: DataFrame, stations: DataFrame, reference: Column, minutes: int = 120) -> DataFrame:
    """One row an expected station: counts, gaps, lag, absence, staleness."""
    seen = obs.groupBy("station_id").agg(F.count("*").alias("accepted_count"), F.max("observed_at").alias("_latest"))
    gap_counts = gaps(obs, minutes).groupBy("station_id").agg(F.count("*").alias("gap_count"))
    behind = F.greatest(F.lit(0.0), (micros(reference) - micros(F.col("_latest"))) / F.lit(1_000_000.0)) / 60
    out = stations.select("station_id").join(seen, "station_id", "left").join(gap_counts, "station_id", "left").fillna(0, ["accepted_count", "gap_count"])
    late = F.when(F.col("_latest").isNotNull(), behind)
    return out.select(
        "station_id", "accepted_count", "gap_count", iso_text(F.col("_latest")).alias("latest_observed_at"), late.alias("minutes_behind_reference"),
        F.col("_latest").isNull().alias("missing_in_batch"), F.coalesce(late > minutes, F.lit(False)).alias("stale"),
    )


def rollup(covered: DataFrame) -> DataFrame:
    return covered.agg(F.count_if("missing_in_batch").alias("empty_station_count"), F.count_if("stale").alias("stale_station_count"))
