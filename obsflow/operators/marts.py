"""Summaries over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spec import MEASURE_COLUMNS
from ..functions.values import iso_text, missing_count, percentage

def dim_date(dates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Rows for the distinct ``observation_date`` not in the dimension yet."""
    d = F.col("observation_date")
    fresh = dates.select("observation_date").filter(d.isNotNull()).distinct()
    if existing is not None:
        fresh = fresh.join(existing, "observation_date", "left_anti")
    return fresh.select(d, F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), (F.weekday(d) + 1).alias("iso_day_of_week"))


def observations(fact: DataFrame, stations: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Facts with station attributes and the number of missing measures."""
    if "observation_date" not in fact.columns:
        fact = fact.withColumn("observation_date", F.to_date("observed_at"))
    s = stations.select("station_id", "station_name", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    out = fact.join(s, "station_id")
    if dates is not None:
        out = out.join(dates.select("observation_date"), "observation_date")
    out = out.withColumns({"latitude": F.coalesce("latitude", "_lat"), "longitude": F.coalesce("longitude", "_lon"), "missing_measurements": missing_count()})
    first = ["observation_date", "observed_at", "station_id", "station_name", "latitude", "longitude", *MEASURE_COLUMNS, "missing_measurements"]
    return out.select(*first, *[c for c in out.columns if c not in first and not c.startswith("_")])


def daily(obs: DataFrame) -> DataFrame:
    """A row a station and UTC day; averages leave out missing measures."""
    missing = F.sum("missing_measurements")
    slots = F.count("*") * len(MEASURE_COLUMNS)
    return obs.groupBy("observation_date", "station_id", "station_name").agg(
        F.count("*").alias("observation_count"), F.avg("temperature_c").alias("avg_temperature_c"), F.min("temperature_c").alias("min_temperature_c"),
        F.max("temperature_c").alias("max_temperature_c"), F.avg("humidity_pct").alias("avg_humidity_pct"), F.avg("wind_kph").alias("avg_wind_kph"),
        missing.alias("missing_measurements"), percentage(slots - missing, slots).alias("completeness_pct"), F.max("observed_at").alias("latest_observed_at"),
    )


def hourly(obs: DataFrame) -> DataFrame:
    """Mean temperature a station and hour."""
    hour = F.date_trunc("hour", "observed_at").cast("timestamp_ntz")
    return obs.groupBy("station_id", hour.alias("hour")).agg(F.avg("temperature_c").alias("avg_temperature_c"), F.count("temperature_c").alias("n_values"))


def completeness(obs: DataFrame) -> DataFrame:
    """Share of measures present a station, over observations, not days."""
    n, missing = F.count("*"), F.sum(missing_count())
    return obs.groupBy("station_id").agg(n.alias("observation_count"), (F.lit(1.0) - missing / (n * len(MEASURE_COLUMNS))).alias("completeness"))


def run_quality(runs: DataFrame) -> DataFrame:
    return runs.withColumn("rejection_pct", percentage(F.col("rejected_count"), F.col("input_count")))


def summary(fact: DataFrame, stations: DataFrame, runs: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One row: counts of the tables, first and last observation, last load, and the
    checkpoints as a map from station to UTC text, an entry a station."""
    f = fact.agg(F.count("*").alias("observation_count"), F.min("observed_at").alias("earliest_observed_at"), F.max("observed_at").alias("latest_observed_at"))
    s = stations.agg(F.count("*").alias("station_count"))
    r = runs.agg(F.count("*").alias("completed_batch_count"), F.max("completed_at").alias("last_completed_at"))
    c = checkpoints.agg(F.map_from_entries(F.collect_list(F.struct("station_id", iso_text(F.col("watermark")).alias("watermark")))).alias("checkpoints"))
    one = F.lit(1)
    out = f.withColumn("_k", one)
    for part in (s, r, c):
        out = out.join(part.withColumn("_k", one), "_k")
    return out.drop("_k")


def extract_summary(obs: DataFrame, loaded: str = "loaded_at") -> DataFrame:
    """One row: rows, stations, latest observation and load (null if there is none),
    and a header text."""
    one = obs.agg(F.count("*").alias("row_count"), F.countDistinct("station_id").alias("station_count"), F.max("observed_at").alias("latest_observed_at"), F.max(loaded).alias("latest_loaded_at"))
    text = F.concat(F.format_number("row_count", 0), F.lit(" observations from "), F.col("station_count"), F.lit(" stations, latest "), F.coalesce(F.date_format("latest_observed_at", "yyyy-MM-dd HH:mm"), F.lit("none")))
    return one.withColumn("header", text)
