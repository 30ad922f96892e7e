"""Windows: planning, slicing, admissibility and matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import micros


def _hours(n: int) -> Column:
    if n <= 0:
        raise ValueError("hours must be positive")
    return F.expr(f"INTERVAL {n} HOURS")


def plan(stations: DataFrame, checkpoints: DataFrame, end: Column, start: Column | None = None, overlap_hours: int = 2, initial_hours: int = 24) -> DataFrame:
    """station_id, start, end, valid: from the explicit start, else the
    checkpoint less the overlap, else ``initial_hours`` before the end."""
    w = checkpoints.select("station_id", "watermark")
    begin = F.coalesce(F.lit(None).cast("timestamp_ntz") if start is None else start, F.col("watermark") - _hours(overlap_hours), end - _hours(initial_hours))
    out = stations.select("station_id").join(w, "station_id", "left").select("station_id", begin.alias("start"), end.alias("end"))
    return out.withColumn("valid", F.col("start") < F.col("end"))


def slices(windows: DataFrame, hours: int = 6) -> DataFrame:
    """Windows cut into pieces of at most ``hours``; the last one is short."""
    step = _hours(hours)
    starts = F.sequence(F.col("start"), F.col("end") - F.expr("INTERVAL 1 MICROSECOND"), step)
    cut = windows.filter("start < end").select("station_id", F.col("end").alias("_end"), F.explode(starts).alias("start"))
    return cut.select("station_id", "start", F.least(F.col("start") + step, F.col("_end")).alias("end"))


def admissible(windows: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Windows with the array issues: order, future, too long ago."""
    oldest = now - F.expr(f"INTERVAL {days} DAYS") - F.expr("INTERVAL 1 MINUTE")
    checks = [F.when(F.col("start") >= F.col("end"), "start_not_before_end"), F.when(F.col("end") > now, "future_end"), F.when(F.col("start") < oldest, "too_old")]
    return windows.withColumn("issues", F.array_compact(F.array(*checks)))


def in_window(rows: DataFrame, start: Column, end: Column, at: str = "observed_at") -> DataFrame:
    """Half-open filter; rows without a time are kept, to be rejected later."""
    return rows.filter(F.col(at).isNull() | ((F.col(at) >= start) & (F.col(at) < end)))


def match(obs: DataFrame, windows: DataFrame, hours: int = 6) -> DataFrame:
    """Observations with the windows of their station that hold them.

    Windows are laid over a grid of hours so that the join has an equality on
    (station, cell) and a large station spreads over as many tasks as cells.
    """
    size = 3600 * 1_000_000 * hours
    cell = lambda ts: F.floor(micros(ts) / size)
    last = cell(F.col("end") - F.expr("INTERVAL 1 MICROSECOND"))
    laid = windows.filter("start < end").select("station_id", F.col("start").alias("window_start"), F.col("end").alias("window_end"), F.explode(F.sequence(cell(F.col("start")), last)).alias("_cell"))
    held = (F.col("observed_at") >= F.col("window_start")) & (F.col("observed_at") < F.col("window_end"))
    return obs.withColumn("_cell", cell(F.col("observed_at"))).join(laid, ["station_id", "_cell"]).filter(held).drop("_cell")


def bounds(windows: DataFrame) -> DataFrame:
    return windows.agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_windows"))


def missed_slots(runs: DataFrame, period_minutes: int) -> DataFrame:
    """runs: deadline, started_at.  How many slots passed before each start."""
    late = micros(F.col("started_at")) - micros(F.col("deadline"))
    return runs.withColumn("missed_slots", F.when(late >= 0, F.floor(late / (period_minutes * 60_000_000)) + 1).otherwise(0).cast("long"))
