"""Freshness, rejection and failure checks as rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import age_minutes, bounded, percentage, zoned_time

SEVERITY = ("healthy", "warning", "critical")


@dataclass(frozen=True)
class Thresholds:
    max_observation_age_minutes: float = 180.0
    max_run_age_minutes: float = 120.0
    max_rejection_pct: float = 10.0
    clock_skew_minutes: int = 5
    failure_hours: int = 24

    def __post_init__(self):
        for name, v in vars(self).items():
            if isinstance(v, bool) or not isinstance(v, (int, float)) or not 0 < v < float("inf"):
                raise ValueError(f"{name} must be a finite positive number")
        if self.max_rejection_pct > 100:
            raise ValueError("max_rejection_pct must be at most 100")


def _skewed(now: Column, t: Thresholds) -> Column:
    return now + F.expr(f"INTERVAL {t.clock_skew_minutes} MINUTES")


def station_health(fact: DataFrame, checkpoints: DataFrame, stations: DataFrame, now: Column, t: Thresholds = Thresholds()) -> DataFrame:
    """Two checks an expected station: its observations and its checkpoint."""
    latest = fact.groupBy("station_id").agg(F.max("observed_at").alias("latest"))
    c = checkpoints.select("station_id", "watermark", "updated_at")
    rows = stations.select("station_id").join(latest, "station_id", "left").join(c, "station_id", "left")
    limit = _skewed(now, t)
    seen = F.when(F.col("latest").isNull(), "missing").when(F.col("latest") > limit, "future").when(age_minutes(now, F.col("latest")) > t.max_observation_age_minutes, "stale").otherwise("current")
    behind = (age_minutes(now, F.col("updated_at")) > t.max_run_age_minutes) | (age_minutes(now, F.col("watermark")) > t.max_run_age_minutes)
    live = F.when(F.col("watermark").isNull(), "missing").when((F.col("watermark") > limit) | (F.col("updated_at") > limit), "future").when(behind, "behind").otherwise("current")
    pair = F.array(F.struct(F.lit("observations").alias("subject"), seen.alias("finding"), age_minutes(now, F.col("latest")).alias("age_minutes")), F.struct(F.lit("checkpoint").alias("subject"), live.alias("finding"), age_minutes(now, F.col("watermark")).alias("age_minutes")))
    out = rows.select("station_id", F.explode(pair).alias("c")).select("station_id", "c.*")
    return out.select(F.concat_ws(":", "subject", "station_id").alias("check_name"), F.when(F.col("finding") == "current", "healthy").otherwise("critical").alias("status"), "finding", "age_minutes")


def latest_live_run(runs: DataFrame, checkpoints: DataFrame, stations: DataFrame) -> DataFrame:
    """The latest nonempty run that a live checkpoint refers to."""
    live = checkpoints.join(stations.select("station_id"), "station_id", "left_semi").select("batch_id")
    return runs.join(live, "batch_id", "left_semi").filter("accepted_count + rejected_count > 0").orderBy(F.desc("completed_at"), F.desc("batch_id")).limit(1)


def quality_health(runs: DataFrame, checkpoints: DataFrame, stations: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row: the rejection rate of the latest live run, missing measures beside it."""
    run = latest_live_run(runs, checkpoints, stations).select("batch_id", percentage(F.col("rejected_count"), F.col("input_count")).alias("rejection_pct"), percentage(F.col("missing_measurement_count"), 3 * F.col("accepted_count")).alias("missing_pct"))
    one = run.agg(F.max("batch_id").alias("batch_id"), F.max("rejection_pct").alias("rejection_pct"), F.max("missing_pct").alias("missing_pct"))
    bad = F.col("batch_id").isNull() | (F.col("rejection_pct") > t.max_rejection_pct)
    return one.select(F.lit("rejection_rate").alias("check_name"), F.when(bad, "warning").otherwise("healthy").alias("status"), "batch_id", "rejection_pct", "missing_pct")


#: Lines of the tail of an event log.
NEWEST = 2000


def parse_events(lines: DataFrame, newest: int | None = NEWEST) -> DataFrame:
    """The ``newest`` lines (None: all) of an event log (columns line_no, value)
    with at (null: no object, or no zoned time), status, batch_id and error.

    A line is parsed once; what isn't an object gives nulls, and no JSON value but
    a text reads like a time with a zone.
    """
    tail = lines if newest is None else lines.orderBy(F.desc("line_no")).limit(newest)
    rows = tail.select("line_no", F.from_json("value", "at string, status string, batch_id string, error string").alias("_e"))
    return rows.select("line_no", zoned_time(F.col("_e.at")).alias("at"), "_e.status", "_e.batch_id", "_e.error")


def recent_lines(lines: DataFrame, now: Column, t: Thresholds = Thresholds()) -> DataFrame:
    """The lines in which a date of the last ``failure_hours`` stands, as far as the
    widest offsets of zones reach; a test of text that comes before the parse."""
    back = -(-(t.failure_hours + 18) // 24)
    dates = [F.date_format(now + F.expr(f"INTERVAL {d} DAYS"), "yyyy-MM-dd") for d in range(-back, 2)]
    here = F.lit(False)
    for d in dates:
        here = here | F.col("value").contains(d)
    return lines.filter(here)


def failure_health(events: DataFrame, checkpoints: DataFrame, stations: DataFrame, now: Column, t: Thresholds = Thresholds()) -> DataFrame:
    """One row: failures of the last day that neither a later success of the
    batch nor later live progress resolves, and the latest of them.  events: of
    all lines or ``recent_lines``, since a tail may be shorter than the day."""
    limit = _skewed(now, t)
    # What resolves a failure of the last day lies in the last day too.
    valid = events.filter((F.col("at") <= limit) & (F.col("at") >= now - F.expr(f"INTERVAL {t.failure_hours} HOURS")))
    success = valid.filter("status = 'succeeded' and batch_id is not null").groupBy("batch_id").agg(F.max("at").alias("_success"))
    live = checkpoints.join(stations.select("station_id"), "station_id", "left_semi").filter(F.col("updated_at") <= limit).agg(F.max("updated_at").alias("_live"))
    failed = valid.filter(F.col("status").isin("failed", "ingestion_failed"))
    both = failed.join(success, "batch_id", "left").withColumn("_k", F.lit(1)).join(live.withColumn("_k", F.lit(1)), "_k")
    resolved = F.coalesce(F.col("_live") > F.col("at"), F.lit(False)) | ((F.col("status") == "failed") & F.coalesce(F.col("_success") > F.col("at"), F.lit(False)))
    open_ = both.filter(~resolved)
    one = open_.agg(F.count("*").alias("unresolved"), F.max_by(F.struct("status", "batch_id", bounded(F.coalesce("error", F.lit("Unknown failure"))).alias("error")), F.struct("at", "line_no")).alias("_f"), F.max("at").alias("latest_at"))
    return one.select(F.lit("recent_failures").alias("check_name"), F.when(F.col("unresolved") > 0, "critical").otherwise("healthy").alias("status"), "unresolved", "latest_at", F.col("_f.status").alias("latest_status"), F.col("_f.batch_id").alias("latest_batch_id"), F.col("_f.error").alias("latest_error"))


def log_health(lines: DataFrame, now: Column, t: Thresholds = Thresholds(), newest: int = NEWEST) -> DataFrame:
    """One row: the ``newest`` lines of the log that are invalid or lie in the
    future, and whether the log (of n_lines) has more lines than these."""
    whole = lines.agg(F.count("*").alias("n_lines"))
    one = parse_events(lines, newest).agg(F.count("*").alias("n_events"), F.count_if(F.col("at").isNull()).alias("invalid_events"), F.count_if(F.col("at") > _skewed(now, t)).alias("future_events"))
    bad = (F.col("invalid_events") > 0) | (F.col("future_events") > 0)
    return one.crossJoin(whole).select(F.lit("event_log").alias("check_name"), F.when(bad, "warning").otherwise("healthy").alias("status"), "n_events", "invalid_events", "future_events", "n_lines", (F.col("n_lines") > F.col("n_events")).alias("truncated"))


def records_health(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("_n")).select(F.lit("warehouse_records").alias("check_name"), F.when(F.col("_n") == 0, "critical").otherwise("healthy").alias("status"))


def overall(*checks: DataFrame) -> DataFrame:
    """The worst status of all checks, and how many there are of each."""
    rows = checks[0].select("check_name", "status")
    for c in checks[1:]:
        rows = rows.unionByName(c.select("check_name", "status"))
    rank = F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), F.col("status"))
    one = rows.agg(F.max(rank).alias("_worst"), F.count("*").alias("n_checks"), F.count_if(F.col("status") != "healthy").alias("n_unhealthy"))
    return one.select(F.element_at(F.array(*[F.lit(s) for s in SEVERITY]), F.col("_worst").cast("int")).alias("status"), "n_checks", "n_unhealthy")
