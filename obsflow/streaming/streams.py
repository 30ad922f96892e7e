"""Streams over the landing folder: validation, loads, windows, sessions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.spec import FEED, KEYS, Feed
from ..operators import load, process, validate
from ..sources.tables import Warehouse


def read_landing(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def classify_stream(lines: DataFrame, allowed: list[str], reference: dt.datetime, feed: Feed = FEED) -> DataFrame:
    """The batch rules, unchanged: they are stateless."""
    return validate.classify(lines, allowed, reference, feed)


def load_stream(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """foreachBatch(load).  The load must be idempotent on the batch number,
    since a batch may run again after a failure."""
    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def load_landing(warehouse: Warehouse, query: str, lines: DataFrame, stations: DataFrame, reference: dt.datetime, checkpoint: str, loaded_at: Column | None = None, feed: Feed = FEED, before_publish=None, available_now: bool = True) -> StreamingQuery:
    """A stream of lines into the warehouse: each micro-batch is a batch of the run
    ledger, named by query and number.

    A micro-batch that runs again, since the stream stopped before it was noted as
    done, finds its own entry and changes nothing; one that stopped before it was
    published leaves nothing and is loaded anew.  stations: station_id, and
    station_name, latitude and longitude if known.
    """
    spark = warehouse.spark
    allowed = [r["station_id"] for r in stations.select("station_id").distinct().collect()]  # a dimension, as rules take it
    asked = {"station_name": "string", "latitude": "double", "longitude": "double"}
    zone_free = F.lit(reference.astimezone(dt.UTC).replace(tzinfo=None)).cast("timestamp_ntz")
    known = stations.select("station_id", *[F.col(c) if c in stations.columns else (F.col("station_id") if c == "station_name" else F.lit(None).cast(t)).alias(c) for c, t in asked.items()], zone_free.alias("metadata_ingested_at"))

    def run(some: DataFrame, number: int) -> None:
        name = f"{query}-{number:010d}"
        attempt = process.transform_landed(some, name, f"{warehouse.root}/streams", allowed, reference, feed)
        if not attempt.counts["input_count"]:
            return
        curated = process.curated_of(spark, attempt)
        tick = F.expr("INTERVAL 1 MICROSECOND")
        windows = curated.groupBy("station_id").agg(F.min("observed_at").alias("start"), (F.max("observed_at") + tick).alias("end"))
        if not attempt.counts["accepted_count"]:  # its run is noted, no checkpoint moves
            windows = stations.select("station_id", (zone_free - tick).alias("start"), zone_free.alias("end"))
        advance = attempt.counts["accepted_count"] > 0
        load.load(warehouse, load.Batch(name, query, curated, known, windows, process.counts_of(spark, attempt), attempt.path, advance), loaded_at, before_publish)

    return load_stream(lines, run, checkpoint, available_now)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows written once each, as soon as the watermark says they are final."""
    return rows.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def state_rows(q: StreamingQuery) -> list[int]:
    """Rows that the stateful operators kept after each micro-batch."""
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in q.recentProgress]


def late_rows(q: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped; an aggregation counts
    them after its partial sums."""
    return sum(o["numRowsDroppedByWatermark"] for p in q.recentProgress for o in p["stateOperators"])


def redeliveries_dropped(obs: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Exact redeliveries of a key within the delay; the first one stays."""
    return obs.withWatermark("observed_at", delay).dropDuplicatesWithinWatermark([*KEYS, "payload_hash"])


def tumbling(obs: DataFrame, width: str = "1 hour", delay: str = "2 hours", at: str = "observed_at") -> DataFrame:
    """Counts and mean temperature a station and window; batch or stream."""
    w = F.window(at, width)
    out = obs.withWatermark(at, delay).groupBy(w, "station_id").agg(F.count("*").alias("n_rows"), F.avg("temperature_c").alias("avg_temperature_c"))
    return out.select("station_id", F.col("window.start").alias("window_start"), "n_rows", "avg_temperature_c")


def sessions(obs: DataFrame, gap: str = "2 hours", delay: str = "2 hours", at: str = "observed_at") -> DataFrame:
    """Stretches of a station without a gap over ``gap``; batch or stream."""
    w = F.session_window(at, gap)
    out = obs.withWatermark(at, delay).groupBy(w, "station_id").agg(F.count("*").alias("n_rows"))
    return out.select("station_id", F.col("session_window.start").alias("session_start"), "n_rows")
