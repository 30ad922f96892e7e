"""The given tables as observations, stations, runs and raw lines.

Each mapping is written twice, for Spark and as a SQL text, with equal columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spec import KEYS
from ..operators.dedup import winners

#: The columns of the given tables: l long, i int, s text, d double, t time, f array of floats.
COLUMNS = {
    "region": "r_regionkey:i r_name:s", "nation": "n_nationkey:i n_name:s n_regionkey:i", "customer": "c_custkey:l c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:l s_name:s s_nationkey:i s_acctbal:d", "part": "p_partkey:l p_name:s p_brand:s p_type:s p_size:i p_retailprice:d",
    "orders": "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:l l_partkey:l l_suppkey:l l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:l ts:t user_id:l event_type:s value:d props:s", "documents": "doc_id:l text:s lang:s source:s n_chars:l", "embeddings": "vec_id:l embedding:f label:i",
    "pages": "page_id:l url:s html:s", "benchmark": "item_id:l text:s", "labels": "doc_id:l quality:i toxic:i", "conversations": "conv_id:l turn:l role:s text:s",
}

NOW = "2024-01-31 00:00:00"
REFERENCE = dt.datetime(2030, 1, 1, tzinfo=dt.UTC)
STATIONS = [f"S{k}" for k in range(10)]


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OBS = """raw_obs AS (SELECT cast(user_id AS VARCHAR) AS station_id, ts AS observed_at,
  CASE WHEN event_id % 7 <> 0 THEN value END AS temperature_c, CASE WHEN event_id % 11 <> 0 THEN value / 3 END AS humidity_pct,
  CASE WHEN event_id % 13 <> 0 THEN value / 2 END AS wind_kph, sha256(concat(cast(event_id AS VARCHAR), '|', props)) AS payload_hash,
  date_trunc('day', ts) + INTERVAL 1 DAY AS source_ingested_at, event_id % 2 AS batch, event_id FROM events),
obs AS (SELECT *, (temperature_c IS NULL)::INT + (humidity_pct IS NULL)::INT + (wind_kph IS NULL)::INT AS missing FROM raw_obs)"""


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i, v = F.col("event_id"), F.col("value")
    return e.select(
        F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp_ntz").alias("observed_at"),
        F.when(i % 7 != 0, v).alias("temperature_c"), F.when(i % 11 != 0, v / 3).alias("humidity_pct"), F.when(i % 13 != 0, v / 2).alias("wind_kph"),
        F.sha2(F.concat(i.cast("string"), F.lit("|"), F.col("props")), 256).alias("payload_hash"),
        (F.date_trunc("day", "ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("source_ingested_at"), (i % 2).alias("batch"), i.alias("event_id"),
    )


STATION = "station AS (SELECT cast(c_custkey AS VARCHAR) AS station_id, c_name AS station_name, c_acctbal / 1000 AS latitude, c_nationkey * 5.0::DOUBLE AS longitude FROM customer)"


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("station_id"), F.col("c_name").alias("station_name"), (F.col("c_acctbal") / 1000).alias("latitude"), (F.col("c_nationkey") * F.lit(5.0)).alias("longitude"))


#: One version of each key of the first batch as what was loaded before.
VERSIONS = """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch, station_id, hour ORDER BY source_ingested_at DESC, payload_hash DESC) AS r
  FROM (SELECT *, date_trunc('hour', observed_at) AS hour FROM obs)) WHERE r = 1),
old AS (SELECT station_id, hour AS observed_at, source_ingested_at, payload_hash, temperature_c FROM best WHERE batch = 0),
incoming AS (SELECT station_id, hour AS observed_at, CASE WHEN event_id % 4 = 0 THEN source_ingested_at - INTERVAL 3 DAY ELSE source_ingested_at END AS source_ingested_at,
  payload_hash, temperature_c FROM best WHERE batch = 1),
eligible AS (SELECT i.* FROM incoming i LEFT JOIN old o USING (station_id, observed_at) WHERE o.station_id IS NULL OR i.source_ingested_at > o.source_ingested_at
  OR (i.source_ingested_at = o.source_ingested_at AND i.payload_hash >= o.payload_hash))"""


def versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(old, incoming): the first two batches by station and hour."""
    hours = obs(spark, sf_dir).withColumn("observed_at", F.date_trunc("hour", "observed_at").cast("timestamp_ntz"))
    best = winners(hours, ["batch", *KEYS], [F.desc("source_ingested_at"), F.desc("payload_hash")])
    columns = [*KEYS, "source_ingested_at", "payload_hash", "temperature_c"]
    early = F.when(F.col("event_id") % 4 == 0, F.col("source_ingested_at") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("source_ingested_at"))
    return best.filter("batch = 0").select(*columns), best.filter("batch = 1").withColumn("source_ingested_at", early).select(*columns)


RUNS = """runs AS (SELECT 'b' || cast(o_orderkey AS VARCHAR) AS batch_id, o_orderdate AS completed_at, n AS input_count, n - r - d AS accepted_count, r AS rejected_count,
  d AS duplicate_count, m AS missing_measurement_count FROM (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS r,
  count(*) FILTER (l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 45) AS d, count(*) FILTER (l_discount > 0.05) AS m FROM lineitem GROUP BY 1) JOIN orders ON o_orderkey = l_orderkey)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run an order, counted from its lines."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.expr("l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 45")).alias("d"), F.count_if(F.col("l_discount") > 0.05).alias("m"),
    )
    both = n.join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return both.select(
        F.concat(F.lit("b"), F.col("o_orderkey").cast("string")).alias("batch_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("completed_at"), F.col("n").alias("input_count"),
        (F.col("n") - F.col("r") - F.col("d")).alias("accepted_count"), F.col("r").alias("rejected_count"), F.col("d").alias("duplicate_count"), F.col("m").alias("missing_measurement_count"),
    )


_CKPT = """ckpt AS (SELECT cast(user_id AS VARCHAR) AS station_id, max(ts) AS watermark, 'b' || cast(max(event_id) AS VARCHAR) AS batch_id,
  max(ts) + INTERVAL 1 HOUR AS updated_at FROM events WHERE {where} GROUP BY user_id)"""
CHECKPOINTS, EARLIER = _CKPT.format(where="true"), _CKPT.format(where="event_type <> 'click'")


def checkpoints(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """A checkpoint a user, at the last event."""
    e = table(spark, sf_dir, "events").filter(where).groupBy("user_id").agg(F.max("ts").cast("timestamp_ntz").alias("watermark"), F.max("event_id").alias("k"))
    return e.select(F.col("user_id").cast("string").alias("station_id"), "watermark", F.concat(F.lit("b"), F.col("k").cast("string")).alias("batch_id"), (F.col("watermark") + F.expr("INTERVAL 1 HOUR")).alias("updated_at"))


EVENT = """ev AS (SELECT event_id AS line_no, CASE WHEN event_id % 50 <> 0 THEN ts END AS "at", CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'succeeded'
  WHEN 'signup' THEN 'ingestion_failed' ELSE 'started' END AS status, 'b' || cast(user_id % 40 AS VARCHAR) AS batch_id, 'error of ' || event_type AS error FROM events)"""


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line an event; each fiftieth has a time without zone."""
    e = table(spark, sf_dir, "events")
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(F.col("event_id") % 50 != 0, "Z").otherwise(""))
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "succeeded").when(F.col("event_type") == "signup", "ingestion_failed").otherwise("started")
    line = F.to_json(F.struct(text.alias("at"), status.alias("status"), F.concat(F.lit("b"), (F.col("user_id") % 40).cast("string")).alias("batch_id"), F.concat(F.lit("error of "), F.col("event_type")).alias("error")))
    return e.select(F.col("event_id").alias("line_no"), line.alias("value"))


#: Partitions a core of rows that are small to read and long to work on.
WAVES = 4


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt evenly over all cores: a file is split by its bytes, and a few
    megabytes of events make minutes of work."""
    return rows.repartition(WAVES * rows.sparkSession.sparkContext.defaultParallelism)


#: The expected reasons of ``raw_lines``, by event_id % 20.
REASONS = """raw AS (SELECT event_id, event_id % 20 AS k, CASE event_id % 20 WHEN 6 THEN NULL WHEN 12 THEN '12' ELSE 'b' || (event_id % 3) END AS batch_id,
  CASE event_id % 20 WHEN 0 THEN 'invalid_observed_at' WHEN 1 THEN CASE WHEN event_id % 7 <> 0 THEN 'unsupported_temperature_unit' ELSE '' END WHEN 2 THEN 'invalid_temperature_value'
  WHEN 3 THEN 'invalid_payload,missing_or_invalid_source_station,invalid_observed_at' WHEN 4 THEN 'humidity_out_of_range' WHEN 5 THEN 'source_station_mismatch'
  WHEN 6 THEN 'invalid_envelope,missing_batch_id,missing_station_id,missing_ingested_at,missing_raw_json,invalid_payload,missing_or_invalid_source_station,invalid_observed_at,invalid_ingested_at'
  WHEN 7 THEN 'unknown_station' WHEN 8 THEN 'future_observed_at' WHEN 9 THEN 'longitude_out_of_range' WHEN 10 THEN 'temperature_out_of_range' WHEN 11 THEN 'invalid_ingested_at'
  WHEN 12 THEN 'invalid_batch_id_type' WHEN 13 THEN 'invalid_text_description' WHEN 14 THEN 'wind_out_of_range' WHEN 15 THEN 'missing_station_id,unknown_station,source_station_mismatch' ELSE '' END AS reasons,
  event_id % 20 = 16 AS twice, (event_id % 7 = 0)::INT AS missing FROM events)"""


def raw_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """A raw line an event, with a defect by event_id % 20; lines of remainder 16
    are delivered twice, and each seventh temperature is null.  more: columns of
    events to carry along."""
    i = F.col("event_id")
    k = i % 20
    s = lambda x: F.lit(x).cast("string")
    station = F.when(k == 7, "nowhere").otherwise(F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")))
    told = F.when(k == 15, " ").otherwise(station)
    url = F.concat(F.lit("https://api.weather.gov/stations/"), F.when(k == 5, "S99").otherwise(station))
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + i % 1_000_000)
    stamp = F.when(k == 8, "2030-01-01T00:11:00Z").otherwise(F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(k == 0, "").otherwise("Z")))
    temperature = F.when(k == 2, '"20"').when(k == 10, "100.0").when(i % 7 == 0, "null").otherwise((i % 50).cast("string"))
    unit = F.when(k == 1, "wmoUnit:foo").otherwise("wmoUnit:degC")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    measure = lambda name, value, code: F.concat(F.lit(f'"{name}":{{"value":'), value, F.lit(',"unitCode":'), q(code), F.lit("}"))
    payload = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), F.when(k == 9, "-181").otherwise("10.5"), F.lit(',45]},"properties":{"station":'), q(url), F.lit(',"timestamp":'), q(stamp), F.lit(","),
        measure("temperature", temperature, unit), F.lit(","), measure("relativeHumidity", F.when(k == 4, "101").otherwise((i % 100).cast("string")), s("wmoUnit:percent")), F.lit(","),
        measure("windSpeed", F.when(k == 14, "-1").otherwise("5"), s("wmoUnit:m_s-1")), F.lit(',"textDescription":'), F.when(k == 13, "7").otherwise('"Clear"'), F.lit("}}"),
    )
    raw = F.when(k == 3, '{"type":').otherwise(payload)
    ingested = F.when(k == 11, "2024-02-30T00:00:00Z").otherwise("2029-12-31T00:00:00Z")
    line = F.to_json(F.struct(F.concat(F.lit("b"), (i % 3).cast("string")).alias("batch_id"), ingested.alias("ingested_at"), told.alias("station_id"), raw.alias("raw_json")))
    line = F.when(k == 6, "not an envelope").when(k == 12, F.regexp_replace(line, '"batch_id":"b[0-9]"', '"batch_id":12')).otherwise(line)
    return spread(table(spark, sf_dir, "events")).select(*more, F.explode(F.array_repeat(line, F.when(k == 16, 2).otherwise(1))).alias("value"))
