"""Queries that go through files: landed batches, streams, logs, partitioned facts.

Each writes what it derives from the given tables to a fresh folder of the shared
one, runs the library on these files and reads the results back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import digests, values
from ..operators import contract, health, incremental, inventory, marts, process, validate
from ..sources import readers
from ..sources.scratch import scratch
from ..sources.tables import Warehouse
from ..streaming import streams
from . import mapping as M
from .registry import query

KINDS = {"l": T.LongType(), "i": T.IntegerType(), "s": T.StringType(), "d": T.DoubleType(), "t": T.TimestampType(), "f": T.ArrayType(T.FloatType())}
FROM, TO = "2024-01-03", "2024-01-28"
#: Lines whose time can't be read stay, to be rejected later.
WINDOW = f"(event_id % 20 IN (0, 3, 6) OR (ts >= TIMESTAMP '{FROM}' AND ts < TIMESTAMP '{TO}'))"


def _lines(spark, sf_dir) -> DataFrame:
    """value and event_id of the raw lines within the window."""
    rows = M.raw_lines(spark, sf_dir, "event_id", "ts").withColumn("observed_at", F.when(~(F.col("event_id") % 20).isin(0, 3, 6), F.col("ts").cast("timestamp_ntz")))
    day = lambda d: F.lit(f"{d} 00:00:00").cast("timestamp_ntz")
    return incremental.in_window(rows, day(FROM), day(TO)).select("value", "event_id")


def _landed(spark, sf_dir, root: str) -> None:
    """Two batches, by event_id, each with its manifest."""
    stations = [{"station_id": s, "name": "" if s == "S0" else f"Station {s}", "latitude": 1.0, "longitude": 2.0} for s in M.STATIONS]
    windows = [{"station_id": s, "start": f"{FROM}T02:00:00+02:00", "end": "2030-01-01T00:00:00Z"} for s in M.STATIONS]
    times = spark.createDataFrame([(w["station_id"], w["start"], w["end"]) for w in windows], "station_id string, start string, end string")
    most = incremental.bounds(times.select("station_id", *[values.zoned_time(F.col(c)).alias(c) for c in ("start", "end")])).first()
    zoned = lambda t: t.isoformat() + "Z"
    lines = _lines(spark, sf_dir)
    for k in range(2):
        manifest = process.manifest_of(f"b{k}", "events", stations, windows, zoned(most["start"]), zoned(most["end"]), "2029-12-31T01:00:00+01:00")
        readers.land_batch(lines.filter(F.col("event_id") % 2 == k).select("value"), root, manifest)


def _items(df: DataFrame, batch_id, item: str, name, value) -> DataFrame:
    return df.select(batch_id.alias("batch_id"), F.lit(item).alias("item"), name.alias("name"), value.cast("long").alias("value"))


RUN = [*contract.COUNTS, "inserted_count", "updated_count", "unchanged_count"]


@query(f"""WITH {M.REASONS}, l AS (SELECT r.*, 'b' || (r.event_id % 2) AS b, ts + to_microseconds(r.event_id % 1000000) AS seen_at FROM raw r JOIN events USING (event_id) WHERE {WINDOW.replace("event_id", "r.event_id")}),
n AS (SELECT b, count(*) + count(*) FILTER (twice) AS i, count(*) FILTER (reasons = '') AS a, count(*) FILTER (reasons <> '') AS r, count(*) FILTER (twice) AS d, coalesce(sum(missing) FILTER (reasons = ''), 0) AS m FROM l GROUP BY b)
SELECT b AS batch_id, item, name, value::BIGINT AS value FROM (
  SELECT b, 'run' AS item, unnest(string_split('{" ".join(RUN)}', ' ')) AS name, unnest([i, a, r, d, m, a, 0, 0]) AS value FROM n
  UNION ALL SELECT b, 'rejected', reason, count(*) FROM (SELECT b, unnest(string_split(reasons, ',')) AS reason FROM l WHERE reasons <> '') GROUP BY ALL
  UNION ALL SELECT b, 'curated', strftime(seen_at, '%Y-%m-%d'), count(*) FROM l WHERE reasons = '' GROUP BY ALL
  UNION ALL SELECT b, 'present', strftime(seen_at, '%Y-%m-%d'), count(*) FILTER (missing = 0) FROM l WHERE reasons = '' GROUP BY ALL
  UNION ALL SELECT b, 'report', unnest(['accepted', 'stale']), unnest([a, 10]) FROM n
  UNION ALL SELECT b, 'event', 'succeeded', 1 FROM n UNION ALL SELECT 'all', 'facts', 'rows', sum(a) FROM n UNION ALL SELECT 'all', 'unnamed_stations', 'S0', 1)""")
def landed_batches(spark, sf_dir):
    """Ledger, quarantine, curated rows, reports and events of two landed batches."""
    root, out = scratch(spark, "landed"), scratch(spark, "processed")
    _landed(spark, sf_dir, root)
    w = Warehouse(spark, f"{out}/warehouse")
    done = [d["attempt"] for d in process.process_all(w, root, out, M.now())]
    runs = w.read("etl_runs")
    entry = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in RUN])).alias("e")
    parts = [_items(runs.select("batch_id", entry), F.col("batch_id"), "run", F.col("e.name"), F.col("e.value"))]
    for a in done:
        b = F.lit(a.batch_id)
        parts.append(_items(validate.reason_counts(process.quarantine(spark, a.lines)), b, "rejected", F.col("reason"), F.col("n_rows")))
        days = process.measures_present(readers.read_curated(spark, a.curated))
        parts += [_items(days, b, item, F.col("observation_date").cast("string"), F.col(c)) for item, c in (("curated", "n_rows"), ("present", "temperature_c"))]
    reports = spark.read.json(f"{out}/reports/batch_id=*")
    covered = F.aggregate(F.transform("station_coverage", lambda s: s["accepted_count"]), F.lit(0).cast("long"), lambda n, x: n + x)
    parts += [_items(reports, F.col("batch_id"), "report", F.lit(name), c) for name, c in (("accepted", covered), ("stale", F.col("stale_station_count")))]
    log = health.parse_events(readers.read_event_lines(spark, f"{out}/events"), None).filter("at is not null")
    parts.append(_items(log.groupBy("batch_id", "status").count(), F.col("batch_id"), "event", F.col("status"), F.col("count")))
    parts.append(_items(w.read("fact_observation").agg(F.count("*").alias("n")), F.lit("all"), "facts", F.lit("rows"), F.col("n")))
    parts.append(_items(w.read("dim_station").filter("station_name = station_id"), F.lit("all"), "unnamed_stations", F.col("station_id"), F.lit(1)))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole


@query(f"""WITH {M.REASONS}, l AS (SELECT r.*, ts + to_microseconds(r.event_id % 1000000) AS seen_at FROM raw r JOIN events USING (event_id) WHERE {WINDOW.replace("event_id", "r.event_id")})
SELECT strftime(seen_at, '%Y-%m-%d') AS day, count(*) AS n_rows, sum(CASE WHEN missing = 0 THEN event_id % 50 END)::DOUBLE AS sum_temperature, (SELECT count(*) + count(*) FILTER (twice) FROM l)::BIGINT AS input_count,
  (SELECT count(*) FROM l WHERE reasons <> '')::BIGINT AS rejected_count FROM l WHERE reasons = '' GROUP BY 1""")
def stream_load(spark, sf_dir):
    """The landing folder loaded as a stream, a ledger entry a micro-batch."""
    landing, root = scratch(spark, "landing"), scratch(spark, "stream-warehouse")
    _lines(spark, sf_dir).select("value").repartition(4).write.text(landing)
    w, checkpoint = Warehouse(spark, root), scratch(spark, "stream-checkpoint")
    stations = spark.createDataFrame([(s,) for s in M.STATIONS], "station_id string")
    for _ in range(2):  # the second run finds nothing to do
        streams.load_landing(w, "events", streams.read_landing(spark, landing, 2), stations, M.REFERENCE, checkpoint, M.now()).awaitTermination()
    runs = w.read("etl_runs").agg(F.sum("input_count").alias("input_count"), F.sum("rejected_count").alias("rejected_count"))
    days = w.read("fact_observation").groupBy(F.col("observation_date").cast("string").alias("day")).agg(F.count("*").alias("n_rows"), F.sum("temperature_c").alias("sum_temperature"))
    return days.withColumn("_k", F.lit(1)).join(runs.withColumn("_k", F.lit(1)), "_k").drop("_k")


#: Every tenth event comes after all others, so most of these are late.
LATE = "event_id % 10 = 0"
APPEND = f"""e AS (SELECT cast(user_id AS VARCHAR) AS station_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END AS temperature_c, {LATE} AS second FROM events),
mark AS (SELECT max(ts) FILTER (NOT second) - INTERVAL 2 HOUR AS w1, max(ts) - INTERVAL 2 HOUR AS w2 FROM e)"""


def _two_files(spark, sf_dir, plan, label: str) -> tuple[DataFrame, int]:
    """The stream's rows, its events in two deliveries, and how many rows the
    watermark dropped."""
    source, path, checkpoint = scratch(spark, label), scratch(spark, f"{label}-out"), scratch(spark, f"{label}-checkpoint")
    e = M.table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp").alias("observed_at"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("temperature_c"), (F.col("event_id") % 10 == 0).alias("second"))
    late = 0
    for second in (False, True):
        rows.filter(F.col("second") == second).drop("second").write.mode("append").parquet(source)
        q = streams.append_stream(plan(spark.readStream.schema(rows.drop("second").schema).parquet(source)), path, checkpoint)
        q.awaitTermination()
        late += streams.late_rows(q)
    return spark.read.parquet(path), late


@query(f"""WITH {APPEND}, w AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM e), l AS (SELECT w.*, second AND window_start + INTERVAL 1 HOUR <= w1 AS late FROM w, mark)
SELECT station_id, window_start, count(*) AS n_rows, round(avg(temperature_c), 6) AS avg_temperature_c, (SELECT count(*) > 0 FROM l WHERE late) AS had_late FROM l, mark
WHERE NOT late AND window_start + INTERVAL 1 HOUR <= w2 GROUP BY station_id, window_start""")
def stream_tumbling_append(spark, sf_dir):
    """Windows that the watermark has closed; later rows don't change them."""
    out, late = _two_files(spark, sf_dir, streams.tumbling, "tumbling-append")
    out = out.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "avg_temperature_c": F.round("avg_temperature_c", 6)})
    return out.withColumn("had_late", F.lit(late > 0))


@query(f"""WITH {APPEND}, a AS (SELECT station_id, ts FROM e WHERE NOT second), g AS (SELECT *, sum((ts - p > INTERVAL 2 HOUR OR p IS NULL)::INT) OVER (PARTITION BY station_id ORDER BY ts) AS k FROM (SELECT *, lag(ts) OVER (PARTITION BY station_id ORDER BY ts) AS p FROM a))
SELECT station_id, min(ts) AS session_start, count(*) AS n_rows FROM g GROUP BY station_id, k HAVING max(ts) + INTERVAL 2 HOUR <= (SELECT w1 FROM mark)""")
def stream_sessions_append(spark, sf_dir):
    """Sessions that the watermark has closed after the first delivery."""
    path = scratch(spark, "sessions-out")
    source = scratch(spark, "sessions-append")
    e = M.table(spark, sf_dir, "events").filter(f"not ({LATE})")
    rows = e.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp").alias("observed_at"))
    rows.write.parquet(source)
    streams.append_stream(streams.sessions(spark.readStream.schema(rows.schema).parquet(source)), path, scratch(spark, "sessions-checkpoint")).awaitTermination()
    out = spark.read.parquet(path)
    return out.withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))


@query(f"""WITH {M.EVENT}, parts AS (SELECT *, CASE WHEN line_no % 7 = 0 THEN 2 WHEN line_no % 3 = 0 THEN 1 ELSE 0 END AS part FROM ev)
SELECT "at", status, batch_id, error FROM parts ORDER BY part DESC, line_no DESC LIMIT 2000""")
def event_log_tail(spark, sf_dir):
    """The newest lines of a log that was appended to three times."""
    path = scratch(spark, "event-log")
    lines = M.event_lines(spark, sf_dir)
    k = F.col("line_no")
    part = F.when(k % 7 == 0, 2).when(k % 3 == 0, 1).otherwise(0)
    for n in range(3):
        lines.filter(part == n).orderBy("line_no").select("value").write.mode("append").text(path)
    return health.parse_events(readers.read_event_lines(spark, path)).drop("line_no")


@query(f"""WITH {M.OBS}, {M.STATION}, d AS (SELECT DISTINCT CAST(observed_at AS DATE) AS observation_date FROM obs) SELECT observation_date, station_id, station_name, count(*) AS n_rows, sum(missing)::BIGINT AS missing_measurements
FROM (SELECT *, CAST(observed_at AS DATE) AS observation_date FROM obs) JOIN station USING (station_id) JOIN d USING (observation_date) WHERE isodow(observation_date) = 1 GROUP BY ALL""")
def mondays(spark, sf_dir):
    """Facts of the days that a filter on the date dimension leaves; only their
    folders are read."""
    fact, dates = _partitioned(spark, sf_dir)
    o = marts.observations(fact, M.stations(spark, sf_dir), dates.filter("iso_day_of_week = 1"))
    return o.groupBy("observation_date", "station_id", "station_name").agg(F.count("*").alias("n_rows"), F.sum("missing_measurements").alias("missing_measurements"))


def _partitioned(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    path, days = scratch(spark, "facts"), scratch(spark, "dates")
    rows = M.obs(spark, sf_dir).withColumns({"observation_date": F.to_date("observed_at"), "latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")})
    rows.repartition("observation_date").write.partitionBy("observation_date").parquet(path)
    fact = spark.read.parquet(path)
    marts.dim_date(fact).write.parquet(days)
    return fact, spark.read.parquet(days)


def _fingerprint_sql() -> str:
    parts = []
    for t, columns in M.COLUMNS.items():
        texts = [digests.sql_text(f'"{c}"', KINDS[kind]) for c, kind in (x.split(":") for x in columns.split())]
        row = " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in texts)
        half = lambda at: f"coalesce(sum(('0x' || md5[{at}:{at + 15}])::UBIGINT::HUGEINT), 0)"
        parts.append(f"SELECT '{t}' AS table_name, count(*) AS n_rows, {half(1)} AS one, {half(17)} AS two FROM (SELECT md5({row}) AS md5 FROM {t})")
    return f"SELECT table_name, n_rows, sha256(n_rows || '|' || one || '|' || two) AS digest FROM ({' UNION ALL '.join(parts)})"


@query(_fingerprint_sql())
def table_fingerprints(spark, sf_dir):
    """Digests of all fourteen tables."""
    return contract.table_set_fingerprint({t: M.table(spark, sf_dir, t) for t in M.COLUMNS})


@query("""SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{"value":"Infinity"}' WHEN 1 THEN '{"value":"-Infinity"}' WHEN 2 THEN '{"value":"NaN"}' WHEN 3 THEN '{}' ELSE '{"value":' || (event_id % 1000 / 4.0::DOUBLE)::VARCHAR || '}' END AS text FROM events""")
def json_numbers(spark, sf_dir):
    """Numbers as JSON text can hold them."""
    k = F.col("event_id") % 5
    x = F.when(k == 0, float("inf")).when(k == 1, float("-inf")).when(k == 2, float("nan")).when(k == 4, F.col("event_id") % 1000 / 4.0)
    return M.table(spark, sf_dir, "events").select("event_id", values.json_number(x).alias("text"))


@query(f"""SELECT day, count(*) AS n_rows FROM (SELECT strftime(ts, '%Y-%m-%d') AS day FROM events WHERE {WINDOW}) GROUP BY day""")
def window_filter(spark, sf_dir):
    """Half-open windows; rows without a time stay."""
    e = M.table(spark, sf_dir, "events").withColumn("observed_at", F.when(~(F.col("event_id") % 20).isin(0, 3, 6), F.col("ts").cast("timestamp_ntz")))
    day = lambda d: F.lit(f"{d} 00:00:00").cast("timestamp_ntz")
    kept = incremental.in_window(e, day(FROM), day(TO))
    return kept.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n_rows"))


@query("""WITH f AS (SELECT event_id % 8 AS k, count(*) AS n FROM events GROUP BY 1)
SELECT 'b' || k AS batch_id, 'day=' || (k % 4) || '/lines-' || (k // 4) || '.txt' AS raw_path, CASE WHEN k % 8 = 3 THEN 'missing' WHEN k % 8 = 5 THEN 'digest_mismatch' WHEN k % 8 = 6 THEN 'count_mismatch' ELSE 'ok' END AS status FROM f""")
def landed_files(spark, sf_dir):
    """Landed files, of one name in several folders, against their manifests."""
    root = scratch(spark, "files")
    e = M.table(spark, sf_dir, "events").select((F.col("event_id") % 8).alias("k"), F.to_json(F.struct("event_id", "props")).alias("value"))
    place = lambda k: f"day={k % 4}/lines-{k // 4}.txt"
    for k in range(8):
        if k != 3:
            readers.write_file(e.filter(F.col("k") == k).select("value"), f"{root}/{place(k)}")
    name = F.concat(F.lit("day="), F.col("k") % 4, F.lit("/lines-"), F.floor(F.col("k") / 4), F.lit(".txt"))
    counts = e.groupBy("k").agg(F.count("*").alias("n")).select(F.concat(F.lit("b"), F.col("k")).alias("batch_id"), name.alias("raw_path"), "k", (F.col("n") + (F.col("k") == 6).cast("long")).alias("record_count"))
    found = inventory.inventory(spark, root).select(F.col("path").alias("raw_path"), "sha256")
    manifests = counts.join(found, "raw_path", "left").select("batch_id", "raw_path", "record_count", F.when(F.col("k") == 5, "0").otherwise(F.col("sha256")).alias("raw_sha256"))
    return inventory.verify_raw(spark, manifests, root)
