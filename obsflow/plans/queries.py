"""One query an operator, over the given tables, and the same in SQL.

Averages and sums are rounded to 6 places where rows meet in no fixed order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import spec, values
from ..operators import contract, coverage, dedup, health, incremental, inventory, marts, merge, reconcile, validate
from ..sources import readers
from ..sources.scratch import scratch
from ..streaming import streams
from . import mapping as M
from .registry import ORACLE, QUERIES, query  # noqa: F401

def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


TIMES = "CAST(TIMESTAMP '" + M.NOW + "' AS TIMESTAMP)"


@query(f"""WITH {M.OBS}, {M.STATION} SELECT CAST(observed_at AS DATE) AS observation_date, station_id, station_name, count(*) AS observation_count,
  round(avg(temperature_c), 6) AS avg_temperature_c, min(temperature_c) AS min_temperature_c, max(temperature_c) AS max_temperature_c, round(avg(humidity_pct), 6) AS avg_humidity_pct,
  round(avg(wind_kph), 6) AS avg_wind_kph, sum(missing)::BIGINT AS missing_measurements, 100.0::DOUBLE * (3 * count(*) - sum(missing)) / (3 * count(*)) AS completeness_pct,
  max(observed_at) AS latest_observed_at FROM obs JOIN station USING (station_id) GROUP BY ALL""")
def daily_summary(spark, sf_dir):
    out = marts.daily(marts.observations(M.obs(spark, sf_dir).withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double")}), M.stations(spark, sf_dir)))
    return rounded(out, "avg_temperature_c", "avg_humidity_pct", "avg_wind_kph")


@query(f"WITH {M.OBS} SELECT station_id, date_trunc('hour', observed_at) AS hour, round(avg(temperature_c), 6) AS avg_temperature_c, count(temperature_c) AS n_values FROM obs GROUP BY ALL")
def hourly_mean(spark, sf_dir):
    return rounded(marts.hourly(M.obs(spark, sf_dir)), "avg_temperature_c")


@query(f"WITH {M.OBS} SELECT station_id, count(*) AS observation_count, 1.0::DOUBLE - sum(missing)::BIGINT / (count(*) * 3)::DOUBLE AS completeness FROM obs GROUP BY ALL")
def station_completeness(spark, sf_dir):
    return marts.completeness(M.obs(spark, sf_dir))


@query(f"""WITH {M.OBS}, {M.STATION} SELECT CAST(observed_at AS DATE) AS observation_date, observed_at, station_id, station_name, coalesce(CASE WHEN event_id % 2 = 0 THEN 1.5::DOUBLE END, latitude) AS latitude, longitude,
  temperature_c, humidity_pct, wind_kph, missing::INT AS missing_measurements, event_id FROM obs JOIN station USING (station_id)""")
def observation_mart(spark, sf_dir):
    o = M.obs(spark, sf_dir).withColumns({"latitude": F.when(F.col("event_id") % 2 == 0, 1.5), "longitude": F.lit(None).cast("double")})
    return marts.observations(o.drop("payload_hash", "source_ingested_at", "batch"), M.stations(spark, sf_dir))


@query("""SELECT DISTINCT CAST(o_orderdate AS DATE) AS observation_date, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day, isodow(o_orderdate)::INT AS iso_day_of_week
  FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_linenumber = 1)""")
def dim_date(spark, sf_dir):
    days = M.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("observation_date"))
    old = marts.dim_date(M.table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select(F.to_date("l_shipdate").alias("observation_date")))
    return marts.dim_date(days, old)


def _classified(spark, sf_dir):
    return validate.classify(M.raw_lines(spark, sf_dir), M.STATIONS, M.REFERENCE)


@query(f"WITH {M.REASONS} SELECT batch_id, reasons, (count(*) + count(*) FILTER (twice))::BIGINT AS n_rows FROM raw GROUP BY ALL")
def validate_reasons(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("batch_id", F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n_rows"))


@query(f"WITH {M.REASONS} SELECT batch_id, reason, count(*) AS n_rows FROM (SELECT batch_id, unnest(string_split(reasons, ',')) AS reason FROM raw WHERE reasons <> '') GROUP BY ALL")
def reject_breakdown(spark, sf_dir):
    return validate.reason_counts(validate.rejected(_classified(spark, sf_dir)), "batch_id")


@query(f"""WITH {M.REASONS} SELECT batch_id, (count(*) + count(*) FILTER (twice))::BIGINT AS input_count, count(*) FILTER (reasons <> '') AS rejected_count, count(*) FILTER (reasons = '') AS accepted_count,
  coalesce(sum(missing) FILTER (reasons = ''), 0)::BIGINT AS missing_measurement_count, count(*) FILTER (twice) AS duplicate_count FROM raw GROUP BY ALL""")
def quality_report(spark, sf_dir):
    return dedup.quality_counts(_classified(spark, sf_dir))


@query(f"WITH {M.REASONS} SELECT count(*)::BIGINT AS n_rows, sum(CASE WHEN missing = 0 THEN event_id % 50 END)::DOUBLE AS sum_temperature, sum(event_id % 100)::DOUBLE AS sum_humidity, (18.0 * count(*))::DOUBLE AS sum_wind FROM raw WHERE reasons = ''")
def curated_rows(spark, sf_dir):
    c = dedup.curated(validate.accepted(_classified(spark, sf_dir)))
    return c.agg(F.count("*").alias("n_rows"), F.sum("temperature_c").alias("sum_temperature"), F.sum("humidity_pct").alias("sum_humidity"), F.sum("wind_kph").alias("sum_wind"))


@query("""SELECT event_id, ['wmoUnit:degC', 'wmoUnit:degF', 'wmoUnit:K', 'wmoUnit:km_h-1', 'wmoUnit:m_s-1', 'wmoUnit:kn', 'wmoUnit:mi_h-1', 'none'][event_id % 8 + 1] AS unit,
  round(CASE event_id % 8 WHEN 0 THEN value WHEN 1 THEN (value - 32) * 5 / 9 WHEN 2 THEN value - 273.15 END, 6) AS temperature_c,
  round(CASE event_id % 8 WHEN 3 THEN value WHEN 4 THEN value * 3.6 WHEN 5 THEN value * 1.852 WHEN 6 THEN value * 1.609344 END, 6) AS wind_kph FROM events""")
def unit_normalize(spark, sf_dir):
    names = [u for m in (spec.MEASURES[0], spec.MEASURES[2]) for u, _, _ in m.units] + ["none"]
    unit = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 8 + 1).cast("int"))
    e = M.table(spark, sf_dir, "events").withColumn("unit", unit)
    return rounded(e.select("event_id", "unit", values.convert(F.col("value"), F.col("unit"), spec.MEASURES[0]).alias("temperature_c"), values.convert(F.col("value"), F.col("unit"), spec.MEASURES[2]).alias("wind_kph")), "temperature_c", "wind_kph")


@query("""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem) WHERE r = 1""")
def dedup_winner(spark, sf_dir):
    best = dedup.winners(M.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")])
    return best.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return contract.duplicate_keys(M.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


GAPS = "lagged AS (SELECT station_id, observed_at, lag(observed_at) OVER (PARTITION BY station_id ORDER BY observed_at) AS previous_at FROM obs)"


@query(f"WITH {M.OBS}, {GAPS} SELECT station_id, observed_at, previous_at, (epoch_us(observed_at) - epoch_us(previous_at)) / 1000000.0::DOUBLE AS gap_seconds FROM lagged WHERE epoch_us(observed_at) - epoch_us(previous_at) > 7200000000")
def gap_detection(spark, sf_dir):
    return coverage.gaps(M.obs(spark, sf_dir))


COVERAGE = f"""{M.OBS}, {M.STATION}, {GAPS}, seen AS (SELECT station_id, count(*) AS n, max(observed_at) AS latest, count(*) FILTER (epoch_us(observed_at) - epoch_us(previous_at) > 7200000000) AS g FROM lagged GROUP BY 1),
covered AS (SELECT station_id, coalesce(n, 0) AS accepted_count, coalesce(g, 0) AS gap_count, strftime(latest, '%Y-%m-%dT%H:%M:%S.%fZ') AS latest_observed_at,
  CASE WHEN latest IS NOT NULL THEN greatest(0.0, (epoch_us({TIMES}) - epoch_us(latest)) / 1000000.0::DOUBLE) / 60 END AS minutes_behind_reference, latest IS NULL AS missing_in_batch,
  coalesce(epoch_us({TIMES}) - epoch_us(latest) > 7200000000, false) AS stale FROM station LEFT JOIN seen USING (station_id))"""


@query(f"WITH {COVERAGE} SELECT * FROM covered")
def station_coverage(spark, sf_dir):
    return coverage.coverage(M.obs(spark, sf_dir), M.stations(spark, sf_dir), M.now())


@query(f"WITH {COVERAGE} SELECT count(*) FILTER (missing_in_batch) AS empty_station_count, count(*) FILTER (stale) AS stale_station_count FROM covered")
def coverage_rollup(spark, sf_dir):
    return coverage.rollup(coverage.coverage(M.obs(spark, sf_dir), M.stations(spark, sf_dir), M.now()))


@query(f"WITH {M.OBS}, {M.VERSIONS} SELECT * FROM eligible")
def eligible_versions(spark, sf_dir):
    old, incoming = M.versions(spark, sf_dir)
    return merge.eligible(incoming, old)


@query(f"""WITH {M.OBS}, {M.VERSIONS} SELECT station_id, observed_at, CASE WHEN t THEN e.source_ingested_at ELSE o.source_ingested_at END AS source_ingested_at, CASE WHEN t THEN e.payload_hash ELSE o.payload_hash END AS payload_hash,
  CASE WHEN t THEN e.temperature_c ELSE o.temperature_c END AS temperature_c FROM (SELECT *, o IS NULL OR (e IS NOT NULL AND e.payload_hash <> o.payload_hash) AS t FROM
  (SELECT station_id, observed_at, CASE WHEN old.payload_hash IS NOT NULL THEN old END AS o, CASE WHEN eligible.payload_hash IS NOT NULL THEN eligible END AS e FROM old FULL JOIN eligible USING (station_id, observed_at)))""")
def merge_fact(spark, sf_dir):
    old, incoming = M.versions(spark, sf_dir)
    return merge.merge_fact(old, merge.eligible(incoming, old))


@query(f"""WITH {M.OBS}, {M.VERSIONS} SELECT station_id, observed_at, source_ingested_at, payload_hash FROM eligible
  UNION ALL SELECT station_id, observed_at, source_ingested_at, payload_hash FROM old ANTI JOIN eligible USING (station_id, observed_at)""")
def merge_ledger(spark, sf_dir):
    old, incoming = M.versions(spark, sf_dir)
    return merge.merge_ledger(old, merge.eligible(incoming, old))


@query(f"""WITH {M.OBS}, {M.VERSIONS} SELECT i AS inserted_count, u AS updated_count, (SELECT count(*) FROM incoming) - i - u AS unchanged_count FROM
  (SELECT count(*) FILTER (o.station_id IS NULL) AS i, count(*) FILTER (o.payload_hash <> e.payload_hash) AS u FROM eligible e LEFT JOIN old o USING (station_id, observed_at))""")
def merge_counts(spark, sf_dir):
    old, incoming = M.versions(spark, sf_dir)
    return merge.load_counts(incoming, merge.eligible(incoming, old), old)


@query("""WITH d AS (SELECT c_custkey AS station_id, c_name AS station_name, TIMESTAMP '2024-01-10' AS metadata_ingested_at, 0 AS n FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, 'new ' || c_name, TIMESTAMP '2024-01-09' + INTERVAL 1 DAY * (c_custkey % 3), 1 FROM customer WHERE c_custkey % 4 > 0)
  SELECT station_id, station_name, metadata_ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY metadata_ingested_at DESC, n DESC) AS r FROM d) WHERE r = 1""")
def dim_upsert(spark, sf_dir):
    c = M.table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "station_id")
    old = c.filter("station_id % 2 = 0").select("station_id", F.col("c_name").alias("station_name"), F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'").alias("metadata_ingested_at"))
    new = c.filter("station_id % 4 > 0").select("station_id", F.concat(F.lit("new "), F.col("c_name")).alias("station_name"), F.expr("TIMESTAMP_NTZ '2024-01-09 00:00:00' + make_dt_interval(cast(station_id % 3 as int))").alias("metadata_ingested_at"))
    return merge.upsert_stations(old, new)


@query(f"""WITH {M.EARLIER}, w AS (SELECT cast(user_id AS VARCHAR) AS station_id, max(ts) + INTERVAL 1 MINUTE AS watermark FROM events WHERE event_type = 'click' GROUP BY 1),
  u AS (SELECT station_id, watermark, batch_id, updated_at, 0 AS n FROM ckpt UNION ALL SELECT station_id, watermark, 'next', {TIMES}, 1 FROM w)
  SELECT station_id, watermark, batch_id, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY watermark DESC, n) AS r FROM u) WHERE r = 1""")
def checkpoint_upsert(spark, sf_dir):
    w = M.table(spark, sf_dir, "events").filter("event_type = 'click'").select(F.col("user_id").cast("string").alias("station_id"), (F.col("ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 MINUTE")).alias("end"))
    return merge.upsert_checkpoints(M.checkpoints(spark, sf_dir, "event_type <> 'click'"), merge.checkpoints_of(w, F.lit("next"), M.now()))


@query(f"WITH {M.CHECKPOINTS} SELECT station_id, watermark FROM ckpt ORDER BY station_id")
def ordered_checkpoints(spark, sf_dir):
    return merge.ordered_checkpoints(M.checkpoints(spark, sf_dir))


@query("SELECT 'b' || o_orderkey AS batch_id, CASE WHEN o_orderkey % 3 = 0 THEN 'new' WHEN o_orderkey % 3 = 1 THEN 'already_loaded' ELSE 'collision' END AS status FROM orders")
def batch_status(spark, sf_dir):
    o = M.table(spark, sf_dir, "orders")
    marked = contract.fingerprint(o.select(F.concat(F.lit("b"), F.col("o_orderkey").cast("string")).alias("batch_id"), "o_orderkey", "o_totalprice", "o_orderstatus"), "batch_id", "o_orderkey")
    incoming = marked.select("batch_id", F.col("digest").alias("input_fingerprint"))
    ledger = marked.filter("o_orderkey % 3 > 0").select("batch_id", F.when(F.col("o_orderkey") % 3 == 1, F.col("digest")).otherwise("other").alias("input_fingerprint"))
    return contract.batch_status(incoming, ledger)


@query("""WITH c AS (SELECT cast(l_suppkey AS VARCHAR) AS station_id, l_shipdate AS observed_at, CASE WHEN l_partkey % 9 > 0 THEN cast(l_partkey AS VARCHAR) END AS payload_hash, l_linenumber % 4 = 0 AS t FROM lineitem),
  s AS (SELECT cast(s_suppkey AS VARCHAR) AS station_id FROM supplier WHERE s_suppkey % 5 > 0), w AS (SELECT cast(s_suppkey AS VARCHAR) AS station_id, s_suppkey % 3 AS k FROM supplier),
  r AS (SELECT count(*) AS i, count(*) AS a, 1 AS r, 0 AS d, 0 AS m FROM c)
  SELECT 'negative_counts' AS check_name, count(*) FILTER (least(i, a, r, d, m) < 0) AS violations FROM r UNION ALL SELECT 'count_identity', count(*) FILTER (i <> a + r + d) FROM r
  UNION ALL SELECT 'accepted_rows', count(*) FILTER (a <> (SELECT count(*) FROM c)) FROM r UNION ALL SELECT 'missing_total', count(*) FILTER (m <> (SELECT count(*) FROM c WHERE t)) FROM r
  UNION ALL SELECT 'required_fields', count(*) FROM c WHERE payload_hash IS NULL UNION ALL SELECT 'duplicate_keys', count(*) FROM (SELECT 1 FROM c GROUP BY station_id, observed_at HAVING count(*) > 1)
  UNION ALL SELECT 'blank_stations', count(*) FROM s WHERE trim(station_id) = '' UNION ALL SELECT 'duplicate_stations', count(*) FROM (SELECT 1 FROM s GROUP BY station_id HAVING count(*) > 1)
  UNION ALL SELECT 'unknown_stations', count(DISTINCT station_id) FROM c WHERE station_id NOT IN (SELECT station_id FROM s)
  UNION ALL SELECT 'unknown_window_stations', count(DISTINCT station_id) FROM w WHERE station_id NOT IN (SELECT station_id FROM s) UNION ALL SELECT 'empty_windows', count(*) FROM w WHERE k = 0 UNION ALL SELECT 'no_windows', (count(*) = 0)::BIGINT FROM w""")
def contract_violations(spark, sf_dir):
    x = M.table(spark, sf_dir, "lineitem")
    c = x.select(F.col("l_suppkey").cast("string").alias("station_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("observed_at"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_tax")).alias("temperature_c"), F.col("l_tax").alias("humidity_pct"), F.col("l_tax").alias("wind_kph"), F.when(F.col("l_partkey") % 9 > 0, F.col("l_partkey").cast("string")).alias("payload_hash"), F.col("l_shipdate").cast("timestamp_ntz").alias("source_ingested_at"))
    s = M.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("station_id"), "s_suppkey")
    w = s.select("station_id", M.now().alias("start"), (M.now() + F.expr("make_dt_interval(0, 0, cast(s_suppkey % 3 as int))")).alias("end"))
    report = x.agg(F.count("*").alias("accepted_count")).select(F.col("accepted_count").alias("input_count"), "accepted_count", F.lit(1).cast("long").alias("rejected_count"), F.lit(0).cast("long").alias("duplicate_count"), F.lit(0).cast("long").alias("missing_measurement_count"))
    return contract.violations(c, s.filter("s_suppkey % 5 > 0").select("station_id"), w, report)


@query(f"WITH {M.RUNS} SELECT *, 100.0::DOUBLE * rejected_count / input_count AS rejection_pct FROM runs")
def run_quality(spark, sf_dir):
    return marts.run_quality(M.runs(spark, sf_dir))


@query(f"""WITH {M.RUNS}, {M.CHECKPOINTS} SELECT (SELECT count(*) FROM events) AS observation_count, (SELECT min(ts) FROM events) AS earliest_observed_at, (SELECT max(ts) FROM events) AS latest_observed_at,
  (SELECT count(*) FROM customer) AS station_count, (SELECT count(*) FROM runs) AS completed_batch_count, (SELECT max(completed_at) FROM runs) AS last_completed_at,
  (SELECT string_agg(station_id || '=' || strftime(watermark, '%Y-%m-%dT%H:%M:%S.%fZ'), ',' ORDER BY station_id) FROM ckpt) AS checkpoints""")
def warehouse_summary(spark, sf_dir):
    out = marts.summary(M.obs(spark, sf_dir), M.stations(spark, sf_dir), M.runs(spark, sf_dir), M.checkpoints(spark, sf_dir))
    entries = F.transform(F.array_sort(F.map_entries("checkpoints")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return out.withColumn("checkpoints", F.array_join(entries, ","))


@query(f"""WITH {M.OBS} SELECT count(*) AS row_count, count(DISTINCT station_id) AS station_count, max(observed_at) AS latest_observed_at, max(source_ingested_at) AS latest_loaded_at,
  format('{{:,}}', count(*)) || ' observations from ' || count(DISTINCT station_id) || ' stations, latest ' || strftime(max(observed_at), '%Y-%m-%d %H:%M') AS header FROM obs""")
def extract_summary(spark, sf_dir):
    return marts.extract_summary(M.obs(spark, sf_dir), "source_ingested_at")


PROFILE = """SELECT 'row_count' AS metric, count(*)::DOUBLE AS value FROM {t} UNION ALL SELECT 'distinct_keys', count(DISTINCT o_orderkey)::DOUBLE FROM {t} UNION ALL SELECT 'null_keys', count(*) FILTER (o_orderkey IS NULL)::DOUBLE FROM {t}
  UNION ALL SELECT 'nulls:o_orderkey', count(*) FILTER (o_orderkey IS NULL)::DOUBLE FROM {t} UNION ALL SELECT 'nulls:o_totalprice', count(*) FILTER (o_totalprice IS NULL)::DOUBLE FROM {t}
  UNION ALL SELECT 'nulls:o_orderstatus', count(*) FILTER (o_orderstatus IS NULL)::DOUBLE FROM {t}
  UNION ALL SELECT 'sum:o_totalprice', sum(o_totalprice::DECIMAL(18,6))::DOUBLE FROM {t} UNION ALL SELECT 'avg:o_totalprice', sum(o_totalprice::DECIMAL(18,6))::DOUBLE / count(o_totalprice) FROM {t}
  UNION ALL SELECT 'min:o_totalprice', min(o_totalprice) FROM {t} UNION ALL SELECT 'max:o_totalprice', max(o_totalprice) FROM {t}"""


def _orders(spark, sf_dir):
    return M.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def _changed(orders):
    price = F.when(F.col("o_orderkey") % 100 == 7, None).when(F.col("o_orderkey") % 100 == 8, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return orders.withColumn("o_totalprice", price)


CHANGED = "changed AS (SELECT o_orderkey, CASE o_orderkey % 100 WHEN 7 THEN NULL WHEN 8 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders)"


@query(PROFILE.format(t="orders"))
def table_profile(spark, sf_dir):
    return reconcile.profile(_orders(spark, sf_dir), ["o_orderkey"])


@query(f"""WITH {CHANGED}, e AS ({PROFILE.format(t="orders")}), a AS ({PROFILE.format(t="changed")}) SELECT metric, e.value AS expected, a.value AS actual,
  e.value IS NOT DISTINCT FROM a.value OR coalesce(abs(e.value - a.value) <= greatest(1e-10 * greatest(abs(e.value), abs(a.value)), 1e-10), false) AS passed FROM e FULL JOIN a USING (metric)""")
def reconcile_profiles(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return reconcile.compare(reconcile.profile(o, ["o_orderkey"]), reconcile.profile(_changed(o), ["o_orderkey"]))


@query(f"""WITH {CHANGED}, e AS ({PROFILE.format(t="orders")}), a AS ({PROFILE.format(t="changed")}), o AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders),
checks AS (SELECT e.value IS NOT DISTINCT FROM a.value OR coalesce(abs(e.value - a.value) <= greatest(1e-10 * greatest(abs(e.value), abs(a.value)), 1e-10), false) AS passed FROM e FULL JOIN a USING (metric)
  UNION ALL SELECT (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT * FROM changed)) + (SELECT count(*) FROM (SELECT * FROM changed EXCEPT ALL SELECT * FROM o)) = 0 UNION ALL SELECT true /* both have the same columns */)
SELECT count(*) AS n_checks, count(*) FILTER (NOT passed) AS n_failed, bool_and(passed) AS passed FROM checks""")
def reconcile_evidence(spark, sf_dir):
    o = _orders(spark, sf_dir)
    return reconcile.overall(reconcile.reconcile(o, _changed(o), ["o_orderkey"]))


def _keys(spark, sf_dir, batch):
    return M.obs(spark, sf_dir).filter(F.col("batch") == batch).select("station_id", F.to_date("observed_at").alias("day"))


KEYS = f"WITH {M.OBS}, a AS (SELECT station_id, CAST(observed_at AS DATE) AS day FROM obs WHERE batch = 0), b AS (SELECT station_id, CAST(observed_at AS DATE) AS day FROM obs WHERE batch = 1)"


@query(f"{KEYS} SELECT * FROM a INTERSECT SELECT * FROM b")
def overlap_keys(spark, sf_dir):
    return reconcile.overlap(_keys(spark, sf_dir, 0), _keys(spark, sf_dir, 1))


@query(f"{KEYS} SELECT * FROM b EXCEPT SELECT * FROM a")
def new_keys(spark, sf_dir):
    return reconcile.only_in_second(_keys(spark, sf_dir, 0), _keys(spark, sf_dir, 1))


@query(f"{KEYS} SELECT * FROM a UNION SELECT * FROM b")
def union_keys(spark, sf_dir):
    return reconcile.union_keys(_keys(spark, sf_dir, 0), _keys(spark, sf_dir, 1))


@query(f"{KEYS} SELECT 'only_in_first' AS side, count(*) AS n_rows FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'only_in_second', count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def multiset_equal(spark, sf_dir):
    return reconcile.multiset_difference(_keys(spark, sf_dir, 0), _keys(spark, sf_dir, 1))


@query(f"WITH {M.RUNS}, {M.CHECKPOINTS}, {M.STATION} SELECT * FROM runs WHERE batch_id IN (SELECT batch_id FROM ckpt WHERE station_id IN (SELECT station_id FROM station)) AND accepted_count + rejected_count > 0 ORDER BY completed_at DESC, batch_id DESC LIMIT 1")
def latest_run_topk(spark, sf_dir):
    return health.latest_live_run(M.runs(spark, sf_dir), M.checkpoints(spark, sf_dir), M.stations(spark, sf_dir))


@query(f"WITH {M.EVENT} SELECT * FROM ev ORDER BY line_no DESC LIMIT 2000")
def event_tail(spark, sf_dir):
    return health.parse_events(M.event_lines(spark, sf_dir))


AGE = "round((epoch_us({now}) - epoch_us({c})) / 60000000.0::DOUBLE, 2)"
HEALTH = f"""{M.OBS}, {M.STATION}, {M.CHECKPOINTS}, j AS (SELECT station_id, latest, watermark, updated_at, {AGE.format(now=TIMES, c="latest")} AS oa, {AGE.format(now=TIMES, c="watermark")} AS wa, {AGE.format(now=TIMES, c="updated_at")} AS ua
  FROM station LEFT JOIN (SELECT station_id, max(observed_at) AS latest FROM obs GROUP BY 1) USING (station_id) LEFT JOIN ckpt USING (station_id)), lim AS (SELECT {TIMES} + INTERVAL 5 MINUTE AS l),
sh AS (SELECT 'observations:' || station_id AS check_name, CASE WHEN latest IS NULL THEN 'missing' WHEN latest > l THEN 'future' WHEN oa > 180 THEN 'stale' ELSE 'current' END AS finding, oa AS age_minutes FROM j, lim
  UNION ALL SELECT 'checkpoint:' || station_id, CASE WHEN watermark IS NULL THEN 'missing' WHEN watermark > l OR updated_at > l THEN 'future' WHEN ua > 120 OR wa > 120 THEN 'behind' ELSE 'current' END, wa FROM j, lim),
station_checks AS (SELECT check_name, CASE finding WHEN 'current' THEN 'healthy' ELSE 'critical' END AS status, finding, age_minutes FROM sh)"""


@query(f"WITH {HEALTH} SELECT * FROM station_checks")
def station_health(spark, sf_dir):
    return health.station_health(M.obs(spark, sf_dir), M.checkpoints(spark, sf_dir), M.stations(spark, sf_dir), M.now())


QUALITY = f"""{M.RUNS}, top AS (SELECT * FROM runs WHERE batch_id IN (SELECT batch_id FROM ckpt WHERE station_id IN (SELECT station_id FROM station)) AND accepted_count + rejected_count > 0 ORDER BY completed_at DESC, batch_id DESC LIMIT 1),
rate AS (SELECT max(batch_id) AS batch_id, max(100.0::DOUBLE * rejected_count / nullif(input_count, 0)) AS rejection_pct, max(100.0::DOUBLE * missing_measurement_count / nullif(3 * accepted_count, 0)) AS missing_pct FROM top),
quality_check AS (SELECT 'rejection_rate' AS check_name, CASE WHEN batch_id IS NULL OR rejection_pct > 10 THEN 'warning' ELSE 'healthy' END AS status, batch_id, rejection_pct, missing_pct FROM rate)"""


@query(f"WITH {M.STATION}, {M.CHECKPOINTS}, {QUALITY} SELECT * FROM quality_check")
def quality_health(spark, sf_dir):
    return health.quality_health(M.runs(spark, sf_dir), M.checkpoints(spark, sf_dir), M.stations(spark, sf_dir))


FAILURE = f"""{M.EVENT}, tail AS (SELECT * FROM ev ORDER BY line_no DESC LIMIT 2000), valid AS (SELECT * FROM ev WHERE "at" <= {TIMES} + INTERVAL 5 MINUTE AND "at" >= {TIMES} - INTERVAL 24 HOUR),
won AS (SELECT batch_id, max("at") AS s FROM valid WHERE status = 'succeeded' GROUP BY 1), live AS (SELECT max(updated_at) AS l FROM ckpt WHERE station_id IN (SELECT station_id FROM station) AND updated_at <= {TIMES} + INTERVAL 5 MINUTE),
open_failures AS (SELECT f.* FROM valid f LEFT JOIN won USING (batch_id), live WHERE status IN ('failed', 'ingestion_failed') AND "at" >= {TIMES} - INTERVAL 24 HOUR AND NOT (coalesce(l > "at", false) OR (status = 'failed' AND coalesce(s > "at", false)))),
failure_check AS (SELECT 'recent_failures' AS check_name, CASE WHEN count(*) > 0 THEN 'critical' ELSE 'healthy' END AS status, count(*) AS unresolved, max("at") AS latest_at, arg_max(status, "at") AS latest_status, arg_max(batch_id, "at") AS latest_batch_id, arg_max(error, "at") AS latest_error FROM open_failures),
log_check AS (SELECT 'event_log' AS check_name, CASE WHEN count(*) FILTER ("at" IS NULL) + count(*) FILTER ("at" > {TIMES} + INTERVAL 5 MINUTE) > 0 THEN 'warning' ELSE 'healthy' END AS status, count(*) AS n_events, count(*) FILTER ("at" IS NULL) AS invalid_events, count(*) FILTER ("at" > {TIMES} + INTERVAL 5 MINUTE) AS future_events, (SELECT count(*) FROM ev) AS n_lines, (SELECT count(*) FROM ev) > count(*) AS truncated FROM tail)"""


def _old_checkpoints(spark, sf_dir):
    return M.checkpoints(spark, sf_dir).withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 12 HOURS"))


OLD = M.CHECKPOINTS.replace("INTERVAL 1 HOUR AS updated_at", "INTERVAL 1 HOUR - INTERVAL 12 HOUR AS updated_at")


@query(f"WITH {M.STATION}, {OLD}, {FAILURE} SELECT * FROM failure_check")
def failure_health(spark, sf_dir):
    return health.failure_health(health.parse_events(health.recent_lines(M.event_lines(spark, sf_dir), M.now()), None), _old_checkpoints(spark, sf_dir), M.stations(spark, sf_dir), M.now())


@query(f"WITH {M.STATION}, {OLD}, {FAILURE} SELECT * FROM log_check")
def event_log_integrity(spark, sf_dir):
    return health.log_health(M.event_lines(spark, sf_dir), M.now())


@query(f"""WITH {HEALTH}, {QUALITY}, {FAILURE}, everything AS (SELECT check_name, status FROM station_checks UNION ALL SELECT check_name, status FROM quality_check UNION ALL SELECT check_name, status FROM failure_check
  UNION ALL SELECT check_name, status FROM log_check UNION ALL SELECT 'warehouse_records', CASE WHEN count(*) = 0 THEN 'critical' ELSE 'healthy' END FROM obs)
  SELECT CASE max(CASE status WHEN 'critical' THEN 2 WHEN 'warning' THEN 1 ELSE 0 END) WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS status, count(*) AS n_checks, count(*) FILTER (status <> 'healthy') AS n_unhealthy FROM everything""")
def health_overall(spark, sf_dir):
    c, s, e = M.checkpoints(spark, sf_dir), M.stations(spark, sf_dir), M.event_lines(spark, sf_dir)
    fact = M.obs(spark, sf_dir)
    return health.overall(health.station_health(fact, c, s, M.now()), health.quality_health(M.runs(spark, sf_dir), c, s), health.failure_health(health.parse_events(health.recent_lines(e, M.now()), None), c, s, M.now()), health.log_health(e, M.now()), health.records_health(fact))


PLAN = f"""{M.STATION}, {M.CHECKPOINTS}, planned AS (SELECT station_id, coalesce(watermark - INTERVAL 2 HOUR, {TIMES} - INTERVAL 24 HOUR) AS start, {TIMES} AS "end" FROM station LEFT JOIN ckpt USING (station_id))"""
SLICED = """sliced AS (SELECT station_id, s AS start, least(s + INTERVAL 6 HOUR, "end") AS "end" FROM (SELECT station_id, "end", unnest(generate_series(start, "end" - INTERVAL 1 MICROSECOND, INTERVAL 6 HOUR)) AS s FROM planned WHERE start < "end"))"""


def _plan(spark, sf_dir):
    return incremental.plan(M.stations(spark, sf_dir), M.checkpoints(spark, sf_dir), M.now())


@query(f"""WITH {PLAN} SELECT *, start < "end" AS valid FROM planned""")
def window_plan(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(f"WITH {PLAN}, {SLICED} SELECT * FROM sliced")
def window_slices(spark, sf_dir):
    return incremental.slices(_plan(spark, sf_dir))


@query(f"""WITH {PLAN} SELECT station_id, start, "end", start < "end" AS valid, concat_ws(',', CASE WHEN start >= "end" THEN 'start_not_before_end' END, CASE WHEN "end" > {TIMES} - INTERVAL 1 DAY THEN 'future_end' END,
  CASE WHEN start < {TIMES} - INTERVAL 1 DAY - INTERVAL 7 DAY - INTERVAL 1 MINUTE THEN 'too_old' END) AS issues FROM planned""")
def window_admissibility(spark, sf_dir):
    return incremental.admissible(_plan(spark, sf_dir), M.now() - F.expr("INTERVAL 1 DAY")).withColumn("issues", F.array_join("issues", ","))


@query(f"""WITH {M.OBS}, {PLAN}, {SLICED} SELECT o.station_id, o.event_id, s.start AS window_start, s."end" AS window_end FROM obs o JOIN sliced s ON o.station_id = s.station_id AND o.observed_at >= s.start AND o.observed_at < s."end\"""")
def window_match(spark, sf_dir):
    got = incremental.match(M.obs(spark, sf_dir).select("station_id", "observed_at", "event_id"), incremental.slices(_plan(spark, sf_dir)))
    return got.select("station_id", "event_id", "window_start", "window_end")


@query("""SELECT event_id, CASE WHEN (event_id % 5) - 2 >= 0 THEN ((event_id % 5) - 2) * 60 // 45 + 1 ELSE 0 END AS missed_slots FROM events""")
def missed_slots(spark, sf_dir):
    e = M.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("deadline"))
    return incremental.missed_slots(e.withColumn("started_at", F.expr("deadline + make_dt_interval(0, cast(event_id % 5 - 2 as int))")), 45).select("event_id", "missed_slots")


def _stream(spark, sf_dir):
    """The events as a stream of files, with observation columns."""
    schema = M.table(spark, sf_dir, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return e.select(F.col("user_id").cast("string").alias("station_id"), F.col("ts").cast("timestamp").alias("observed_at"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("temperature_c"), F.sha2(F.concat(F.col("event_id").cast("string"), F.lit("|"), F.col("props")), 256).alias("payload_hash"))


def _run(spark, stream: DataFrame, mode: str, label: str) -> DataFrame:
    """The stream run until its source is empty, its result written and read."""
    path, checkpoint = scratch(spark, label), scratch(spark, label + "-checkpoint")
    spark.createDataFrame([], stream.schema).write.parquet(path)
    how = "overwrite" if mode == "complete" else "append"
    q = stream.writeStream.outputMode(mode).foreachBatch(lambda df, _: df.write.mode(how).parquet(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(f"WITH {M.OBS} SELECT station_id, time_bucket(INTERVAL 1 HOUR, observed_at) AS window_start, count(*) AS n_rows, round(avg(temperature_c), 6) AS avg_temperature_c FROM obs GROUP BY ALL")
def stream_tumbling(spark, sf_dir):
    out = _run(spark, streams.tumbling(_stream(spark, sf_dir)), "complete", "tumbling")
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "avg_temperature_c")


@query(f"""WITH {M.OBS}, {GAPS}, marked AS (SELECT *, sum(CASE WHEN previous_at IS NULL OR observed_at - previous_at > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY station_id ORDER BY observed_at) AS k FROM lagged)
  SELECT station_id, min(observed_at) AS session_start, count(*) AS n_rows FROM marked GROUP BY station_id, k""")
def stream_sessions(spark, sf_dir):
    out = _run(spark, streams.sessions(_stream(spark, sf_dir)), "complete", "sessions")
    return out.withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))


@query(f"WITH {M.OBS} SELECT DISTINCT station_id, observed_at, payload_hash FROM obs")
def stream_dedup(spark, sf_dir):
    twice = _stream(spark, sf_dir).withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("_k")
    out = _run(spark, streams.redeliveries_dropped(twice), "append", "dedup")
    return out.select("station_id", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "payload_hash")


@query(f"WITH {M.REASONS} SELECT batch_id, reasons, (count(*) + count(*) FILTER (twice))::BIGINT AS n_rows FROM raw GROUP BY ALL")
def stream_validate(spark, sf_dir):
    landing = scratch(spark, "landing")
    M.raw_lines(spark, sf_dir).write.text(landing)
    rows = streams.classify_stream(streams.read_landing(spark, landing), M.STATIONS, M.REFERENCE).select("batch_id", F.array_join("reasons", ",").alias("reasons"))
    return _run(spark, rows, "append", "validated").groupBy("batch_id", "reasons").agg(F.count("*").alias("n_rows"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN '' ELSE o_orderpriority END AS o_orderpriority, o_totalprice, o_orderdate FROM orders")
def csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "extract")
    text = F.when(F.col("o_orderkey") % 5 == 1, "").when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    o = M.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("o_orderpriority"), "o_totalprice", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    readers.write_extract(o, path, ["o_orderkey"])
    return readers.read_extract(spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double, o_orderdate timestamp_ntz")


@query("SELECT e.event_id FROM events e WHERE e.event_id % 10 = 3")
def checksum_failures(spark, sf_dir):
    e = M.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("raw_json"), F.when(F.col("event_id") % 10 != 3, F.sha2("props", 256)).otherwise("0").alias("payload_sha256"))
    return readers.checksum_failures(e).select("event_id")


@query("SELECT 's' || c_custkey AS batch_id, 'no_manifest' AS problem FROM customer WHERE c_custkey % 4 = 0 UNION ALL SELECT 's' || c_custkey, 'several_manifests' FROM customer WHERE c_custkey % 4 = 1")
def lineage_gaps(spark, sf_dir):
    c = M.table(spark, sf_dir, "customer").select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("batch_id"), F.concat(F.lit("/raw/"), F.col("c_name")).alias("raw_path"), "c_custkey")
    m = c.withColumn("raw_path", F.when(F.col("c_custkey") % 4 == 0, "/elsewhere").otherwise(F.col("raw_path"))).withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("c_custkey") % 4 == 1, 2).otherwise(1))))
    return inventory.lineage_gaps(c.select("batch_id", "raw_path"), m.select("batch_id", "raw_path"))


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '/new/raw/' || c_name WHEN 1 THEN '/old/../' || c_name ELSE '/other/' || c_name END AS raw_path, c_custkey % 3 = 0 AS rebased FROM customer""")
def path_rebase(spark, sf_dir):
    k = F.col("c_custkey") % 3
    path = F.concat(F.when(k == 0, "/old/raw/").when(k == 1, "/old/../").otherwise("/other/"), F.col("c_name"))
    return inventory.rebase(M.table(spark, sf_dir, "customer").select("c_custkey", path.alias("raw_path")), "raw_path", "/old", "/new")


@query("""SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'invalid_identifier' END, CASE WHEN c_custkey % 4 = 0 THEN 'other_station' END, CASE WHEN c_custkey % 5 = 0 THEN 'blank_name' END,
  CASE WHEN c_custkey % 7 IN (0, 1) THEN 'invalid_coordinates' END) AS issues FROM customer""")
def station_metadata(spark, sf_dir):
    k = F.col("c_custkey")
    wanted = F.concat(F.when(k % 3 == 0, "bad id ").otherwise("S"), k.cast("string"))
    pair = F.when(k % 7 == 0, F.array(F.lit(200.0), F.lit(0.0))).when(k % 7 == 1, F.array(F.lit(10.0))).when(k % 7 == 2, F.lit(None)).otherwise(F.array(F.lit(10.0), F.lit(-45.0)))
    rows = M.table(spark, sf_dir, "customer").select("c_custkey", wanted.alias("requested_id"), F.when(k % 4 == 0, "X").otherwise(wanted).alias("station_id"), F.when(k % 5 == 0, " ").otherwise(F.col("c_name")).alias("name"), pair.alias("coordinates"))
    return validate.station_metadata_issues(rows).select("c_custkey", F.array_join("issues", ",").alias("issues"))


@query()
def file_inventory(spark, sf_dir):
    return inventory.inventory(spark, sf_dir, exclude=r"\.crc$")


@query("""SELECT c_custkey::VARCHAR AS path, CASE c_custkey % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'extra' WHEN 2 THEN 'size_mismatch' WHEN 3 THEN 'checksum_mismatch' ELSE 'ok' END AS status FROM customer""")
def inventory_verify(spark, sf_dir):
    k = F.col("c_custkey")
    c = M.table(spark, sf_dir, "customer").select(k.cast("string").alias("path"), F.length("c_name").cast("long").alias("size"), F.sha2("c_name", 256).alias("sha256"), "c_custkey")
    found = c.filter(k % 5 != 0).select("path", F.when(k % 5 == 2, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(k % 5 == 3, "0").otherwise(F.col("sha256")).alias("sha256"))
    return inventory.verify(c.filter(k % 5 != 1).select("path", "size", "sha256"), found)
