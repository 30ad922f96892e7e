import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from obsflow.functions.spec import CURATED_SCHEMA
from obsflow.operators import health, load, reconcile
from obsflow.sources import readers
from obsflow.sources.tables import Warehouse

T = dt.datetime.fromisoformat


def batch(spark, name, rows, end="2024-01-02 12:00", **more):
    """rows: (observed_at, temperature, hash, ingested_at)."""
    curated = spark.createDataFrame([("A", T(o), t, None, 1.0, "x", None, None, h, T(i)) for o, t, h, i in rows], CURATED_SCHEMA)
    n, missing = len(rows), sum(1 + (t is None) for _, t, _, _ in rows)
    report = spark.createDataFrame([(n, n, 0, 0, missing)], "input_count bigint, accepted_count bigint, rejected_count bigint, duplicate_count bigint, missing_measurement_count bigint")
    stations = spark.createDataFrame([("A", "Alpha", 1.0, 2.0, T("2024-01-01 00:00"))], "station_id string, station_name string, latitude double, longitude double, metadata_ingested_at timestamp_ntz")
    windows = spark.createDataFrame([("A", T("2024-01-01 00:00"), T(end))], "station_id string, start timestamp_ntz, end timestamp_ntz")
    return load.Batch(name, "test", curated, stations, windows, report, **more)


FIRST = [("2024-01-02 10:00", 1.0, "h1", "2024-01-02 11:00"), ("2024-01-02 11:00", None, "h2", "2024-01-02 11:30")]


def facts(w):
    return {str(r["observed_at"]): (r["temperature_c"], r["payload_hash"]) for r in w.read("fact_observation").collect()}


def test_load_replay_correction_and_collision(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    r = load.load(w, batch(spark, "b1", FIRST))
    assert (r["status"], r["inserted_count"], r["updated_count"], r["unchanged_count"]) == ("loaded", 2, 0, 0)
    before = w.versions()
    assert load.load(w, batch(spark, "b1", FIRST, raw_path="/elsewhere"))["status"] == "already_loaded" and w.versions() == before
    with pytest.raises(ValueError, match="other content"):
        load.load(w, batch(spark, "b1", FIRST[:1]))
    with pytest.raises(ValueError, match="other content"):
        load.load(w, batch(spark, "b1", FIRST, advance_checkpoint=False))
    r = load.load(w, batch(spark, "b2", [("2024-01-02 10:00", 5.0, "h3", "2024-01-02 12:00"), ("2024-01-02 11:00", 9.0, "h0", "2024-01-02 11:00")]))
    assert (r["inserted_count"], r["updated_count"], r["unchanged_count"]) == (0, 1, 1)
    assert facts(w) == {"2024-01-02 10:00:00": (5.0, "h3"), "2024-01-02 11:00:00": (None, "h2")}
    assert w.read("etl_runs").count() == 2 and w.read("dim_date").count() == 1


def test_failure_before_publish_changes_nothing(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    load.load(w, batch(spark, "b1", FIRST))
    before = {n: sorted(map(str, df.collect())) for n, df in w.snapshot().items()}

    def fail():
        raise RuntimeError("injected")

    with pytest.raises(RuntimeError):
        load.load(w, batch(spark, "b2", [("2024-01-02 10:00", 5.0, "h3", "2024-01-02 12:00")]), before_publish=fail)
    assert {n: sorted(map(str, df.collect())) for n, df in w.snapshot().items()} == before


def test_checkpoint_is_monotone_and_backfill_leaves_it(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    mark = lambda: [(str(r["watermark"]), r["batch_id"]) for r in w.read("source_checkpoints").collect()]
    load.load(w, batch(spark, "b1", FIRST, end="2024-01-02 12:00"))
    load.load(w, batch(spark, "b2", FIRST, end="2024-01-02 11:00"))
    load.load(w, batch(spark, "b3", FIRST, end="2024-01-02 12:00"))
    assert mark() == [("2024-01-02 12:00:00", "b1")]
    load.load(w, batch(spark, "b4", FIRST, end="2024-01-03 12:00", advance_checkpoint=False))
    assert mark() == [("2024-01-02 12:00:00", "b1")]
    load.load(w, batch(spark, "b5", [], end="2024-01-03 12:00"))
    assert mark() == [("2024-01-03 12:00:00", "b5")]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[:4])
def test_batches_commute(spark, tmp_path, order):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    versions = [("2024-01-02 10:00", 1.0, "a", "2024-01-02 11:00"), ("2024-01-02 10:00", 2.0, "b", "2024-01-02 11:00"), ("2024-01-02 10:00", 3.0, "c", "2024-01-02 10:30")]
    for k in order:
        load.load(w, batch(spark, f"b{k}", [versions[k]]))
    assert facts(w) == {"2024-01-02 10:00:00": (2.0, "b")}
    assert [r["payload_hash"] for r in w.read("observation_versions").collect()] == ["b"]


def test_contract_failures(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    twice = batch(spark, "b", FIRST[:1] * 2)
    with pytest.raises(ValueError, match="duplicate_keys"):
        load.load(w, twice)
    other = batch(spark, "b", FIRST)
    other.curated = other.curated.withColumn("station_id", F.lit("Z"))
    with pytest.raises(ValueError, match="unknown_stations"):
        load.load(w, other)
    wrong = batch(spark, "b", FIRST)
    wrong.report = wrong.report.withColumn("missing_measurement_count", F.lit(0).cast("long"))
    with pytest.raises(ValueError, match="missing_total"):
        load.load(w, wrong)
    with pytest.raises(ValueError, match="path component"):
        load.load(w, batch(spark, "../b", FIRST))
    assert w.versions() == {}


def test_extracts_publish_together(spark, tmp_path):
    a = spark.createDataFrame([(2, None), (1, "")], "k int, s string")
    readers.publish_extracts({"one": (a, ["k"]), "none": (a.limit(0), ["k"])}, f"file://{tmp_path}/out")
    back = readers.read_extract(spark, readers.published(spark, f"file://{tmp_path}/out") + "/one", "k int, s string")
    assert [tuple(r) for r in back.collect()] == [(1, ""), (2, None)]
    assert readers.read_extract(spark, readers.published(spark, f"file://{tmp_path}/out") + "/none", "k int, s string").count() == 0
    with pytest.raises(Exception):  # noqa: B017
        readers.read_extract(spark, readers.published(spark, f"file://{tmp_path}/out") + "/one", "k int, other string").collect()


def test_landing_is_write_once(spark, tmp_path):
    rows = readers.envelopes(spark.createDataFrame([("b", "t", "s", '{"x": 20.0}')], "batch_id string, ingested_at string, station_id string, raw_json string"))
    path = readers.land(rows, f"file://{tmp_path}", "b1")
    assert '{\\"x\\": 20.0}' in readers.read_lines(spark, path).first()["value"]
    with pytest.raises(Exception):  # noqa: B017
        readers.land(rows, f"file://{tmp_path}", "b1")


def test_reconcile_finds_each_change(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b")], "k int, x double, s string")
    failed = lambda other: {r["metric"] for r in reconcile.reconcile(df, other, ["k"]).filter("not passed").collect()}
    assert failed(df) == set()
    assert "nulls:x" in failed(df.fillna(0.0, ["x"]))
    assert failed(df.withColumn("s", F.when(F.col("k") == 1, "z").otherwise(F.col("s")))) == {"content"}
    assert {"row_count", "content"} <= failed(df.unionByName(df.limit(1)))
    assert "header" in failed(df.withColumnRenamed("s", "t"))
    assert reconcile.missing_columns(["a", "a"], ["a", "b"]) == ["missing:b", "twice:a"]


def test_thresholds_are_checked():
    for bad in ({"max_rejection_pct": 101}, {"max_run_age_minutes": 0}, {"max_observation_age_minutes": float("inf")}):
        with pytest.raises(ValueError):
            health.Thresholds(**bad)


def test_failures_before_the_tail_count(spark, monkeypatch):
    from obsflow.plans import mapping, queries

    now = T(str(mapping.NOW))
    at = lambda minutes: (now - dt.timedelta(minutes=minutes)).isoformat() + "Z"
    events = [("failed", 120, "x"), ("failed", 119, "y"), ("failed", 60 * 25, "z"), *[("started", 60, "w")] * 2500, ("succeeded", 30, "y")]
    lines = spark.createDataFrame([(k, f'{{"at": "{at(m)}", "status": "{status}", "batch_id": "{b}"}}') for k, (status, m, b) in enumerate(events)] + [(-1, "no event")], "line_no long, value string")
    monkeypatch.setattr(mapping, "event_lines", lambda spark, sf_dir: lines)
    got = queries.failure_health(spark, "/root/testdata/sf0.001").first()
    assert (got["status"], got["unresolved"], got["latest_batch_id"]) == ("critical", 1, "x")
    tail = health.log_health(lines, mapping.now()).first()
    assert (tail["n_events"], tail["invalid_events"], tail["n_lines"], tail["truncated"]) == (2000, 0, 2505, True)
    whole = health.log_health(lines, mapping.now(), newest=2505).first()
    assert (whole["n_events"], whole["invalid_events"], whole["truncated"]) == (2505, 1, False)


def test_extract_is_written_in_ordered_parts(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        rows = spark.range(5000, 0, -1).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
        readers.write_extract(rows, f"file://{tmp_path}/parts", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    parts = [p.read_text().splitlines() for p in sorted((tmp_path / "parts").glob("*.csv"))]
    assert len(parts) > 1 and all(p[0] == "k,s" for p in parts)
    assert [x for p in parts for x in p[1:]] == [f"{k},{k}" for k in range(1, 5001)]
    assert readers.read_extract(spark, f"file://{tmp_path}/parts", "k bigint, s string").count() == 5000
    readers.write_extract(rows.limit(0), f"file://{tmp_path}/none", ["k"])
    assert [p.read_text() for p in (tmp_path / "none").glob("*.csv")] == ["k,s\n"]


def test_odd_log_lines_are_invalid_not_lost(spark):
    odd = ["", "[]", '[{"at": "2024-01-01T00:00:00Z"}]', "7", "null", "{", '{"at": 20240101}', '{"at": {"at": "2024-01-01T00:00:00Z"}}', '{"at": null}', '{"at": "2024-01-01T00:00:00"}', '{"status": "failed"}', '{"at": "2024-02-30T00:00:00Z"}']
    good = ['{"at": "2024-01-01T02:00:00+02:00", "status": 5}', ' {"other": [1], "at": "2024-01-01T00:00:00.25Z"}']
    lines = spark.createDataFrame(list(enumerate(odd + good)), "line_no long, value string")
    got = {r["line_no"]: r for r in health.parse_events(lines, None).collect()}
    assert [got[k]["at"] for k in range(len(odd))] == [None] * len(odd)
    assert got[len(odd)]["at"] == T("2024-01-01 00:00") and got[len(odd)]["status"] == "5" and got[len(odd) + 1]["at"] == T("2024-01-01 00:00:00.25")


def test_recent_lines_reach_over_zones(spark):
    now = F.lit("2024-03-01 01:00:00").cast("timestamp_ntz")
    near = ["2024-03-01T18:59:00+18:00", "2024-02-28T07:30:00-17:30", "2024-02-29T12:00:00Z"]
    far = ["2024-02-27T23:00:00Z", "2024-03-03T00:00:00Z"]
    lines = spark.createDataFrame([(k, f'{{"at": "{x}"}}') for k, x in enumerate(near + far)], "line_no long, value string")
    assert {r["line_no"] for r in health.recent_lines(lines, now).collect()} == {0, 1, 2}
