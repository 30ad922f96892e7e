"""Streams that stop between steps, late rows, state that goes, pruned partitions,
files of any size."""

import datetime as dt
import hashlib

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_process import envelope

from obsflow.operators import inventory, marts
from obsflow.plans import landed
from obsflow.sources import readers
from obsflow.sources.tables import Warehouse
from obsflow.streaming import streams

NOW = dt.datetime(2024, 3, 5, 12, tzinfo=dt.UTC)


class Stop(Exception):
    pass


def deliver(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


@pytest.mark.parametrize("published", [False, True])
def test_a_micro_batch_that_runs_again_changes_nothing_more(spark, tmp_path, monkeypatch, published):
    landing, w = f"file://{tmp_path}/landing", Warehouse(spark, f"file://{tmp_path}/w")
    stations = spark.createDataFrame([("P",), ("Q",)], "station_id string")
    deliver(spark, landing, envelope("P", "2024-03-05T09:00:00Z", 1.5), envelope("P", "2024-03-05T10:00:00Z", 2.5), "broken")
    stopped = []

    def stop():
        if not stopped:
            stopped.append(1)
            raise Stop

    def run(before=None):
        streams.load_landing(w, "q", streams.read_landing(spark, landing), stations, NOW, f"file://{tmp_path}/checkpoint", before_publish=before).awaitTermination()

    if published:  # stops after the load, before the stream notes the micro-batch as done
        from obsflow.operators import load

        real = load.load

        def loaded(*args, **kw):
            real(*args, **kw)
            stop()

        monkeypatch.setattr("obsflow.streaming.streams.load.load", loaded)
    with pytest.raises(Exception):  # noqa: B017
        run(None if published else stop)
    assert stopped and w.read("etl_runs").count() == int(published)
    number = w.state().number
    run()
    assert w.state().number == (number if published else number + 1)
    runs = w.read("etl_runs").collect()
    assert [(r["batch_id"], r["input_count"], r["accepted_count"], r["rejected_count"], r["inserted_count"]) for r in runs] == [("q-0000000000", 3, 2, 1, 2)]
    # A later correction is another micro-batch; the checkpoint moves past what was seen.
    deliver(spark, landing, envelope("P", "2024-03-05T09:00:00Z", 9.5, "2024-03-05T12:30:00Z"), envelope("Q", "2024-03-05T11:00:00Z", 3))
    deliver(spark, landing, "nothing of use")
    run()
    assert {(r["station_id"], r["temperature_c"]) for r in w.read("fact_observation").collect()} == {("P", 9.5), ("P", 2.5), ("Q", 3.0)}
    assert w.read("etl_runs").agg(F.sum("rejected_count")).first()[0] == 2
    marks = {r["station_id"]: r["watermark"] for r in w.read("source_checkpoints").collect()}
    assert marks["P"] == dt.datetime(2024, 3, 5, 10, 0, 0, 1) and marks["Q"] == dt.datetime(2024, 3, 5, 11, 0, 0, 1)


def test_state_goes_and_late_rows_are_counted(spark, tmp_path):
    source, out, checkpoint = (f"file://{tmp_path}/{x}" for x in ("in", "out", "checkpoint"))
    kind = "station_id string, observed_at timestamp, temperature_c double"
    at = lambda h: dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(hours=h)

    def run(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        q = streams.append_stream(streams.tumbling(spark.readStream.schema(kind).parquet(source)), out, checkpoint)
        q.awaitTermination()
        return streams.state_rows(q), streams.late_rows(q)

    state, late = run([("A", at(h), 1.0) for h in range(48)])
    assert late == 0 and max(state) == 48 and state[-1] <= 4
    state, late = run([("A", at(3.5), 100.0), ("A", at(60), 1.0)])
    assert late == 1 and state[-1] <= 4
    got = {r["window_start"].replace(tzinfo=None): (r["n_rows"], r["avg_temperature_c"]) for r in spark.read.parquet(out).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    assert len(got) == 48 and set(got.values()) == {(1, 1.0)}  # the late row changed no window


def test_a_filter_on_dates_prunes_fact_folders_at_run_time(spark):
    fact, dates = landed._partitioned(spark, SMALL)
    stations = spark.createDataFrame([("1", "one", 1.0, 2.0)], "station_id string, station_name string, latitude double, longitude double")
    o = marts.observations(fact, stations, dates.filter("iso_day_of_week = 1"))
    plan = o._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    days = {r[0].isoweekday() for r in o.select("observation_date").distinct().collect()}
    assert days <= {1}


def test_files_of_any_size_are_hashed(spark, tmp_path):
    root = tmp_path / "tree"
    for folder, name, size in (("a", "same.bin", 10), ("b", "same.bin", 3_000_000), ("b/c d", "empty.bin", 0)):
        (root / folder).mkdir(parents=True, exist_ok=True)
        (root / folder / name).write_bytes(bytes(k * k % 251 for k in range(size)))
    want = {str(f.relative_to(root)): (f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in root.rglob("*.bin")}
    for whole in (inventory.WHOLE, 1000, -1):
        got = {r["path"]: (r["size"], r["sha256"]) for r in inventory.inventory(spark, f"file://{root}", whole=whole).collect()}
        assert got == want, whole
    assert {r["path"] for r in inventory.inventory(spark, f"file://{root}", exclude="^b/").collect()} == {"a/same.bin"}
    assert "content" not in str(inventory._listing(spark, f"file://{root}")._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1])


def test_landed_files_are_told_apart_by_full_paths(spark, tmp_path):
    root = f"file://{tmp_path}/raw"
    rows = lambda n: spark.createDataFrame([(f"line {k}",) for k in range(n)], "value string")
    for folder, n in (("x", 2), ("y z", 3)):
        readers.write_file(rows(n), f"{root}/{folder}/raw.txt")
    digest = lambda n: hashlib.sha256("".join(f"line {k}\n" for k in range(n)).encode()).hexdigest()
    m = [("b1", "x/raw.txt", digest(2), 2), ("b2", "y z/raw.txt", digest(3), 3), ("b3", "y z/raw.txt", digest(2), 3), ("b4", "x/raw.txt", digest(2), 5), ("b5", "raw.txt", digest(2), 2)]
    got = inventory.verify_raw(spark, spark.createDataFrame(m, "batch_id string, raw_path string, raw_sha256 string, record_count long"), root)
    assert {r["batch_id"]: r["status"] for r in got.collect()} == {"b1": "ok", "b2": "ok", "b3": "digest_mismatch", "b4": "count_mismatch", "b5": "missing"}
