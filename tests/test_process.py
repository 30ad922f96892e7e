"""Landed batches end to end: write-once landing, one validating pass, quarantine,
reports, events, and the warehouse under concurrent and stopped loads."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from obsflow.functions import digests
from obsflow.operators import process
from obsflow.sources import readers
from obsflow.sources.tables import Warehouse

END = "2024-03-05T12:00:00+00:00"


def envelope(station, at, value, ingested="2024-03-05T12:00:00Z", **change):
    body = {"type": "Feature", "properties": {"station": f"https://api.weather.gov/stations/{station}", "timestamp": at, "temperature": {"value": value, "unitCode": "wmoUnit:degC"}}}
    return json.dumps({"batch_id": "any", "ingested_at": ingested, "station_id": station, "raw_json": json.dumps(body)} | change)


def manifest(name, stations=("P", "Q"), start="2024-03-04T12:00:00Z", end=END, **more):
    s = [{"station_id": x, "name": "" if x == "Q" else f"Station {x}", "latitude": 1.0, "longitude": 2.0} for x in stations]
    w = [{"station_id": x, "start": start, "end": end} for x in stations]
    return process.manifest_of(name, "test", s, w, start, end, "2024-03-05T12:30:00+01:00", **more)


def landed(spark, root, lines, m):
    return readers.land_batch(spark.createDataFrame([(x,) for x in lines], "value string"), root, m)


LINES = [
    envelope("P", "2024-03-05T09:00:00Z", 1.5), envelope("P", "2024-03-05T09:00:00Z", 2.5, "2024-03-05T12:01:00Z"), envelope("P", "2024-03-05T13:30:00+03:00", None),
    envelope("Q", "2024-03-04T23:00:00Z", 70), envelope("Z", "2024-03-05T09:00:00Z", 1), "{broken",
]


def test_a_batch_from_lines_to_reports(spark, tmp_path):
    root, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/out"
    w = Warehouse(spark, f"{out}/warehouse")
    landed(spark, root, LINES, manifest("b1"))
    done = process.process(w, root, out, "b1")
    counts = {"input_count": 6, "accepted_count": 2, "rejected_count": 3, "duplicate_count": 1, "missing_measurement_count": 5}
    attempt = done["attempt"]
    assert done["status"] == "loaded" and attempt.counts == counts
    rejected = {tuple(r["reasons"]) for r in process.quarantine(spark, attempt.lines).collect()}
    assert ("temperature_out_of_range",) in rejected and ("unknown_station",) in rejected and len(rejected) == 3
    assert all(r["raw_envelope"] in LINES for r in process.quarantine(spark, f"{out}/batches/batch_id=*/attempt=*/lines").collect())
    curated = readers.read_curated(spark, attempt.curated)
    assert {(r["station_id"], r["temperature_c"]) for r in curated.collect()} == {("P", 2.5), ("P", None)}
    for path in (attempt.report, f"{out}/reports/batch_id=b1"):
        r = spark.read.json(path).first().asDict(True)
        assert {k: r[k] for k in counts} == counts and (r["empty_station_count"], r["stale_station_count"]) == (1, 0)
        assert [s["station_id"] for s in r["station_coverage"]] == ["P", "Q"]
    names = {r["station_id"]: r["station_name"] for r in w.read("dim_station").collect()}
    assert names == {"P": "Station P", "Q": "Q"}
    assert [r["metadata_ingested_at"] for r in w.read("dim_station").distinct().collect()][0] == dt.datetime(2024, 3, 5, 11, 30)
    # A replay is another attempt: nothing is loaded, and the batch's report stays that of the load.
    again = process.process(w, root, out, "b1")
    assert again["status"] == "already_loaded" and again["attempt"].attempt_id != attempt.attempt_id
    assert spark.read.json(f"{out}/reports/batch_id=b1").first()["attempt_id"] == attempt.attempt_id
    assert [r["status"] for r in spark.read.json(f"{out}/events").collect()] == ["succeeded"] * 2


def test_only_complete_batches_are_found(spark, tmp_path):
    root, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/out"
    assert readers.read_landed(spark, root).count() == 0
    readers.land(spark.createDataFrame([(LINES[0],)], "value string"), root, "unfinished")
    landed(spark, root, LINES[:3], manifest("late", end="2024-03-05T13:00:00Z"))
    landed(spark, root, LINES[:1], manifest("early", end="2024-03-05T12:00:00Z"))
    assert {r["batch_id"] for r in readers.read_landed(spark, root).collect()} == {"late", "early"}
    with pytest.raises(Exception, match="(?i)exist"):
        landed(spark, root, LINES[:1], manifest("late"))
    w = Warehouse(spark, f"{out}/warehouse")
    assert [d["attempt"].batch_id for d in process.process_all(w, root, out)] == ["early", "late"]
    assert process.process_all(w, root, out) == [] and w.read("etl_runs").count() == 2


def test_wrong_manifests_and_changed_lines_are_not_loaded(spark, tmp_path):
    root, out = f"file://{tmp_path}/raw", f"file://{tmp_path}/out"
    w = Warehouse(spark, f"{out}/warehouse")
    landed(spark, root, LINES, manifest("zoneless", end="2024-03-05T12:00:00"))
    landed(spark, root, LINES, manifest("few"))
    landed(spark, root, LINES, manifest("other"))
    spark.createDataFrame([(LINES[0],)], "value string").write.mode("append").text(readers.lines_of(root, "few"))
    spark.createDataFrame([(x.replace("1.5", "1.6"),) for x in LINES], "value string").write.mode("overwrite").text(readers.lines_of(root, "other"))
    for name, why in (("zoneless", "invalid_end"), ("few", "7 lines"), ("other", "not those"), ("none", "(?i)path|exist")):
        with pytest.raises(Exception, match=why):
            process.process(w, root, out, name)
    assert w.versions() == {} and {r["status"] for r in spark.read.json(f"{out}/events").collect()} == {"failed"}
    with pytest.raises(ValueError, match="path component"):
        readers.lines_of(root, "a/b")


def rows(spark, *values):
    return spark.createDataFrame([(k, dt.datetime.fromisoformat(at), dt.datetime(2024, 1, 1), "h") for k, at in values], "station_id string, observed_at timestamp_ntz, source_ingested_at timestamp_ntz, payload_hash string")


def test_a_load_rewrites_the_days_of_its_batch_alone(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    first = w.commit({"observation_versions": rows(spark, ("A", "2024-01-01 10:00"), ("A", "2024-01-02 10:00"), ("A", "2024-01-03 10:00"))})
    day = [dt.date(2024, 1, 2)]
    assert [r["station_id"] for r in w.read("observation_versions", days=day).collect()] == ["A"] and w.read("observation_versions", days=[dt.date(2025, 1, 1)]).count() == 0
    second = w.commit({"observation_versions": rows(spark, ("B", "2024-01-02 10:00"), ("B", "2024-01-02 11:00"))}, days=day)
    one, two = first.daily["observation_versions"], second.daily["observation_versions"]
    assert {d for d in two if two[d] != one[d]} == {"2024-01-02"} and set(two) == set(one)
    assert sorted(r["station_id"] for r in w.read("observation_versions").collect()) == ["A", "A", "B", "B"]
    assert w.read("observation_versions", first).count() == 3  # readers of the state before keep it
    files = [f for f in w.read("observation_versions", days=day).inputFiles() if "2024-01-02" not in f]
    assert files == []


def test_no_load_is_lost_between_snapshot_and_commit(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    station = lambda name: spark.createDataFrame([(name, "A", 1.0, 2.0, None)], "station_id string, station_name string, latitude double, longitude double, metadata_ingested_at timestamp_ntz")
    taken = w.state()
    w.commit({"dim_station": station("one")})
    with pytest.raises(OSError, match="meanwhile"):
        w.commit({"dim_station": station("two")}, since=taken)
    assert [r["station_id"] for r in w.read("dim_station").collect()] == ["one"]


def test_what_a_stopped_load_left_is_in_nobodys_way(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    w.commit({"observation_versions": rows(spark, ("A", "2024-01-01 10:00"))})
    (tmp_path / "w" / "claim-2").touch()
    (tmp_path / "w" / "staged-dead").write_text("{")
    w.commit({"observation_versions": rows(spark, ("B", "2024-01-01 10:00"))})
    assert [r["station_id"] for r in w.read("observation_versions").collect()] == ["B"]


def test_readers_keep_their_extracts_while_others_are_published(spark, tmp_path):
    target = f"file://{tmp_path}/extracts"
    with pytest.raises(FileNotFoundError):
        readers.published(spark, target)
    frame = lambda n: spark.createDataFrame([(k, "x") for k in range(n)], "k int, s string")
    readers.publish_extracts({"one": (frame(1), ["k"]), "two": (frame(2), ["k"])}, target)
    old = readers.published(spark, target)
    seen = []
    readers.publish_extracts({"one": (frame(3), ["k"]), "two": (frame(4), ["k"])}, target, before_publish=lambda: seen.append(readers.published(spark, target)))
    count = lambda folder: [readers.read_extract(spark, f"{folder}/{n}", "k int, s string").count() for n in ("one", "two")]
    assert seen == [old] and count(old) == [1, 2] and count(readers.published(spark, target)) == [3, 4]


def test_log_lines_come_in_the_order_of_their_appends(spark, tmp_path):
    path, said = f"file://{tmp_path}/log", []
    r = random.Random(1)
    for n, size in enumerate((3, 400, 1)):
        lines = [f"{n}:{k}" + "x" * r.randint(0, 40) for k in range(size)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
        said += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        log = readers.read_event_lines(spark, path)
        assert log.rdd.getNumPartitions() > 2
        got = [x["value"] for x in log.orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == said


def test_digests_tell_tables_apart_but_not_orders(spark):
    base = [(1, "a", 1.5, [1.0, None], dt.datetime(2024, 1, 1)), (2, None, None, None, None), (2, None, None, None, None)]
    kind = "k long, s string, x double, v array<double>, t timestamp_ntz"
    one = lambda rows: digests.table_digest(spark.createDataFrame(rows, kind)).first()["digest"]
    assert one(base) == one(base[::-1])
    others = [base[:2], [*base[:2], (2, "", None, None, None)], [(1, "a", 1.5, [1.0], None), *base[1:]], [*base, base[0]]]
    assert len({one(base), *map(one, others)}) == 5
    assert digests.table_digest(spark.createDataFrame([], kind)).first()["n_rows"] == 0
    shifted = spark.createDataFrame([("ab", "c"), ("a", "bc")], "p string, q string")
    assert shifted.select(digests.row_text([F.col("p"), F.col("q")]).alias("t")).distinct().count() == 2
