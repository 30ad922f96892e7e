import pytest

from obsflow.sources.tables import Warehouse


def test_readers_see_one_state_throughout_a_commit(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    row = lambda name: spark.createDataFrame([(name, "A", 1.0, 2.0, None)], "station_id string, station_name string, latitude double, longitude double, metadata_ingested_at timestamp_ntz")
    ids = lambda: [r["station_id"] for r in w.read("dim_station").collect()]
    assert ids() == [] and w.versions() == {}
    w.commit({"dim_station": row("one")})
    seen = []
    w.commit({"dim_station": row("two")}, before_publish=lambda: seen.extend(ids()))
    assert seen == ["one"] and ids() == ["two"]
    # Of two loads that began at one state the second fails.
    with pytest.raises(OSError, match="meanwhile"):
        w.commit({"dim_station": row("three")}, before_publish=lambda: w.commit({"dim_station": row("four")}))
    assert ids() == ["four"]

    def fail():
        raise RuntimeError

    with pytest.raises(RuntimeError):
        w.commit({"dim_station": row("five")}, before_publish=fail)
    assert ids() == ["four"]
