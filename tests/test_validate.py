import datetime as dt
import json

import pytest

from obsflow.functions import spec
from obsflow.operators import coverage, dedup, load, validate
from obsflow.plans import defects

NOW = dt.datetime(2024, 1, 2, 12, tzinfo=dt.UTC)
LINES = dict(defects.templates())
#: A sound line of station S1, seen an hour before NOW.
SOUND = json.loads(LINES["nothing"])


def line(ingested_at="2024-01-02T12:00:00Z", batch_id="b", **measures):
    """The sound line with other measures: name=(value, unit)."""
    p = json.loads(SOUND["raw_json"])
    for name, (value, unit) in measures.items():
        p["properties"][name] = {"value": value, "unitCode": unit}
    return json.dumps(SOUND | {"raw_json": json.dumps(p), "ingested_at": ingested_at, "batch_id": batch_id})


@pytest.fixture(scope="module")
def reasons(spark):
    df = spark.createDataFrame(list(LINES.items()), "change string, value string")
    return {r["change"]: r["reasons"] for r in validate.classify(df, ["S1", "S2"], NOW, keep=("change",)).collect()}


def test_every_reason_is_found(reasons):
    assert {c for r in reasons.values() for c in r} == set(spec.FEED.codes()) and len(spec.FEED.codes()) == 40
    assert reasons["nothing"] == [] and all(r == sorted(r, key=spec.FEED.codes().index) for r in reasons.values())


@pytest.mark.parametrize("leaf", spec.FEED.leaves(), ids=lambda leaf: leaf.name)
def test_a_place_takes_its_own_kind_and_null(reasons, leaf):
    wrong_text = {"station": "missing_or_invalid_source_station", "time": leaf.reason}
    for kind in defects.STANDS:
        got = reasons[f"{leaf.name}:{kind}"]
        if kind == leaf.kind or kind == "null":
            expected = kind == leaf.kind and leaf.name in wrong_text  # a word is neither a station nor a time
            assert (wrong_text.get(leaf.name) in got) if expected else leaf.reason not in got or leaf.name in ("time", "pair")
        else:
            assert leaf.reason in got, kind


@pytest.mark.parametrize("field", spec.ENVELOPE_FIELDS)
def test_an_envelope_field_is_a_text_that_is_there(reasons, field):
    for kind in (*defects.STANDS, "blank"):
        got = reasons[f"{field}:{kind}"]
        assert (f"missing_{field}" in got) == (kind in ("null", "blank"))
        assert (f"invalid_{field}_type" in got) == (kind not in ("text", "null", "blank"))


@pytest.mark.parametrize("m", spec.MEASURES, ids=lambda m: m.name)
def test_limits_hold_in_every_unit(spark, m):
    back = lambda x, factor, offset: (x - offset) / factor
    cases = [(back(x, f, o), unit, bad) for unit, f, o in m.units for x, bad in ((m.low + 0.5, False), (m.high - 0.5, False), (m.low - 0.5, True), (m.high + 0.5, True))]
    df = spark.createDataFrame([(line(**{m.name: (x, unit)}),) for x, unit, _ in cases], "value string")
    got = {r["raw_envelope"]: r["reasons"] for r in validate.classify(df, ["S1"], NOW).collect()}
    assert [got[line(**{m.name: (x, unit)})] for x, unit, _ in cases] == [[f"{m.short}_out_of_range"] if bad else [] for _, _, bad in cases]


def test_times_at_the_edge_of_the_future(spark):
    at = lambda t: json.dumps(SOUND | {"raw_json": SOUND["raw_json"].replace("2024-01-02T11:00:00Z", t)})
    edge = NOW + dt.timedelta(minutes=spec.FEED.future_minutes)
    late = [at(edge.isoformat()), at((edge + dt.timedelta(microseconds=1)).isoformat())]
    got = {r["raw_envelope"]: r["reasons"] for r in validate.classify(spark.createDataFrame([(x,) for x in late], "value string"), ["S1"], NOW).collect()}
    assert [got[x] for x in late] == [[], ["future_observed_at"]]


@pytest.mark.parametrize("text", ["", "[1]", '{"batch_id": "b"', "5"])
def test_broken_lines_are_kept(spark, text):
    row = validate.classify(spark.createDataFrame([(text,)], "value string"), ["S1"], NOW).first()
    assert row["raw_envelope"] == text and "invalid_envelope" in row["reasons"]


def test_units(spark):
    for name, unit, value, column, want in [("temperature", "wmoUnit:degF", -40, "temperature_c", -40.0), ("temperature", "wmoUnit:K", 273.15, "temperature_c", 0.0), ("windSpeed", "wmoUnit:m_s-1", 10, "wind_kph", 36.0), ("windSpeed", "wmoUnit:mi_h-1", 10, "wind_kph", 16.09344)]:
        df = spark.createDataFrame([(line(**{name: (value, unit)}),)], "value string")
        assert validate.classify(df, ["S1"], NOW).first()[column] == pytest.approx(want)


def test_winner_does_not_depend_on_order(spark):
    a = line(temperature=(1, "wmoUnit:degC"))
    b = line("2024-01-02T12:30:00Z", temperature=(2, "wmoUnit:degC"))
    for lines in ([a, b], [b, a]):
        t = load.transform(spark.createDataFrame([(x,) for x in lines], "value string"), ["S1"], NOW)
        assert [r["temperature_c"] for r in t.curated.collect()] == [2.0]
        c = t.counts.first()
        assert (c["input_count"], c["accepted_count"], c["duplicate_count"], c["rejected_count"]) == (2, 1, 1, 0)


def test_empty_input(spark):
    t = load.transform(spark.createDataFrame([], "value string"), ["S1"], NOW)
    assert t.curated.count() == 0 and t.rejected.count() == 0 and t.counts.count() == 0
    c = t.coverage.first()
    assert c["missing_in_batch"] and not c["stale"] and c["minutes_behind_reference"] is None


def test_coverage_signals(spark):
    times = ["2024-01-02 09:00", "2024-01-02 10:00", "2024-01-02 13:00", "2024-01-03 13:30"]
    obs = spark.createDataFrame([("A", dt.datetime.fromisoformat(t)) for t in times], "station_id string, observed_at timestamp_ntz")
    from pyspark.sql import functions as F

    c = coverage.coverage(obs, spark.createDataFrame([("A",), ("B",)], "station_id string"), F.lit("2024-01-03 16:30").cast("timestamp_ntz"))
    rows = {r["station_id"]: r for r in c.collect()}
    assert rows["A"]["gap_count"] == 2 and rows["A"]["minutes_behind_reference"] == 180.0 and rows["A"]["stale"]
    assert rows["B"]["missing_in_batch"] and coverage.rollup(c).first().asDict() == {"empty_station_count": 1, "stale_station_count": 1}


def test_preconditions(spark):
    df = spark.createDataFrame([("",)], "value string")
    with pytest.raises(ValueError):
        validate.classify(df, [], NOW)
    with pytest.raises(ValueError):
        validate.classify(df, ["A"], NOW.replace(tzinfo=None))


def test_quality_counts_of_null_batches(spark):
    c = {r["batch_id"]: r for r in dedup.quality_counts(validate.classify(spark.createDataFrame([("x",), (line(),)], "value string"), ["S1"], NOW)).collect()}
    assert c[None]["rejected_count"] == 1 and c["b"]["accepted_count"] == 1
