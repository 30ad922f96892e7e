"""A line for every kind of value at every place of the feed, and their reasons.

The lines are made from the feed's own table of places: at each place stands, in
turn, a text, an object, a list, a flag, a number and null; then come values of
the right kind that break a rule.  The SQL knows nothing of how a line was made:
it reads the line's JSON and derives the reasons from what it finds.
"""

from __future__ import annotations

import copy
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spec import FEED, Feed
from ..operators import validate
from . import mapping as M
from .registry import query

#: What may stand at a place, by kind.
STANDS = {"text": "w", "object": {"a": 1}, "list": [7], "flag": True, "number": 3, "null": None}
MARK = "%ID%"


def _payload(feed: Feed) -> dict:
    units = {m.name: {"value": 20.0, "unitCode": m.units[0][0]} for m in feed.measures}
    return {"type": "Feature", "geometry": {"type": "Point", "coordinates": [10.0, 45.0]}, "properties": {"station": "https://api.weather.gov/stations/S1", "timestamp": "2024-01-02T11:00:00Z", "textDescription": f"seen {MARK}", **units}}


def _envelope(raw: str, **change) -> str:
    return json.dumps({"batch_id": f"b{MARK}", "ingested_at": "2024-01-02T12:00:00Z", "station_id": "S1", "raw_json": raw} | change)


def _put(payload: dict, path: str, value) -> dict:
    out = copy.deepcopy(payload)
    *above, last = [int(k) if k.isdigit() else k for k in path.removeprefix("$.").replace("[", ".").replace("]", "").split(".")]
    at = out
    for k in above:
        at = at[k]
    at[last] = value
    return out


def templates(feed: Feed = FEED) -> list[tuple[str, str]]:
    """(what was changed, line with MARK in place of an id)."""
    base = _payload(feed)
    raw = json.dumps(base)
    out = [("nothing", _envelope(raw))]
    for leaf in feed.leaves():
        out += [(f"{leaf.name}:{kind}", _envelope(json.dumps(_put(base, leaf.path, x)))) for kind, x in STANDS.items()]
    for field in feed.envelope:
        out += [(f"{field}:{kind}", _envelope(raw, **{field: x})) for kind, x in (STANDS | {"blank": " "}).items()]
    values = [(leaf.path, x) for leaf in feed.places for x in {"station": ["https://api.weather.gov/stations/S2", "http://api.weather.gov/stations/S1/", "https://example.org/S1"], "time": ["2024-01-02T11:00:00", "2024-01-02T13:00:00+02:00", "2024-13-02T11:00:00Z", "2031-01-01T00:00:00Z"], "longitude": [-180.5, 180], "latitude": [91, -90], "pair": [[], [1.0]]}.get(leaf.name, [])]
    for m in feed.measures:
        values += [(f"{m.path}.unitCode", "furlong"), *[(m.path, {"value": x, "unitCode": unit}) for unit, factor, offset in m.units for x in ((m.low - offset) / factor - 1, (m.high - offset) / factor + 1, (m.high - offset) / factor - 1)], (m.path, {}), (m.path, {"value": None, "unitCode": "furlong"})]
    out += [(f"{path}={x}", _envelope(json.dumps(_put(base, path, x)))) for path, x in values]
    out += [(f"ingested_at={x}", _envelope(raw, ingested_at=x)) for x in ("2024-02-30T00:00:00Z", "2024-01-02 12:00:00", "2024-01-02T12:00:00.5-03:30")]
    out += [("no station of ours", _envelope(raw, station_id="S99")), ("broken payload", _envelope('{"type":')), ("list as payload", _envelope("[1]")), ("null as payload", _envelope("null"))]
    return [*out, ("broken line", '{"batch_id": "b'), ("list as line", "[1]"), ("word as line", f"line {MARK}"), ("fields missing", "{}")]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id and the line of each event, one template after the other."""
    all_ = [t for _, t in templates()]
    texts = F.array(*[F.lit(t) for t in all_])
    e = M.table(spark, sf_dir, "events").select("event_id")
    return e.select("event_id", F.replace(F.get(texts, (F.col("event_id") % len(all_)).cast("int")), F.lit(MARK), F.col("event_id").cast("string")).alias("value"))


def _kind(j: str, path: str) -> str:
    return f"CASE json_type({j}, '{path}') WHEN 'VARCHAR' THEN 'text' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' WHEN 'BOOLEAN' THEN 'flag' WHEN 'NULL' THEN NULL WHEN 'BIGINT' THEN 'number' WHEN 'UBIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' END"


def _sql(feed: Feed = FEED) -> str:
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for _, t in templates(feed))
    n = len(templates(feed))
    number = lambda path: f"CASE json_type(p, '{path}') WHEN 'BOOLEAN' THEN (p->>'{path}')::BOOLEAN::INT::DOUBLE WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN NULL ELSE TRY_CAST(p->>'{path}' AS DOUBLE) END"
    kinds = [f"{_kind('p', leaf.path)} AS k_{leaf.name}" for leaf in feed.leaves()] + [f"{_kind('j', f'$.{f}')} AS k_{f}" for f in feed.envelope]
    found = [f"{number(leaf.path) if leaf.kind == 'number' else f"p->>'{leaf.path}'"} AS v_{leaf.name}" for leaf in feed.leaves() if leaf.kind in ("text", "number")]
    canonical = [f"CASE v_{m.name}_unit {' '.join(f"WHEN '{code}' THEN v_{m.name}_value * {factor!r}::DOUBLE + {offset!r}::DOUBLE" for code, factor, offset in m.units)} END AS {m.column}" for m in feed.measures]
    iso = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
    timed = lambda c: f"coalesce(regexp_matches({c}, '{iso}') AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL, false)"
    fires = {}
    for leaf in feed.leaves():
        fires[leaf.reason] = f"k_{leaf.name} <> '{leaf.kind}'" + (f" OR (k_{leaf.name} IS NOT NULL AND (v_{leaf.name} IS NULL OR isinf(v_{leaf.name})))" if leaf.kind == "number" else "")
    for f in feed.envelope:
        fires |= {f"missing_{f}": f"{f} IS NULL OR trim({f}) = ''", f"invalid_{f}_type": f"k_{f} <> 'text'"}
    for m in feed.measures:
        codes = ", ".join(f"'{code}'" for code, _, _ in m.units)
        fires |= {f"unsupported_{m.name}_unit": f"k_{m.name}_value IS NOT NULL AND NOT coalesce(v_{m.name}_unit IN ({codes}), false)", f"{m.short}_out_of_range": f"{m.column} < {m.low} OR {m.column} > {m.high}"}
    fires |= {
        "invalid_envelope": "coalesce(json_type(j), '') <> 'OBJECT'", "invalid_payload": "coalesce(json_type(p), '') <> 'OBJECT'", "unknown_station": f"station_id NOT IN ({', '.join(repr(s) for s in M.STATIONS)})",
        "missing_or_invalid_source_station": "source IS NULL", "source_station_mismatch": "source <> station_id", "invalid_observed_at": f"k_time <> 'text' OR NOT {timed('v_time')}",
        "future_observed_at": f"TRY_CAST(v_time AS TIMESTAMP) > TIMESTAMP '{M.REFERENCE:%Y-%m-%d %H:%M:%S}' + INTERVAL {feed.future_minutes} MINUTE", "invalid_ingested_at": f"NOT {timed('ingested_at')}",
        "invalid_coordinates": "k_pair <> 'list' OR (k_pair IS NOT NULL AND (v_longitude IS NULL OR v_latitude IS NULL))", "longitude_out_of_range": "abs(v_longitude) > 180", "latitude_out_of_range": "abs(v_latitude) > 90",
    }
    listed = ", ".join(f"CASE WHEN {fires[code]} THEN '{code}' END" for code in feed.codes())
    return f"""WITH t AS (SELECT [{quoted}] AS t), l AS (SELECT event_id, replace(t[event_id % {n} + 1], '{MARK}', event_id::VARCHAR) AS line FROM events, t),
e AS (SELECT event_id, CASE WHEN json_valid(line) THEN line::JSON END AS j FROM l), f AS (SELECT event_id, j, {', '.join(f"CASE WHEN json_type(j) = 'OBJECT' THEN j->>'$.{f}' END AS {f}" for f in feed.envelope)} FROM e),
g AS (SELECT *, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS p FROM f), h AS (SELECT *, {', '.join(kinds + found)} FROM g),
m AS (SELECT *, nullif(regexp_extract(v_station, '{feed.station_url}', 1), '') AS source, {', '.join(canonical)} FROM h)
SELECT event_id, concat_ws(',', {listed}) AS reasons FROM m"""


@query(_sql())
def validate_codes(spark, sf_dir):
    """The reasons of every line, each of the forty codes among them."""
    rows = lines(spark, sf_dir)
    out = validate.classify(rows, M.STATIONS, M.REFERENCE, keep=("event_id",))
    return out.select("event_id", F.array_join("reasons", ",").alias("reasons"))
