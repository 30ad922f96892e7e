"""What a feed looks like: envelope, paths, measures, units and limits."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Measure:
    """A measured value: where it stands, how it is called, its units as
    {code: (factor, offset)} and its admissible range after conversion."""

    column: str
    name: str
    short: str
    units: tuple[tuple[str, float, float], ...]
    low: float
    high: float

    @property
    def path(self) -> str:
        return f"$.properties.{self.name}"


#: Units of the World Meteorological Organization's vocabulary
#: with factor and offset to the canonical unit, and admissible ranges.
MEASURES = (
    Measure("temperature_c", "temperature", "temperature", (("wmoUnit:degC", 1.0, 0.0), ("wmoUnit:degF", 5.0 / 9.0, -32.0 * 5.0 / 9.0), ("wmoUnit:K", 1.0, -273.15)), -100.0, 60.0),
    Measure("humidity_pct", "relativeHumidity", "humidity", (("wmoUnit:percent", 1.0, 0.0),), 0.0, 100.0),
    Measure("wind_kph", "windSpeed", "wind", (("wmoUnit:km_h-1", 1.0, 0.0), ("wmoUnit:m_s-1", 3.6, 0.0), ("wmoUnit:kn", 1.852, 0.0), ("wmoUnit:mi_h-1", 1.609344, 0.0)), 0.0, 500.0),
)


@dataclass(frozen=True)
class Leaf:
    """A place in the envelope or the payload, the kind of value that may stand
    there besides null, and the reason given for another kind."""

    name: str
    path: str
    kind: str
    reason: str


#: Fields of the envelope, places in the payload, and reasons.
ENVELOPE_FIELDS = ("batch_id", "station_id", "ingested_at", "raw_json")
STATION_URL = r"^https?://api\.weather\.gov/stations/([A-Za-z0-9_-]+)/?$"
PAYLOAD = (
    Leaf("properties", "$.properties", "object", "invalid_properties"),
    Leaf("station", "$.properties.station", "text", "invalid_source_station_type"),
    Leaf("time", "$.properties.timestamp", "text", "invalid_observed_at"),
    Leaf("text", "$.properties.textDescription", "text", "invalid_text_description"),
    Leaf("geometry", "$.geometry", "object", "invalid_geometry"),
    Leaf("pair", "$.geometry.coordinates", "list", "invalid_coordinates"),
    Leaf("longitude", "$.geometry.coordinates[0]", "number", "invalid_longitude"),
    Leaf("latitude", "$.geometry.coordinates[1]", "number", "invalid_latitude"),
)


@dataclass(frozen=True)
class Feed:
    envelope: tuple[str, ...] = ENVELOPE_FIELDS
    station_url: str = STATION_URL
    places: tuple[Leaf, ...] = PAYLOAD
    measures: tuple[Measure, ...] = MEASURES
    future_minutes: int = 10
    gap_minutes: int = 120

    def leaves(self) -> tuple[Leaf, ...]:
        """All places of the payload, those of the measures included."""
        out = list(self.places)
        for m in self.measures:
            out += [
                Leaf(m.name, m.path, "object", f"invalid_{m.name}_object"),
                Leaf(f"{m.name}_value", f"{m.path}.value", "number", f"invalid_{m.name}_value"),
                Leaf(f"{m.name}_unit", f"{m.path}.unitCode", "text", f"invalid_{m.name}_unit_type"),
            ]
        return tuple(out)

    def codes(self) -> list[str]:
        """All reasons, in the order in which a line lists them."""
        of = {leaf.name: leaf.reason for leaf in self.leaves()}
        out = ["invalid_envelope", *[code for f in self.envelope for code in (f"missing_{f}", f"invalid_{f}_type")], "unknown_station", "invalid_payload"]
        out += [of["properties"], of["station"], "missing_or_invalid_source_station", "source_station_mismatch", of["time"], "future_observed_at", "invalid_ingested_at", of["text"]]
        out += [code for m in self.measures for code in (of[m.name], of[f"{m.name}_value"], of[f"{m.name}_unit"], f"unsupported_{m.name}_unit")]
        out += [f"{m.short}_out_of_range" for m in self.measures]
        return [*out, of["geometry"], of["pair"], of["longitude"], of["latitude"], "longitude_out_of_range", "latitude_out_of_range"]


FEED = Feed()
CURATED = (
    ("station_id", "string"), ("observed_at", "timestamp_ntz"), ("temperature_c", "double"), ("humidity_pct", "double"), ("wind_kph", "double"),
    ("text_description", "string"), ("latitude", "double"), ("longitude", "double"), ("payload_hash", "string"), ("source_ingested_at", "timestamp_ntz"),
)
CURATED_SCHEMA = ", ".join(f"{n} {t}" for n, t in CURATED)
KEYS = ["station_id", "observed_at"]
MEASURE_COLUMNS = [m.column for m in MEASURES]
