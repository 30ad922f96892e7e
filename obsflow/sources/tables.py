"""Six tables published together by one small pointer file.

A load writes what it changes to new folders; then one pointer that names the
folders of all tables is put beside the older ones, under the next number.  The
highest number counts, and no pointer is ever deleted or changed: readers see
either the old folders or the new ones, and a failed load changes nothing.

Facts and their versions are kept a day at a time: a pointer names a folder for
each day, so a load reads and rewrites the days of its batch alone.

A pointer is written under another name first and moved to its number by a rename
that never replaces a file.  So of two loads that began at one state the second
fails, and what a stopped load left behind is in nobody's way.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.spec import CURATED_SCHEMA

SCHEMAS = {
    "dim_station": "station_id string, station_name string, latitude double, longitude double, metadata_ingested_at timestamp_ntz",
    "dim_date": "observation_date date, year int, month int, day int, iso_day_of_week int",
    "fact_observation": CURATED_SCHEMA + ", observation_date date, batch_id string, loaded_at timestamp_ntz",
    "observation_versions": "station_id string, observed_at timestamp_ntz, source_ingested_at timestamp_ntz, payload_hash string",
    "etl_runs": """batch_id string, input_fingerprint string, source string, completed_at timestamp_ntz, input_count bigint, accepted_count bigint,
        rejected_count bigint, duplicate_count bigint, missing_measurement_count bigint, inserted_count bigint, updated_count bigint, unchanged_count bigint,
        raw_path string""",
    "source_checkpoints": "station_id string, watermark timestamp_ntz, batch_id string, updated_at timestamp_ntz",
}
#: Tables kept by the day of ``observed_at``.
DAILY = ("fact_observation", "observation_versions")
DAY = "observation_date"


def days_of(rows: DataFrame) -> list[dt.date]:
    """The days of a batch's rows; a driver-side list as long as the batch has days."""
    return sorted(r["day"] for r in rows.select(F.to_date("observed_at").alias("day")).filter("day is not null").distinct().collect())


@dataclass(frozen=True)
class State:
    """What one pointer names: a folder a table, or a folder a day."""

    number: int = 0
    whole: dict[str, str] = field(default_factory=dict)
    daily: dict[str, dict[str, str]] = field(default_factory=dict)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), conf)
        self._keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # replaces nothing

    def state(self) -> State:
        """The state that counts now; an empty one before the first commit."""
        found = self._fs.globStatus(self._path(f"{self.root}/pointer-*.json")) or []
        number = max((int(f.getPath().getName()[len("pointer-") : -len(".json")]) for f in found), default=0)
        if not number:
            return State()
        stream = self._fs.open(self._path(f"{self.root}/pointer-{number}.json"))
        try:
            named = json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()
        return State(number, named["whole"], named["daily"])

    def versions(self) -> dict:
        """Each table's folder, or its folders by day."""
        s = self.state()
        return s.whole | s.daily

    def read(self, name: str, state: State | None = None, days: Iterable[dt.date] | None = None) -> DataFrame:
        """A table at the state that counts now, or at one taken before; of tables
        kept by day only ``days``, if given."""
        state = self.state() if state is None else state
        schema = SCHEMAS[name]
        if name not in DAILY:
            path = state.whole.get(name)
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{path}") if path else self.spark.createDataFrame([], schema)
        folders = state.daily.get(name, {})
        wanted = folders if days is None else [d for d in map(str, days) if d in folders]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{name}/{folders[d]}/{DAY}={d}" for d in wanted]
        columns = [f.name for f in self.spark.createDataFrame([], schema).schema]
        stored = schema if DAY in columns else f"{schema}, {DAY} date"
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/{name}").parquet(*paths).select(*columns)

    def snapshot(self, state: State | None = None, days: Iterable[dt.date] | None = None) -> dict[str, DataFrame]:
        """All six tables at one state."""
        state = self.state() if state is None else state
        return {name: self.read(name, state, days) for name in SCHEMAS}

    def commit(self, tables: dict[str, DataFrame], before_publish=None, since: State | None = None, days: Iterable[dt.date] | None = None) -> State:
        """Writes the tables, then publishes all of them at once.

        since: the state that the tables were made from; it must still count.
        days: the days that the tables kept by day hold; all others stay as they
        are.  None: the tables are whole, and no other day stays.
        before_publish: called in between (tests inject failures there).
        """
        since = self.state() if since is None else since
        whole, daily = dict(since.whole), {n: dict(d) for n, d in since.daily.items()}

        def write(name: str, df: DataFrame) -> tuple[str, str]:
            version = f"v={uuid.uuid4().hex}"
            path = f"{self.root}/{name}/{version}"
            if name in DAILY:
                # One task a day, and as many as Spark wants for large days.
                df.withColumn(DAY, F.to_date("observed_at")).hint("rebalance", DAY).write.partitionBy(DAY).parquet(path)
            else:
                df.select(*[f.name for f in self.read(name, State()).schema]).write.parquet(path)
            return name, version

        # Small tables wait for the large ones in no order.
        with ThreadPoolExecutor(max(1, len(tables))) as pool:
            versions = dict(pool.map(write, tables, tables.values()))
        for name, version in versions.items():
            if name not in DAILY:
                whole[name] = version
                continue
            written = [f.getPath().getName()[len(DAY) + 1 :] for f in self._fs.globStatus(self._path(f"{self.root}/{name}/{version}/{DAY}=*")) or []]
            daily[name] = (daily.get(name, {}) if days is not None else {}) | dict.fromkeys(written, version)
        if before_publish is not None:
            before_publish()
        staged = self._path(f"{self.root}/staged-{uuid.uuid4().hex}")
        out = self._fs.create(staged, True)
        out.write(bytearray(json.dumps({"whole": whole, "daily": daily}).encode()))
        out.close()
        try:
            self._files.rename(staged, self._path(f"{self.root}/pointer-{since.number + 1}.json"), self._keep)
        except Exception as e:
            self._fs.delete(staged, False)
            if "FileAlreadyExists" in str(e):
                raise OSError("another load was published meanwhile") from e
            raise
        return State(since.number + 1, whole, daily)
