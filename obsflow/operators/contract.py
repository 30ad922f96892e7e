"""What a batch must hold before it is loaded, and its fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.digests import table_digest
from ..functions.spec import KEYS
from ..functions.values import blank, missing_count

COUNTS = ("input_count", "accepted_count", "rejected_count", "duplicate_count", "missing_measurement_count")


def fingerprint(df: DataFrame, *by: str) -> DataFrame:
    """n_rows and an order-free digest of all columns, in one distributed pass."""
    return table_digest(df, *by)


def table_set_fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [fingerprint(df).select(F.lit(name).alias("table_name"), "n_rows", "digest") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def batch_status(incoming: DataFrame, runs: DataFrame) -> DataFrame:
    """batch_id and fingerprint of incoming batches against the run ledger."""
    old = runs.select("batch_id", F.col("input_fingerprint").alias("_old"))
    status = F.when(F.col("_old").isNull(), "new").when(F.col("_old") == F.col("input_fingerprint"), "already_loaded").otherwise("collision")
    return incoming.join(old, "batch_id", "left").select("batch_id", status.alias("status"))


def _first_level(df: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    """One row: distinct keys, keys met twice, and sums, in one shuffle."""
    by_key = df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()])
    return by_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 1).alias("twice"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums])


def violations(curated: DataFrame, stations: DataFrame, windows: DataFrame, report: DataFrame) -> DataFrame:
    """(check_name, violations); a batch may be loaded if all are 0.

    report: rows of COUNTS.  stations: station_id.  windows: station_id, start and
    end.  Each frame is read once; one row of each is compared.
    """
    negative = F.lit(False)
    for c in COUNTS:
        negative = negative | F.col(c).isNull() | (F.col(c) < 0)
    total = F.col("accepted_count") + F.col("rejected_count") + F.col("duplicate_count")
    required = blank(F.col("station_id")) | F.col("observed_at").isNull() | blank(F.col("payload_hash")) | F.col("source_ingested_at").isNull()
    flag = lambda c: c.cast("long")
    named = lambda df, **names: df.select(*[F.col(k).alias(v) for k, v in names.items()], F.lit(1).alias("_k"))
    of_curated = named(_first_level(curated, KEYS, missing=missing_count(), required=flag(required)), n="rows", twice="duplicate_keys", missing="missing", required="required_fields")
    of_stations = named(_first_level(stations, ["station_id"], blank=flag(blank(F.col("station_id")))), blank="blank_stations", twice="duplicate_stations")
    empty = flag(~F.coalesce(F.col("start") < F.col("end"), F.lit(False)))
    of_windows = named(_first_level(windows, ["station_id"], empty=empty), n="windows", empty="empty_windows")
    used = curated.select("station_id", F.lit(1).alias("_c"), F.lit(0).alias("_w")).unionByName(windows.select("station_id", F.lit(0).alias("_c"), F.lit(1).alias("_w"))).groupBy("station_id").agg(F.max("_c").alias("_c"), F.max("_w").alias("_w"))
    unknown = used.join(stations.select("station_id"), "station_id", "left_anti").agg(F.count_if(F.col("_c") == 1).alias("unknown_stations"), F.count_if(F.col("_w") == 1).alias("unknown_window_stations")).withColumn("_k", F.lit(1))
    row = report.withColumn("_k", F.lit(1)).join(of_curated, "_k")
    counted = row.groupBy("_k").agg(
        F.count_if(negative).alias("negative_counts"), F.count_if(~F.col("input_count").eqNullSafe(total)).alias("count_identity"), F.count_if(~F.col("accepted_count").eqNullSafe(F.col("rows"))).alias("accepted_rows"),
        F.count_if(~F.col("missing_measurement_count").eqNullSafe(F.col("missing"))).alias("missing_total"), F.max("required_fields").alias("required_fields"), F.max("duplicate_keys").alias("duplicate_keys"),
    )
    one = counted.join(of_stations, "_k").join(of_windows, "_k").join(unknown, "_k").withColumn("no_windows", (F.col("windows") == 0).cast("long"))
    checks = ["negative_counts", "count_identity", "accepted_rows", "missing_total", "required_fields", "duplicate_keys", "blank_stations", "duplicate_stations", "unknown_stations", "unknown_window_stations", "empty_windows", "no_windows"]
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).cast("long").alias("violations")) for c in checks])).alias("c")).select("c.*")
