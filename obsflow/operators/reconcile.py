"""Profiles of two copies of a table, compared; set checks; evidence rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import equivalent
from .contract import fingerprint


def profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """(metric, value): rows, distinct and null keys, nulls of every column, and
    sum, average, least and largest of every number, in one pass."""
    numeric = [f.name for f in df.schema if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal") and f.name not in keys]
    anynull = F.lit(False)
    for k in keys:
        anynull = anynull | F.col(k).isNull()
    aggs = {"row_count": F.count("*"), "distinct_keys": F.count_distinct(F.struct(*keys)), "null_keys": F.count_if(anynull)}
    for c in df.columns:
        aggs[f"nulls:{c}"] = F.count_if(F.col(c).isNull())
    for c in numeric:
        d = F.col(c).cast("double")
        # Sums as decimals don't depend on the order of rows.
        total = F.sum(d.cast("decimal(38,6)")).cast("double")
        aggs |= {f"sum:{c}": total, f"avg:{c}": total / F.count(c), f"min:{c}": F.min(d), f"max:{c}": F.max(d)}
    one = df.agg(*[a.cast("double").alias(f"m{k}") for k, a in enumerate(aggs.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"m{k}").alias("value")) for k, name in enumerate(aggs)])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


def compare(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Two profiles side by side with whether they agree."""
    e, a = expected.withColumnRenamed("value", "expected"), actual.withColumnRenamed("value", "actual")
    both = e.join(a, "metric", "full_outer")
    return both.select("metric", "expected", "actual", equivalent(F.col("expected"), F.col("actual")).alias("passed"))


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """(metric, expected, actual, passed) as text: header, all profile metrics,
    unique and complete keys, and the content digest."""
    spark = expected.sparkSession
    text = lambda df, c: F.col(c).cast("string").alias(c)
    rows = compare(profile(expected, keys), profile(actual, keys)).select("metric", text(None, "expected"), text(None, "actual"), "passed")
    head = spark.createDataFrame([("header", ",".join(expected.columns), ",".join(actual.columns), expected.columns == actual.columns)], "metric string, expected string, actual string, passed boolean")
    d = fingerprint(expected).select(F.col("digest").alias("expected"), F.lit(1).alias("_k")).join(fingerprint(actual).select(F.col("digest").alias("actual"), F.lit(1).alias("_k")), "_k")
    content = d.select(F.lit("content").alias("metric"), "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"))
    return head.unionByName(rows).unionByName(content)


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def only_in_second(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of b that a lacks."""
    return b.subtract(a)


def union_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def multiset_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """side and row count of what each table has beyond the other; equal
    multisets have 0 on both sides."""
    left = a.exceptAll(b).agg(F.count("*").alias("n_rows")).select(F.lit("only_in_first").alias("side"), "n_rows")
    return left.unionByName(b.exceptAll(a).agg(F.count("*").alias("n_rows")).select(F.lit("only_in_second").alias("side"), "n_rows"))


def overall(checks: DataFrame) -> DataFrame:
    """One row: whether all evidence rows passed."""
    return checks.agg(F.count("*").alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed")).withColumn("passed", F.col("n_failed") == 0)


def missing_columns(header: list[str], required: list[str]) -> list[str]:
    """Problems of an extract's header: columns it lacks or has twice."""
    return [f"missing:{c}" for c in required if c not in header] + [f"twice:{c}" for c in sorted(set(header)) if header.count(c) > 1]
