"""A session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def create_session(app: str = "obsflow", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution; on a cluster master and sizes come from submit."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()
