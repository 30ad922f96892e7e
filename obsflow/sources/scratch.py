"""Where streams and files of a query go: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below spark.checkpoint.dir; a temporary one if that is unset."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = conf.rstrip("/") if conf else "file://" + tempfile.mkdtemp(prefix="obsflow-")
    return f"{root}/{label}-{uuid.uuid4().hex}"
