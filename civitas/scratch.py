"""Shared folder for intermediate tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only where none is set."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other job writes to."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
