"""What several operators share: reading tables, staging results, block counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.scratch import fresh_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Shuffle files of a staged step are not needed once it is written.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# What is staged inside ``passing``, per level.
_PASSING: list[list[tuple[str, str]]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end; a result is staged with ``keep``."""
    made: list[tuple[str, str]] = []
    _PASSING.append(made)
    try:
        yield
    finally:
        _PASSING.remove(made)
        for kind, name in made:
            _delete(spark, kind, name)


@contextmanager
def briefly(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like :func:`stage`, but deleted at the end."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    try:
        _written(frame, lambda w: w.parquet(path))
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        _delete(spark, "path", path)


def _delete(spark: SparkSession, kind: str, name: str) -> None:
    if kind == "table":
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    else:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _made(kind: str, name: str, keep: bool) -> None:
    if _PASSING and not keep:
        _PASSING[-1].append((kind, name))


def stage(frame: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends there."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    _made("path", path, keep)
    _written(frame, lambda w: w.parquet(path))
    return spark.read.schema(frame.schema).parquet(path)


def stage_bucketed(
    frame: DataFrame, label: str, key: str, buckets: int, keep: bool = False
) -> DataFrame:
    """The same as a bucketed table: joins by the key with tables of as many buckets move nothing."""
    name = f"{label}_{uuid.uuid4().hex}"
    _made("table", name, keep)
    _written(frame, lambda w: w.bucketBy(buckets, key).saveAsTable(name))
    return frame.sparkSession.table(name)


def _written(frame: DataFrame, write) -> None:
    spark = frame.sparkSession
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        write(frame.write.option("compression", "zstd"))
    finally:
        spark.conf.set(_CLEAN, before)


def parts(frame: DataFrame, least: int = 0) -> int:
    """Shuffle partitions of the session, ``least`` at least."""
    return max(least, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def clean_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
