"""Writing tables: plain, replacing dimensions, and build-then-switch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.model.specs import TABLES, spec
from civitas.sources.versions import Versions


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "overwrite",
    sort_by: tuple[str, ...] = (),
) -> DataFrame:
    """Write ``<root>/<name>`` in contract order and types, and read it back.

    ``sort_by`` range-partitions and sorts the files, which is what lets a later
    prefix or page query skip files by their minimum and maximum.
    """
    frame = df
    if name in TABLES:
        frame = df.select(*[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec(name).columns])
    if sort_by:
        frame = frame.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    path = f"{root.rstrip('/')}/{name}"
    frame.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def save_bucketed(
    df: DataFrame, database: str, name: str, key: str, buckets: int, mode: str = "overwrite"
) -> DataFrame:
    """Save a catalog table bucketed and sorted by ``key``.

    Two tables bucketed alike join on that key without an exchange: companies
    with their establishments, or two generations in the delta gate.
    """
    table = f"{database}.{name}"
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def replace_dimensions(
    root: str, regions: DataFrame, states: DataFrame, cities: DataFrame
) -> dict[str, DataFrame]:
    """Replace the three geographic dimensions as a whole, parents first.

    All three are read and written beside the current ones before the first is
    switched, so a failing source leaves every dimension as it was.
    """
    frames = {"ibge_regiao": regions, "ibge_estado": states, "ibge_cidade": cities}
    spark = regions.sparkSession
    staged = {}
    for name, frame in frames.items():
        staged[name] = f"{root}/{name}__{uuid.uuid4().hex}"
        frame.select(
            *[F.col(c.name).cast(c.dtype).alias(c.name) for c in spec(name).columns]
        ).write.parquet(staged[name])
    for name, path in staged.items():
        _switch(spark, path, f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in frames}


class CountMismatch(RuntimeError):
    """The new table does not hold the rows it should; the current one stays."""


def build_and_swap(df: DataFrame, target: str, expect_rows: int | None = None) -> DataFrame:
    """Write beside ``target``, check the row count, then switch the folders.

    Readers keep the old content until the new one is complete.  On a count
    that differs from ``expect_rows`` nothing is switched.
    """
    spark = df.sparkSession
    fresh = f"{target}_new_{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    if expect_rows is not None:
        found = spark.read.parquet(fresh).count()
        if found != expect_rows:
            _delete(spark, fresh)
            raise CountMismatch(f"{target}: {found} rows built, {expect_rows} expected")
    _switch(spark, fresh, target)
    spark.catalog.refreshByPath(target)
    return spark.read.parquet(target)


def build_version(df: DataFrame, target: str, expect_rows: int | None = None) -> DataFrame:
    """The next version of the table under ``target``, checked before it counts.

    Unlike the switch of folders there is no moment without a table, and of two
    writers at once both versions are kept, the later in force; readers open
    ``read_version``.
    """

    def check(stored: DataFrame) -> None:
        if expect_rows is not None and (found := stored.count()) != expect_rows:
            raise CountMismatch(f"{target}: {found} rows built, {expect_rows} expected")

    Versions(df.sparkSession, target).put(lambda _: df, check)
    return read_version(df.sparkSession, target)


def read_version(spark: SparkSession, target: str) -> DataFrame:
    found = Versions(spark, target).read()
    if found is None:
        raise FileNotFoundError(f"{target} has no version")
    return found


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return location.getFileSystem(conf), location, jvm


def _delete(spark: SparkSession, path: str) -> None:
    system, location, _ = _hadoop(spark, path)
    system.delete(location, True)


def _switch(spark: SparkSession, fresh: str, target: str) -> None:
    """Move ``fresh`` into the place of ``target``; the old one goes last."""
    system, place, jvm = _hadoop(spark, target)
    old = None
    if system.exists(place):
        old = jvm.org.apache.hadoop.fs.Path(f"{target}_old_{uuid.uuid4().hex}")
        if not system.rename(place, old):
            raise OSError(f"cannot set {target} aside")
    if not system.rename(jvm.org.apache.hadoop.fs.Path(fresh), place):
        if old is not None:
            system.rename(old, place)
        raise OSError(f"cannot move {fresh} to {target}")
    if old is not None:
        system.delete(old, True)
