"""Generations compared by digests of buckets, so that equal buckets are not read.

A table is stored in folders by bucket of its id, with one row per bucket beside
it: how many rows, and the sums of their hashes, which no order of rows or files
changes.  Two generations whose digests of a bucket are equal hold the same rows
in it; only the others are joined.  How much that saves follows from how the
changes lie: a month that touches every bucket is read as a whole, a corrected
or repeated load nearly not at all.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "balde"
BUCKETS = 256
SUFFIX = "_resumo"
_SUMS = ("linhas", "alto", "meio", "baixo")


def with_bucket(frame: DataFrame, key: str, buckets: int) -> DataFrame:
    return frame.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def bucket_digests(frame: DataFrame, key: str, row_hash: str, buckets: int) -> DataFrame:
    """One row per bucket that has rows.

    A row's 64-bit hash goes into three sums of 22 bits or less, so those of
    10^12 rows fit a long; a null hash is told from every value.
    """
    mask = F.lit((1 << 22) - 1)
    row = F.xxhash64(key, row_hash, F.col(row_hash).isNull())
    return (
        with_bucket(frame.select(key, row_hash), key, buckets)
        .groupBy(BUCKET)
        .agg(
            F.count("*").alias("linhas"),
            F.sum(F.shiftright(row, 44)).alias("alto"),
            F.sum(F.shiftright(row, 22).bitwiseAND(mask)).alias("meio"),
            F.sum(row.bitwiseAND(mask)).alias("baixo"),
        )
        .withColumn("baldes", F.lit(buckets))
    )


def write_digested(
    frame: DataFrame,
    root: str,
    name: str,
    key: str = "cnpj_completo",
    row_hash: str = "row_hash",
    buckets: int = BUCKETS,
) -> None:
    """Store a table by bucket, then its digests, taken from what was stored.

    A table without digests is one whose write did not end; it is compared as a
    whole.
    """
    spark, path = frame.sparkSession, f"{root.rstrip('/')}/{name}"
    with_bucket(frame, key, buckets).repartition(buckets, BUCKET).sortWithinPartitions(
        BUCKET, key
    ).write.partitionBy(BUCKET).parquet(path)
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # no row, hence no folder: one that holds the schema alone
        frame.limit(0).write.parquet(f"{path}/{BUCKET}=0")
        stored = spark.read.parquet(path)
    bucket_digests(stored.drop(BUCKET), key, row_hash, buckets).coalesce(1).write.parquet(path + SUFFIX)


def stored_digests(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}{SUFFIX}")
    except AnalysisException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def differing_buckets(new: DataFrame, current: DataFrame) -> list[int] | None:
    """Buckets whose digests differ; None when the two were cut differently.

    Both sides have one row per bucket, so they fit the driver.
    """
    sizes = {r[0] for r in new.select("baldes").union(current.select("baldes")).distinct().collect()}
    if len(sizes) > 1:
        return None
    n, c = new.alias("n"), current.alias("c")
    same = F.lit(True)
    for name in _SUMS:
        same = same & F.col(f"n.{name}").eqNullSafe(F.col(f"c.{name}"))
    both = n.join(c, F.col(f"n.{BUCKET}") == F.col(f"c.{BUCKET}"), "full_outer").filter(~same)
    return sorted(r[0] for r in both.select(F.coalesce(f"n.{BUCKET}", f"c.{BUCKET}")).collect())


def stored_delta(
    spark: SparkSession,
    new_root: str,
    current_root: str,
    name: str,
    key: str = "cnpj_completo",
    row_hash: str = "row_hash",
) -> DataFrame | None:
    """The counts of ``generation_delta`` for two stored tables.

    None when one of them has no digests or they were cut differently: then the
    whole tables have to be compared.
    """
    from civitas.operators.generations import generation_delta

    new, current = (stored_digests(spark, r, name) for r in (new_root, current_root))
    buckets = None if new is None or current is None else differing_buckets(new, current)
    if buckets is None:
        return None
    sides = [
        spark.read.parquet(f"{r.rstrip('/')}/{name}").filter(F.col(BUCKET).isin(buckets))
        for r in (new_root, current_root)
    ]
    total = current.agg(F.coalesce(F.sum("linhas"), F.lit(0)).cast("bigint").alias("total_vigente"))
    # one row each
    return generation_delta(*sides, key, row_hash).drop("total_vigente").crossJoin(total)
