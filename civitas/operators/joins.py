"""Row-level lookup of a unique side, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the rows, so there can
# never be more than 1 / HOT_SHARE hot keys whatever the size of the table.
HOT_SHARE = 0.001


def hot_keys(
    fact: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = 1_000_000
) -> list:
    """Keys holding more than ``share`` of all rows; at most ``1 / share`` of them.

    A key of fewer than ``min_rows`` rows fits a task whatever its share.

    One narrow aggregate over the key column, combined map side.  The short
    list is fixed here once, so that both sides of a join agree on it even when
    a lost executor makes Spark compute either side again.
    """
    counts = fact.groupBy(key).agg(F.count("*").alias("n"))
    limit = max(min_rows, int(fact.count() * share))
    found = counts.filter((F.col("n") >= limit) & F.col(key).isNotNull())
    return [r[0] for r in found.select(key).collect()]


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread: Column,
    hot: list,
    how: str = "left",
    salts: int = 64,
) -> DataFrame:
    """Join ``fact`` to ``dim`` (unique per ``key``), hot keys split over ``salts``.

    Rows of a hot key are dealt out by ``spread``, a value that never changes
    on recomputation (an id, not a random number); only the few matching rows
    of ``dim`` are repeated, one per salt.
    """
    if not hot:
        return fact.join(dim, key, how)
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False))
    salted_fact = fact.withColumn(
        "_salt", F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(salts))).otherwise(0).cast("int")
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_dim = dim.withColumn("_salt", F.explode(copies))
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")
