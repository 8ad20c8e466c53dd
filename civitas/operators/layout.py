"""One table laid out for predicates on any of several columns.

A table sorted by one column skips files for that column alone.  Here each
column's value becomes a rank among quantiles of a sample, the bits of the ranks
are interleaved to one number, and the table is range-partitioned by it: rows
near in every column lie in the same file, so a filter on any pair of columns
skips most files by their minimum and maximum.

Quantiles and not values are interleaved, so a value of a third of all rows
takes the ranks it has rows for and the other columns split it; rows of one
number are spread by a hash and never gather in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
SAMPLE = 20_000


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """2^bits - 1 ascending bounds per column, a frequent value several times, from
    ``sample`` rows at most.

    The rows whose hashes are lowest are the sample, so the same table always
    gets the same layout.
    """
    rows = (
        df.select(*columns, F.xxhash64(*df.columns).alias("_h")).orderBy("_h").limit(sample)
        .drop("_h").toArrow()
    )
    bounds = {}
    for name in columns:
        values = sorted(v for v in rows.column(name).to_pylist() if v is not None)
        steps = 1 << bits
        bounds[name] = [values[len(values) * n // steps] for n in range(1, steps)] if values else []
    return bounds


def rank_of(column: str, bounds: Sequence) -> Column:
    """How many bounds a value reaches, by halving; null comes with the lowest."""
    cuts = sorted(set(bounds))
    reached = [0, *[bisect_right(bounds, c) for c in cuts]]

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(reached[low])
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(cuts[middle]), search(middle + 1, high)).otherwise(
            search(low, middle)
        )

    return search(0, len(cuts))


def curve_key(bounds: dict[str, list], bits: int = BITS) -> Column:
    """The ranks' bits interleaved, the highest of every column first."""
    key = F.lit(0).cast("long")
    for at, (name, cuts) in enumerate(bounds.items()):
        rank = rank_of(name, cuts).cast("long")
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(bounds) + at))
    return key


def write_curve(
    df: DataFrame, path: str, columns: Sequence[str], files: int, bits: int = BITS
) -> None:
    """Store ``df`` under ``path`` in about so many files along the curve."""
    if not 0 < bits * len(columns) < 63:
        raise ValueError("the ranks of all columns have to fit 62 bits")
    bounds = quantile_bounds(df, columns, bits)
    key, spread = curve_key(bounds, bits), F.xxhash64(*df.columns)
    (
        df.withColumns({"_curve": key, "_spread": spread})
        .repartitionByRange(files, "_curve", "_spread")
        .sortWithinPartitions("_curve", *columns)
        .drop("_curve", "_spread")
        .write.parquet(path)
    )
