"""Exact distinct companies per territory from bitmaps that merge.

A company's root of eight digits is a number, and numbers are bits: 32,768 of
them make a bitmap of four kilobytes.  One pass builds the bitmaps of the finest
territory; coarser ones are their union, so states and regions come from the
same exchange and the base is not shuffled by company at all.  A territory has
3,052 bitmaps at most, whatever its rows.

This pays where the base is sorted by root (``sinks.write_table(sort_by=...)``)
and territories are few: a task then holds few bitmaps.  For cities on unsorted
rows the pairs of ``stock`` are smaller than four kilobytes a group, so the
views keep them there.

Roots that are no eight digits (letters, other lengths, blanks) are gathered as
sets, cut into ``OTHERS`` groups by hash so that none is large, and merge the
same way.  A null root counts as a row, not as a company.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT = "cnpj_basico"
OTHERS = 4096


def company_bitmaps(est: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    """Per key and group of roots: ``mapa``, ``outros`` and the given aggregates."""
    root = F.col(ROOT)
    digits = root.rlike("^[0-9]{8}$")
    number = F.when(digits, root).cast("bigint")
    other = F.when(~digits, root)
    # groups of other roots come below the numbers; a null root has none
    group = F.coalesce(
        F.bitmap_bucket_number(number), -1 - F.pmod(F.xxhash64(other), F.lit(OTHERS))
    )
    return (
        est.withColumns({"grupo": group, "_bit": F.bitmap_bit_position(number), "_outro": other})
        .groupBy(*keys, "grupo")
        .agg(
            F.bitmap_construct_agg("_bit").alias("mapa"),
            F.collect_set("_outro").alias("outros"),
            *counts,
        )
    )


def merged_bitmaps(maps: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    """The bitmaps of a coarser territory: unions of those of a finer one."""
    return maps.groupBy(*keys, "grupo").agg(
        F.bitmap_or_agg("mapa").alias("mapa"),
        F.array_distinct(F.flatten(F.collect_list("outros"))).alias("outros"),
        *counts,
    )


def companies_in(maps: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    """``total_empresas`` per key: bits set in its bitmaps and members of its sets."""
    found = F.bitmap_count("mapa") + F.size("outros")
    return maps.groupBy(*keys).agg(F.sum(found).cast("bigint").alias("total_empresas"), *counts)


def region_and_state(est: DataFrame) -> DataFrame:
    """Companies and establishments of each region and state, from one pass.

    ``nivel`` is ``regiao`` or ``estado``; the state of a region's row is null.
    Rows without a state belong to no territory.
    """
    keys, rows = ["cod_regiao_ibge", "cod_estado_ibge"], F.count("*").alias("total_estabelecimentos")
    total = F.sum("total_estabelecimentos").alias("total_estabelecimentos")
    states = company_bitmaps(est.dropna(subset=keys), keys, rows)
    regions = merged_bitmaps(states, keys[:1], total)
    return (
        companies_in(states, keys, total).withColumn("nivel", F.lit("estado"))
        .unionByName(
            companies_in(regions, keys[:1], total)
            .withColumns({"nivel": F.lit("regiao"), "cod_estado_ibge": F.lit(None).cast("int")})
        )
    )
