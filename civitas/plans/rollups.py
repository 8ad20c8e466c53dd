"""Shared pre-aggregations the views are derived from.

At full size the establishment table is scanned a few times at most: each
rollup collapses it once, map side first, to a table whose size follows
geography, activities and companies.  A company that owns a third of all rows
shrinks to one row per place and status before anything is joined on its key,
so no join ever gathers the raw rows of one key.

``build_views`` writes each rollup once and reads it back for every view; a
single view asked for alone simply composes the rollup into its own plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.functions.text import has_email, is_prospect_email
from civitas.plans.anchor import month_of, window_end, window_starts

ACTIVE, CLOSED = "02", "08"
HEAD_OFFICE, BRANCH = "1", "2"

# Fixed value: month the published series start at.
SERIES_FLOOR = dt.date(2000, 1, 1)


def is_active() -> Column:
    return F.col("cod_situacao_cadastral") == ACTIVE


def is_head_office() -> Column:
    return F.col("matriz_filial") == HEAD_OFFICE


def new_counts(anchor: dt.date, only: tuple[str, ...] | None = None) -> list[Column]:
    """Openings inside each window, whatever became of them."""
    opened, end = F.col("data_inicio_atividade"), window_end(anchor)
    return [
        F.count_if((opened >= F.lit(start)) & (opened < F.lit(end))).alias(name)
        for name, start in window_starts(anchor).items()
        if only is None or name in only
    ]


STOCK_KEYS = (
    "cod_cnae_principal",
    "cod_cidade_ibge",
    "cod_estado_ibge",
    "cod_regiao_ibge",
    "cod_situacao_cadastral",
)
STOCK_READS = STOCK_KEYS + ("matriz_filial", "email", "telefone_1", "data_inicio_atividade")


def stock_by_activity_place(est: DataFrame, anchor: dt.date) -> DataFrame:
    """Counts per activity, place and status."""
    return est.groupBy(*STOCK_KEYS).agg(
        F.count("*").alias("total"),
        F.count_if(is_head_office()).alias("matrizes"),
        F.count_if(has_email(F.col("email"))).alias("com_email"),
        F.count_if(F.col("telefone_1").isNotNull()).alias("com_telefone"),
        F.count_if(is_prospect_email(F.col("email"))).alias("email_prospeccao"),
        *new_counts(anchor),
    )


ROOT_PLACE_KEYS = (
    "cnpj_basico",
    "cod_cidade_ibge",
    "cod_estado_ibge",
    "cod_regiao_ibge",
    "cod_situacao_cadastral",
)
ROOT_PLACE_READS = ROOT_PLACE_KEYS + ("matriz_filial", "email")


def stock_by_root_place(est: DataFrame) -> DataFrame:
    """Counts per company, place and status: what is joined to the company."""
    return est.groupBy(*ROOT_PLACE_KEYS).agg(
        F.count("*").alias("total"),
        F.count_if(is_head_office()).alias("matrizes"),
        F.count_if(has_email(F.col("email"))).alias("com_email"),
    )


HEADS_KEYS = ("cnpj_basico", "cod_estado_ibge", "cod_cidade_ibge", "cod_cnae_principal")
HEADS_READS = HEADS_KEYS + ("matriz_filial", "cod_situacao_cadastral")


def head_offices_by_root(est: DataFrame, keys: tuple[str, ...] = HEADS_KEYS) -> DataFrame:
    """Head offices per company and ``keys``; ``ativo`` is 1 when any is active."""
    return (
        est.filter(is_head_office())
        .groupBy(*keys)
        .agg(F.max(F.coalesce(is_active(), F.lit(False)).cast("int")).alias("ativo"))
    )


MOVEMENT_READS = ("data_inicio_atividade", "data_situacao_cadastral", "cod_situacao_cadastral")


def movements(est: DataFrame, floor: dt.date = SERIES_FLOOR) -> DataFrame:
    """Each establishment as its opening and, when closed, its closing.

    One scan feeds both sides: a row becomes up to two dated movements instead
    of the table being read once per side.  The date floor stays a plain filter
    in front so that it is pushed to the scan.
    """
    start = F.lit(floor)
    # NULL dates make these NULL, which both the filter and WHEN take as no
    opens = F.col("data_inicio_atividade") >= start
    closes = (F.col("cod_situacao_cadastral") == CLOSED) & (
        F.col("data_situacao_cadastral") >= start
    )

    def movement(happened: Column, day: str, opening: int, still_active: Column, closing: int):
        return F.when(
            happened,
            F.struct(
                month_of(F.col(day)).alias("mes_abertura"),
                F.lit(opening).cast("bigint").alias("abertura"),
                still_active.cast("bigint").alias("ainda_ativo"),
                F.lit(closing).cast("bigint").alias("baixa"),
            ),
        )

    active = F.coalesce(is_active(), F.lit(False))
    pair = F.array(
        movement(opens, "data_inicio_atividade", 1, active, 0),
        movement(closes, "data_situacao_cadastral", 0, F.lit(0), 1),
    )
    kept = [c for c in est.columns if c not in MOVEMENT_READS]
    return (
        est.filter(opens | closes)
        .select(*kept, F.explode(F.array_compact(pair)).alias("m"))
        .select(*kept, "m.*")
    )


ROOT_MOVEMENT_READS = ("cnpj_basico", "cod_estado_ibge", "cod_regiao_ibge") + MOVEMENT_READS


def movements_by_root(est: DataFrame, floor: dt.date = SERIES_FLOOR) -> DataFrame:
    """Monthly movements per company and state: what is joined to the company."""
    return (
        movements(est, floor)
        .groupBy("cnpj_basico", "mes_abertura", "cod_estado_ibge")
        .agg(
            F.max("cod_regiao_ibge").alias("cod_regiao_ibge"),
            F.sum("abertura").alias("abertura"),
            F.sum("ainda_ativo").alias("ainda_ativo"),
            F.sum("baixa").alias("baixa"),
        )
    )
