"""Monthly openings, closings and balance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.plans.rollups import SERIES_FLOOR, movements


def _series(moves: DataFrame, keys: list[str], opening_name: str, anchor: dt.date, *extra):
    """Sum movements per month and ``keys`` and close with balance and markers."""
    totals = moves.groupBy("mes_abertura", *keys).agg(
        F.max("cod_regiao_ibge").alias("cod_regiao_ibge"),
        F.sum("abertura").alias(opening_name),
        *extra,
        F.sum("ainda_ativo").alias("ainda_ativos"),
        F.sum("baixa").alias("baixas"),
    )
    return totals.withColumns(
        {
            "saldo": F.col(opening_name) - F.col("baixas"),
            "mes_ancora": F.lit(anchor),
            "mes_parcial": F.col("mes_abertura") > F.lit(anchor),
        }
    )


def abertura_periodo(est: DataFrame, anchor: dt.date, floor: dt.date = SERIES_FLOOR) -> DataFrame:
    """Month x city x state, with the distinct companies among the openings.

    ``empresas_unicas`` is distinct inside one city and month; summing it over
    cities counts a company once per city.
    """
    opened_by = F.when(F.col("abertura") == 1, F.col("cnpj_basico"))
    return _series(
        movements(est, floor),
        ["cod_cidade_ibge", "cod_estado_ibge"],
        "total_aberturas",
        anchor,
        F.count_distinct(opened_by).alias("empresas_unicas"),
    )


def movimentacao_cnae(est: DataFrame, anchor: dt.date, floor: dt.date = SERIES_FLOOR) -> DataFrame:
    return _series(
        movements(est, floor), ["cod_cnae_principal", "cod_estado_ibge"], "aberturas", anchor
    )


def _by_company_trait(root_moves, companies, trait, name, anchor):
    traits = companies.select("cnpj_basico", F.col(trait).alias(name))
    return _series(
        root_moves.join(traits, "cnpj_basico"), [name, "cod_estado_ibge"], "aberturas", anchor
    )


def movimentacao_natureza(
    root_moves: DataFrame, companies: DataFrame, anchor: dt.date
) -> DataFrame:
    return _by_company_trait(
        root_moves, companies, "cod_natureza_juridica", "cod_natureza", anchor
    )


def movimentacao_porte(root_moves: DataFrame, companies: DataFrame, anchor: dt.date) -> DataFrame:
    """By the size the company has now, not the one it had then; may be NULL."""
    return _by_company_trait(root_moves, companies, "cod_porte", "cod_porte", anchor)
