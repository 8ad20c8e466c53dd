"""Views of the current stock: by territory, activity, legal form, size, regime.

Names are joined after aggregating: a code determines its name, so the join
handles one row per group instead of one per establishment.  Joins carry no
hints; Spark picks broadcast or shuffle from the sizes it measures.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civitas.plans import distinct
from civitas.plans.anchor import NEW_WINDOWS
from civitas.plans.rollups import (
    BRANCH,
    is_active,
    is_head_office,
    new_counts,
)

# Fixed value: active establishments an activity needs to be ranked in a city.
RANKED_MINIMUM = 5


def _territory_counts(est: DataFrame, keys: list[str], anchor: dt.date, *extra) -> DataFrame:
    """Counts of one territory level with exact distinct companies.

    The distinct count spreads the shuffle over (territory, company), so a
    state with a third of all rows does not land in one task.
    """
    return est.groupBy(*keys).agg(
        F.count_distinct("cnpj_basico").alias("total_empresas"), *_counts(anchor), *extra
    )


COUNTED = (
    "total_estabelecimentos", "ativos", "matrizes_ativas", "filiais_ativas", *NEW_WINDOWS
)


def _counts(anchor: dt.date) -> list:
    """The counts of a territory that add up."""
    return [
        F.count("*").alias("total_estabelecimentos"),
        F.count_if(is_active()).alias("ativos"),
        F.count_if(is_active() & is_head_office()).alias("matrizes_ativas"),
        F.count_if(is_active() & (F.col("matriz_filial") == BRANCH)).alias("filiais_ativas"),
        *new_counts(anchor),
    ]


def stats_estado(
    est: DataFrame, states: DataFrame, anchor: dt.date, by_bitmaps: bool = False
) -> DataFrame:
    """``by_bitmaps``: companies as merged bitmaps, for a base sorted by root."""
    keys, located = ["cod_estado_ibge"], est.filter(F.col("cod_estado_ibge").isNotNull())
    if by_bitmaps:
        counts = distinct.companies_in(
            distinct.company_bitmaps(located, keys, *_counts(anchor)), keys, *_sums(*COUNTED)
        )
    else:
        counts = _territory_counts(located, keys, anchor)
    return named_states(counts, states, anchor)


def named_states(counts: DataFrame, states: DataFrame, anchor: dt.date) -> DataFrame:
    names = states.select("cod_estado_ibge", "sigla_uf", "nome_estado", "cod_regiao_ibge")
    return counts.join(names, "cod_estado_ibge").withColumn("mes_ancora", F.lit(anchor))


def stats_municipio(
    est: DataFrame, cities: DataFrame, states: DataFrame, anchor: dt.date
) -> DataFrame:
    keys = ["cod_cidade_ibge", "cod_estado_ibge"]
    opened = F.col("data_inicio_atividade")
    located = est.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    counts = _territory_counts(
        located,
        keys,
        anchor,
        F.min(opened).alias("primeira_abertura"),
        F.max(opened).alias("ultima_abertura"),
    )
    return named_cities(counts, cities, states, anchor)


def named_cities(
    counts: DataFrame, cities: DataFrame, states: DataFrame, anchor: dt.date
) -> DataFrame:
    return (
        counts.join(cities.select("cod_cidade_ibge", "nome_cidade"), "cod_cidade_ibge")
        .join(states.select("cod_estado_ibge", "sigla_uf", "cod_regiao_ibge"), "cod_estado_ibge")
        .withColumn("mes_ancora", F.lit(anchor))
    )


def _sums(*names: str):
    return [F.sum(n).alias(n) for n in names]


def _active_sum():
    return F.sum(F.when(is_active(), F.col("total")).otherwise(0)).alias("ativos")


def stats_cnae(stock: DataFrame, activities: DataFrame, anchor: dt.date) -> DataFrame:
    """Both distinct counts run over the small stock rollup, not over the base."""
    counts = stock.groupBy("cod_cnae_principal").agg(
        F.sum("total").alias("total_estabelecimentos"),
        _active_sum(),
        F.count_distinct("cod_estado_ibge").alias("estados_presentes"),
        F.count_distinct("cod_cidade_ibge").alias("cidades_presentes"),
        *_sums("matrizes", "com_email", "com_telefone", *NEW_WINDOWS),
    )
    names = activities.select(F.col("cod_cnae").alias("cod_cnae_principal"), "nome_cnae")
    return counts.join(names, "cod_cnae_principal", "left").withColumn("mes_ancora", F.lit(anchor))


def stats_cnae_estado(stock: DataFrame) -> DataFrame:
    return stock.groupBy("cod_cnae_principal", "cod_estado_ibge").agg(
        *_sums("total"), _active_sum(), *_sums("com_email", "matrizes")
    )


def top_cnaes_cidade(
    stock: DataFrame, activities: DataFrame, cities: DataFrame, anchor: dt.date
) -> DataFrame:
    """Activities of each city by active establishments; ties go to the lower code."""
    counts = (
        stock.groupBy("cod_cidade_ibge", "cod_cnae_principal")
        .agg(*_sums("total"), _active_sum(), *_sums("novos_1mes", "novos_6meses", "novos_1ano"))
        .filter(F.col("ativos") >= RANKED_MINIMUM)
        .join(
            activities.select(F.col("cod_cnae").alias("cod_cnae_principal"), "nome_cnae"),
            "cod_cnae_principal",
        )
        .join(cities.select("cod_cidade_ibge", "cod_estado_ibge"), "cod_cidade_ibge")
    )
    by_size = Window.partitionBy("cod_cidade_ibge").orderBy(
        F.desc("ativos"), F.asc("cod_cnae_principal")
    )
    return counts.select(
        "cod_cidade_ibge",
        "cod_cnae_principal",
        "nome_cnae",
        "cod_estado_ibge",
        "total",
        "ativos",
        "novos_1mes",
        "novos_6meses",
        "novos_1ano",
        F.lit(anchor).alias("mes_ancora"),
        F.row_number().over(by_size).cast("bigint").alias("ranking"),
    )


_PLACE_STATUS = (
    "cod_cidade_ibge",
    "cod_estado_ibge",
    "cod_regiao_ibge",
    "cod_situacao_cadastral",
)


def stats_cidade_situacao(stock: DataFrame) -> DataFrame:
    return stock.groupBy(*_PLACE_STATUS).agg(
        *_sums("total", "matrizes", "com_email", "com_telefone", "email_prospeccao")
    )


def regime_tributario_cidade(
    by_root: DataFrame, companies: DataFrame, simples: DataFrame
) -> DataFrame:
    """Tax regime counts; a company missing from ``simples`` counts as neither.

    The regime is attached to the company first (both sides unique per key),
    then to the per-company rollup, so all three meet on one partitioning.
    """
    yes = F.lit("S")
    in_simples = F.coalesce(F.col("opcao_simples") == yes, F.lit(False))
    in_mei = F.coalesce(F.col("opcao_mei") == yes, F.lit(False))
    regimes = companies.select("cnpj_basico").join(
        simples.select("cnpj_basico", "opcao_simples", "opcao_mei"), "cnpj_basico"
    )

    def counted(condition, name):
        return F.sum(F.when(condition, F.col("total")).otherwise(0)).alias(name)

    return (
        by_root.join(regimes, "cnpj_basico", "left")
        .groupBy(*_PLACE_STATUS)
        .agg(
            F.sum("total").alias("total"),
            counted(in_simples, "simples_nacional"),
            counted(in_mei, "mei"),
            counted(in_simples | in_mei, "simples_ou_mei"),
            counted(~in_simples & ~in_mei, "lucro_presumido_real"),
        )
    )


def porte_cidade(by_root: DataFrame, companies: DataFrame) -> DataFrame:
    sized = by_root.join(companies.select("cnpj_basico", "cod_porte"), "cnpj_basico")
    return sized.groupBy(*_PLACE_STATUS, "cod_porte").agg(
        *_sums("total", "matrizes", "com_email")
    )


def _companies_per(heads: DataFrame, companies: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct companies (and active ones) per legal form and ``keys``.

    After the join the rows already sit by company, so the per-company level
    needs no further exchange, and counting its rows is the distinct count.
    """
    forms = companies.select("cnpj_basico", F.col("cod_natureza_juridica").alias("cod_natureza"))
    per_company = (
        heads.join(forms, "cnpj_basico")
        .groupBy("cod_natureza", *keys, "cnpj_basico")
        .agg(F.max("ativo").alias("ativo"))
    )
    return per_company.groupBy("cod_natureza", *keys).agg(
        F.count("*").alias("total"), F.sum("ativo").alias("ativos")
    )


def natureza_estado(
    heads: DataFrame, companies: DataFrame, forms: DataFrame, states: DataFrame
) -> DataFrame:
    counts = _companies_per(
        heads.filter(F.col("cod_estado_ibge").isNotNull()), companies, ["cod_estado_ibge"]
    )
    regions = states.select("cod_estado_ibge", "cod_regiao_ibge")
    return (
        counts.join(forms.select("cod_natureza"), "cod_natureza", "left_semi")
        .join(regions, "cod_estado_ibge", "left")
        .select("cod_natureza", "cod_regiao_ibge", "cod_estado_ibge", "total", "ativos")
    )


def natureza_municipio(heads: DataFrame, companies: DataFrame, forms: DataFrame) -> DataFrame:
    counts = _companies_per(
        heads.filter(F.col("cod_cidade_ibge").isNotNull()),
        companies,
        ["cod_estado_ibge", "cod_cidade_ibge"],
    )
    return counts.join(forms.select("cod_natureza"), "cod_natureza", "left_semi")


def natureza_nacional(heads: DataFrame, companies: DataFrame, forms: DataFrame) -> DataFrame:
    """Every legal form, with zeros for those without a company."""
    active_roots = heads.filter("ativo = 1").select("cnpj_basico", "ativo").distinct()
    per_company = (
        companies.select("cnpj_basico", F.col("cod_natureza_juridica").alias("cod_natureza"))
        .join(active_roots, "cnpj_basico", "left")
        .groupBy("cod_natureza", "cnpj_basico")
        .agg(F.max(F.coalesce("ativo", F.lit(0))).alias("ativo"))
    )
    counts = per_company.groupBy("cod_natureza").agg(
        F.count("*").alias("total"), F.sum("ativo").alias("ativos")
    )
    zero = F.lit(0).cast("bigint")
    return (
        forms.select("cod_natureza", "nome_natureza")
        .join(counts, "cod_natureza", "left")
        .select(
            "cod_natureza",
            "nome_natureza",
            F.coalesce("total", zero).alias("total"),
            F.coalesce("ativos", zero).alias("ativos"),
        )
    )


def natureza_cnae(heads: DataFrame, companies: DataFrame, activities: DataFrame) -> DataFrame:
    active = heads.filter("ativo = 1").withColumnRenamed("cod_cnae_principal", "cod_cnae")
    counts = _companies_per(active, companies, ["cod_cnae"]).drop("ativos")
    return counts.join(activities.select("cod_cnae"), "cod_cnae", "left_semi").select(
        "cod_natureza", "cod_cnae", "total"
    )


