"""The documented consumer queries over tables and views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.functions.indicators import ratio_pct
from civitas.functions.text import ESTABLISHMENT_KINDS, PARTNER_KINDS, contains, label_codes
from civitas.plans.rollups import is_active


def by_full_id(
    est: DataFrame, companies: DataFrame, cities: DataFrame, full_id: str
) -> DataFrame:
    """An establishment with its company and, where known, its city."""
    return (
        est.filter(F.col("cnpj_completo") == full_id)
        .join(companies.select("cnpj_basico", "razao_social"), "cnpj_basico")
        .join(cities.select("cod_cidade_ibge", "nome_cidade"), "cod_cidade_ibge", "left")
        .select("cnpj_completo", "razao_social", "nome_fantasia", "uf", "nome_cidade")
    )


def by_root(est: DataFrame, companies: DataFrame, root: str) -> DataFrame:
    """Establishments of a company with their kind.

    The root is filtered on both sides: one company row meets its
    establishments, and both scans skip everything else.
    """
    mine = companies.filter(F.col("cnpj_basico") == root).select("cnpj_basico", "razao_social")
    return (
        est.filter(F.col("cnpj_basico") == root)
        .join(mine, "cnpj_basico")
        .select(
            "cnpj_completo",
            "razao_social",
            label_codes(F.col("matriz_filial"), ESTABLISHMENT_KINDS).alias("tipo"),
        )
    )


def partners_of(partners: DataFrame, qualifications: DataFrame, root: str) -> DataFrame:
    return (
        partners.filter(F.col("cnpj_basico") == root)
        .join(
            qualifications.withColumnRenamed("cod_qualificacao", "cod_qualificacao_socio"),
            "cod_qualificacao_socio",
        )
        .select(
            "nome_socio",
            F.col("nome_qualificacao").alias("qualificacao"),
            "data_entrada_sociedade",
            label_codes(F.col("identificador_socio"), PARTNER_KINDS).alias("tipo_socio"),
        )
        .orderBy("data_entrada_sociedade", "nome_socio")
    )


def per_state(est: DataFrame, states: DataFrame) -> DataFrame:
    counts = est.groupBy("cod_estado_ibge").agg(
        F.count("*").alias("total_estabelecimentos"), F.count_if(is_active()).alias("ativos")
    )
    return (
        counts.join(states, "cod_estado_ibge")
        .select("sigla_uf", "nome_estado", "total_estabelecimentos", "ativos")
        .orderBy(F.desc("total_estabelecimentos"), "sigla_uf")
    )


def per_city_geo(
    est: DataFrame, cities: DataFrame, states: DataFrame, limit: int = 20
) -> DataFrame:
    """Active establishments per city with coordinates, largest first."""
    counts = est.filter(is_active()).groupBy("cod_cidade_ibge").agg(F.count("*").alias("total"))
    place = cities.select(
        "cod_cidade_ibge", "cod_estado_ibge", "nome_cidade", "latitude", "longitude"
    )
    return (
        counts.join(place, "cod_cidade_ibge")
        .join(states.select("cod_estado_ibge", "sigla_uf"), "cod_estado_ibge")
        .groupBy("nome_cidade", "sigla_uf", "latitude", "longitude")
        .agg(F.sum("total").alias("total"))
        .orderBy(F.desc("total"), "nome_cidade", "sigla_uf")
        .limit(limit)
    )


def per_region(est: DataFrame, regions: DataFrame) -> DataFrame:
    """Companies and establishments of each region, active only."""
    counts = (
        est.filter(is_active())
        .groupBy("cod_regiao_ibge")
        .agg(
            F.count_distinct("cnpj_basico").alias("total_empresas"),
            F.count("*").alias("total_estabelecimentos"),
        )
    )
    return (
        counts.join(regions, "cod_regiao_ibge")
        .select("nome_regiao", "total_empresas", "total_estabelecimentos")
        .orderBy(F.desc("total_empresas"), "nome_regiao")
    )


def secondary_of(secondary: DataFrame, activities: DataFrame, full_id: str) -> DataFrame:
    return (
        secondary.filter(F.col("cnpj_completo") == full_id)
        .join(activities, "cod_cnae")
        .select("cnpj_completo", "cod_cnae", "nome_cnae")
    )


def activities_in_state(
    est: DataFrame, activities: DataFrame, state: int, limit: int = 20
) -> DataFrame:
    counts = (
        est.filter((F.col("cod_estado_ibge") == state) & is_active())
        .groupBy(F.col("cod_cnae_principal").alias("cod_cnae"))
        .agg(F.count("*").alias("total"))
    )
    return (
        counts.join(activities, "cod_cnae")
        .select("cod_cnae", "nome_cnae", "total")
        .orderBy(F.desc("total"), "cod_cnae")
        .limit(limit)
    )


# -- over the views ----------------------------------------------------------


def view_state_rank(stats_estado: DataFrame) -> DataFrame:
    return stats_estado.select(
        "sigla_uf",
        "nome_estado",
        "total_estabelecimentos",
        "ativos",
        "matrizes_ativas",
        "total_empresas",
        "novos_1ano",
    ).orderBy(F.desc("total_estabelecimentos"), "sigla_uf")


def view_top_cities(stats_municipio: DataFrame, limit: int = 10) -> DataFrame:
    return (
        stats_municipio.select(
            "nome_cidade", "sigla_uf", "total_empresas", "ativos", "novos_6meses"
        )
        .orderBy(F.desc("total_empresas"), "nome_cidade", "sigla_uf")
        .limit(limit)
    )


def view_top_activities(stats_cnae: DataFrame, limit: int = 20) -> DataFrame:
    return (
        stats_cnae.select(
            "cod_cnae_principal",
            "nome_cnae",
            "total_estabelecimentos",
            "ativos",
            "estados_presentes",
        )
        .orderBy(F.desc("total_estabelecimentos"), "cod_cnae_principal")
        .limit(limit)
    )


def series_state(series: DataFrame, state: int, since: dt.date) -> DataFrame:
    """A state's months, summed over its cities."""
    names = ("total_aberturas", "empresas_unicas", "ainda_ativos")
    return (
        series.filter((F.col("cod_estado_ibge") == state) & (F.col("mes_abertura") >= F.lit(since)))
        .groupBy("mes_abertura")
        .agg(*[F.sum(n).alias(n) for n in names])
        .orderBy("mes_abertura")
    )


def series_city(series: DataFrame, city: int, since: dt.date) -> DataFrame:
    return (
        series.filter((F.col("cod_cidade_ibge") == city) & (F.col("mes_abertura") >= F.lit(since)))
        .select("mes_abertura", "total_aberturas", "empresas_unicas", "ainda_ativos")
        .orderBy("mes_abertura")
    )


def ranking_city(top_cnaes: DataFrame, city: int) -> DataFrame:
    return (
        top_cnaes.filter(F.col("cod_cidade_ibge") == city)
        .select("cod_cnae_principal", "nome_cnae", "total", "ranking")
        .orderBy("ranking")
    )


def form_rank_states(by_state: DataFrame, states: DataFrame, form: str) -> DataFrame:
    """States of one legal form with the share still active."""
    return (
        by_state.filter(F.col("cod_natureza") == form)
        .join(states.select("cod_estado_ibge", "sigla_uf", "nome_estado"), "cod_estado_ibge")
        .select(
            "sigla_uf",
            "nome_estado",
            "total",
            "ativos",
            ratio_pct(F.col("ativos"), F.col("total")).alias("taxa_atividade"),
        )
        .orderBy(F.desc("total"), "sigla_uf")
    )


def form_by_region(
    by_state: DataFrame, regions: DataFrame, form: str, only: tuple[int, ...] | None = None
) -> DataFrame:
    """One legal form summed by region, all of them or only those listed."""
    chosen = by_state.filter(F.col("cod_natureza") == form)
    if only:
        chosen = chosen.filter(F.col("cod_regiao_ibge").isin(*only))
    sums = chosen.groupBy("cod_regiao_ibge").agg(
        F.sum("total").alias("total"), F.sum("ativos").alias("ativos")
    )
    return (
        sums.join(regions, "cod_regiao_ibge")
        .select("nome_regiao", "sigla_regiao", "total", "ativos")
        .orderBy(F.desc("total"), "nome_regiao")
    )


def form_regions_in(
    by_state: DataFrame, regions: DataFrame, form: str, only: tuple[int, ...]
) -> DataFrame:
    return form_by_region(by_state, regions, form, only).select("nome_regiao", "total")


def forms_of(view: DataFrame, forms: DataFrame, column: str, code: int) -> DataFrame:
    """Legal forms of one state (H10) or one city (H11), largest first."""
    return (
        view.filter(F.col(column) == code)
        .join(forms, "cod_natureza")
        .select("nome_natureza", "total", "ativos")
        .orderBy(F.desc("total"), "nome_natureza")
    )


def top_cities_by_form(
    by_city: DataFrame, cities: DataFrame, states: DataFrame, form: str, limit: int = 10
) -> DataFrame:
    return (
        by_city.filter(F.col("cod_natureza") == form)
        .join(cities.select("cod_cidade_ibge", "nome_cidade"), "cod_cidade_ibge")
        .join(states.select("cod_estado_ibge", "sigla_uf"), "cod_estado_ibge")
        .select("nome_cidade", "sigla_uf", "total", "ativos")
        .orderBy(F.desc("total"), "nome_cidade", "sigla_uf")
        .limit(limit)
    )


def capitals_compare(by_city: DataFrame, cities: DataFrame, states: DataFrame) -> DataFrame:
    capitals = cities.filter(F.col("capital")).select("cod_cidade_ibge", "nome_cidade")
    return (
        by_city.join(capitals, "cod_cidade_ibge")
        .join(states.select("cod_estado_ibge", "sigla_uf"), "cod_estado_ibge")
        .groupBy("nome_cidade", "sigla_uf")
        .agg(F.sum("total").alias("total"), F.sum("ativos").alias("ativos"))
        .orderBy(F.desc("total"), "nome_cidade")
    )


def form_search(forms_view: DataFrame, code_part: str, name_part: str) -> DataFrame:
    """Code or name containing a text, whatever the case."""
    return forms_view.filter(
        contains(F.col("cod_natureza"), code_part, ignore_case=True)
        | contains(F.col("nome_natureza"), name_part, ignore_case=True)
    )


def form_summary(forms_view: DataFrame) -> DataFrame:
    return forms_view.agg(
        F.count("*").alias("total_naturezas"),
        F.sum("total").alias("total_empresas"),
        F.sum("ativos").alias("total_ativas"),
    )


def form_top_rate(forms_view: DataFrame, minimum: int = 1000, limit: int = 5) -> DataFrame:
    rate = ratio_pct(F.col("ativos"), F.col("total"))
    return (
        forms_view.filter(F.col("total") > minimum)
        .select("cod_natureza", "nome_natureza", "total", "ativos", rate.alias("taxa_atividade"))
        .orderBy(F.desc_nulls_first("taxa_atividade"), "cod_natureza")
        .limit(limit)
    )


def comparison_lookup(comparison: DataFrame, level: str, column: str, code: int) -> DataFrame:
    """The five periods of one territory."""
    return comparison.filter((F.col("nivel") == level) & (F.col(column) == code)).orderBy(
        "periodo_meses"
    )


def activity_growth_rank(comparison: DataFrame, level: str, months: int) -> DataFrame:
    """Entities of a level by growth; those without a previous period come last."""
    return comparison.filter(
        (F.col("nivel") == level) & (F.col("periodo_meses") == months)
    ).orderBy(F.desc_nulls_last("aberturas_variacao_pct"), "cod_cnae_principal")
