"""The narrow search table and the queries it answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.functions.text import has_email, is_prospect_email, normalize_name, starts_with
from civitas.functions.values import row_hash
from civitas.operators.joins import lookup
from civitas.plans.rollups import ACTIVE, HEAD_OFFICE

SEARCH_READS = (
    "cnpj_completo",
    "cnpj_basico",
    "nome_fantasia",
    "cod_regiao_ibge",
    "cod_estado_ibge",
    "cod_cidade_ibge",
    "cod_cnae_principal",
    "cod_situacao_cadastral",
    "matriz_filial",
    "data_inicio_atividade",
    "cep",
    "ddd_telefone_1",
    "ddd_telefone_2",
    "bairro",
)

# The fields a row is considered changed by, in hashing order.
HASHED = (
    "razao_social",
    "nome_fantasia",
    "cod_cnae_principal",
    "cod_situacao_cadastral",
    "cod_cidade_ibge",
    "cod_porte",
    "cod_natureza_juridica",
    "data_inicio_atividade",
    "cep",
    "matriz_filial",
)

PAGE_SIZE = 51


def build_search_table(
    est: DataFrame, companies: DataFrame, hot_roots: tuple[str, ...] | list[str] = ()
) -> DataFrame:
    """One row per establishment with normalised names and a row hash.

    ``hot_roots`` (see :func:`civitas.operators.joins.hot_keys`) names companies
    whose establishments must not all meet in one task; without it adaptive
    execution splits such a partition when it sees one.
    """
    owner = companies.select("cnpj_basico", "razao_social", "cod_porte", "cod_natureza_juridica")
    joined = lookup(
        est.select(*SEARCH_READS), owner, "cnpj_basico", F.col("cnpj_completo"), list(hot_roots)
    )
    return joined.select(
        "cnpj_completo",
        "cnpj_basico",
        normalize_name(F.col("razao_social")).alias("razao_social_norm"),
        normalize_name(F.col("nome_fantasia")).alias("nome_fantasia_norm"),
        "cod_regiao_ibge",
        "cod_estado_ibge",
        "cod_cidade_ibge",
        "cod_cnae_principal",
        "cod_situacao_cadastral",
        "matriz_filial",
        "cod_porte",
        "cod_natureza_juridica",
        "data_inicio_atividade",
        "cep",
        "ddd_telefone_1",
        "ddd_telefone_2",
        normalize_name(F.col("bairro")).alias("bairro_norm"),
        row_hash([F.col(c) for c in HASHED]).alias("row_hash"),
    )


def by_name_prefix(
    busca: DataFrame,
    term: str,
    status: str | None = None,
    column: str = "razao_social_norm",
    limit: int | None = 20,
) -> DataFrame:
    """Names starting with ``term``, in name order.

    Written sorted by the name (``sinks.write_table(sort_by=...)``), the pushed
    prefix filter skips every file outside the prefix.
    """
    found = busca.filter(starts_with(F.col(column), term))
    if status:
        found = found.filter(F.col("cod_situacao_cadastral") == status)
    ordered = found.orderBy(column, "cnpj_completo")
    return ordered.limit(limit) if limit else ordered


def count_name_prefix(
    busca: DataFrame, term: str, column: str = "razao_social_norm"
) -> DataFrame:
    return busca.filter(starts_with(F.col(column), term)).agg(F.count("*").alias("total"))


def by_name_substring(
    busca: DataFrame, term: str, column: str = "razao_social_norm"
) -> DataFrame:
    return busca.filter(F.col(column).contains(term))


def city_activity_page(
    busca: DataFrame, city: int, cnae: str, offset: int = 0, size: int = PAGE_SIZE
) -> DataFrame:
    """One page of the active establishments of an activity in a city, by id."""
    return (
        busca.filter(
            (F.col("cod_cidade_ibge") == city)
            & (F.col("cod_cnae_principal") == cnae)
            & (F.col("cod_situacao_cadastral") == ACTIVE)
        )
        .orderBy("cnpj_completo")
        .offset(offset)
        .limit(size)
    )


def keyset_page(
    est: DataFrame,
    geo: str,
    value: int,
    after: str = "",
    status: str | None = None,
    size: int = PAGE_SIZE,
) -> DataFrame:
    """The page after an id inside a city, state or region; costs no offset."""
    found = est.filter((F.col(geo) == value) & (F.col("cnpj_completo") > after))
    if status:
        found = found.filter(F.col("cod_situacao_cadastral") == status)
    return found.orderBy("cnpj_completo").limit(size)


def by_area_code(busca: DataFrame, ddd: str) -> DataFrame:
    """Area code of either phone."""
    return busca.filter((F.col("ddd_telefone_1") == ddd) | (F.col("ddd_telefone_2") == ddd))


def search(
    busca: DataFrame,
    *,
    state: int | None = None,
    city: int | None = None,
    cnae: str | None = None,
    status: str | None = None,
    kind: str | None = None,
    opened_from: dt.date | None = None,
    opened_to: dt.date | None = None,
    porte: str | None = None,
    district: str | None = None,
    cep: str | None = None,
    capital: tuple | None = None,
    companies: DataFrame | None = None,
    simples: bool | None = None,
    mei: bool | None = None,
    regimes: DataFrame | None = None,
) -> DataFrame:
    """All given conditions together.

    A capital range reads ``companies`` and a regime ``regimes``; both only
    restrict, so they are semi joins on the company root.
    """
    equal = {
        "cod_estado_ibge": state,
        "cod_cidade_ibge": city,
        "cod_cnae_principal": cnae,
        "cod_situacao_cadastral": status,
        "matriz_filial": kind,
        "cod_porte": porte,
        "cep": cep,
    }
    out = busca
    for column, value in equal.items():
        if value is not None:
            out = out.filter(F.col(column) == value)
    if opened_from is not None:
        out = out.filter(F.col("data_inicio_atividade") >= F.lit(opened_from))
    if opened_to is not None:
        out = out.filter(F.col("data_inicio_atividade") <= F.lit(opened_to))
    if district is not None:
        out = out.filter(F.col("bairro_norm").contains(normalize_name(F.lit(district))))
    if capital is not None:
        low, high = capital
        rich = companies
        if low is not None:
            rich = rich.filter(F.col("capital_social") >= low)
        if high is not None:
            rich = rich.filter(F.col("capital_social") <= high)
        out = out.join(rich.select("cnpj_basico"), "cnpj_basico", "left_semi")
    for flag, wanted in (("opcao_simples", simples), ("opcao_mei", mei)):
        if wanted is not None:
            chosen = regimes.filter(F.col(flag) == "S").select("cnpj_basico")
            out = out.join(chosen, "cnpj_basico", "left_semi" if wanted else "left_anti")
    return out


def leads(
    est: DataFrame, cnae: str | None = None, status: str = ACTIVE, city: int | None = None
) -> DataFrame:
    """Establishments with an address to write to.

    By activity any address counts; by city accounting offices are left out.
    """
    out = est.filter(F.col("cod_situacao_cadastral") == status)
    if cnae is not None:
        out = out.filter(F.col("cod_cnae_principal") == cnae)
    if city is not None:
        return out.filter((F.col("cod_cidade_ibge") == city) & is_prospect_email(F.col("email")))
    return out.filter(has_email(F.col("email")))


def state_head_offices(est: DataFrame, state: int) -> DataFrame:
    """Head offices of a state in root order."""
    return (
        est.filter((F.col("cod_estado_ibge") == state) & (F.col("matriz_filial") == HEAD_OFFICE))
        .select("cnpj_basico", "cnpj_completo")
        .orderBy("cnpj_basico", "cnpj_completo")
    )


def state_activities(est: DataFrame, state: int, min_count: int = 1) -> DataFrame:
    """Activities of a state with at least ``min_count`` establishments."""
    return (
        est.filter(F.col("cod_estado_ibge") == state)
        .groupBy("cod_cnae_principal")
        .agg(F.count("*").alias("total"))
        .filter(F.col("total") >= min_count)
    )


def city_activities(est: DataFrame, state: int) -> DataFrame:
    """Establishments per city and activity of a state."""
    return (
        est.filter(F.col("cod_estado_ibge") == state)
        .groupBy("cod_cidade_ibge", "cod_cnae_principal")
        .agg(F.count("*").alias("total"))
    )


def by_secondary_activity(
    secondary: DataFrame,
    cnae: str,
    state: int | None = None,
    city: int | None = None,
    region: int | None = None,
) -> DataFrame:
    """Establishments with a secondary activity, optionally inside a territory."""
    out = secondary.filter(F.col("cod_cnae") == cnae)
    places = {"cod_estado_ibge": state, "cod_cidade_ibge": city, "cod_regiao_ibge": region}
    for column, value in places.items():
        if value is not None:
            out = out.filter(F.col(column) == value)
    return out
