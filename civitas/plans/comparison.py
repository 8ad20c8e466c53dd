"""Equivalent periods compared, read from the monthly series.

The ten windows of the five periods are conditional sums of one aggregate, so
no row is multiplied by the number of periods before a shuffle; the levels are
grouping sets over that already small aggregate, and only the final rows are
unfolded into one per period.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.functions.indicators import survival_pct, variation_pct
from civitas.plans.anchor import PERIOD_SIZES, month_add, periods

# Level names in the order of their geographic column.
LEVELS = {
    "regiao": "cod_regiao_ibge",
    "estado": "cod_estado_ibge",
    "municipio": "cod_cidade_ibge",
}
COUNTRY = "brasil"
NOT_APPLICABLE = 0

_MEASURES = ("aberturas", "ainda_ativos", "baixas")


def _window_sums(anchor: dt.date) -> list[Column]:
    month, sums = F.col("mes_abertura"), []
    for p in periods(anchor):
        inside = {
            "atual": month >= F.lit(p.current_start),
            "anterior": (month >= F.lit(p.previous_start)) & (month <= F.lit(p.previous_end)),
        }
        for when, condition in inside.items():
            for m in _MEASURES:
                sums.append(
                    F.sum(F.when(condition, F.col(m)).otherwise(0)).alias(f"{m}_{when}_{p.size}")
                )
    return sums


def _per_period(anchor: dt.date) -> Column:
    """Array with one struct of measures and bounds per period."""
    rows = []
    for p in periods(anchor):
        rows.append(
            F.struct(
                F.lit(p.size).cast("smallint").alias("periodo_meses"),
                F.lit(p.current_start).alias("periodo_atual_inicio"),
                F.lit(p.current_end).alias("periodo_atual_fim"),
                F.lit(p.previous_start).alias("periodo_anterior_inicio"),
                F.lit(p.previous_end).alias("periodo_anterior_fim"),
                *[
                    F.col(f"{m}_{when}_{p.size}").alias(f"{m}_{when}")
                    for m in _MEASURES
                    for when in ("atual", "anterior")
                ],
            )
        )
    return F.array(*rows)


def compare(
    series: DataFrame,
    anchor: dt.date,
    entity: tuple[str, ...] = (),
    levels: tuple[str, ...] = tuple(LEVELS),
    openings: str = "aberturas",
) -> DataFrame:
    """One row per entity, level, territory and period.

    Only the column of the row's own level holds a code, the others hold 0.
    Which level a row belongs to comes from the grouping marker, so a NULL
    territory in the data is never mistaken for an aggregated-away one.
    """
    reach = month_add(anchor, 1 - 2 * max(PERIOD_SIZES))
    geo = [LEVELS[level] for level in levels]
    base = (
        series.filter(F.col("mes_abertura").between(F.lit(reach), F.lit(anchor)))
        .withColumnRenamed(openings, "aberturas")
        .groupBy(*entity, *geo)
        .agg(*_window_sums(anchor))
    )
    sums = [c for c in base.columns if c not in (*entity, *geo)]
    sets = [[*entity]] + [[*entity, g] for g in geo]
    grouped = base.groupingSets(
        [[F.col(c) for c in one] for one in sets], *[F.col(c) for c in (*entity, *geo)]
    ).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[(F.grouping(g) == 0).alias(f"at_{level}") for level, g in zip(levels, geo)],
    )
    level = F.lit(COUNTRY)
    known = F.lit(True)
    for name, g in zip(levels, geo):
        level = F.when(F.col(f"at_{name}"), F.lit(name)).otherwise(level)
        known = known & (~F.col(f"at_{name}") | F.col(g).isNotNull())

    def code(name: str) -> Column:
        if name not in levels:
            return F.lit(NOT_APPLICABLE).alias(LEVELS[name])
        g = LEVELS[name]
        return F.when(F.col(f"at_{name}"), F.col(g)).otherwise(NOT_APPLICABLE).alias(g)

    unfolded = grouped.filter(known).select(
        *entity,
        level.alias("nivel"),
        *[code(name) for name in LEVELS],
        F.lit(anchor).alias("mes_ancora"),
        F.inline(_per_period(anchor)),
    )
    return _with_indicators(unfolded, entity)


def _with_indicators(rows: DataFrame, entity: tuple[str, ...]) -> DataFrame:
    c = F.col
    now = survival_pct(c("ainda_ativos_atual"), c("aberturas_atual"))
    before = survival_pct(c("ainda_ativos_anterior"), c("aberturas_anterior"))
    opened, opened_before = c("aberturas_atual"), c("aberturas_anterior")
    closed, closed_before = c("baixas_atual"), c("baixas_anterior")
    return rows.select(
        *entity,
        "nivel",
        *LEVELS.values(),
        "periodo_meses",
        "mes_ancora",
        "periodo_atual_inicio",
        "periodo_atual_fim",
        "periodo_anterior_inicio",
        "periodo_anterior_fim",
        opened,
        opened_before,
        (opened - opened_before).alias("aberturas_variacao_abs"),
        variation_pct(opened, opened_before).alias("aberturas_variacao_pct"),
        "ainda_ativos_atual",
        "ainda_ativos_anterior",
        now.alias("sobrevivencia_atual_pct"),
        before.alias("sobrevivencia_anterior_pct"),
        (now - before).cast("decimal(6,2)").alias("sobrevivencia_delta_pp"),
        closed,
        closed_before,
        (closed - closed_before).alias("baixas_variacao_abs"),
        variation_pct(closed, closed_before).alias("baixas_variacao_pct"),
        (opened - closed).alias("saldo_atual"),
        (opened_before - closed_before).alias("saldo_anterior"),
    )


def comparativo_territorio(series: DataFrame, anchor: dt.date) -> DataFrame:
    return compare(series, anchor, openings="total_aberturas")


def comparativo_cnae(series: DataFrame, anchor: dt.date) -> DataFrame:
    return compare(series, anchor, ("cod_cnae_principal",), ("regiao", "estado"))


def comparativo_natureza(series: DataFrame, anchor: dt.date) -> DataFrame:
    return compare(series, anchor, ("cod_natureza",), ("regiao", "estado"))
