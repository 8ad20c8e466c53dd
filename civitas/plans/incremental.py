"""Views of a new generation from those of the one before and what changed.

Every measure of the views is a sum over companies, also the distinct counts: a
company adds one to a group it has a row in, whatever the others do.  So only
companies with a row that changed in ``estabelecimento``, ``empresa`` or
``simples`` matter.  Their rows of both generations are set aside once; the
ordinary view definitions run on them, and the stored view minus the old part
plus the new part is the new view.

* Companies that changed are found by comparing, per company, sums of row
  hashes over the columns that views read.
* Windows move with the anchor month, so they are not merged: the stock per
  activity and place is kept with its opening month (``STATE``), older months
  lumped together, and any later anchor sums the months it needs.
* First and last openings are merged as bounds; where a removal touched a bound
  the places concerned, and only these, are read again.
* Rankings, percentages and comparisons are not merged either: they are built
  from the merged rollup and series, which are small.

A changed dimension, an earlier anchor or a missing state means a full build.
States lie in one region each, as the geography tables have it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.functions.text import has_email, is_prospect_email
from civitas.model.source import FrameSource, OverlaySource, PathSource, TableSource
from civitas.plans import stock
from civitas.plans.anchor import month_of, window_end, window_starts
from civitas.plans.graph import (
    EST_READS,
    ROLLUPS,
    VIEWS,
    Build,
    anchor_of,
    build_views,
    select_views,
)
from civitas.plans.rollups import (
    BRANCH,
    SERIES_FLOOR,
    STOCK_KEYS,
    STOCK_READS,
    is_active,
    is_head_office,
)
from civitas.scratch import fresh_path

STATE = "agg_atividade_mes"
STOCK = "agg_atividade_local"
STATE_SUMS = ("total", "matrizes", "filiais", "com_email", "com_telefone", "email_prospeccao")

#: The columns whose change makes a company one that changed.
READS = {
    "estabelecimento": EST_READS,
    "empresa": ("cnpj_basico", "cod_natureza_juridica", "cod_porte"),
    "simples": ("cnpj_basico", "opcao_simples", "opcao_mei"),
}
DIMENSIONS = ("ibge_estado", "ibge_cidade", "cnae", "natureza_juridica")
ROOT = "cnpj_basico"


@dataclass(frozen=True)
class Merge:
    """How a view is merged: what is summed, what a group carries, what follows."""

    sums: tuple[str, ...]
    carried: tuple[str, ...] = ()
    opening: str | None = None  # of a monthly series, whose balance and markers follow
    keep_empty: bool = False


_SERIES = ("ainda_ativos", "baixas")
MERGED: dict[str, Merge] = {
    "mv_abertura_periodo": Merge(
        ("total_aberturas", "empresas_unicas", *_SERIES), ("cod_regiao_ibge",), "total_aberturas"
    ),
    "mv_regime_tributario_cidade": Merge(
        ("total", "simples_nacional", "mei", "simples_ou_mei", "lucro_presumido_real")
    ),
    "mv_porte_cidade": Merge(("total", "matrizes", "com_email")),
    "mv_stats_natureza_juridica_estado": Merge(("total", "ativos")),
    "mv_stats_natureza_juridica_municipio": Merge(("total", "ativos")),
    "mv_stats_natureza_juridica": Merge(("total", "ativos"), keep_empty=True),
    "mv_stats_natureza_juridica_cnae": Merge(("total",)),
    **{
        f"mv_movimentacao_mensal_{name}": Merge(
            ("aberturas", *_SERIES), ("cod_regiao_ibge",), "aberturas"
        )
        for name in ("cnae", "natureza", "porte")
    },
}
_MARKERS = ("saldo", "mes_ancora", "mes_parcial")
TERRITORIES = {
    "mv_stats_estado": ("cod_estado_ibge",),
    "mv_stats_municipio": ("cod_cidade_ibge", "cod_estado_ibge"),
}


def changed_companies(old: TableSource, new: TableSource) -> DataFrame:
    """Roots whose rows differ between two generations in what the views read.

    Thirds of 64-bit row hashes are added with the sign of their generation, so
    rows may come in any order and as often as they like, and the sums of 10^12
    rows fit a long.  On tables bucketed by root this needs no exchange.
    """
    sides, mask = [], F.lit((1 << 22) - 1)
    for sign, source in ((1, new), (-1, old)):
        for number, (name, columns) in enumerate(READS.items()):
            row = F.xxhash64(F.lit(number), *columns, *[F.col(c).isNull() for c in columns])
            sides.append(
                source.table(name, columns).select(
                    ROOT,
                    F.lit(sign).alias("sign"),
                    (F.shiftright(row, 44) * sign).alias("high"),
                    (F.shiftright(row, 22).bitwiseAND(mask) * sign).alias("middle"),
                    (row.bitwiseAND(mask) * sign).alias("low"),
                )
            )
    rows = sides[0]
    for side in sides[1:]:
        rows = rows.unionByName(side)
    parts = ("sign", "high", "middle", "low")
    sums = rows.groupBy(ROOT).agg(*[F.sum(c).alias(c) for c in parts])
    return sums.filter(_any(parts)).select(ROOT)


class CompanySource(TableSource):
    """A generation with only the rows of some companies in its company tables."""

    def __init__(self, base: TableSource, companies: DataFrame):
        self.base, self.companies = base, companies

    def load(self, name, columns):
        if name not in READS:
            return self.base.load(name, columns)
        wanted = tuple(columns) if columns else READS[name]
        frame = self.base.table(name, tuple(dict.fromkeys((ROOT, *wanted))))
        chosen = self.companies.select(F.col(ROOT).alias("_root"))
        return frame.join(chosen, F.col(ROOT).eqNullSafe(F.col("_root")), "left_semi")

    def has(self, name):
        return name in READS or name not in {*ROLLUPS, *VIEWS} and self.base.has(name)


def _set_aside(spark: SparkSession, source: TableSource, companies: DataFrame) -> TableSource:
    """The rows of some companies, written once for all views to read."""
    chosen, frames = CompanySource(source, companies), {}
    for name, columns in READS.items():
        path = fresh_path(spark, f"changed-{name}")
        chosen.table(name, columns).write.parquet(path)
        frames[name] = spark.read.parquet(path)
    # what the generation has in rollups and views counts all its companies
    return OverlaySource(chosen, FrameSource(frames))


def _horizon(anchor: dt.date) -> dt.date:
    return min(window_starts(anchor).values())


def activity_months(est: DataFrame, anchor: dt.date) -> DataFrame:
    """Stock per activity, place, status and opening month; months before every
    window are one, and so are unknown ones."""
    opened = F.col("data_inicio_atividade")
    return (
        est.withColumn("mes", F.when(opened >= F.lit(_horizon(anchor)), month_of(opened)))
        .groupBy(*STOCK_KEYS, "mes")
        .agg(
            F.lit(_horizon(anchor)).alias("desde"),
            F.count("*").alias("total"),
            F.count_if(is_head_office()).alias("matrizes"),
            F.count_if(F.col("matriz_filial") == BRANCH).alias("filiais"),
            F.count_if(has_email(F.col("email"))).alias("com_email"),
            F.count_if(F.col("telefone_1").isNotNull()).alias("com_telefone"),
            F.count_if(is_prospect_email(F.col("email"))).alias("email_prospeccao"),
        )
    )


def _new_sums(anchor: dt.date) -> list[Column]:
    month, end = F.col("mes"), F.lit(window_end(anchor))
    return [
        F.sum(F.when((month >= F.lit(start)) & (month < end), F.col("total")).otherwise(0)).alias(name)
        for name, start in window_starts(anchor).items()
    ]


def activity_stock(months: DataFrame, anchor: dt.date) -> DataFrame:
    """The rollup per activity and place, with the windows of an anchor."""
    kept = [c for c in STATE_SUMS if c != "filiais"]
    return months.groupBy(*STOCK_KEYS).agg(*[F.sum(c).alias(c) for c in kept], *_new_sums(anchor))


def _signed(parts: list[tuple[int, DataFrame]], keys, sums, carried=()) -> DataFrame:
    """Sum of frames with signs; what a group carries comes from the latest part."""
    rows = None
    for order, (sign, frame) in enumerate(parts):
        part = frame.select(
            *keys,
            *[(F.col(c) * sign).alias(c) for c in sums],
            F.struct(F.lit(order * sign).alias("_order"), *carried).alias("_carried"),
        )
        rows = part if rows is None else rows.unionByName(part)
    totals = rows.groupBy(*keys).agg(
        *[F.sum(c).cast("long").alias(c) for c in sums], F.max("_carried").alias("_carried")
    )
    return totals.select(*keys, *sums, *[F.col(f"_carried.{c}").alias(c) for c in carried])


def _any(columns: Iterable[str]) -> Column:
    condition = F.lit(False)
    for c in columns:
        condition = condition | (F.col(c) != 0)
    return condition


def merge_view(name: str, stored: DataFrame, old: DataFrame, new: DataFrame, anchor: dt.date):
    """A stored view with the old part of the changed companies taken for the new one."""
    how = MERGED[name]
    derived = _MARKERS if how.opening else ()
    keys = [c for c in stored.columns if c not in (*how.sums, *how.carried, *derived)]
    # parts in the order of trust: a group's region is the new generation's
    merged = _signed([(-1, old), (1, stored), (1, new)], keys, how.sums, how.carried)
    if not how.keep_empty:
        merged = merged.filter(_any(how.sums))
    if how.opening:
        merged = merged.withColumns(
            {
                "saldo": F.col(how.opening) - F.col("baixas"),
                "mes_ancora": F.lit(anchor),
                "mes_parcial": F.col("mes_abertura") > F.lit(anchor),
            }
        )
    return merged.select(stored.columns)


def _reach(est: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Distinct companies and bounds of the openings of each place."""
    opened = F.col("data_inicio_atividade")
    return est.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.count_distinct(ROOT).alias("total_empresas"),
        F.min(opened).alias("primeira_abertura"),
        F.max(opened).alias("ultima_abertura"),
    )


def _bounds(spark, keys, stored: DataFrame, old: DataFrame, new: DataFrame, est: DataFrame) -> DataFrame:
    """First and last opening per place; read again where a removal touched one."""
    first, last = F.col("primeira_abertura"), F.col("ultima_abertura")
    columns = [*keys, "primeira_abertura", "ultima_abertura"]
    sides = [f.select(columns) for f in (stored, old, new)]
    joined = sides[0].alias("s")
    for side, label in zip(sides[1:], "on", strict=True):
        on = [F.col(f"s.{k}") == F.col(f"{label}.{k}") for k in keys]
        joined = joined.join(side.alias(label), on, "left")

    def gone(column: str, still) -> Column:
        """The bound was an old row's, and no new row reaches it."""
        held = F.col(f"s.{column}") == F.col(f"o.{column}")
        return held & ~F.coalesce(still(F.col(f"n.{column}"), F.col(f"s.{column}")), F.lit(False))

    path = fresh_path(spark, "bounds")
    joined.filter(
        gone("primeira_abertura", lambda n, s: n <= s) | gone("ultima_abertura", lambda n, s: n >= s)
    ).select(*[F.col(f"s.{k}") for k in keys]).write.parquet(path)
    touched = spark.read.parquet(path)
    merged = sides[0].unionByName(sides[2]).groupBy(*keys).agg(
        F.min(first).alias("primeira_abertura"), F.max(last).alias("ultima_abertura")
    )
    if touched.isEmpty():
        return merged
    # only the rows of these places
    again = est.join(touched, list(keys), "left_semi").groupBy(*keys).agg(
        F.min("data_inicio_atividade").alias("primeira_abertura"),
        F.max("data_inicio_atividade").alias("ultima_abertura"),
    )
    return merged.join(touched, list(keys), "left_anti").unionByName(again)


def _territory(
    name: str, spark, months: DataFrame, stored: DataFrame, old: Build, new: Build, whole: Build
) -> DataFrame:
    """A territory view: counts from the state, reach from the changed companies."""
    keys = TERRITORIES[name]
    active = F.when(is_active(), 1).otherwise(0)
    counts = months.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.sum("total").alias("total_estabelecimentos"),
        *[
            F.sum(F.col(c) * active).alias(out)
            for c, out in (("total", "ativos"), ("matrizes", "matrizes_ativas"), ("filiais", "filiais_ativas"))
        ],
        *_new_sums(whole.anchor),
    )
    reads = (ROOT, *keys, "data_inicio_atividade")
    before, after = _reach(old.est(*reads), keys), _reach(new.est(*reads), keys)
    companies = _signed([(1, stored), (-1, before), (1, after)], keys, ["total_empresas"])
    counts = counts.join(companies, list(keys))
    states = whole.dim("ibge_estado")
    if name == "mv_stats_estado":
        return stock.named_states(counts, states, whole.anchor).select(stored.columns)
    est = whole.est(*keys, "data_inicio_atividade")
    counts = counts.join(_bounds(spark, keys, stored, before, after, est), list(keys))
    return stock.named_cities(counts, whole.dim("ibge_cidade"), states, whole.anchor).select(
        stored.columns
    )


def write_state(source: TableSource, target: str, anchor: dt.date) -> None:
    """The state a later refresh starts from; written beside the views."""
    est = source.table("estabelecimento", STOCK_READS)
    activity_months(est, anchor).write.mode("overwrite").parquet(f"{target}/{STATE}")


def same_dimensions(old: TableSource, new: TableSource) -> bool:
    for name in DIMENSIONS:
        a, b = old.table(name), new.table(name)
        columns = sorted(a.columns)
        if columns != sorted(b.columns):
            return False
        one, other = a.select(columns), b.select(columns)
        if not one.exceptAll(other).isEmpty() or not other.exceptAll(one).isEmpty():
            return False
    return True


def build_first(spark, source, target, only=None, anchor=None, floor=SERIES_FLOOR) -> list[str]:
    """A full build that leaves the state for the next refresh as well."""
    anchor = anchor or anchor_of(source)
    names = build_views(spark, source, target, only, anchor, floor)
    write_state(source, target, anchor)
    return names


def refresh_changed(
    spark: SparkSession,
    old: TableSource,
    new: TableSource,
    stored: str,
    target: str,
    only: Iterable[str] | None = None,
    anchor: dt.date | None = None,
    floor: dt.date = SERIES_FLOOR,
) -> list[str]:
    """Write the views of generation ``new`` under ``target`` from the views that
    ``build_first`` or an earlier refresh left of ``old`` under ``stored``.

    Returns the names of the views that were merged or derived; after a full
    build the list is empty.
    """
    if stored.rstrip("/") == target.rstrip("/"):
        raise ValueError("the views of a generation are written beside those of the one before")
    anchor = anchor or anchor_of(new)
    before = PathSource(spark, stored)
    names = select_views(only)
    needed = {r for v in names for r in VIEWS[v].reads if r in VIEWS} | set(names)
    held = all(before.has(n) for n in [STATE, *(v for v in needed if v in MERGED or v in TERRITORIES)])
    if not held or not same_dimensions(old, new) or _since(before) > _horizon(anchor):
        build_first(spark, new, target, only, anchor, floor)
        return []
    path = fresh_path(spark, "companies")
    changed_companies(old, new).write.parquet(path)
    companies = spark.read.parquet(path)
    a = Build(_set_aside(spark, old, companies), anchor, floor)
    b = Build(_set_aside(spark, new, companies), anchor, floor)

    horizon = F.lit(_horizon(anchor))
    keys = [*STOCK_KEYS, "mes"]
    state = before.table(STATE).withColumn("mes", F.when(F.col("mes") >= horizon, F.col("mes")))
    parts = [(1, state)] + [
        (sign, activity_months(side.est(*STOCK_READS), anchor)) for sign, side in ((-1, a), (1, b))
    ]
    state = _signed(parts, keys, STATE_SUMS).filter("total != 0").withColumn("desde", horizon)
    state.write.mode("overwrite").parquet(f"{target}/{STATE}")
    months = spark.read.parquet(f"{target}/{STATE}")
    activity_stock(months, anchor).write.mode("overwrite").parquet(f"{target}/{STOCK}")

    written = PathSource(spark, target)
    whole = Build(OverlaySource(new, written), anchor, floor)
    for name in (v for v in VIEWS if v in needed):
        if name in TERRITORIES:
            frame = _territory(name, spark, months, before.table(name), a, b, whole)
        elif name in MERGED:
            frame = merge_view(
                name, before.table(name), VIEWS[name].build(a), VIEWS[name].build(b), anchor
            )
        else:
            frame = VIEWS[name].build(whole)
        frame.write.mode("overwrite").parquet(f"{target}/{name}")
    return [v for v in VIEWS if v in names]


def _since(before: TableSource) -> dt.date:
    """The month from which the stored state knows months apart."""
    row = before.table(STATE).select("desde").first()
    return row[0] if row else dt.date.min
