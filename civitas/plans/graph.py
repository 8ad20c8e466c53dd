"""The nineteen views, what each one reads and in which order to build them."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.model.source import FrameSource, OverlaySource, PathSource, TableSource
from civitas.plans import comparison, rollups, series, stock
from civitas.plans.anchor import anchor_month
from civitas.plans.rollups import SERIES_FLOOR
from civitas.scratch import fresh_path
from civitas.sources.sinks import build_and_swap


@dataclass(frozen=True)
class Build:
    """Everything a view needs besides its own definition."""

    source: TableSource
    anchor: dt.date
    floor: dt.date = SERIES_FLOOR

    def est(self, *columns: str) -> DataFrame:
        return self.source.table("estabelecimento", columns)

    def dim(self, name: str) -> DataFrame:
        return self.source.table(name)

    def companies(self, *columns: str) -> DataFrame:
        return self.source.table("empresa", ("cnpj_basico", *columns))

    def part(self, name: str) -> DataFrame:
        """A rollup or view: the written table when there is one, else its plan."""
        if self.source.has(name):
            return self.source.table(name)
        return (ROLLUPS.get(name) or VIEWS[name].build)(self)


ROLLUPS: dict[str, Callable[[Build], DataFrame]] = {
    "agg_atividade_local": lambda b: rollups.stock_by_activity_place(
        b.est(*rollups.STOCK_READS), b.anchor
    ),
    "agg_raiz_local": lambda b: rollups.stock_by_root_place(b.est(*rollups.ROOT_PLACE_READS)),
    "agg_raiz_matriz": lambda b: rollups.head_offices_by_root(b.est(*rollups.HEADS_READS)),
    "agg_raiz_movimento": lambda b: rollups.movements_by_root(
        b.est(*rollups.ROOT_MOVEMENT_READS), b.floor
    ),
}


@dataclass(frozen=True)
class View:
    number: int
    build: Callable[[Build], DataFrame]
    key: tuple[str, ...]
    reads: tuple[str, ...] = ()  # rollups and views it is derived from
    comment: str = ""


_TERRITORY = (
    "cnpj_basico",
    "cod_estado_ibge",
    "cod_situacao_cadastral",
    "matriz_filial",
    "data_inicio_atividade",
)
_LEVEL_KEY = ("nivel", "cod_regiao_ibge", "cod_estado_ibge", "cod_cidade_ibge", "periodo_meses")


def _heads(b: Build, *keys: str) -> DataFrame:
    """Head offices per company: the written rollup, else one just as fine as needed."""
    if b.source.has("agg_raiz_matriz"):
        return b.source.table("agg_raiz_matriz")
    keys = ("cnpj_basico", *keys)
    est = b.est(*keys, "matriz_filial", "cod_situacao_cadastral")
    return rollups.head_offices_by_root(est, keys)


VIEWS: dict[str, View] = {
    "mv_stats_estado": View(
        1,
        lambda b: stock.stats_estado(b.est(*_TERRITORY), b.dim("ibge_estado"), b.anchor),
        ("cod_estado_ibge",),
        comment="Stock and openings per state, windows ending at the anchor month",
    ),
    "mv_stats_municipio": View(
        2,
        lambda b: stock.stats_municipio(
            b.est(*_TERRITORY, "cod_cidade_ibge"),
            b.dim("ibge_cidade"),
            b.dim("ibge_estado"),
            b.anchor,
        ),
        ("cod_cidade_ibge",),
        comment="Stock and openings per city, windows ending at the anchor month",
    ),
    "mv_stats_cnae": View(
        3,
        lambda b: stock.stats_cnae(b.part("agg_atividade_local"), b.dim("cnae"), b.anchor),
        ("cod_cnae_principal",),
        ("agg_atividade_local",),
        "Stock, reach and openings per main activity",
    ),
    "mv_stats_cnae_estado": View(
        4,
        lambda b: stock.stats_cnae_estado(b.part("agg_atividade_local")),
        ("cod_cnae_principal", "cod_estado_ibge"),
        ("agg_atividade_local",),
        "Stock per main activity and state",
    ),
    "mv_abertura_periodo": View(
        5,
        lambda b: series.abertura_periodo(
            b.est("cod_cidade_ibge", *rollups.ROOT_MOVEMENT_READS), b.anchor, b.floor
        ),
        ("mes_abertura", "cod_cidade_ibge", "cod_estado_ibge"),
        comment="Monthly openings and closings per city",
    ),
    "mv_top_cnaes_cidade": View(
        6,
        lambda b: stock.top_cnaes_cidade(
            b.part("agg_atividade_local"), b.dim("cnae"), b.dim("ibge_cidade"), b.anchor
        ),
        ("cod_cidade_ibge", "cod_cnae_principal"),
        ("agg_atividade_local",),
        "Activities of a city ranked by active establishments",
    ),
    "mv_stats_cidade_situacao": View(
        7,
        lambda b: stock.stats_cidade_situacao(b.part("agg_atividade_local")),
        ("cod_cidade_ibge", "cod_situacao_cadastral"),
        ("agg_atividade_local",),
        "Counts per city and registration status",
    ),
    "mv_regime_tributario_cidade": View(
        8,
        lambda b: stock.regime_tributario_cidade(
            b.part("agg_raiz_local"),
            b.companies(),
            b.source.table("simples", ("cnpj_basico", "opcao_simples", "opcao_mei")),
        ),
        ("cod_cidade_ibge", "cod_situacao_cadastral"),
        ("agg_raiz_local",),
        "Tax regimes per city and status",
    ),
    "mv_porte_cidade": View(
        9,
        lambda b: stock.porte_cidade(b.part("agg_raiz_local"), b.companies("cod_porte")),
        ("cod_cidade_ibge", "cod_porte", "cod_situacao_cadastral"),
        ("agg_raiz_local",),
        "Company sizes per city and status",
    ),
    "mv_stats_natureza_juridica_estado": View(
        10,
        lambda b: stock.natureza_estado(
            _heads(b, "cod_estado_ibge"),
            b.companies("cod_natureza_juridica"),
            b.dim("natureza_juridica"),
            b.dim("ibge_estado"),
        ),
        ("cod_natureza", "cod_estado_ibge"),
        ("agg_raiz_matriz",),
        "Companies per legal form and state of the head office",
    ),
    "mv_stats_natureza_juridica_municipio": View(
        11,
        lambda b: stock.natureza_municipio(
            _heads(b, "cod_estado_ibge", "cod_cidade_ibge"),
            b.companies("cod_natureza_juridica"),
            b.dim("natureza_juridica"),
        ),
        ("cod_natureza", "cod_cidade_ibge"),
        ("agg_raiz_matriz",),
        "Companies per legal form and city of the head office",
    ),
    "mv_stats_natureza_juridica": View(
        12,
        lambda b: stock.natureza_nacional(
            _heads(b), b.companies("cod_natureza_juridica"), b.dim("natureza_juridica")
        ),
        ("cod_natureza",),
        ("agg_raiz_matriz",),
        "Companies per legal form, zero rows included",
    ),
    "mv_stats_natureza_juridica_cnae": View(
        13,
        lambda b: stock.natureza_cnae(
            _heads(b, "cod_cnae_principal"), b.companies("cod_natureza_juridica"), b.dim("cnae")
        ),
        ("cod_natureza", "cod_cnae"),
        ("agg_raiz_matriz",),
        "Companies with an active head office per legal form and activity",
    ),
    "mv_movimentacao_mensal_cnae": View(
        14,
        lambda b: series.movimentacao_cnae(
            b.est(
                "cod_cnae_principal", "cod_estado_ibge", "cod_regiao_ibge", *rollups.MOVEMENT_READS
            ),
            b.anchor,
            b.floor,
        ),
        ("mes_abertura", "cod_cnae_principal", "cod_estado_ibge"),
        comment="Monthly openings and closings per activity and state",
    ),
    "mv_movimentacao_mensal_natureza": View(
        15,
        lambda b: series.movimentacao_natureza(
            b.part("agg_raiz_movimento"), b.companies("cod_natureza_juridica"), b.anchor
        ),
        ("mes_abertura", "cod_natureza", "cod_estado_ibge"),
        ("agg_raiz_movimento",),
        "Monthly openings and closings per legal form and state",
    ),
    "mv_movimentacao_mensal_porte": View(
        16,
        lambda b: series.movimentacao_porte(
            b.part("agg_raiz_movimento"), b.companies("cod_porte"), b.anchor
        ),
        ("mes_abertura", "cod_porte", "cod_estado_ibge"),
        ("agg_raiz_movimento",),
        "Monthly openings and closings per current company size and state",
    ),
    "mv_comparativo_territorio": View(
        17,
        lambda b: comparison.comparativo_territorio(b.part("mv_abertura_periodo"), b.anchor),
        _LEVEL_KEY,
        ("mv_abertura_periodo",),
        "Equivalent periods compared per territory",
    ),
    "mv_comparativo_cnae": View(
        18,
        lambda b: comparison.comparativo_cnae(b.part("mv_movimentacao_mensal_cnae"), b.anchor),
        ("cod_cnae_principal", *_LEVEL_KEY),
        ("mv_movimentacao_mensal_cnae",),
        "Equivalent periods compared per activity",
    ),
    "mv_comparativo_natureza": View(
        19,
        lambda b: comparison.comparativo_natureza(
            b.part("mv_movimentacao_mensal_natureza"), b.anchor
        ),
        ("cod_natureza", *_LEVEL_KEY),
        ("mv_movimentacao_mensal_natureza",),
        "Equivalent periods compared per legal form",
    ),
}


def file_name(view: str) -> str:
    """``NN_<view>``: the label a selection fragment is matched against."""
    return f"{VIEWS[view].number:02d}_{view}"


def select_views(only: Iterable[str] | None = None) -> list[str]:
    """Views whose label contains a fragment, plus all that depend on them.

    A fragment matching nothing stops the job before any work starts.
    """
    if only is None:
        return list(VIEWS)
    fragments = [f.strip() for f in only if f.strip()]
    unknown = [f for f in fragments if not any(f in file_name(v) for v in VIEWS)]
    if unknown:
        raise ValueError(f"no view matches: {', '.join(unknown)}")
    chosen = {v for v in VIEWS if any(f in file_name(v) for f in fragments)}
    while True:
        dependants = {v for v, view in VIEWS.items() if chosen & set(view.reads)} - chosen
        if not dependants:
            return [v for v in VIEWS if v in chosen]
        chosen |= dependants


def view(source: TableSource, name: str, anchor: dt.date, floor: dt.date = SERIES_FLOOR):
    """One view as a lazy DataFrame."""
    return VIEWS[name].build(Build(source, anchor, floor))


def anchor_of(source: TableSource) -> dt.date:
    runs = (
        source.table("pipeline_stats", ("run_id", "reference_period", "started_at"))
        if source.has("pipeline_stats")
        else None
    )
    opened = (
        source.table("estabelecimento", ("data_inicio_atividade",))
        if source.has("estabelecimento")
        else None
    )
    return anchor_month(runs, opened)


#: What the views and rollups read of the establishments.
EST_READS = tuple(
    dict.fromkeys(
        (
            *rollups.STOCK_READS,
            *rollups.ROOT_PLACE_READS,
            *rollups.HEADS_READS,
            *rollups.ROOT_MOVEMENT_READS,
        )
    )
)


def establishments_once(spark: SparkSession, source: TableSource, *extra: str) -> TableSource:
    """``source`` with the establishments that views read written once.

    For a source that derives them by joins: every view and rollup then scans a
    written table instead of running these joins again.
    """
    path = fresh_path(spark, "estabelecimento")
    source.table("estabelecimento", (*extra, *EST_READS)).write.parquet(path)
    return OverlaySource(source, FrameSource({"estabelecimento": spark.read.parquet(path)}))


def _write(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def build_views(
    spark: SparkSession,
    source: TableSource,
    target: str,
    only: Iterable[str] | None = None,
    anchor: dt.date | None = None,
    floor: dt.date = SERIES_FLOOR,
) -> list[str]:
    """Write the selected views as Parquet under ``target``; returns their names.

    Rollups are written first, once, and every view that derives from one reads
    it back; comparisons read the series written just before them.
    """
    chosen = select_views(only)
    anchor = anchor or anchor_of(source)
    # A rollup left by an earlier build belongs to that build's data and anchor.
    bare = Build(source, anchor, floor)
    wanted = {r for v in chosen for r in VIEWS[v].reads if r in ROLLUPS}
    for name in (r for r in ROLLUPS if r in wanted):
        _write(ROLLUPS[name](bare), f"{target}/{name}")
    missing = {
        r for v in chosen for r in VIEWS[v].reads if r in VIEWS and r not in chosen
    }
    written = _WrittenSource(spark, target, wanted)
    build = Build(OverlaySource(source, written), anchor, floor)
    for name in [v for v in VIEWS if v in missing or v in chosen]:
        _write(VIEWS[name].build(build), f"{target}/{name}")
        written.names.add(name)
    return chosen


class _WrittenSource(PathSource):
    """Only what this build has written so far."""

    def __init__(self, spark, root, names):
        super().__init__(spark, root)
        self.names = set(names)

    def has(self, name):
        return name in self.names


# Order in which views are refreshed, dependencies first.
REFRESH_ORDER = sorted(VIEWS, key=lambda v: (v.startswith("mv_comparativo"), VIEWS[v].number))


def refresh_views(
    spark: SparkSession,
    source: TableSource,
    target: str,
    existing: Iterable[str],
    anchor: dt.date | None = None,
    floor: dt.date = SERIES_FLOOR,
    publish: Callable[[str, DataFrame], None] | None = None,
) -> DataFrame:
    """Rebuild the existing views in dependency order, one status row each.

    A view that fails leaves its old content and does not stop the others;
    ``publish(name, frame)`` puts the new content in place and defaults to
    writing beside the old folder and switching (``sinks.build_and_swap``).
    """
    anchor = anchor or anchor_of(source)
    present = set(existing)
    bare = Build(source, anchor, floor)
    readable = set(present)  # a dependant reads the series in place, new or old
    for name in {r for v in present & set(VIEWS) for r in VIEWS[v].reads if r in ROLLUPS}:
        try:
            _write(ROLLUPS[name](bare), f"{target}/{name}")
            readable.add(name)
        except Exception:  # its views then fail or succeed on their own
            continue
    build = Build(OverlaySource(source, _WrittenSource(spark, target, readable)), anchor, floor)
    results = []
    for name in REFRESH_ORDER:
        if name not in present:
            results.append((name, "AUSENTE", None))
            continue
        started = time.monotonic()
        try:
            frame = VIEWS[name].build(build)
            if publish:
                publish(name, frame)
            else:
                build_and_swap(frame, f"{target}/{name}")
            status = "OK"
        except Exception as failure:  # one broken view must not hide the rest
            status = f"ERRO: {failure}"
        results.append((name, status, time.monotonic() - started))
    return spark.createDataFrame(results, "mv_name string, status string, duration_seconds double")


# What the shared columns of the views mean.
COLUMN_COMMENTS = {
    "ativos": "Registration status 02",
    "matrizes_ativas": "Active head offices",
    "filiais_ativas": "Active branches",
    "novos_1mes": "Openings in the anchor month",
    "novos_6meses": "Openings in the 6 months ending at the anchor, inclusive",
    "novos_1ano": "Openings in the 12 months ending at the anchor, inclusive",
    "novos_2anos": "Openings in the 24 months ending at the anchor, inclusive",
    "novos_4anos": "Openings in the 48 months ending at the anchor, inclusive",
    "mes_ancora": "Last complete month of the load",
    "mes_abertura": "Month of the movement, opening or closing",
    "mes_parcial": "True for months after the anchor, still being filled",
    "ainda_ativos": "How many of those openings still have status 02",
    "baixas": "Closings (status 08) in the month",
    "saldo": "Openings minus closings",
    "empresas_unicas": "Distinct companies inside city and month; not additive over cities",
    "nivel": "Which geographic column holds the code; the others are 0",
    "periodo_meses": "Window length in months: 1, 6, 12, 24 or 48",
    "aberturas_variacao_pct": "NULL when the previous period had no openings",
    "sobrevivencia_delta_pp": "Difference of the two rounded rates; NULL if either is NULL",
}


def register_views(
    spark: SparkSession, database: str, target: str, names: Iterable[str]
) -> None:
    """Catalog tables, with table and column comments, over the written views."""
    for name in names:
        fields = [
            f"`{f.name}` {f.dataType.simpleString()}"
            + (f" COMMENT '{COLUMN_COMMENTS[f.name]}'" if f.name in COLUMN_COMMENTS else "")
            for f in spark.read.parquet(f"{target}/{name}").schema.fields
        ]
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(
            f"CREATE TABLE {database}.{name} ({', '.join(fields)}) USING parquet "
            f"COMMENT '{VIEWS[name].comment}' LOCATION '{target}/{name}'"
        )


def table_stats(source: TableSource, names: Iterable[str]) -> DataFrame:
    """Rows per table, largest first; empty tables are left out."""
    counts = None
    for name in names:
        one = source.table(name).agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts.filter("rows > 0").orderBy(F.desc("rows"), "table")
