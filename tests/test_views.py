"""The nineteen views on a skewed fixture, and the graph that builds them.

A third of all establishments belong to one company, another company has head
offices in several places, and geography, size and dates are NULL here and
there.  The reference results come from the plain SQL definitions.
"""

import datetime as dt
import random
import re

import duckdb
import pytest
from compare import rows_of
from frames import values
from pyspark.sql import functions as F

from civitas.model.source import FrameSource
from civitas.model.specs import spec
from civitas.plans import anchor as a
from civitas.plans import comparison, graph
from civitas.plans.graph import VIEWS
from entry_oracles import _CTES

ANCHOR = dt.date(2020, 6, 1)
FLOOR = dt.date(1995, 1, 1)
EST = ("cnpj_completo cnpj_basico matriz_filial cod_situacao_cadastral data_situacao_cadastral "
       "data_inicio_atividade cod_cnae_principal email telefone_1 cod_regiao_ibge cod_estado_ibge "
       "cod_cidade_ibge").split()


def make_rows(seed=7, size=1500):
    pick = random.Random(seed)
    places = [(1 + s % 3, 10 + s, 1000 + 10 * s + c) for s in range(5) for c in range(4)]
    rows = []
    for i in range(size):
        root = "HOT" if i % 3 == 0 else f"R{pick.randrange(300):04d}"
        region, state, city = pick.choice(places)
        if pick.random() < 0.05:
            city = None
        if pick.random() < 0.03:
            region = state = city = None
        opened = ANCHOR - dt.timedelta(days=pick.randrange(-40, 9000))
        status = pick.choice(["02", "08", "04"])
        closed = opened + dt.timedelta(days=pick.randrange(2000)) if pick.random() < 0.9 else None
        rows.append((f"{i:014d}", root, pick.choice("112") if root != "HOT" else pick.choice("1222"),
                     status, closed, opened, f"{pick.randrange(12):07d}",
                     pick.choice([None, "", "a@b", "x@Contab.c"]), pick.choice([None, "1"]),
                     region, state, city))
    return rows


def make_frames(spark):
    est = spark.createDataFrame(
        make_rows(),
        ", ".join(f"{c} {spec('estabelecimento')[c].dtype.simpleString()}" for c in EST),
    )
    roots = ["HOT", *[f"R{i:04d}" for i in range(280)]]  # the last twenty have no company
    companies = spark.createDataFrame(
        [(r, ["2062", "2135", "9999", "1000"][i % 4], [None, "01", "05"][i % 3])
         for i, r in enumerate(roots)],
        "cnpj_basico string, cod_natureza_juridica string, cod_porte string")
    simples = spark.createDataFrame(
        [(r, "SN"[i % 2], [None, "S", "N"][i % 3]) for i, r in enumerate(roots) if i % 5],
        "cnpj_basico string, opcao_simples string, opcao_mei string")
    forms = spark.createDataFrame(
        [("2062", "LTDA"), ("2135", "MEI"), ("1000", "GOV"), ("7777", "NONE")],
        "cod_natureza string, nome_natureza string")
    activities = spark.createDataFrame(
        [(f"{i:07d}", f"act {i}") for i in range(10)], "cod_cnae string, nome_cnae string")
    states = spark.createDataFrame(
        [(10 + s, f"S{s}", f"State {s}", 1 + s % 3) for s in range(5)],
        "cod_estado_ibge int, sigla_uf string, nome_estado string, cod_regiao_ibge int")
    cities = spark.createDataFrame(
        [(1000 + 10 * s + c, f"C{s}{c}", 10 + s) for s in range(5) for c in range(4)],
        "cod_cidade_ibge int, nome_cidade string, cod_estado_ibge int")
    return {
        "estabelecimento": est, "empresa": companies, "simples": simples,
        "natureza_juridica": forms, "cnae": activities, "ibge_estado": states, "ibge_cidade": cities,
    }


@pytest.fixture(scope="module")
def source(spark):
    return FrameSource({n: f.cache() for n, f in make_frames(spark).items()})


def as_arrow(frame):
    import pyarrow as pa
    return pa.Table.from_batches(frame.toArrow().to_batches())


@pytest.fixture(scope="module")
def plain_sql(source):
    con = duckdb.connect()
    for name in source.frames:
        con.register(name, as_arrow(source.table(name)))
    con.execute(f"CREATE VIEW ancora AS SELECT DATE '{ANCHOR}' AS mes_ancora")
    for name in ("janelas", "periodos"):
        con.execute(f"CREATE VIEW {name} AS {_CTES[name]}")
    for name, body in _CTES.items():
        if name.startswith("mv_") and not name.endswith("_2000"):
            con.execute(f"CREATE TABLE {name} AS {body}")
    return con


def check(frame, plain_sql, name):
    result = plain_sql.execute(f"SELECT * FROM {name}")
    want = rows_of([d[0] for d in result.description], result.fetchall())
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    assert got[0] == want[0]
    assert got[1] == want[1] and want[1]


@pytest.mark.parametrize("name", list(VIEWS))
def test_view_equals_its_plain_definition(source, plain_sql, name):
    check(graph.view(source, name, ANCHOR, FLOOR), plain_sql, name)


def test_built_views_equal_the_single_ones(spark, source, plain_sql, tmp_path):
    """Written rollups and series give the same results as one plan per view."""
    names = graph.build_views(spark, source, str(tmp_path), anchor=ANCHOR, floor=FLOOR)
    assert names == list(VIEWS)
    for name in names:
        check(spark.read.parquet(f"{tmp_path}/{name}"), plain_sql, name)
    for name in names:  # every view holds one row per key, NULL parts exempt
        view = spark.read.parquet(f"{tmp_path}/{name}").dropna(subset=list(VIEWS[name].key))
        if name in ("mv_stats_cidade_situacao", "mv_regime_tributario_cidade", "mv_porte_cidade"):
            continue  # the fixture gives one city rows with and without a region
        assert view.groupBy(*VIEWS[name].key).count().filter("count > 1").count() == 0, name


@pytest.mark.parametrize("name", ["mv_top_cnaes_cidade", "mv_comparativo_territorio"])
def test_result_does_not_depend_on_shuffle_partitions(spark, source, name):
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(values(graph.view(source, name, ANCHOR, FLOOR)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_published_floor_is_the_default(source):
    series = graph.view(source, "mv_abertura_periodo", ANCHOR)
    assert series.agg(F.min("mes_abertura")).first()[0] >= dt.date(2000, 1, 1)


def test_series_balance(source):
    series = graph.view(source, "mv_movimentacao_mensal_cnae", ANCHOR, FLOOR)
    assert series.filter("saldo <> aberturas - baixas").count() == 0
    assert series.filter("mes_parcial <> (mes_abertura > mes_ancora)").count() == 0


def test_null_territory_counts_in_the_country_only(source):
    rows = graph.view(source, "mv_comparativo_territorio", ANCHOR, FLOOR)
    year = rows.filter("periodo_meses = 48").groupBy("nivel").agg(F.sum("aberturas_atual"))
    totals = dict(values(year))
    assert totals["brasil"] > totals["regiao"] == totals["estado"] > totals["municipio"]
    codes = ["cod_regiao_ibge", "cod_estado_ibge", "cod_cidade_ibge"]
    assert rows.filter(" OR ".join(f"{c} IS NULL" for c in codes)).count() == 0


def test_a_territory_always_has_its_five_periods(source):
    rows = graph.view(source, "mv_comparativo_cnae", ANCHOR, FLOOR)
    per = rows.groupBy("cod_cnae_principal", "nivel", "cod_regiao_ibge", "cod_estado_ibge").count()
    assert [r[0] for r in per.select("count").distinct().collect()] == [5]


def test_comparison_of_an_empty_series_is_empty(source):
    series = graph.view(source, "mv_abertura_periodo", ANCHOR, FLOOR).limit(0)
    assert comparison.comparativo_territorio(series, ANCHOR).count() == 0


# -- anchor ----------------------------------------------------------------------

RUN = "run_id string, reference_period string, started_at timestamp"


def anchor_of(spark, runs, opened):
    history = spark.createDataFrame(runs, RUN) if runs is not None else None
    est = (
        spark.createDataFrame([(d,) for d in opened], "data_inicio_atividade date")
        if opened is not None
        else None
    )
    return a.anchor_month(history, est, today=dt.date(2026, 3, 15))


T = dt.datetime(2026, 1, 1)


@pytest.mark.parametrize(
    "runs, opened, expected",
    [
        ([("1", "2026-07", T)], [dt.date(2026, 7, 3)], dt.date(2026, 6, 1)),
        ([("1", "2026-07", T)], [dt.date(2099, 1, 1)], dt.date(2026, 6, 1)),
        ([("1", "2026-07", T)], [dt.date(2026, 3, 1)], dt.date(2026, 2, 1)),
        ([("1", "2026-13", T)], [dt.date(2026, 3, 1)], dt.date(2026, 2, 1)),
        ([("1", "07/2026", T)], [], dt.date(2026, 2, 1)),
        (None, [dt.date(2026, 1, 31)], dt.date(2025, 12, 1)),
        ([("1", "2026-07", T)], None, dt.date(2026, 6, 1)),
        ([("1", "2026-07", T), ("2", "2026-05", T + dt.timedelta(1))], [None], dt.date(2026, 4, 1)),
        ([], [], dt.date(2026, 2, 1)),
    ],
)
def test_anchor(spark, runs, opened, expected):
    assert anchor_of(spark, runs, opened) == expected


def test_windows(spark):
    six = next(p for p in a.periods(dt.date(2026, 6, 1)) if p.size == 6)
    assert (six.current_start, six.current_end) == (dt.date(2026, 1, 1), dt.date(2026, 6, 1))
    assert (six.previous_start, six.previous_end) == (dt.date(2025, 7, 1), dt.date(2025, 12, 1))
    rows = a.period_windows(spark, dt.date(2026, 6, 1)).collect()
    assert [r["periodo_meses"] for r in rows] == [1, 6, 12, 24, 48]
    assert rows[4]["periodo_anterior_inicio"] == dt.date(2018, 7, 1)


# -- graph -----------------------------------------------------------------------


def test_selection():
    assert graph.select_views(["05"]) == ["mv_abertura_periodo", "mv_comparativo_territorio"]
    assert graph.select_views(["mensal_cnae", "01_"]) == [
        "mv_stats_estado", "mv_movimentacao_mensal_cnae", "mv_comparativo_cnae"]
    assert len(graph.select_views(None)) == 19
    with pytest.raises(ValueError, match="nada"):
        graph.select_views(["05", "nada"])


def test_a_comparison_alone_builds_its_series(spark, source, tmp_path):
    built = graph.build_views(spark, source, str(tmp_path), only=["18_"], anchor=ANCHOR, floor=FLOOR)
    assert built == ["mv_comparativo_cnae"]
    assert spark.read.parquet(f"{tmp_path}/mv_comparativo_cnae").count() > 0


def test_a_stale_rollup_is_not_reused(spark, source, tmp_path):
    graph.build_views(spark, source, str(tmp_path), only=["03_"], anchor=ANCHOR, floor=FLOOR)
    later = a.month_add(ANCHOR, -12)
    graph.build_views(spark, source, str(tmp_path), only=["03_"], anchor=later, floor=FLOOR)
    written = spark.read.parquet(f"{tmp_path}/mv_stats_cnae")
    assert values(written) == values(graph.view(source, "mv_stats_cnae", later).select(*written.columns))


def test_refresh_isolates_a_failure(spark, source, tmp_path):
    target = str(tmp_path)
    names = ["mv_stats_estado", "mv_abertura_periodo", "mv_comparativo_territorio"]
    graph.build_views(spark, source, target, only=["01_", "05_"], anchor=ANCHOR, floor=FLOOR)
    before = values(spark.read.parquet(f"{target}/mv_stats_estado"))
    broken = dict(source.frames)
    broken["ibge_estado"] = broken["ibge_estado"].withColumn(
        "sigla_uf", F.raise_error(F.lit("boom")).cast("string"))
    report = graph.refresh_views(spark, FrameSource(broken), target, names, ANCHOR, FLOOR)
    status = {r["mv_name"]: r["status"] for r in report.collect()}
    assert len(status) == 19
    assert status["mv_stats_estado"].startswith("ERRO: ")
    assert status["mv_abertura_periodo"] == status["mv_comparativo_territorio"] == "OK"
    assert status["mv_porte_cidade"] == "AUSENTE"
    assert values(spark.read.parquet(f"{target}/mv_stats_estado")) == before


def test_registered_views_carry_comments(spark, source, tmp_path):
    graph.build_views(spark, source, str(tmp_path), only=["01_"], anchor=ANCHOR)
    spark.sql("CREATE DATABASE IF NOT EXISTS painel")
    graph.register_views(spark, "painel", str(tmp_path), ["mv_stats_estado"])
    fields = {r["col_name"]: r["comment"]
              for r in spark.sql("DESCRIBE TABLE painel.mv_stats_estado").collect()}
    assert fields["mes_ancora"] == graph.COLUMN_COMMENTS["mes_ancora"]
    assert spark.table("painel.mv_stats_estado").count() == 5


def test_table_stats_leaves_out_empty_tables(spark):
    frames = FrameSource({"a": spark.range(2), "b": spark.range(0), "c": spark.range(9)})
    assert [tuple(r) for r in graph.table_stats(frames, "abc").collect()] == [("c", 9), ("a", 2)]


# -- plans -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark, source, tmp_path_factory):
    """The fixture as Parquet, so that plans show what reaches the scan."""
    from civitas.model.source import PathSource

    root = str(tmp_path_factory.mktemp("tables"))
    for name in source.frames:
        source.table(name).write.parquet(f"{root}/{name}")
    return PathSource(spark, root)


def plan_of(frame):
    jvm = frame.sparkSession.sparkContext._jvm
    query = frame._jdf.queryExecution()
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")


@pytest.mark.parametrize("name", list(VIEWS))
def test_no_plan_has_python_or_a_cross_join(stored, name):
    plan = plan_of(graph.view(stored, name, ANCHOR, FLOOR))
    for word in ("Cartesian", "NestedLoop", "BatchEvalPython", "ArrowEval", "MapInPandas"):
        assert word not in plan


def test_scans_read_only_what_the_view_needs(stored):
    plan = plan_of(graph.view(stored, "mv_stats_cnae_estado", ANCHOR))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert len(schemas) == 1
    assert "cnpj_basico" not in schemas[0] and "cnpj_completo" not in schemas[0]


def test_one_scan_feeds_openings_and_closings(stored):
    plan = plan_of(graph.view(stored, "mv_movimentacao_mensal_cnae", ANCHOR))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.MULTILINE)) == 1
    assert "PushedFilters: [Or(GreaterThanOrEqual(data_inicio_atividade,2000-01-01)" in plan


def test_company_views_collapse_a_company_before_joining_it(stored, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(graph.view(stored, "mv_porte_cidade", ANCHOR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    # the tree prints operators top down: an aggregate, the join, an aggregate below it
    tree = plan.split("\n\n")[0]
    assert "HashAggregate" in tree[tree.index("Join"):]


def test_prefix_search_reaches_the_scan(stored):
    from civitas.functions.text import starts_with

    frame = stored.table("estabelecimento", ("cnpj_completo",))
    plan = plan_of(frame.filter(starts_with(F.col("cnpj_completo"), "0000")))
    assert "StringStartsWith(cnpj_completo,0000)" in plan
