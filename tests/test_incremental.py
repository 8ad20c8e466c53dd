"""Views merged from what changed, against full builds of the new generation."""

import datetime as dt

import pytest
from frames import values
from pyspark.sql import functions as F
from test_views import ANCHOR, EST, FLOOR, make_frames

from civitas.model.source import FrameSource, PathSource
from civitas.plans import graph, incremental
from civitas.plans.anchor import month_add
from civitas.plans.graph import VIEWS

NEXT = month_add(ANCHOR, 1)


def later(frames, step):
    """The next generation: rows gone, new, moved and closed; companies changed."""
    est, number = frames["estabelecimento"], F.col("cnpj_completo").cast("long")
    hit = F.col("cnpj_basico") != "HOT" if step == 1 else F.lit(True)
    moved = est.filter(number % 31 != step).withColumns(
        {
            "cod_situacao_cadastral": F.when(hit & (number % 23 == step), "08").otherwise(
                F.col("cod_situacao_cadastral")),
            "data_situacao_cadastral": F.when(hit & (number % 23 == step), F.lit(NEXT)).otherwise(
                F.col("data_situacao_cadastral")),
            "email": F.when(hit & (number % 29 == step), "n@x").otherwise(F.col("email")),
            "cod_cnae_principal": F.when(hit & (number % 37 == step), "0000003").otherwise(
                F.col("cod_cnae_principal")),
        }
    )
    # the first opening of one city goes, another city goes altogether
    first = est.filter("cod_cidade_ibge = 1001").agg(F.min("data_inicio_atividade")).first()[0]
    moved = moved.filter(
        ~F.coalesce(
            (F.col("cod_cidade_ibge") == 1001) & (F.col("data_inicio_atividade") == F.lit(first))
            | (F.col("cod_cidade_ibge") == 1040 + step), F.lit(False)))
    fresh = est.filter(number % 41 == step).withColumns(
        {
            "cnpj_completo": F.concat(F.lit(str(step)), F.substring("cnpj_completo", 2, 13)),
            "cnpj_basico": F.when(number % 2 == 0, F.concat(F.lit("N"), F.substring("cnpj_completo", 11, 4)))
            .when(number % 3 == 0, F.lit(None)).otherwise(F.col("cnpj_basico")),
            "data_inicio_atividade": F.lit(NEXT),
        }
    )
    companies = frames["empresa"].withColumn(
        "cod_porte", F.when(F.col("cnpj_basico") == f"R010{step}", "05").otherwise(F.col("cod_porte"))
    ).withColumn(
        "cod_natureza_juridica",
        F.when(F.col("cnpj_basico").isin("R0007", "HOT"), "1000").otherwise(F.col("cod_natureza_juridica")),
    ).filter(F.col("cnpj_basico") != f"R000{step}")
    simples = frames["simples"].filter(F.col("cnpj_basico") != f"R002{step}")
    return {**frames, "estabelecimento": moved.select(EST).unionByName(fresh.select(EST)),
            "empresa": companies, "simples": simples}


@pytest.fixture(scope="module")
def generations(spark, tmp_path_factory):
    """Three generations, their full builds, and two refreshes one after the other."""
    root, frames = str(tmp_path_factory.mktemp("refresh")), make_frames(spark)
    sources = []
    for step in range(3):
        frames = later(frames, step) if step else frames
        for name, frame in frames.items():
            frame.write.parquet(f"{root}/g{step}/{name}")
        sources.append(PathSource(spark, f"{root}/g{step}"))
        frames = {n: sources[-1].table(n) for n in frames}
    incremental.build_first(spark, sources[0], f"{root}/v0", None, ANCHOR, FLOOR)
    done = [
        incremental.refresh_changed(
            spark, sources[step - 1], sources[step], f"{root}/v{step - 1}", f"{root}/v{step}", None, NEXT, FLOOR)
        for step in (1, 2)
    ]
    graph.build_views(spark, sources[2], f"{root}/full", None, NEXT, FLOOR)
    return root, sources, done


def test_every_view_equals_a_full_build(spark, generations):
    root, _, done = generations
    assert done == [list(VIEWS)] * 2
    for name in VIEWS:
        got, want = spark.read.parquet(f"{root}/v2/{name}"), spark.read.parquet(f"{root}/full/{name}")
        assert got.dtypes == want.select(got.columns).dtypes and set(got.columns) == set(want.columns), name
        assert values(got) == values(want, *got.columns), name


def test_only_changed_companies_are_set_aside(generations):
    _, (old, new, _), _ = generations
    found = {r[0] for r in incremental.changed_companies(old, new).collect()}
    rows = {}
    for side, source in (("old", old), ("new", new)):
        for name, columns in incremental.READS.items():
            for r in source.table(name, columns).collect():
                rows.setdefault(r["cnpj_basico"], {"old": [], "new": []})[side].append((name, *map(str, r)))
    want = {root for root, sides in rows.items() if sorted(sides["old"]) != sorted(sides["new"])}
    assert found == want and None in want and 20 < len(want) < len(rows)


def test_nothing_changed_and_repeated_rows(spark, generations):
    _, (old, _, _), _ = generations
    assert incremental.changed_companies(old, old).isEmpty()
    twice = FrameSource({n: old.table(n) for n in incremental.READS})
    twice.frames["simples"] = twice.frames["simples"].unionByName(twice.frames["simples"].limit(1))
    assert incremental.changed_companies(old, twice).count() == 1


def test_refresh_reads_no_whole_company_table_for_the_merge(spark, generations, tmp_path):
    """Without the base tables of the rest, the merge still gives the series."""
    root, (old, new, _), _ = generations
    companies = incremental.changed_companies(old, new)
    seen = []

    class Watched(PathSource):
        def load(self, name, columns):
            seen.append((name, columns))
            return super().load(name, columns)

    watched = [Watched(spark, f"{root}/g{n}") for n in range(2)]
    incremental.refresh_changed(
        spark, *watched, f"{root}/v0", f"{tmp_path}/v", ["abertura_periodo", "porte_cidade"], NEXT, FLOOR)
    # once for the comparison, once to set the rows of changed companies aside
    assert sum(name == "estabelecimento" for name, _ in seen) == 4
    share = old.table("estabelecimento").join(companies, "cnpj_basico", "left_semi").count()
    assert share < old.table("estabelecimento").count()


def test_full_build_where_merging_is_not_possible(spark, generations, tmp_path):
    root, (old, new, _), _ = generations
    only = ["stats_cnae_estado"]
    refresh = lambda stored, target, anchor, source=new: incremental.refresh_changed(
        spark, old, source, stored, f"{tmp_path}/{target}", only, anchor, FLOOR)
    assert refresh(f"{root}/none", "a", NEXT) == []
    assert refresh(f"{root}/v1", "b", ANCHOR - dt.timedelta(days=40)) == []
    cities = new.table("ibge_cidade").withColumn("nome_cidade", F.lit("other"))
    renamed = FrameSource({**{n: new.table(n) for n in (*incremental.READS, *incremental.DIMENSIONS)}, "ibge_cidade": cities})
    assert refresh(f"{root}/v0", "c", NEXT, renamed) == []
    assert refresh(f"{root}/v0", "d", NEXT) == ["mv_stats_cnae_estado"]
    want = values(graph.view(new, "mv_stats_cnae_estado", NEXT, FLOOR))
    for target in "abcd":
        assert values(spark.read.parquet(f"{tmp_path}/{target}/mv_stats_cnae_estado")) == want
    with pytest.raises(ValueError):
        incremental.refresh_changed(spark, old, new, f"{root}/v0", f"{root}/v0/", only, NEXT, FLOOR)


@pytest.mark.parametrize(
    "name",
    [
        "refresh_changed_territory", "refresh_changed_series", "refresh_changed_companies",
        "refresh_changed_ranking", "check_views_present", "build_views", "refresh_views",
    ],
)
def test_establishments_are_derived_once(spark, monkeypatch, name):
    """The joins that the test tables need run once a query, not once a view and rollup."""
    import entry_queries
    from civitas.model.driver_tables import DriverTables

    derived, plain = [], DriverTables._estabelecimento

    def counted(self, wanted):
        derived.append(wanted)
        return plain(self, wanted)

    monkeypatch.setattr(DriverTables, "_estabelecimento", counted)
    assert entry_queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    # the anchor reads one column of it as well
    assert len([w for w in derived if w != {"data_inicio_atividade"}]) == 1
