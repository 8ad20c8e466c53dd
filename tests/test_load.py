"""A month from ZIP archives to a published generation."""

import datetime as dt
from decimal import Decimal

import pytest
from frames import values
from pyspark.sql import functions as F
from test_ingest import make_zip

from civitas.functions.sql import register_functions
from civitas.model.specs import spec
from civitas.operators.generations import Generation, GenerationStore
from civitas.plans import load
from civitas.plans.graph import VIEWS


def establishment(basico, ordem, name, **cells):
    row = dict.fromkeys(spec("estabelecimento").file_schema.fieldNames(), "")
    row.update(
        cnpj_basico=basico, cnpj_ordem=ordem, cnpj_dv="00", matriz_filial="1" if ordem == "0001" else "2",
        nome_fantasia=name, cod_situacao_cadastral="02", data_situacao_cadastral="20240105",
        cod_motivo_situacao_cadastral="01", data_inicio_atividade="20240105",
        cod_cnae_principal="0111301", uf="SP", cod_municipio="7107", **cells)
    return list(row.values())


def write_month(folder):
    make_zip(folder / "Cnaes.zip", {"a": [("0111301", "Arroz"), ("0111302", "Milho")]})
    make_zip(folder / "Motivos.zip", {"a": [("01", "Ativa")]})
    make_zip(folder / "Municipios.zip", {"a": [("7107", "SAO PAULO")]})
    make_zip(folder / "Naturezas.zip", {"a": [("2062", "Limitada")]})
    make_zip(folder / "Paises.zip", {"a": [("105", "BRASIL")]})
    make_zip(folder / "Qualificacoes.zip", {"a": [("10", "Diretor")]})
    make_zip(folder / "Empresas0.zip", {"a": [
        ("1", "", "2062", "10", "1.000,00", "", ""),
        ("1", "Ação Ltda", "2062", "10", "1.000,00", "", ""),
        ("2", "Beta", "2062", "10", "5,5", "01", ""),
    ]})
    make_zip(folder / "Empresas1.zip", {"a": [("3", "Gama", "", "10", "1,0", "01", "")]})
    make_zip(folder / "Estabelecimentos0.zip", {
        "a": [
            establishment("1", "0001", "São José", cod_cnae_secundario="0111302, 0111301,"),
            establishment("1", "0002", "Filial", cod_pais="23"),
            establishment("2", "0001", "Beta\x91"),
        ],
        "b": [establishment("2", "0002", "Ruim", numero="1234567")],
    })
    make_zip(folder / "Simples.zip", {"a": [("1", "S", "20240105", "00000000", "N", "", "")]})
    make_zip(folder / "Socios.zip", {"a": [
        ("1", "2", "Ana", "***1***", "10", "20240105", "042", "", "", "", "4")]})
    make_zip(folder / "Leiame.zip", {"a": [("x",)]})


@pytest.fixture(scope="module")
def dimensions(spark):
    return {
        "ibge_regiao": spark.createDataFrame([(3, "SE", "Sudeste")], spec("ibge_regiao").schema),
        "ibge_estado": spark.createDataFrame(
            [(35, "SP", "São Paulo", None, None, 3)], spec("ibge_estado").schema),
        "ibge_cidade": spark.createDataFrame(
            [(3550308, "São Paulo", None, None, True, 35, "7107", "11", "x")],
            spec("ibge_cidade").schema),
    }


def test_month_to_generation(spark, tmp_path, dimensions):
    folder, served = tmp_path / "zips", tmp_path / "served"
    folder.mkdir()
    write_month(folder)
    generation = f"{served}/dados_202402"
    anchor = dt.date(2024, 1, 1)
    metrics, unknown = load.complete_month(
        spark, str(folder), generation, dimensions, anchor=anchor)
    assert [u.rsplit("/", 1)[-1] for u in unknown] == ["Leiame.zip"]
    counts = {r["table"]: (r["rows_loaded"], r["rows_failed"]) for r in metrics.collect()}
    assert counts["empresa"] == (3, 1) and counts["estabelecimento"] == (3, 1)
    assert counts["estabelecimento_cnae_sec"] == (2, 0)

    def table(name):
        return spark.read.parquet(f"{generation}/{name}")

    assert values(table("empresa"), "cnpj_basico", "razao_social", "capital_social") == [
        ("1", "Ação Ltda", Decimal("1000.00")), ("2", "Beta", Decimal("5.50"))]
    assert values(table("estabelecimento"), "cnpj_completo", "cod_pais", "cod_cidade_ibge") == [
        ("00000001000100", None, 3550308), ("00000001000200", "023", None),
        ("00000002000100", None, 3550308)]
    assert {"023", "042"} <= {r[0] for r in table("pais").select("cod_pais").collect()}
    assert table("_chaves").filter("orphans > 0").count() == 0
    assert table(load.SEARCH_TABLE).filter("nome_fantasia_norm = 'SAO JOSE'").count() == 1
    for view in VIEWS:
        assert table(view) is not None
    assert table("mv_stats_estado").first()["novos_1mes"] == 2

    store = GenerationStore(spark, str(served))
    views = {v: table(v) for v in ("mv_stats_estado", "mv_stats_cnae")}
    new = Generation(table("estabelecimento"), views, table(load.SEARCH_TABLE))
    assert store.publish("202402", new, None, minimum=3)
    spark.sql("CREATE DATABASE IF NOT EXISTS vigente")
    store.serve("vigente", ["mv_stats_estado", load.SEARCH_TABLE])
    assert spark.table(f"vigente.{load.SEARCH_TABLE}").count() == 3


def test_parked_rows_of_a_month_load_after_correction(spark, tmp_path, dimensions):
    (tmp_path / "zips").mkdir()
    write_month(tmp_path / "zips")
    generation = f"{tmp_path}/g"
    load.complete_month(spark, str(tmp_path / "zips"), generation, dimensions, anchor=dt.date(2024, 1, 1))
    parked = spark.read.parquet(f"{generation}/_quarentena")
    fixed = parked.withColumn("payload", F.replace("payload", F.lit('"1234567"'), F.lit('"12"')))
    fixed.write.parquet(f"{tmp_path}/fixed")
    spark.read.parquet(f"{tmp_path}/fixed").write.mode("overwrite").parquet(f"{generation}/_quarentena")
    assert load.retry_parked(spark, generation, "estabelecimento").first() == (1, 1, 0)
    table = spark.read.parquet(f"{generation}/estabelecimento")
    assert values(table.filter("numero = '12'"), "cnpj_completo", "cod_cidade_ibge") == [
        ("00000002000200", 3550308)]
    after = spark.read.parquet(f"{generation}/_quarentena")
    assert values(after, "table", "status") == [("empresa", "pending"), ("estabelecimento", "processed")]
    assert load.retry_parked(spark, generation, "estabelecimento").first() == (0, 0, 0)


def test_a_missing_archive_fails_the_month(spark, tmp_path, dimensions):
    write_month(tmp_path)
    (tmp_path / "Simples.zip").unlink()
    with pytest.raises(load.MissingArchive, match="simples"):
        load.complete_month(spark, str(tmp_path), f"{tmp_path}/g", dimensions, anchor=dt.date(2024, 1, 1))


def test_a_repeated_regime_row_fails_the_month(spark, tmp_path, dimensions):
    write_month(tmp_path)
    row = ("1", "S", "20240105", "00000000", "N", "", "")
    make_zip(tmp_path / "Simples.zip", {"a": [row, row]})
    with pytest.raises(load.KeysBroken, match="simples"):
        load.complete_month(spark, str(tmp_path), f"{tmp_path}/g", dimensions, anchor=dt.date(2024, 1, 1))


def test_whole_file_mode(spark, tmp_path, dimensions):
    write_month(tmp_path)
    metrics, _ = load.load_month(
        spark, str(tmp_path), str(tmp_path / "out"), dimensions["ibge_cidade"],
        dimensions["ibge_estado"], granularity="file")
    counts = {r["table"]: (r["rows_loaded"], r["rows_failed"]) for r in metrics.collect()}
    assert counts["empresa"] == (3, 1) and counts["estabelecimento"] == (0, 4)


def test_an_empty_folder_is_an_error(spark, tmp_path, dimensions):
    make_zip(tmp_path / "Leiame.zip", {"a": [("x",)]})
    with pytest.raises(FileNotFoundError):
        load.load_month(spark, str(tmp_path), str(tmp_path / "out"), dimensions["ibge_cidade"],
                        dimensions["ibge_estado"])


def test_sql_functions(spark):
    spark.createDataFrame([("a", "2026-07", dt.datetime(2026, 7, 1))],
                          "run_id string, reference_period string, started_at timestamp"
                          ).write.mode("overwrite").saveAsTable("pipeline_stats")
    spark.createDataFrame([(dt.date(2099, 1, 1),)], "data_inicio_atividade date").write.mode(
        "overwrite").saveAsTable("estabelecimento")
    register_functions(spark)
    row = spark.sql("SELECT fn_variacao_pct(150, 100), fn_variacao_pct(1000000000, 1), "
                    "fn_variacao_pct(5, 0), fn_sobrevivencia_pct(1, 3), fn_sobrevivencia_pct(0, 0), "
                    "fn_mes_ancora()").first()
    assert tuple(row) == (Decimal("50.00"), Decimal("999999.99"), None, Decimal("33.33"), None,
                          dt.date(2026, 6, 1))
    assert spark.range(3).select(F.expr("fn_variacao_pct(id, 1)")).count() == 3
