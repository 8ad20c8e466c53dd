"""The search table, its queries and the hot-key join."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.functions.text import normalize_name
from civitas.model.specs import spec
from civitas.operators import search as s
from civitas.operators.joins import hot_keys, lookup
from civitas.plans import lookups
from civitas.sources.sinks import write_table

EST = s.SEARCH_READS + ("uf", "email")


def est_rows(n=60):
    rows = []
    for i in range(n):
        root = "HOT" if i % 3 == 0 else f"R{i % 7}"
        rows.append((
            f"{i:014d}", root, None if i % 5 == 0 else f"Café {i}", 1, 10 + i % 2, 100 + i % 4,
            f"{i % 3:07d}", "02" if i % 2 else "08", "1" if i % 4 else "2",
            dt.date(2020, 1, 1) + dt.timedelta(i), "01000000", "11" if i % 2 else None,
            "21" if i % 3 else "11", "São João", "SP",
            [None, "", "a@b", "x@ContaBil"][i % 4],
        ))
    return rows


@pytest.fixture(scope="module")
def est(spark):
    return spark.createDataFrame(
        est_rows(), ", ".join(f"{c} {spec('estabelecimento')[c].dtype.simpleString()}" for c in EST)
    )


@pytest.fixture(scope="module")
def companies(spark):
    rows = [("HOT", "Ação S/A", "01", "2062", Decimal("10.00"))]
    rows += [(f"R{i}", f"Marca {i}", None, "2135", Decimal(i * 100)) for i in range(6)]  # R6 has none
    return spark.createDataFrame(
        rows, "cnpj_basico string, razao_social string, cod_porte string, "
        "cod_natureza_juridica string, capital_social decimal(16,2)")


@pytest.fixture(scope="module")
def busca(est, companies):
    return s.build_search_table(est, companies).cache()


def test_columns_and_hash(busca):
    assert len(busca.columns) == 18
    row = busca.filter("cnpj_completo = '00000000000003'").first()
    assert (row["razao_social_norm"], row["nome_fantasia_norm"], row["bairro_norm"]) == (
        "ACAO S/A", "CAFE 3", "SAO JOAO")
    text = "Ação S/A|Café 3|0000000|02|103|01|2062|2020-01-04|01000000|1"
    assert row["row_hash"] == hashlib.md5(text.encode()).hexdigest()


def test_establishments_without_a_company_stay(busca, est):
    assert busca.count() == est.count()
    assert busca.filter("cnpj_basico = 'R6'").first()["razao_social_norm"] is None


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_changes_nothing(spark, est, companies, how):
    hot = hot_keys(est, "cnpj_basico", share=0.2, min_rows=1)
    assert hot == ["HOT"]
    left, right = est.select("cnpj_completo", "cnpj_basico"), companies.select("cnpj_basico", "cod_porte")
    salted = lookup(left, right, "cnpj_basico", F.col("cnpj_completo"), hot, how)
    assert values(salted, "cnpj_completo", "cod_porte") == values(
        left.join(right, "cnpj_basico", how), "cnpj_completo", "cod_porte")


def test_hot_rows_are_spread(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("k"), "id")
    dim = fact.select("k").distinct().withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def largest(hot):
            joined = lookup(fact, dim, "k", F.col("id"), hot)
            sizes = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("v").alias("n"))
            return max(r["n"] for r in sizes.collect())

        assert largest([]) >= 1000 > largest(["HOT"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_tables_have_no_hot_keys(est):
    assert hot_keys(est, "cnpj_basico") == []


def test_prefix_and_substring(busca):
    got = [r["razao_social_norm"] for r in s.by_name_prefix(busca, "MARCA", "02").collect()]
    assert got == sorted(got) and len(got) == 17 and all(n.startswith("MARCA") for n in got)
    assert s.count_name_prefix(busca, "CAFE 1", "nome_fantasia_norm").first()[0] == 9
    assert s.by_name_substring(busca, "CAO").count() == 20
    assert s.by_name_prefix(busca, "CAO").count() == 0


def test_sorted_files_answer_a_prefix(spark, busca, tmp_path):
    write_table(busca, str(tmp_path), "busca", sort_by=("razao_social_norm",))
    stored = spark.read.parquet(f"{tmp_path}/busca")
    assert values(s.by_name_prefix(stored, "MARCA")) == values(s.by_name_prefix(busca, "MARCA"))


def test_pages_follow_each_other(busca, est):
    first = s.city_activity_page(busca, 101, "0000001", 0, 2)
    second = s.city_activity_page(busca, 101, "0000001", 2, 2)
    every = s.city_activity_page(busca, 101, "0000001", 0, 100)
    ids = [r["cnpj_completo"] for r in every.collect()]
    assert [r["cnpj_completo"] for r in first.collect()] == ids[:2]
    assert [r["cnpj_completo"] for r in second.collect()] == ids[2:4]
    after = s.keyset_page(est, "cod_estado_ibge", 11, ids[1], "02", 3)
    want = [f"{i:014d}" for i in range(60) if i % 2 and f"{i:014d}" > ids[1]][:3]
    assert [r["cnpj_completo"] for r in after.collect()] == want
    assert s.keyset_page(est, "cod_regiao_ibge", 1, size=100).count() == 60


def test_filters(spark, busca, companies):
    assert s.by_area_code(busca, "11").count() == 40
    regimes = spark.createDataFrame([("HOT", "S", "N"), ("R1", "N", "S")],
                                    "cnpj_basico string, opcao_simples string, opcao_mei string")
    assert s.search(busca, simples=True, regimes=regimes).count() == 20
    assert s.search(busca, mei=False, regimes=regimes).filter("cnpj_basico = 'R1'").count() == 0
    rich = s.search(busca, capital=(100, 200), companies=companies)
    assert {r[0] for r in rich.select("cnpj_basico").collect()} == {"R1", "R2"}
    few = s.search(busca, state=11, status="02", kind="1", opened_from=dt.date(2020, 1, 10),
                   opened_to=dt.date(2020, 2, 1), district="são", porte="01", cep="01000000")
    want = [i for i in range(60) if i % 2 and i % 4 and i % 3 == 0 and 9 <= i <= 31]
    assert values(few, "cnpj_completo") == [(f"{i:014d}",) for i in want]
    assert s.search(busca, city=101, cnae="0000001").count() == 5


def test_leads(est):
    assert s.leads(est, cnae="0000000", status="08").count() == 5
    by_city = s.leads(est, city=102, status="08")
    assert by_city.count() == 15
    assert s.leads(est, city=103, status="02").count() == 0  # only accounting offices there


def test_sitemaps(est):
    heads = [tuple(r) for r in s.state_head_offices(est, 11).collect()]
    assert heads == sorted(heads) and len(heads) == 30
    assert values(s.state_activities(est, 10, 10)) == [(f"{i:07d}", 10) for i in range(3)]
    assert s.state_activities(est, 10, 11).count() == 0
    assert sum(r["total"] for r in s.city_activities(est, 10).collect()) == 30


def test_secondary_activity(spark):
    rows = [("1", "A", 1, 10, 100), ("2", "A", 2, 20, 200), ("2", "B", 2, 20, 200)]
    sec = spark.createDataFrame(
        rows, "cnpj_completo string, cod_cnae string, cod_regiao_ibge int, cod_estado_ibge int, "
        "cod_cidade_ibge int")
    assert s.by_secondary_activity(sec, "A").count() == 2
    for place in ({"state": 20}, {"city": 200}, {"region": 2}):
        assert values(s.by_secondary_activity(sec, "A", **place), "cnpj_completo") == [("2",)]


def test_lookups(spark, est, companies):
    cities = spark.createDataFrame([(100, "C")], "cod_cidade_ibge int, nome_cidade string")
    row = lookups.by_full_id(est, companies, cities, "00000000000001").first()
    assert (row["razao_social"], row["nome_cidade"]) == ("Marca 1", None)
    kinds = {r["tipo"] for r in lookups.by_root(est, companies, "HOT").collect()}
    assert kinds == {"MATRIZ", "FILIAL"}


def test_growth_rank_puts_undefined_last(spark):
    rows = [("a", None), ("b", Decimal("-1.00")), ("c", Decimal("5.00"))]
    frame = spark.createDataFrame(
        [("brasil", 12, c, v) for c, v in rows],
        "nivel string, periodo_meses int, cod_cnae_principal string, "
        "aberturas_variacao_pct decimal(8,2)")
    got = lookups.activity_growth_rank(frame, "brasil", 12).collect()
    assert [r["cod_cnae_principal"] for r in got] == ["c", "b", "a"]


def test_normalised_search_term_matches_normalised_name(spark):
    frame = spark.createDataFrame([("ÇÃO",)], "c string")
    assert frame.select(normalize_name(F.col("c"))).first()[0] == "CAO"
