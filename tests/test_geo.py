"""Geographic lookup against a plain dictionary reading of the rules."""

import itertools

import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.model.specs import spec
from civitas.operators.geo import add_geo, city_spellings, geo_dimensions
from civitas.operators.ingest import explode_secondary

CITIES = [
    # ibge code, state, municipal code
    (1100205, 11, "0003"),
    (3550308, 35, "7107"),
    (3304557, 33, "0060010"),
    (5300108, 53, "97"),
    (4106902, 99, "0007535"),  # its state is not in the dimension
    (1200401, 12, "0000"),  # stripping leaves nothing
]
STATES = [(11, "RO", 1), (12, "AC", 1), (33, "RJ", 3), (35, "SP", 3), (53, "DF", 5), (41, "PR", 4)]
CODES = [None, "", " ", "3", "03", "003", "0003", "00003", "0000003", "7107", " 7107 ", "07107",
         "0007107", "60010", "060010", "0060010", "97", "0097", "0000097", "7535", "0007535",
         "0", "00", "0000", "0000000", "9999", "abc"]
STATE_CODES = [None, "", "SP", " sp ", "PR", "EX"]
COUNTRIES = [None, "", "105", " 0105 ", "23", "0"]


@pytest.fixture(scope="module")
def dims(spark):
    cities = spark.createDataFrame(
        [(c, f"city {c}", None, None, False, s, m, None, None) for c, s, m in CITIES],
        spec("ibge_cidade").schema,
    )
    states = spark.createDataFrame(
        [(c, uf, uf, None, None, r) for c, uf, r in STATES], spec("ibge_estado").schema
    )
    return cities, states


def expected(code, uf, country, guard):
    if guard and country and country.strip() not in ("105", "0105"):
        return None, None, None
    by_code = {}
    for city in CITIES:  # official codes first, so a stripped one never hides them
        by_code[city[2]] = city
    for city in CITIES:
        by_code.setdefault(city[2].lstrip("0"), city)
    by_state = {s[0]: s for s in STATES}
    by_uf = {s[1]: s for s in STATES}
    siafi = (code or "").strip()
    city = None
    if siafi:
        for form in (siafi, siafi.zfill(4), siafi.zfill(7)):
            city = city or by_code.get(form)
    state = by_state.get(city[1]) if city else None
    if state is None and uf:
        state = by_uf.get(uf.strip().upper())
    return (state[2] if state else None, state[0] if state else None, city[0] if city else None)


@pytest.mark.parametrize("guard", [True, False])
def test_every_combination(spark, dims, guard):
    rows = [(i, *r) for i, r in enumerate(itertools.product(CODES, STATE_CODES, COUNTRIES))]
    frame = spark.createDataFrame(rows, "i int, cod_municipio string, uf string, cod_pais string")
    got = {
        r["i"]: (r["cod_regiao_ibge"], r["cod_estado_ibge"], r["cod_cidade_ibge"])
        for r in add_geo(frame, *dims, guard_foreign=guard).collect()
    }
    assert len(got) == len(rows)
    assert got == {i: expected(c, uf, p, guard) for i, c, uf, p in rows}


def test_a_spelling_leads_to_one_city(spark):
    rows = [(2, "0100"), (1, "100"), (3, "0000100")]
    cities = spark.createDataFrame(
        [(c, "x", None, None, False, 1, m, None, None) for c, m in rows], spec("ibge_cidade").schema
    )
    table = city_spellings(cities)
    assert table.groupBy("spelling").count().filter("count > 1").count() == 0
    found = dict(values(table, "spelling", "cod_cidade_ibge"))
    assert found["0100"] == 2 and found["100"] == 1 and found["0000100"] == 3


def test_dimensions_keep_one_row_per_code(spark, dims):
    cities, states = dims
    regions = spark.createDataFrame([(1, "N", "Norte"), (1, "N", "Again")], spec("ibge_regiao").schema)
    doubled = cities.unionByName(cities.withColumn("nome_cidade", F.lit("zz"))).unionByName(
        cities.withColumn("cod_municipio", F.lit(" ")).withColumn("cod_cidade_ibge", F.lit(5))
    )
    out = geo_dimensions(regions, states, doubled)
    assert values(out["ibge_regiao"], "nome_regiao") == [("Again",)]
    assert out["ibge_cidade"].count() == len(CITIES)
    assert out["ibge_cidade"].filter("nome_cidade = 'zz'").count() == 0


def test_explode_secondary(spark, dims):
    columns = ("cnpj_basico cnpj_ordem cnpj_dv uf cod_municipio data_inicio_atividade "
               "cod_cnae_secundario").split()
    rows = [
        ("1", "2", "3", "SP", "7107", "20200101", "1, 2,,3"),
        ("2", "2", "3", "SP", "7107", "20200101", ""),
        ("3", "2", "3", "EX", None, "20200101", "5,5"),
        ("4", "2", "3", "EX", None, "20200101", None),
        ("5", "2", "3", "EX", None, "20200101", " , "),
    ]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = values(explode_secondary(frame, *dims))
    assert got == [
        ("00000001000203", "1", 3, 35, 3550308, "20200101"),
        ("00000001000203", "2", 3, 35, 3550308, "20200101"),
        ("00000001000203", "3", 3, 35, 3550308, "20200101"),
        ("00000003000203", "5", None, None, None, "20200101"),
        ("00000003000203", "5", None, None, None, "20200101"),
    ]


def test_a_repeated_abbreviation_does_not_multiply_rows(spark):
    cities = spark.createDataFrame([], spec("ibge_cidade").schema)
    states = spark.createDataFrame(
        [(36, "SP", "b", None, None, 4), (35, "SP", "a", None, None, 3)], spec("ibge_estado").schema)
    rows = spark.createDataFrame([("x", "SP", None)], "cod_municipio string, uf string, cod_pais string")
    found = add_geo(rows, cities, states)
    assert values(found, "cod_estado_ibge", "cod_regiao_ibge") == [(35, 3)]
