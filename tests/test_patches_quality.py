"""Reference-data patches and the checks."""

import datetime as dt
from decimal import Decimal

from frames import values
from pyspark.sql import functions as F

from civitas.model.source import FrameSource
from civitas.model.specs import TABLES, spec
from civitas.operators import patches, quality

COMPANY = "cnpj_basico string, razao_social string, cod_porte string, line int"


def frame_of(spark, name, rows):
    return spark.createDataFrame(rows, spec(name).schema)


def test_insert_if_missing_keeps_the_existing_row(spark):
    got = dict(values(patches.insert_if_missing(
        frame_of(spark, "pais", [("150", "OLD"), ("105", "BRASIL")]), patches.MISSING_COUNTRIES,
        "cod_pais")))
    assert len(got) == 19 and got["150"] == "OLD" and got["737"] == "SERVIA"


def test_country_codes(spark):
    frame = spark.createDataFrame([("23",), ("0",), ("105",), (None,), (" 7",)], "cod_pais string")
    out = patches.null_zero_country(patches.pad_country(frame))
    assert [r[0] for r in out.collect()] == ["023", None, "105", None, " 7"]


def test_fill_porte_keeps_null_apart_from_empty(spark):
    frame = spark.createDataFrame([("",), (None,), ("03",)], "cod_porte string")
    assert [r[0] for r in patches.fill_porte(frame).collect()] == ["00", None, "03"]
    assert [r[0] for r in patches.fill_porte(frame, True).collect()] == ["00", "00", "03"]


def test_absorb_orphans(spark):
    dim = frame_of(spark, "pais", [("105", "BRASIL")])
    first = spark.createDataFrame([("042",), ("105",), (None,), ("042",)], "c string")
    second = spark.createDataFrame([("042",), ("755",)], "c string")
    full, added = patches.absorb_orphans(dim, [(first, "c"), (second, "c")], "cod_pais", "nome_pais")
    assert values(added) == [("042", patches.UNKNOWN_COUNTRY), ("755", patches.UNKNOWN_COUNTRY)]
    assert full.count() == 3


def test_dedup_company_prefers_a_name_then_the_first_line(spark):
    rows = [
        ("1", " ", "01", 1), ("1", "B", "01", 3), ("1", "A", "01", 5),
        ("2", None, None, 9), ("2", "", "03", 7),
        ("3", "ONLY", None, 1),
    ]
    frame = spark.createDataFrame(rows, COMPANY)
    got = values(patches.dedup_company(frame, ("line",)))
    assert got == [("1", "B", "01", 3), ("2", "", "03", 7), ("3", "ONLY", None, 1)]


def test_dedup_company_does_not_depend_on_partitions(spark):
    rows = [(str(i % 7), None if i % 3 else f"N{i % 5}", str(i % 4), i % 11) for i in range(500)]
    frame = spark.createDataFrame(rows, COMPANY)
    whole = values(patches.dedup_company(frame))
    assert whole == values(patches.dedup_company(frame.repartition(13)))
    assert whole == values(patches.dedup_company(frame.coalesce(1)))
    best = {}
    for row in rows:
        name_missing = int(row[1] is None or not row[1].strip())
        rank = (name_missing, *[(v is None, v if v is not None else "") for v in row[1:]])
        if row[0] not in best or rank < best[row[0]][0]:
            best[row[0]] = (rank, row)
    assert whole == sorted(r for _, r in best.values())


def test_drop_keys_keeps_null_keys(spark):
    frame = spark.createDataFrame([("24417449",), ("1",), (None,)], "k string")
    assert values(patches.drop_keys(frame, "k", patches.ORPHAN_REGIME_ROOTS)) == [(None,), ("1",)]


def test_padding_comes_before_absorbing(spark):
    tables = {
        "pais": frame_of(spark, "pais", [("023", "ALEMANHA"), ("105", "BRASIL")]),
        "qualificacao_socio": frame_of(spark, "qualificacao_socio", [("10", "Diretor")]),
        "motivo": frame_of(spark, "motivo", [("01", "x")]),
        "estabelecimento": spark.createDataFrame([("23",), ("0",), ("042",)], "cod_pais string"),
        "empresa": spark.createDataFrame([("1", "A", "", 1), ("1", " ", "01", 2)], COMPANY),
        "simples": spark.createDataFrame([("24539162",), ("1",)], "cnpj_basico string"),
        "socio": spark.createDataFrame([("755",)], "cod_pais string"),
        "cnae": frame_of(spark, "cnae", []),
    }
    out = patches.apply_patches(tables)
    codes = {r[0] for r in out["pais"].select("cod_pais").collect()}
    assert {"023", "042", "755"} <= codes and not {"23", "0"} & codes
    assert values(out["empresa"]) == [("1", "A", "00", 1)]
    assert values(out["simples"]) == [("1",)] and out["motivo"].count() == 4
    assert out["cnae"] is tables["cnae"]


def test_column_checks(spark):
    frame = frame_of(spark, "pais", [("1", None), ("12345", "x" * 61), (None, "ok")])
    assert values(quality.check_not_null(frame, spec("pais"))) == [
        ("pais", "cod_pais", 1), ("pais", "nome_pais", 1)]
    assert values(quality.check_length(frame, spec("pais"))) == [
        ("pais", "cod_pais", 1), ("pais", "nome_pais", 1)]


def test_unique_exempts_null_unless_strict(spark):
    frame = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1)], "k string, n int")
    assert values(quality.check_unique(frame, ["k", "n"])) == [("b", 1, 2)]
    assert len(values(quality.check_unique(frame, ["k", "n"], strict_nulls=True))) == 2


def registry(spark, **rows):
    return FrameSource({n: frame_of(spark, n, rows.get(n, [])) for n in TABLES})


PARTNER = ("00000000", "2", "X", None, "99", dt.date(2020, 1, 1), "999", None, None, None, "1")


def test_orphan_partner_fails_its_edges_and_no_other(spark):
    found = {
        (r["table"], r["column"]): r["orphans"]
        for r in quality.check_fk(registry(spark, socio=[PARTNER, PARTNER])).collect()
    }
    assert len(found) == 18
    assert {k for k, n in found.items() if n} == {
        ("socio", "cnpj_basico"), ("socio", "cod_pais"), ("socio", "cod_qualificacao_socio")}
    assert found["socio", "cnpj_basico"] == 2


def test_referential_report(spark):
    report = {r["fk_name"]: (r["orphan_count"], r["status"])
              for r in quality.referential_report(registry(spark, socio=[PARTNER])).collect()}
    assert report == {"fk_estab_empresa": (0, "OK"), "fk_estab_cnae": (0, "OK"),
                      "fk_socio_empresa": (1, "AVISO: Sócios órfãos")}


def test_id_checks(spark):
    rows = [("12345678000100", "12345678", "0001", "00"), ("123", "12345678", "0001", "00"),
            (None, "1", "1", "1"), ("", "1", "1", "1")]
    frame = spark.createDataFrame(
        rows, "cnpj_completo string, cnpj_basico string, cnpj_ordem string, cnpj_dv string")
    both = FrameSource({"estabelecimento": frame, "estabelecimento_cnae_sec": frame.limit(1)})
    assert [r["count"] for r in quality.check_id_nulls(both).collect()] == [2, 0]
    assert quality.check_id_format(frame).first()["count"] == 2
    row = quality.check_id_consistency(frame).first()
    assert (row["count"], row["status"]) == (2, "AVISO: Inconsistências encontradas")


def test_floor_views_and_counts(spark):
    ten = spark.range(10)
    assert quality.check_row_floor(ten, 10).first()["passed"]
    assert not quality.check_row_floor(ten).first()["passed"]
    views = {"full": ten, "empty": ten.limit(0)}
    assert values(quality.check_views(views)) == [("empty", True), ("full", False)]
    assert quality.check_count_match(ten, ten).first() == (10, 10, True)
    assert quality.check_count_match(ten, ten.limit(0)).first() == (10, 0, False)


def test_sanity_checks_find_planted_faults(spark):
    comparison = spark.createDataFrame(
        [("brasil", 0, 12, 10, 0, Decimal("1.00")), ("regiao", 0, 12, 10, 1, None),
         ("estado", 1, 12, 9, 1, None)],
        "nivel string, cod_estado_ibge int, periodo_meses int, aberturas_atual bigint, "
        "aberturas_anterior bigint, aberturas_variacao_pct decimal(8,2)")
    states = spark.createDataFrame([(1, 8)], "cod_estado_ibge int, novos_1ano bigint")
    assert quality.sanity_12m(comparison, states).first()[0] == 1
    assert quality.sanity_levels(comparison).first() == (12, 10, 10, 9, True)
    assert quality.sanity_null_variation(comparison).first()[0] == 1
    one = spark.createDataFrame([(dt.date(2020, 1, 1),)], "mes_ancora date")
    two = spark.createDataFrame([(dt.date(2020, 2, 1),)], "mes_ancora date")
    assert quality.sanity_anchor({"a": one, "b": one}).first()[0] == 1
    assert quality.sanity_anchor({"a": one, "b": two}).first()[0] == 2
    base = spark.createDataFrame(
        [("08", dt.date(2001, 1, 1)), ("08", None), ("02", dt.date(2001, 1, 1))],
        "cod_situacao_cadastral string, data_situacao_cadastral date")
    series = spark.range(1).select(F.lit(3).cast("bigint").alias("baixas"))
    assert quality.sanity_closings(series, base).first() == (3, 1, 2)


def test_foreign_keys_read_each_child_once(spark):
    from civitas.model.source import FrameSource
    from civitas.model.specs import ForeignKey, TableSpec, text

    part = TableSpec("part", "P", (text("id"),), ("id",))
    child = TableSpec("child", "C", (text("a"), text("b")), (), (ForeignKey("a", "part", "id"), ForeignKey("b", "part", "id")))
    rows = [("1", "1")] * 50 + [("2", None), ("9", "3"), (None, "3")]
    frames = {
        "part": spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "id string"),
        "child": spark.createDataFrame(rows, "a string, b string"),
    }
    loads = []

    class Watched(FrameSource):
        def load(self, name, columns):
            loads.append(name)
            return super().load(name, columns)

    got = quality.check_fk(Watched(frames), {"part": part, "child": child})
    assert values(got) == [("child", "a", "part", 1), ("child", "b", "part", 2)]
    assert sorted(loads) == ["child", "part"]
