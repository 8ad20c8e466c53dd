import json
"""Archives to tables: reading, cleaning, quarantine and retry."""

import csv
import datetime as dt
import io
import zipfile
from decimal import Decimal

import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.functions.text import empty_to_null
from civitas.model.specs import TABLES, spec
from civitas.operators.ingest import transform_table
from civitas.operators.quarantine import (
    list_quarantine,
    load_metrics,
    retry_quarantine,
    split_valid,
)
from civitas.sources import files, sinks
from civitas.sources.zip_csv import list_archives, read_zip_csv


def make_zip(path, members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, rows in members.items():
            text = io.StringIO()
            csv.writer(text, delimiter=";", quoting=csv.QUOTE_ALL).writerows(rows)
            archive.writestr(name, text.getvalue().encode("latin1"))


HEALTHY = [("0111301", "Cultivo de arroz"), ("0111302", "Cultivo de milho"),
           ("0111303", "Cultivo de trigo")]
POISONED = [("0111301", "Cultivo de arroz"), ("0111302", "")]


def read_cnaes(spark, folder):
    return read_zip_csv(spark, f"{folder}/Cnaes*.zip", spec("cnae").file_schema)


def test_reads_every_member_of_every_archive(spark, tmp_path):
    make_zip(tmp_path / "Cnaes0.zip", {"a.CNAECSV": HEALTHY, "b.CNAECSV": [("9", 'A; "B"\nç\x91')]})
    make_zip(tmp_path / "cnaes1.ZIP", {"c.CNAECSV": [("8",), ("7", "x", "extra")]})
    assert len(list_archives(f"{tmp_path}/Cnaes*.zip")) == 2
    frame = read_cnaes(spark, tmp_path)
    assert frame.rdd.getNumPartitions() == 3
    got = values(frame, "cod_cnae", "nome_cnae", "_source_file", "_member", "_line", "_fields")
    assert ("9", 'A; "B"\nç\x91', "Cnaes0.zip", "b.CNAECSV", 1, 2) in got
    assert ("8", None, "cnaes1.ZIP", "c.CNAECSV", 1, 1) in got
    assert ("7", "x", "cnaes1.ZIP", "c.CNAECSV", 2, 3) in got
    assert len(got) == 6


def test_large_member_is_streamed_in_batches(spark, tmp_path):
    rows = [(f"{i:07d}", f"nome {i}") for i in range(45_001)]
    make_zip(tmp_path / "Cnaes.zip", {"a": rows})
    frame = read_cnaes(spark, tmp_path)
    assert frame.agg(F.max("_line"), F.count("*"), F.count_distinct("cod_cnae")).first() == (
        45_001, 45_001, 45_001,
    )


# quoted line breaks, doubled quotes, empty and missing cells, quotes inside cells
AWKWARD = (
    '"1";"a\nb"\n"2";"c ""d"" e"\n\n3;\n;\n"";""\n4;5" tube;x\n"5";"f"g;h"\n \n"6"\r\n'
    '7; "i"\n"8";"j;k\r\nl"\n"9";"""m"""\n10;"ção"\n""""""\n"11";"\n\n;"";\n"\n'
)


@pytest.mark.parametrize("block_chars", [1, 7, 40, 1 << 20])
@pytest.mark.parametrize("tail", ["", "last;one", '12;"left open\n13;x'])
def test_blocks_parse_like_the_csv_module(spark, tmp_path, block_chars, tail):
    """Wherever the borders of blocks fall, also within quotes."""
    content = AWKWARD * 3 + tail
    with zipfile.ZipFile(tmp_path / "Cnaes.zip", "w") as archive:
        archive.writestr("a", content.encode("latin1"))
    frame = read_zip_csv(
        spark, f"{tmp_path}/Cnaes.zip", spec("cnae").file_schema, spread=3, block_chars=block_chars
    )
    got = [tuple(r) for r in frame.orderBy("_line").drop("_source_file", "_member").collect()]
    rows = csv.reader(io.StringIO(content, newline=None), delimiter=";")
    assert got == [
        ((*row, None, None)[0], (*row, None, None)[1], number, len(row))
        for number, row in enumerate(rows, 1)
    ]


def test_blocks_are_parsed_after_they_are_dealt_out(spark, tmp_path):
    """One member, several parsing tasks; no cell passes through Python on the way."""
    rows = [(f"{i:07d}", "nome; com\nquebra" if i % 3 == 0 else f"nome {i}") for i in range(20_000)]
    make_zip(tmp_path / "Cnaes.zip", {"a": rows})
    frame = read_zip_csv(
        spark, f"{tmp_path}/Cnaes.zip", spec("cnae").file_schema, spread=4, block_chars=20_000
    )
    sizes = frame.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and sum(r[1] for r in sizes) == 20_000
    assert sorted(tuple(r) for r in frame.select("cod_cnae", "nome_cnae").collect()) == rows
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") + plan.count("csvtostructs") == 1
    assert plan.index("csv") < plan.index("Repartition 4")


def test_spread_keeps_rows(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": HEALTHY})
    frame = read_zip_csv(spark, f"{tmp_path}/Cnaes.zip", spec("cnae").file_schema, spread=5)
    assert frame.rdd.getNumPartitions() == 5 and frame.count() == 3


def test_broken_archive_fails_the_load(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": [(f"{i:07d}", "x" * 50 + str(i)) for i in range(5000)]})
    data = bytearray((tmp_path / "Cnaes.zip").read_bytes())
    data[200:260] = b"\x00" * 60
    (tmp_path / "Cnaes.zip").write_bytes(bytes(data))
    with pytest.raises(Exception):
        read_cnaes(spark, tmp_path).count()
    rows = read_zip_csv(
        spark, f"{tmp_path}/Cnaes.zip", spec("cnae").file_schema, on_error="quarantine"
    )
    good, bad = split_valid(transform_table(rows, "cnae"), spec("cnae"), "file")
    assert good.count() == 0 and values(bad, "source_file")[0] == ("Cnaes.zip",)


def test_healthy_load(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": HEALTHY})
    good, bad = split_valid(transform_table(read_cnaes(spark, tmp_path), "cnae"), spec("cnae"))
    assert values(good) == sorted(HEALTHY) and bad.count() == 0


@pytest.mark.parametrize("granularity, loaded, parked", [("row", 1, 1), ("file", 0, 2)])
def test_poisoned_load(spark, tmp_path, granularity, loaded, parked):
    make_zip(tmp_path / "Cnaes0.zip", {"a": POISONED})
    rows = transform_table(read_cnaes(spark, tmp_path), "cnae")
    good, bad = split_valid(rows, spec("cnae"), granularity)
    assert (good.count(), bad.count()) == (loaded, parked)
    assert values(list_quarantine(bad)) == [("cnae", "Cnaes0.zip", parked)]


def test_only_the_bad_file_is_parked(spark, tmp_path):
    make_zip(tmp_path / "Cnaes0.zip", {"a": POISONED})
    make_zip(tmp_path / "Cnaes1.zip", {"a": [("0000001", "ok")]})
    rows = transform_table(read_cnaes(spark, tmp_path), "cnae")
    good, bad = split_valid(rows, spec("cnae"), "file")
    assert values(good) == [("0000001", "ok")] and bad.count() == 2


def test_unknown_source_file_is_one_file(spark):
    frame = spark.createDataFrame([("1", "a"), ("2", None)], "cod_cnae string, nome_cnae string")
    good, bad = split_valid(frame, spec("cnae"), "file")
    assert (good.count(), bad.count()) == (0, 2)


def test_quarantine_cycle(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": POISONED})
    rows = transform_table(read_cnaes(spark, tmp_path), "cnae")
    good, bad = split_valid(rows, spec("cnae"), "row")
    metrics = load_metrics({"cnae": good}, bad)
    assert values(metrics) == [("cnae", 1, 1, 1, True)]

    loaded, still, counts = retry_quarantine(bad, spec("cnae"))
    assert counts.first() == (1, 0, 1) and loaded.count() == 0

    fixed = bad.withColumn("payload", F.lit('{"cod_cnae":"0111302","nome_cnae":"Milho"}'))
    loaded, marked, counts = retry_quarantine(fixed, spec("cnae"))
    assert counts.first() == (1, 1, 0)
    assert values(loaded) == [("0111302", "Milho")]
    assert values(marked, "status") == [("processed",)]
    assert list_quarantine(marked).count() == 0
    assert retry_quarantine(marked, spec("cnae"))[2].first() == (0, 0, 0)


def test_quarantine_of_other_tables_is_untouched(spark):
    frame = spark.createDataFrame([("1", None)], "cod_cnae string, nome_cnae string")
    _, bad = split_valid(frame, spec("cnae"))
    _, kept, counts = retry_quarantine(bad, spec("pais"))
    assert kept.count() == 1 and counts.first() == (0, 0, 0)


def test_company_types_and_reasons(spark):
    columns = spec("empresa").file_schema.fieldNames()
    rows = [
        ("1", " ACME\x91 ", "2062", "10", "1.234,56", "", ""),
        ("2", "B", "2062", "10", "x9", "01", None),
        ("3", "C" * 201, "2062", "10", "7", "01", None),
        ("4", "D", None, "10", "-1,0", "01", None),
    ]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    good, bad = split_valid(transform_table(frame, "empresa"), spec("empresa"))
    assert [tuple(r) for r in good.collect()] == [
        ("1", "ACME", "2062", "10", Decimal("1234.56"), None, None)
    ]
    reasons = {tuple(r) for r in bad.select(F.explode("errors")).collect()}
    assert reasons == {
        ("capital_social: not a number: x9",),
        ("capital_social: not a number: -1,0",),
        ("capital_social: missing",),
        ("razao_social: longer than 200",),
        ("cod_natureza_juridica: missing",),
    }


def test_unreadable_date_is_parked_and_an_impossible_one_is_null(spark):
    columns = spec("simples").file_schema.fieldNames()
    row = ("1", "S", "20230230", "00000000", "N", "abc", "2023-02-28")
    frame = spark.createDataFrame([row, ("2", *row[1:5], "0", row[6])],
                                  ", ".join(f"{c} string" for c in columns))
    good, bad = split_valid(transform_table(frame, "simples"), spec("simples"))
    assert values(good) == [("2", "S", None, None, "N", None, dt.date(2023, 2, 28))]
    assert bad.first()["errors"] == ["data_opcao_mei: not a date: abc"]


def test_short_line_is_null_at_its_end(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": [("0111301",)]})
    rows = transform_table(read_cnaes(spark, tmp_path), "cnae")
    assert split_valid(rows, spec("cnae"))[1].first()["errors"] == [
        "fields: 1 instead of 2", "nome_cnae: missing"]


def test_long_line_is_parked_with_its_text(spark, tmp_path):
    make_zip(tmp_path / "Cnaes.zip", {"a": [("0111301", " Arroz\x91", "x"), ("0111302", "Milho")]})
    good, bad = split_valid(transform_table(read_cnaes(spark, tmp_path), "cnae"), spec("cnae"))
    assert values(good) == [("0111302", "Milho")]
    row = bad.first()
    assert row["errors"] == ["fields: 3 instead of 2"]
    assert json.loads(row["payload"]) == {"cod_cnae": "0111301", "nome_cnae": " Arroz\x91"}


def test_retry_runs_the_whole_chain(spark):
    columns = spec("empresa").file_schema.fieldNames()
    row = ("1", "A", "2062", "10", "x", "01", None)
    frame = spark.createDataFrame([row], ", ".join(f"{c} string" for c in columns))
    _, bad = split_valid(transform_table(frame, "empresa"), spec("empresa"))
    fixed = bad.withColumn("payload", F.replace("payload", F.lit('"x"'), F.lit('"1.234,56"')))
    loaded, _, counts = retry_quarantine(fixed, spec("empresa"))
    assert loaded.first()["capital_social"] == Decimal("1234.56")
    assert counts.first() == (1, 1, 0)
    columns = spec("simples").file_schema.fieldNames()
    frame = spark.createDataFrame([("1", "S", "abc", "", "N", "", "")], ", ".join(f"{c} string" for c in columns))
    _, bad = split_valid(transform_table(frame, "simples"), spec("simples"))
    fixed = bad.withColumn("payload", F.replace("payload", F.lit('"abc"'), F.lit('"20240105"')))
    loaded, _, _ = retry_quarantine(fixed, spec("simples"))
    assert loaded.first()["data_opcao_simples"] == dt.date(2024, 1, 5)


def test_damaged_file_is_parked_as_a_whole(spark):
    frame = spark.createDataFrame(
        [("0111301", "a", "F", 2), (None, None, "F", -1), ("0111302", "b", "G", 2)],
        "cod_cnae string, nome_cnae string, _source_file string, _fields int")
    good, bad = split_valid(transform_table(frame, "cnae"), spec("cnae"), park_damaged=True)
    assert values(good) == [("0111302", "b")]
    assert values(bad, "source_file") == [("F",), ("F",)]


def test_extracted_file(spark, tmp_path):
    path = tmp_path / "K.CNAECSV"
    path.write_bytes('"1";"A; ""B"" ç"\r\n"2";""\r\n'.encode("latin1"))
    frame = empty_to_null(files.read_table(spark, "cnae", str(path)))
    assert values(frame) == [("1", 'A; "B" ç'), ("2", None)]


@pytest.mark.parametrize("sep", [",", ";"])
def test_dimension_csv_with_bom_and_aliases(spark, tmp_path, sep):
    path = tmp_path / "states.csv"
    lines = [
        sep.join(("ibge_code", "abbreviation", "name", "latitude", "longitude", "region_id")),
        sep.join(("11", " RO ", "Rondônia", "-10.83", "-63.34", "1")),
        sep.join(("12", "AC", "Acre", "", "-70.55", "1")),
    ]
    path.write_text("﻿" + "\n".join(lines), encoding="utf-8")
    assert values(files.read_dimension(spark, "ibge_estado", str(path))) == [
        (11, "RO", "Rondônia", Decimal("-10.830000"), Decimal("-63.340000"), 1),
        (12, "AC", "Acre", None, Decimal("-70.550000"), 1),
    ]


def test_city_dimension_accepts_both_header_sets(spark, tmp_path):
    english, own = tmp_path / "a.csv", tmp_path / "b.csv"
    english.write_text("ibge_code,name,latitude,longitude,capital,state_code,siafi_id,ddd,timezone\n"
                       "1100205,Porto Velho,-8.76,-63.9,true,11,0003,69,America/Porto_Velho\n")
    own.write_text("cod_cidade_ibge;nome_cidade;latitude;longitude;is_capital;cod_estado_ibge;"
                   "cod_municipio;ddd;fuso_horario\n"
                   "1100205;Porto Velho;-8.76;-63.9;true;11;0003;69;America/Porto_Velho\n")
    first, second = (files.read_dimension(spark, "ibge_cidade", str(p)) for p in (english, own))
    assert values(first) == values(second)
    assert first.first()["capital"] is True and first.first()["cod_municipio"] == "0003"


def test_routing(spark):
    names = ["Empresas0.zip", "ESTABELECIMENTOS12.zip", "Simples.zip", "Leiame1.zip"]
    listing = spark.createDataFrame([(n,) for n in names], "filename string")
    got = values(files.route_files(listing), "filename", "target")
    assert got == [
        ("ESTABELECIMENTOS12.zip", "estabelecimento"),
        ("ESTABELECIMENTOS12.zip", "estabelecimento_cnae_sec"),
        ("Empresas0.zip", "empresa"),
        ("Leiame1.zip", None),
        ("Simples.zip", "simples"),
    ]


def test_manifest(spark):
    schema = "filename string, size_bytes bigint"
    remote = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema)
    local = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], schema)
    assert values(files.diff_manifest(local, remote), "filename", "status") == [
        ("a", "ok"), ("b", "size_mismatch"), ("c", "missing"), ("d", "extra"),
    ]
    assert not files.manifest_is_valid(local, remote) and files.manifest_is_valid(remote, remote)


def test_periods_newest_first(spark):
    names = ["2024-01", "2023-12", "x", "2024-1", "2024-01"]
    folders = spark.createDataFrame([(n,) for n in names], "name string")
    got = [tuple(r) for r in files.available_periods(folders).collect()]
    assert got == [("2024-01", "01/2024", True), ("2023-12", "12/2023", False)]


def test_build_and_swap(spark, tmp_path):
    target = str(tmp_path / "t")
    assert sinks.build_and_swap(spark.range(5), target, 5).count() == 5
    with pytest.raises(sinks.CountMismatch):
        sinks.build_and_swap(spark.range(3), target, 4)
    assert spark.read.parquet(target).count() == 5
    assert sinks.build_and_swap(spark.read.parquet(target).filter("id < 2"), target, 2).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_write_table_follows_the_contract(spark, tmp_path):
    frame = spark.createDataFrame([("x", "1")], "nome_pais string, cod_pais string")
    written = sinks.write_table(frame, str(tmp_path), "pais", sort_by=("cod_pais",))
    assert written.columns == ["cod_pais", "nome_pais"]
    sinks.write_table(frame, str(tmp_path), "pais", mode="append")
    assert spark.read.parquet(f"{tmp_path}/pais").count() == 2


def test_replace_dimensions_is_all_or_nothing(spark, tmp_path):
    def dim(name, rows):
        return spark.createDataFrame(rows, spec(name).schema)

    regions = dim("ibge_regiao", [(1, "N", "Norte")])
    states = dim("ibge_estado", [(11, "RO", "Rondônia", None, None, 1)])
    cities = dim("ibge_cidade", [(1100205, "Porto Velho", None, None, True, 11, "0003", "69", "x")])
    root = str(tmp_path)
    sinks.replace_dimensions(root, regions, states, cities)
    broken = cities.withColumn("cod_cidade_ibge", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception):
        sinks.replace_dimensions(root, regions.limit(0), states, broken)
    assert spark.read.parquet(f"{root}/ibge_regiao").count() == 1
    replaced = sinks.replace_dimensions(root, regions.limit(0), states, cities)
    assert replaced["ibge_regiao"].count() == 0 and replaced["ibge_cidade"].count() == 1


def test_specs():
    assert len(TABLES) == 14
    assert sum(len(t.foreign_keys) for t in TABLES.values()) == 18
    assert len(spec("estabelecimento").columns) == 34
    assert len(spec("estabelecimento").file_schema) == 30
    for table in TABLES.values():
        for key in table.foreign_keys:
            assert key.parent_column in TABLES[key.parent].column_names
