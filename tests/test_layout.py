"""The curve layout: ranks, and files that predicates leave to read."""

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.operators import layout

COLUMNS = ("cod_cidade_ibge", "cod_cnae_principal", "cod_situacao_cadastral", "data_inicio_atividade")


@pytest.fixture(scope="module")
def est(spark):
    pick = random.Random(8)
    rows = [
        (i, 7 if i % 3 == 0 else pick.randrange(60), f"{pick.randrange(40):07d}", pick.choice(["02", "02", "04", "08", None]),
         dt.date(1990, 1, 1) + dt.timedelta(days=pick.randrange(12000)) if i % 50 else None)
        for i in range(12000)
    ]
    return spark.createDataFrame(
        rows, "id int, cod_cidade_ibge int, cod_cnae_principal string, cod_situacao_cadastral string, data_inicio_atividade date"
    ).cache()


def test_ranks_count_the_bounds_reached(spark):
    frame = spark.createDataFrame([(v,) for v in (None, -3, 0, 4, 5, 6, 99)], "v int")
    got = [r[0] for r in frame.select(layout.rank_of("v", [0, 5, 6])).collect()]
    assert got == [0, 0, 1, 1, 2, 3, 3] and frame.select(layout.rank_of("v", [])).distinct().count() == 1
    # a frequent value takes the ranks it has rows for
    assert [r[0] for r in frame.select(layout.rank_of("v", [0, 5, 5, 5])).collect()] == [0, 0, 1, 1, 4, 4, 4]


def test_interleaved_bits(spark):
    frame = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    keys = frame.select("a", "b", layout.curve_key({"a": [1, 2, 3], "b": [1, 2, 3]}, 2).alias("k")).collect()
    assert all(r.k == (r.a & 1) | (r.b & 1) << 1 | (r.a & 2) << 1 | (r.b & 2) << 2 for r in keys)


def files_left(path, tests):
    """Files whose minimum and maximum leave every range possible."""
    left, every = 0, list(path.glob("*.parquet"))
    for file in every:
        meta, possible = pq.ParquetFile(file).metadata, True
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for name, low, high in tests:
            stats = [meta.row_group(g).column(names.index(name)).statistics for g in range(meta.num_row_groups)]
            possible &= any(s.has_min_max and s.min <= high and s.max >= low for s in stats)
        left += possible
    return left, len(every)


PAIRS = [
    [("cod_cidade_ibge", 30, 31), ("data_inicio_atividade", dt.date(2015, 1, 1), dt.date(2016, 1, 1))],
    [("cod_cnae_principal", "0000011", "0000012"), ("cod_situacao_cadastral", "08", "08")],
    [("cod_cnae_principal", "0000030", "0000031"), ("data_inicio_atividade", dt.date(1991, 1, 1), dt.date(1991, 6, 1))],
    # the city of a third of all rows
    [("cod_cidade_ibge", 7, 7), ("cod_cnae_principal", "0000005", "0000005")],
]


def test_every_pair_of_predicates_skips_files(spark, est, tmp_path):
    layout.write_curve(est, f"{tmp_path}/curve", COLUMNS, files=64)
    assert values(spark.read.parquet(f"{tmp_path}/curve")) == values(est)
    est.repartitionByRange(64, "cod_cidade_ibge", "id").write.parquet(f"{tmp_path}/sorted")
    for tests in PAIRS:
        left, every = files_left(tmp_path / "curve", tests)
        assert every > 50 and left <= 0.4 * every, (tests, left, every)
    # sorted by city, pairs without the city read everything
    assert all(files_left(tmp_path / "sorted", PAIRS[n])[0] > 50 for n in (1, 2))
    for tests in PAIRS:
        condition = F.lit(True)
        for name, low, high in tests:
            condition &= F.col(name).between(F.lit(low), F.lit(high))
        assert values(spark.read.parquet(f"{tmp_path}/curve").filter(condition)) == values(est.filter(condition))


def test_hot_number_is_spread_and_empty_tables(spark, tmp_path):
    same = spark.range(3000).select("id", F.lit(1).alias("a"), F.lit("x").alias("b"))
    layout.write_curve(same, f"{tmp_path}/hot", ("a", "b"), files=8)
    sizes = [r["n"] for r in spark.read.parquet(f"{tmp_path}/hot").groupBy("_metadata.file_path").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) < 1000 and sum(sizes) == 3000
    layout.write_curve(same.limit(0), f"{tmp_path}/none", ("a", "b"), files=4)
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError):
        layout.write_curve(same, f"{tmp_path}/bad", ("a", "b"), files=4, bits=40)
