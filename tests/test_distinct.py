"""Distinct companies by bitmaps against plain distinct counts."""

import random

import pytest
from frames import values
from pyspark.sql import functions as F
from test_views import ANCHOR, make_frames

from civitas.plans import distinct, stock

EDGE = ["00000000", "00000001", "00032767", "00032768", "00032769", "99999999"]
OTHER = ["1234567", "123456789", "12ABC345", "", " 0000001", "١٢٣٤٥٦٧٨"]


@pytest.fixture(scope="module")
def est(spark):
    pick = random.Random(4)
    roots = [*EDGE, *OTHER, None, *[f"{pick.randrange(10**8):08d}" for _ in range(300)]]
    rows = [(pick.choice(roots), s % 3, s) for s in (pick.randrange(9) for _ in range(3000))]
    rows += [("00000001", None, 3), ("00000001", 1, None), (None, 2, 50), ("X", 2, 51)]
    return spark.createDataFrame(rows, "cnpj_basico string, cod_regiao_ibge int, cod_estado_ibge int").repartition(7)


def test_states_and_regions(est):
    located = est.dropna(subset=["cod_regiao_ibge", "cod_estado_ibge"])
    plain = lambda *keys: located.groupBy(*keys).agg(
        F.count_distinct("cnpj_basico").alias("total_empresas"), F.count("*").alias("total_estabelecimentos"))
    got = distinct.region_and_state(est).cache()
    columns = ["cod_regiao_ibge", "cod_estado_ibge", "total_empresas", "total_estabelecimentos"]
    assert values(got.filter("nivel = 'estado'"), *columns) == values(plain(*columns[:2]), *columns)
    assert values(got.filter("nivel = 'regiao'").drop("cod_estado_ibge", "nivel"), *columns[:1], *columns[2:]) == values(
        plain(columns[0]), *columns[:1], *columns[2:])
    assert distinct.region_and_state(est.limit(0)).count() == 0


def test_one_exchange_of_bitmaps(est):
    """The rows are exchanged once, as bitmaps; what follows them is one row per territory."""
    keys = ["cod_estado_ibge"]
    frame = distinct.companies_in(distinct.company_bitmaps(est, keys), keys)
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("bitmap_construct_agg") >= 2 and "partial_bitmap_construct_agg" in plan
    executed = frame._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 2


def test_view_equals_the_one_by_pairs(spark):
    frames = make_frames(spark)
    # roots with letters and digits alike
    root = F.when(F.col("cnpj_basico") == "HOT", "00000001").otherwise(
        F.concat(F.lit("0000"), F.substring("cnpj_basico", 2, 4)))
    est = frames["estabelecimento"].withColumn("cnpj_basico", F.when(F.col("cod_cidade_ibge") % 2 == 0, root).otherwise(F.col("cnpj_basico")))
    one, other = (stock.stats_estado(est, frames["ibge_estado"], ANCHOR, b) for b in (False, True))
    assert set(one.columns) == set(other.columns) and values(one) == values(other, *one.columns)
