"""Stored pages and prefix counts against sorting and scanning."""

import random
import shutil

import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.operators import pages


def listing(spark, size=2000):
    pick = random.Random(9)
    rows = [(f"{i:014d}", 1 if i % 3 == 0 else pick.choice([2, 3, None]), pick.choice("ab") if i % 3 else "a", i)
            for i in pick.sample(range(10**6), size)]
    return spark.createDataFrame(rows, "cnpj_completo string, cod_cidade_ibge int, cod_cnae_principal string, extra int")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pages") / "busca")
    frame = listing(spark).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # several files for one listing
    try:
        pages.write_pages(frame, path, size=7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    return frame, path


@pytest.mark.parametrize("values_,number", [((1, "a"), 0), ((1, "a"), 60), ((2, "b"), 3), ((1, "b"), 0), ((9, "a"), 0), ((1, "a"), 9999)])
def test_pages_equal_offset(spark, stored, values_, number):
    frame, path = stored
    want = (frame.filter((F.col("cod_cidade_ibge") == values_[0]) & (F.col("cod_cnae_principal") == values_[1]))
            .orderBy("cnpj_completo").offset(7 * number).limit(7))
    got = pages.read_page(spark, path, values_, number)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_last_page_is_what_is_left(spark, stored):
    frame, path = stored
    total = frame.filter("cod_cidade_ibge = 1 and cod_cnae_principal = 'a'").count()
    last = (total - 1) // 7
    assert pages.read_page(spark, path, (1, "a"), last).count() == total - 7 * last
    assert pages.read_page(spark, path, (1, "a"), last + 1).count() == 0


def test_a_deep_page_reads_one_range(spark, stored, tmp_path):
    """The bounds are pushed, and files outside them can be gone."""
    _, path = stored
    shutil.copytree(path, tmp_path / "copy")
    shutil.copytree(path + pages.DIRECTORY, f"{tmp_path}/copy{pages.DIRECTORY}")
    page = pages.read_page(spark, f"{tmp_path}/copy", (1, "a"), 80)
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = page._jdf.queryExecution().explainString(formatted)
    assert "GreaterThanOrEqual(cnpj_completo" in plan and "LessThan(cnpj_completo" in plan
    ids = [r["cnpj_completo"] for r in page.collect()]
    holding = spark.read.parquet(f"{tmp_path}/copy").filter(F.col("cnpj_completo").isin(ids))
    files = {r[0].rsplit("/", 1)[1] for r in holding.select("_metadata.file_path").distinct().collect()}
    every = list((tmp_path / "copy").glob("*.parquet"))
    assert len(files) <= 2 < len(every)
    want = values(page)
    for file in every:
        if file.name not in files:
            file.unlink()
    assert values(pages.read_page(spark, f"{tmp_path}/copy", (1, "a"), 80)) == want and len(want) == 7


def test_empty_listing(spark, tmp_path):
    pages.write_pages(listing(spark).limit(0), f"{tmp_path}/none", size=3)
    assert pages.read_page(spark, f"{tmp_path}/none", (1, "a"), 0).count() == 0


def test_prefix_counts_answer_any_term(spark):
    pick = random.Random(2)
    names = ["".join(pick.choices("ABÇ ", k=pick.randrange(1, 9))) for _ in range(600)]
    names += ["AAAA"] * 90 + ["AAAAB"] * 3 + ["", None, "%_", "%x", "Z"]
    frame = spark.createDataFrame([(n,) for n in names], "name string").cache()
    counts = pages.prefix_counts(frame, "name", crowded=25).cache()
    stored = {r["prefixo"]: r["total"] for r in counts.collect()}
    real = [n for n in names if n]
    assert len(stored) == counts.count() and all(t == sum(n.startswith(p) for n in real) for p, t in stored.items())
    assert all(len(p) == 1 or stored[p[:-1]] > 25 for p in stored) and "AAAAB" in stored
    terms = ["A", "AAAA", "AAAAB", "AAAAC", "AAAAA", "%", "%_", "Q", "", "ZZ", *pick.sample(real, 12), *[n + "A" for n in pick.sample(real, 6)]]
    for term in terms:
        got = pages.count_by_prefix(counts, frame, "name", term, crowded=25).first()[0]
        assert got == sum(n.startswith(term) for n in real), term
    assert pages.prefix_counts(frame.limit(0), "name") is None
