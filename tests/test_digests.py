"""Stored generations compared by the digests of their buckets."""

import pytest
from frames import values
from pyspark.sql import functions as F
from test_generations_runs import rows_of

from civitas.operators import digests as d
from civitas.operators import generations as g
from civitas.plans.graph import VIEWS

NAME = g.SEARCH_TABLE


def store(spark, root, name, ids, changed=(), buckets=16):
    d.write_digested(rows_of(spark, ids, changed), f"{root}/{name}", NAME, buckets=buckets)


def test_digests_see_every_kind_of_change(spark):
    base = rows_of(spark, range(500))
    take = lambda frame: d.bucket_digests(frame, "cnpj_completo", "row_hash", 8)
    assert d.differing_buckets(take(base), take(base.repartition(7))) == []
    blank = base.withColumn("row_hash", F.when(F.col("cnpj_completo").endswith("42"), None).otherwise(F.col("row_hash")))
    for other in (rows_of(spark, range(500), {3}), rows_of(spark, range(499)), blank,
                  base.unionByName(base.limit(1)), base.limit(0)):
        assert d.differing_buckets(take(other), take(base)) == d.differing_buckets(take(base), take(other)) != []
    swapped = base.withColumn("row_hash", F.when(F.col("cnpj_completo") == f"{1:014d}", "x").when(
        F.col("cnpj_completo") == f"{2:014d}", "y").otherwise(F.col("row_hash")))
    other = base.withColumn("row_hash", F.when(F.col("cnpj_completo") == f"{1:014d}", "y").when(
        F.col("cnpj_completo") == f"{2:014d}", "x").otherwise(F.col("row_hash")))
    assert d.differing_buckets(take(swapped), take(other))
    assert d.differing_buckets(d.bucket_digests(base, "cnpj_completo", "row_hash", 9), take(base)) is None


@pytest.mark.parametrize("ids,changed", [(range(300), ()), (range(300), (5, 77)), (range(40, 320), (50,)), (range(0), ())])
def test_counts_equal_the_whole_comparison(spark, tmp_path, ids, changed):
    store(spark, tmp_path, "new", ids, changed)
    store(spark, tmp_path, "old", range(300))
    whole = g.generation_delta(rows_of(spark, ids, changed), rows_of(spark, range(300)))
    got = d.stored_delta(spark, f"{tmp_path}/new", f"{tmp_path}/old", NAME)
    assert values(got.select(whole.columns)) == values(whole)


def test_equal_buckets_are_not_read(spark, tmp_path):
    store(spark, tmp_path, "new", range(300), {9})
    store(spark, tmp_path, "old", range(300))
    bucket = d.with_bucket(rows_of(spark, [9]), "cnpj_completo", 16).first()[d.BUCKET]
    got = d.stored_delta(spark, f"{tmp_path}/new", f"{tmp_path}/old", NAME)
    # every other folder can be gone: one changed row has one bucket
    import shutil
    for side in ("new", "old"):
        for n in range(16):
            if n != bucket:
                shutil.rmtree(tmp_path / side / NAME / f"{d.BUCKET}={n}", ignore_errors=True)
    assert got.first().asDict() == {"novas": 0, "removidas": 0, "alteradas": 1, "total_vigente": 300}


def test_without_digests_or_cut_differently(spark, tmp_path):
    store(spark, tmp_path, "a", range(10))
    store(spark, tmp_path, "b", range(10), buckets=8)
    rows_of(spark, range(10)).write.parquet(f"{tmp_path}/c/{NAME}")
    for other in "bc":
        assert d.stored_delta(spark, f"{tmp_path}/a", f"{tmp_path}/{other}", NAME) is None


def test_publishing_compares_by_digests(spark, tmp_path):
    shop = g.GenerationStore(spark, str(tmp_path))
    for month, changed in (("202601", ()), ("202602", (1, 2)), ("202603", range(90))):
        root = f"{tmp_path}/{g.generation_name(month)}"
        store(spark, root, "", range(100), changed)
        rows_of(spark, range(100)).write.parquet(f"{root}/estabelecimento")
        for view in VIEWS:
            spark.range(1).write.parquet(f"{root}/{view}")
    assert shop.publish("202601", minimum=1) and shop.publish("202602", minimum=1)
    assert float(shop.cycles().filter("load_id = '202602'").first()["delta_pct"]) == 2.0
    with pytest.raises(g.CycleAborted):
        shop.publish("202603", minimum=1)
    assert shop.current() == g.generation_name("202602")
