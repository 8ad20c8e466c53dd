"""The driver contract: keys, columns and values against the SQL."""

import os

import pytest
from compare import compare, connect
from frames import SMALL

import __spark_entry__ as entry
from entry_oracles import ORACLES
from entry_queries import QUERIES

# One query per family on every run; CIVITAS_ALL=1 compares all of them.
CHOSEN = (
    "mv_stats_municipio mv_comparativo_territorio src_zip_csv src_fixed_schema src_dim_csv "
    "sink_quarantine transform_table clean_sanitize normalize_name patch_dedup_company "
    "check_fk delta_gate publish_generation build_views refresh_views busca_estabelecimento "
    "by_full_id run_finish"
).split()
KEYS = list(QUERIES) if os.environ.get("CIVITAS_ALL") else CHOSEN


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 150
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_its_sql(spark, con, key):
    outcome = compare(spark, con, SMALL, key, entry.queries()[key], entry.oracle_sql()[key])
    assert outcome.startswith("ok"), outcome


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "mes_ancora" in frame.columns


def test_scratch_tables_go_to_the_configured_folder(spark):
    from civitas.scratch import SETTING, fresh_path

    configured = spark.sparkContext.getConf().get(SETTING)
    first, second = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert first.startswith(configured) and first != second
