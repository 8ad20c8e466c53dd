"""The delta gate, publishing and the run history."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from frames import values
from pyspark.sql import functions as F

from civitas.operators import generations as g
from civitas.operators import runs as r


def rows_of(spark, ids, changed=()):
    data = [
        (f"{i:014d}", "alterado" if i in changed else hashlib.md5(f"{i}original".encode()).hexdigest())
        for i in ids
    ]
    return spark.createDataFrame(data, "cnpj_completo string, row_hash string")


@pytest.fixture()
def older(spark):
    return rows_of(spark, range(100))


def gate(new, old, **options):
    return g.delta_gate(g.generation_delta(new, old), **options).first()


def test_two_changed_rows_pass(spark, older):
    row = gate(rows_of(spark, range(100), {7, 42}), older)
    assert (row["alteradas"], row["delta_pct"], row["aprovado"]) == (2, 2.0, True)


def test_truncated_generation_fails(spark, older):
    row = gate(rows_of(spark, range(40)), older)
    assert (row["removidas"], row["novas"], row["delta_pct"], row["aprovado"]) == (60, 0, 60.0, False)


def test_limit_is_inclusive_and_hash_is_null_safe(spark, older):
    row = gate(rows_of(spark, range(75)), older)
    assert row["delta_pct"] == 25.0 and row["aprovado"]
    assert not gate(rows_of(spark, range(75)), older, max_pct=24.9)["aprovado"]
    blank = older.withColumn("row_hash", F.lit(None).cast("string"))
    assert gate(blank, older)["alteradas"] == 100 and gate(blank, blank)["alteradas"] == 0


def test_empty_current_generation(spark, older):
    row = gate(older, older.limit(0))
    assert (row["novas"], row["delta_pct"], row["aprovado"]) == (100, 10000.0, False)


def generation(spark, search, views=None):
    filled = {"mv": spark.range(1)} if views is None else views
    return g.Generation(search.select("cnpj_completo"), filled, search)


def test_validation_collects_every_failure(spark, older):
    bad = generation(spark, rows_of(spark, range(40)), {"cheia": spark.range(1),
                                                        "vazia": spark.range(0)})
    with pytest.raises(g.CycleAborted) as failure:
        g.validate_generation(bad, generation(spark, older), minimum=50)
    text = str(failure.value)
    assert "row_floor" in text and "view vazia" in text and "delta" in text and "cheia" not in text
    with pytest.raises(g.CycleAborted, match="views: none"):
        g.validate_generation(generation(spark, older, {}), None, minimum=1)


def test_publish_abort_rollback(spark, older, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    assert store.current() is None
    first, second = dt.datetime(2026, 6, 1), dt.datetime(2026, 7, 1)
    assert store.publish("202606", generation(spark, older), None, minimum=1, now=first)
    assert not store.publish("202606")  # already served: nothing to do
    new = generation(spark, rows_of(spark, range(100), {7, 42}))
    truncated = generation(spark, rows_of(spark, range(40)))
    with pytest.raises(g.CycleAborted):
        store.publish("202607", truncated, generation(spark, older), minimum=1)
    assert store.current() == "dados_202606"
    assert store.publish("202607", new, generation(spark, older), minimum=1, now=second)
    assert store.current() == "dados_202607"
    got = values(store.cycles(), "load_id", "etapa", "delta_pct", "publicado_em")
    assert got == [("202606", "publicado", Decimal("0.000"), first),
                   ("202607", "publicado", Decimal("2.000"), second)]
    assert store.rollback() == "dados_202606" and store.current() == "dados_202606"
    assert store.rollback("dados_202607") == "dados_202607"
    assert g.retention_candidates(store.cycles(), store.current()).count() == 0


def test_rollback_needs_an_earlier_generation(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    store.publish("202606", skip_validation=True)
    with pytest.raises(g.CycleAborted):
        store.rollback()


def test_serve_points_views_at_the_current_generation(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS servido")
    store = g.GenerationStore(spark, str(tmp_path))
    for load, n in (("1", 3), ("2", 5)):
        spark.range(n).write.parquet(f"{tmp_path}/dados_{load}/t")
        store.publish(load, skip_validation=True)
        store.serve("servido", ["t"])
        assert spark.table("servido.t").count() == n


def test_retention_never_lists_the_previous_one(spark):
    day = dt.datetime(2026, 1, 1)
    rows = [(f"{m}", f"dados_{m}", day.replace(month=m) if m != 3 else None) for m in range(1, 6)]
    cycles = spark.createDataFrame(rows, "load_id string, schema_nome string, publicado_em timestamp")
    assert values(g.retention_candidates(cycles, "dados_5")) == [
        ("dados_1",), ("dados_2",), ("dados_3",)]
    assert values(g.retention_candidates(cycles, "dados_1")) == [("dados_2",), ("dados_3",)]


def test_record_writes_extra_fields_on_first_sight(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    store.record("1", "carregado", linhas_estabelecimento=7)
    store.record("1", "validado")
    assert values(store.cycles(), "load_id", "etapa", "linhas_estabelecimento") == [
        ("1", "validado", 7)]


RUNS = (
    "run_id string, reference_period string, status string, started_at timestamp, "
    "finished_at timestamp, duration_seconds decimal(18,2), records_inserted_total bigint, "
    "files_downloaded_count int, files_downloaded_detail string, views_refreshed_at timestamp, "
    "error string"
)
T0 = dt.datetime(2026, 7, 1, 3, 0, 0)


def run(spark, *rows):
    return spark.createDataFrame([(*row, *[None] * (11 - len(row))) for row in rows], RUNS)


def test_start_is_idempotent(spark):
    runs = run(spark, ("a", "2026-07", "completed", T0))
    new = spark.createDataFrame(
        [("a", "2026-08", T0), ("b", "2026-08", T0)],
        "run_id string, reference_period string, started_at timestamp")
    assert values(r.start_run(runs, new), "run_id", "reference_period", "status") == [
        ("a", "2026-07", "completed"), ("b", "2026-08", "in_progress")]


def test_finish_keeps_totals_a_resume_does_not_bring(spark):
    detail = '[{"filename":"A.zip","size_bytes":2000000000},{"filename":"B.zip","size_bytes":5}]'
    runs = run(
        spark,
        ("a", "2026-07", "in_progress", T0, None, None, 218380000, 2, detail, None, "old"),
        ("b", "2026-06", "in_progress", T0),
    )
    done = spark.createDataFrame(
        [("a", T0 + dt.timedelta(minutes=2), "completed", None, T0)],
        "run_id string, finished_at timestamp, status string, records_inserted_total bigint, "
        "views_refreshed_at timestamp")
    row = r.finish_run(runs, done).filter("run_id = 'a'").first()
    assert (row["status"], row["duration_seconds"], row["records_inserted_total"]) == (
        "completed", Decimal("120.00"), 218380000)
    assert row["error"] is None and row["files_downloaded_detail"] == detail
    assert row["views_refreshed_at"] == T0
    assert r.finish_run(runs, done).filter("run_id = 'b'").first()["status"] == "in_progress"
    assert values(r.big_files(runs.filter("run_id = 'a'"))) == [("A.zip", 2000000000)]
    assert values(r.files_summary(runs)) == [("a", 2, 2000000005), ("b", 0, 0)]


def test_mark_refresh_stamps_the_latest(spark):
    later = T0 + dt.timedelta(days=1)
    runs = run(spark, ("a", "2026-07", "completed", T0), ("b", "2026-08", "completed", later))
    assert values(r.mark_refresh(runs, later), "run_id", "views_refreshed_at") == [
        ("a", None), ("b", later)]
    assert values(r.mark_refresh(runs, later, "2026-07"), "run_id", "views_refreshed_at") == [
        ("a", later), ("b", None)]
    assert r.mark_refresh(runs, later, "1999-01").filter("views_refreshed_at IS NOT NULL").count() == 0
    assert r.mark_refresh(runs.limit(0), later).count() == 0


def test_run_status(spark):
    def steps(name, **status):
        return [(name, s, status.get(s, "success")) for s in ("download", *r.REQUIRED_STEPS)]

    rows = (steps("done") + steps("skipped", download="pending")
            + steps("failed", download="failed") + steps("partial", materialized_views="pending"))
    frame = spark.createDataFrame(rows, "run_id string, name string, status string")
    assert values(r.run_status(frame)) == [
        ("done", "completed"), ("failed", "failed"), ("partial", "partial"), ("skipped", "completed")]


def test_last_and_volume(spark):
    later = T0 + dt.timedelta(days=1)
    runs = run(spark, ("a", "2026-07", "completed", T0, later, Decimal("5400"), 10, 3),
               ("b", "2026-08", "partial", later, later, Decimal("1"), 1, 4))
    assert r.last_run(runs).first()["reference_period"] == "2026-08"
    assert r.files_of(runs, "2026-07").first()[0] == 3
    assert values(r.monthly_volume(runs)) == [("2026-07", 10, Decimal("1.50"))]
    assert r.last_run(runs.limit(0)).count() == 0


def test_an_interrupted_change_keeps_the_history(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    store.record("202606", g.PUBLISHED, publicado_em=dt.datetime(2026, 6, 1))
    started = store.cycles().first()["iniciado_em"]
    assert started is not None
    # a writer that died before its file appeared leaves an unfinished version
    (tmp_path / "_ciclos" / "versao=1" / "_temporary").mkdir(parents=True)
    assert [r["load_id"] for r in g.GenerationStore(spark, str(tmp_path)).cycles().collect()] == ["202606"]


def test_rollback_refuses_what_was_never_published(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    store.record("202606", g.PUBLISHED, publicado_em=dt.datetime(2026, 6, 1))
    with pytest.raises(g.CycleAborted):
        store.rollback("dados_202605")
    assert store.current() is None


def test_publish_without_the_served_tables_is_refused(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    store.point_to("dados_202606")
    with pytest.raises(g.CycleAborted, match="cannot be read"):
        store.publish("202607")
    assert store.current() == "dados_202606"
