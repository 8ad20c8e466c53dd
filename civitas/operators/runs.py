"""History of load runs: one row per run, with nested details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILE_DETAIL = "array<struct<filename:string,size_bytes:bigint,source_url:string,downloaded_at:string>>"

# Steps that must have succeeded before a run counts as complete.
REQUIRED_STEPS = (
    "schema_init",
    "data_load",
    "patches",
    "tables_logged",
    "primary_keys",
    "foreign_keys",
    "search_table",
    "materialized_views",
)
BIG_FILE = 1 << 30


def start_run(runs: DataFrame, new: DataFrame) -> DataFrame:
    """Add runs not seen before; a resumed run keeps its original start."""
    fresh = new.join(runs.select("run_id"), "run_id", "left_anti").withColumn(
        "status", F.lit("in_progress")
    )
    return runs.unionByName(fresh, allowMissingColumns=True)


# Columns a resume without a value for them must not erase.
KEPT_ON_RESUME = (
    "records_inserted_total",
    "tables_populated",
    "files_downloaded_count",
    "files_downloaded_detail",
    "views_refreshed_at",
)


def finish_run(runs: DataFrame, done: DataFrame) -> DataFrame:
    """Close the runs listed in ``done`` (one row per run).

    Totals and details are only overwritten by values, the error always, so a
    retry that succeeds clears it.  Duration is in seconds.
    """
    brought = [c for c in done.columns if c != "run_id"]
    closing = done.select(
        "run_id", *[F.col(c).alias(f"_{c}") for c in brought], F.lit(True).alias("_done")
    )
    merged = runs.join(closing, "run_id", "left")
    hit = F.coalesce("_done", F.lit(False))

    def overwrite(name: str):
        new = F.col(f"_{name}") if name in brought else F.lit(None)
        return F.when(hit, new).otherwise(F.col(name)).alias(name)

    seconds = F.col("_finished_at").cast("double") - F.col("started_at").cast("double")
    out = []
    for name in runs.columns:
        if name in ("finished_at", "status", "error"):
            out.append(overwrite(name))
        elif name == "duration_seconds":
            kind = runs.schema[name].dataType
            out.append(F.when(hit, seconds.cast(kind)).otherwise(F.col(name)).alias(name))
        elif name in KEPT_ON_RESUME and name in brought:
            out.append(F.coalesce(f"_{name}", name).alias(name))
        else:
            out.append(F.col(name))
    return merged.select(*out)


def _latest(runs: DataFrame, period: str | None = None) -> DataFrame:
    """The run that started last, as one row; an aggregate, not a global sort."""
    chosen = runs if period is None else runs.filter(F.col("reference_period") == period)
    best = chosen.agg(
        F.max(F.struct("started_at", "run_id", F.struct(*runs.columns).alias("run"))).alias("m")
    )
    return best.filter("m IS NOT NULL").select("m.run.*")


def mark_refresh(runs: DataFrame, refreshed_at, period: str | None = None) -> DataFrame:
    """Stamp the latest run (of ``period`` when given) with a view refresh."""
    chosen = runs if period is None else runs.filter(F.col("reference_period") == period)
    key = chosen.agg(F.max(F.struct("started_at", "run_id")).alias("m")).select(
        F.col("m.run_id").alias("_run"), F.lit(True).alias("_hit")
    )
    stamped = F.when(F.col("_hit"), F.lit(refreshed_at).cast("timestamp")).otherwise(
        F.col("views_refreshed_at")
    )
    return (
        runs.join(key, F.col("run_id") == F.col("_run"), "left")
        .withColumn("views_refreshed_at", stamped)
        .select(*runs.columns)
    )


def run_status(steps: DataFrame, required: tuple[str, ...] = REQUIRED_STEPS) -> DataFrame:
    """Terminal status per run from its steps (``run_id, name, status``).

    A failed step decides even when everything required succeeded; a run that
    merely left required steps out is partial.
    """
    succeeded = (F.col("status") == "success") & F.col("name").isin(*required)
    return (
        steps.groupBy("run_id")
        .agg(
            F.max((F.col("status") == "failed").cast("int")).alias("any_failed"),
            F.count_distinct(F.when(succeeded, F.col("name"))).alias("required_done"),
        )
        .select(
            "run_id",
            F.when(F.col("any_failed") == 1, "failed")
            .when(F.col("required_done") == len(required), "completed")
            .otherwise("partial")
            .alias("run_status"),
        )
    )


def last_run(runs: DataFrame) -> DataFrame:
    return _latest(runs).select(
        "reference_period", "started_at", "finished_at", "duration_seconds", "status"
    )


def files_of(runs: DataFrame, period: str) -> DataFrame:
    """Files downloaded by the latest run of a period."""
    return _latest(runs, period).select("files_downloaded_count")


def monthly_volume(runs: DataFrame) -> DataFrame:
    """Completed runs by period with their hours."""
    hours = F.round(F.col("duration_seconds") / F.lit(3600), 2).cast("decimal(18,2)")
    return (
        runs.filter(F.col("status") == "completed")
        .select("reference_period", "records_inserted_total", hours.alias("horas"))
        .orderBy("reference_period")
    )


def _details(runs: DataFrame) -> DataFrame:
    detail = F.col("files_downloaded_detail")
    if dict(runs.dtypes)["files_downloaded_detail"] == "string":
        detail = F.from_json(detail, FILE_DETAIL)
    return runs.withColumn("detail", detail)


def big_files(runs: DataFrame, min_bytes: int = BIG_FILE) -> DataFrame:
    """Files over a size in the latest run."""
    return (
        _details(_latest(runs))
        .select(F.inline("detail"))
        .filter(F.col("size_bytes") > min_bytes)
        .select(F.col("filename").alias("arquivo"), F.col("size_bytes").alias("tamanho"))
    )


def files_summary(runs: DataFrame) -> DataFrame:
    """Number of files and their bytes per run, computed inside the row."""
    total = F.aggregate(
        "detail", F.lit(0).cast("bigint"), lambda acc, d: acc + F.coalesce(d["size_bytes"], F.lit(0))
    )
    return _details(runs).select(
        "run_id",
        F.size(F.coalesce("detail", F.array().cast(FILE_DETAIL))).cast("bigint").alias(
            "files_downloaded"
        ),
        F.coalesce(total, F.lit(0)).alias("total_bytes"),
    )
