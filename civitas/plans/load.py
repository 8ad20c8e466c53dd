"""A month from its archives to a complete generation folder.

Every step reads tables and writes tables; between steps nothing lives in
memory, so a lost executor costs a task and a lost driver costs one step.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.model.source import PathSource
from civitas.model.specs import TABLES, spec
from civitas.operators.generations import SEARCH_TABLE
from civitas.operators.geo import geo_dimensions
from civitas.operators.ingest import transform_table
from civitas.operators.joins import hot_keys
from civitas.operators.patches import apply_patches
from civitas.operators.quality import check_fk, check_keys
from civitas.operators.quarantine import load_metrics, retry_quarantine, split_valid
from civitas.operators.search import build_search_table
from civitas.plans.graph import build_views
from civitas.plans.rollups import SERIES_FLOOR
from civitas.scratch import fresh_path
from civitas.sources.files import route_files
from civitas.sources.sinks import build_and_swap, write_table
from civitas.sources.zip_csv import list_archives, read_zip_csv

QUARANTINE = "_quarentena"
CHECKS = "_chaves"
DIMENSIONS = ("ibge_regiao", "ibge_estado", "ibge_cidade")


def _routes(spark: SparkSession, folder: str) -> tuple[dict, list[str]]:
    """Archives and tables per file stem, and the archives nobody claims.

    The listing has one row per archive, so it fits the driver.
    """
    archives = list_archives(f"{folder.rstrip('/')}/*.zip")
    listing = spark.createDataFrame(
        [(a, a.rsplit("/", 1)[-1]) for a in archives], "path string, filename string"
    )
    routes, unknown = {}, []
    for row in route_files(listing).select("stem", "path", "target").collect():
        if row["target"] is None:
            unknown.append(row["path"])
            continue
        paths, targets = routes.setdefault(row["stem"], (set(), set()))
        paths.add(row["path"])
        targets.add(row["target"])
    return routes, sorted(unknown)


def load_month(
    spark: SparkSession,
    folder: str,
    root: str,
    cities: DataFrame,
    states: DataFrame,
    granularity: str = "row",
    on_error: str = "fail",
    spread: int | None = None,
    quarantine: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """Load every known archive of ``folder`` into tables under ``root``.

    Parked rows go to ``quarantine`` (``<root>/_quarentena`` by default); with
    ``on_error='quarantine'`` a damaged archive is parked as a whole.

    Returns the load metrics and the archives of unknown stems.  Raw rows are
    first written as Parquet to the shared folder: each archive is unpacked
    once however many tables it feeds.  The task that inflates a member only cuts
    it into blocks; ``spread`` tasks (all cores by default) parse them.
    """
    routes, unknown = _routes(spark, folder)
    quarantine = quarantine or f"{root}/{QUARANTINE}"
    good: dict[str, DataFrame] = {}
    mode = "overwrite"
    for stem, (paths, targets) in sorted(routes.items()):
        layout_table = "estabelecimento" if "estabelecimento" in targets else next(iter(targets))
        staged = fresh_path(spark, f"raw-{stem}")
        layout = spec(layout_table).file_schema
        tasks = spread or spark.sparkContext.defaultParallelism
        read_zip_csv(spark, sorted(paths), layout, spread=tasks, on_error=on_error).write.parquet(
            staged
        )
        raw = spark.read.parquet(staged)
        for target in sorted(targets):
            rows = transform_table(raw, target, cities, states)
            judged = fresh_path(spark, f"judged-{target}")
            kept, parked = split_valid(
                rows,
                spec(target),
                granularity,
                staging=judged,
                park_damaged=on_error == "quarantine",
            )
            good[target] = write_table(kept, root, target)
            parked.write.mode(mode).parquet(quarantine)
            mode = "append"
    if not good:
        raise FileNotFoundError(f"no known archive in {folder}")
    return load_metrics(good, spark.read.parquet(quarantine)), unknown


class KeysBroken(RuntimeError):
    """A declared key does not hold; views over such tables would count rows twice."""


class MissingArchive(RuntimeError):
    """A month without the archive of a table that it must have."""


def complete_month(
    spark: SparkSession,
    folder: str,
    generation: str,
    dimensions: dict[str, DataFrame],
    runs: DataFrame | None = None,
    anchor: dt.date | None = None,
    floor: dt.date = SERIES_FLOOR,
    optional: Collection[str] = (),
    **load_options,
) -> tuple[DataFrame, list[str]]:
    """Archives to a whole generation: tables, key report, search table, views.

    A table without an archive fails the month unless ``optional`` names it;
    then it is empty.  Parked rows stay with the generation.

    Returns what :func:`load_month` returns.  Publishing is a separate step
    (``generations.GenerationStore``), so an unfinished generation is never
    served.
    """
    loaded = fresh_path(spark, "loaded")
    unique = geo_dimensions(*[dimensions[name] for name in DIMENSIONS])
    dims = {name: write_table(unique[name], generation, name) for name in DIMENSIONS}
    metrics, unknown = load_month(
        spark, folder, loaded, dims["ibge_cidade"], dims["ibge_estado"],
        quarantine=f"{generation}/{QUARANTINE}", **load_options,
    )
    staged = PathSource(spark, loaded)
    wanted = [name for name in TABLES if name not in DIMENSIONS]
    absent = [name for name in wanted if not staged.has(name)]
    if lacking := sorted(set(absent) - set(optional)):
        raise MissingArchive(f"no archive in {folder} for {', '.join(lacking)}")
    tables = {
        name: spark.createDataFrame([], TABLES[name].schema)
        if name in absent
        else staged.table(name)
        for name in wanted
    }
    for name, frame in apply_patches(tables).items():
        write_table(frame, generation, name)
    if runs is not None:
        runs.write.mode("overwrite").parquet(f"{generation}/pipeline_stats")
    source = PathSource(spark, generation)
    broken = check_keys(source).filter("repeated > 0 or nulls > 0").collect()  # one row per key
    if broken:
        raise KeysBroken("; ".join(f"{r['table']}({r['key']})" for r in broken))
    check_fk(source).write.mode("overwrite").parquet(f"{generation}/{CHECKS}")
    est = source.table("estabelecimento")
    build_and_swap(
        build_search_table(est, source.table("empresa"), hot_keys(est, "cnpj_basico")),
        f"{generation}/{SEARCH_TABLE}",
        est.agg(F.count("*")).first()[0],
    )
    build_views(spark, source, generation, anchor=anchor, floor=floor)
    return metrics, unknown


def retry_parked(spark: SparkSession, generation: str, name: str) -> DataFrame:
    """Load the corrected parked rows of one table into a generation.

    Good rows are appended to their table and the quarantine is rewritten with
    those marked processed.  Returns the counts of the retry.
    """
    source = PathSource(spark, generation)
    loaded, marked, counts = retry_quarantine(
        source.table(QUARANTINE), spec(name), source.table("ibge_cidade"), source.table("ibge_estado")
    )
    staged = fresh_path(spark, f"retried-{name}")
    loaded.write.parquet(staged)
    numbers = counts.collect()
    build_and_swap(marked, f"{generation}/{QUARANTINE}")
    write_table(spark.read.schema(loaded.schema).parquet(staged), generation, name, mode="append")
    return spark.createDataFrame(numbers, counts.schema)
