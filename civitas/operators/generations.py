"""Comparing, gating and publishing data generations.

A generation is one complete load.  The only distributed step is the row-hash
comparison; the rest works on the small table of load cycles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.functions.values import is_distinct
from civitas.operators.digests import stored_delta
from civitas.operators.quality import MINIMUM_ESTABLISHMENTS, check_row_floor, check_views
from civitas.plans.graph import VIEWS
from civitas.sources.versions import Versions

# Fixed value: highest share of changed rows that still publishes, in percent.
MAX_DELTA_PCT = 25.0
GENERATION_PREFIX = "dados_"
PUBLISHED, VALIDATED = "publicado", "validado"
SEARCH_TABLE = "busca_estabelecimento"


class CycleAborted(RuntimeError):
    """A quality gate failed; nothing was published."""


def generation_name(load_id: str) -> str:
    return f"{GENERATION_PREFIX}{load_id}"


def generation_delta(
    new: DataFrame, current: DataFrame, key: str = "cnpj_completo", row_hash: str = "row_hash"
) -> DataFrame:
    """Rows new, removed and changed, and the size of the current generation.

    A full outer join on the unique id; bucketed by the id on both sides
    (``sinks.save_bucketed``) it runs without an exchange.
    """
    n = new.select(F.col(key).alias("new_key"), F.col(row_hash).alias("new_hash"))
    c = current.select(F.col(key).alias("cur_key"), F.col(row_hash).alias("cur_hash"))
    both = n.join(c, F.col("new_key") == F.col("cur_key"), "full_outer")
    in_new, in_current = F.col("new_key").isNotNull(), F.col("cur_key").isNotNull()
    return both.agg(
        F.count_if(in_new & ~in_current).alias("novas"),
        F.count_if(~in_new & in_current).alias("removidas"),
        F.count_if(in_new & in_current & is_distinct(F.col("new_hash"), F.col("cur_hash"))).alias(
            "alteradas"
        ),
        F.count_if(in_current).alias("total_vigente"),
    )


def delta_gate(counts: DataFrame, max_pct: float = MAX_DELTA_PCT) -> DataFrame:
    """Share of changed rows against the current generation, and the verdict."""
    moved = F.col("novas") + F.col("removidas") + F.col("alteradas")
    share = F.lit(100.0) * moved / F.greatest(F.col("total_vigente"), F.lit(1))
    return counts.withColumn("delta_pct", share).withColumn(
        "aprovado", F.col("delta_pct") <= F.lit(float(max_pct))
    )


def first_load_gate(spark: SparkSession) -> DataFrame:
    """Verdict when nothing is served yet: there is nothing to differ from."""
    return spark.range(1).select(
        *[
            F.lit(0).cast("bigint").alias(c)
            for c in ("novas", "removidas", "alteradas", "total_vigente")
        ],
        F.lit(0.0).alias("delta_pct"),
        F.lit(True).alias("aprovado"),
    )


@dataclass
class Generation:
    """The parts of one generation the gates look at."""

    establishments: DataFrame
    views: Mapping[str, DataFrame]
    search: DataFrame | None = None
    delta: DataFrame | None = None  # against the current one, where it is known already


def validation_report(
    new: Generation,
    current: Generation | None,
    minimum: int = MINIMUM_ESTABLISHMENTS,
    max_pct: float = MAX_DELTA_PCT,
) -> DataFrame:
    """One row per check: ``check``, ``passed``, ``detail`` and its number, ``value``."""
    floor = check_row_floor(new.establishments, minimum).select(
        F.lit("row_floor").alias("check"),
        "passed",
        F.concat(F.col("rows").cast("string"), F.lit(" of "), F.col("minimum").cast("string"))
        .alias("detail"),
        F.col("rows").cast("double").alias("value"),
    )
    report = floor
    if new.views:
        report = report.unionByName(
            check_views(new.views).select(
                F.concat(F.lit("view "), F.col("view")).alias("check"),
                (~F.col("empty")).alias("passed"),
                F.when(F.col("empty"), "empty").otherwise("has rows").alias("detail"),
                F.lit(None).cast("double").alias("value"),
            )
        )
    else:
        report = report.unionByName(
            new.establishments.sparkSession.range(1).select(
                F.lit("views").alias("check"),
                F.lit(False).alias("passed"),
                F.lit("none").alias("detail"),
                F.lit(None).cast("double").alias("value"),
            )
        )
    spark = new.establishments.sparkSession
    if current is None:
        gate = first_load_gate(spark)
    else:
        delta = new.delta if new.delta is not None else generation_delta(new.search, current.search)
        gate = delta_gate(delta, max_pct)
    text = F.concat_ws(
        " ",
        *[
            F.concat(F.lit(f"{c}="), F.col(c).cast("string"))
            for c in ("novas", "removidas", "alteradas", "total_vigente")
        ],
    )
    return report.unionByName(
        gate.select(
            F.lit("delta").alias("check"),
            F.col("aprovado").alias("passed"),
            text.alias("detail"),
            F.col("delta_pct").alias("value"),
        )
    )


def validate_generation(
    new: Generation,
    current: Generation | None,
    minimum: int = MINIMUM_ESTABLISHMENTS,
    max_pct: float = MAX_DELTA_PCT,
) -> list:
    """Run every check, then raise with all failures or return the report rows.

    The report is bounded by the number of views, so it fits the driver.
    """
    rows = validation_report(new, current, minimum, max_pct).collect()
    failed = [f"{r['check']}: {r['detail']}" for r in rows if not r["passed"]]
    if failed:
        raise CycleAborted("nothing was published; failed: " + "; ".join(failed))
    return rows


CYCLE_SCHEMA = (
    "load_id string, schema_nome string, iniciado_em timestamp, etapa string, "
    "publicado_em timestamp, linhas_estabelecimento bigint, delta_pct decimal(6,3), "
    "observacao string"
)


def upsert_cycle(cycles: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per load: new values win where given, the rest is kept."""
    fresh = rows.select(
        "load_id", *[F.col(c).alias(f"_{c}") for c in rows.columns if c != "load_id"]
    )
    merged = cycles.join(fresh, "load_id", "full_outer")
    columns = [
        F.coalesce(f"_{c}", c).alias(c) if f"_{c}" in fresh.columns else F.col(c)
        for c in cycles.columns
        if c != "load_id"
    ]
    return merged.select("load_id", *columns)


def previous_published(cycles: DataFrame, current: str | None) -> DataFrame:
    """Latest published generation other than the current one (at most one row)."""
    candidates = cycles.filter(F.col("publicado_em").isNotNull())
    if current is not None:
        candidates = candidates.filter(F.col("schema_nome") != current)
    return (
        candidates.orderBy(F.desc("publicado_em"), F.desc("schema_nome"))
        .limit(1)
        .select("schema_nome", "publicado_em")
    )


def retention_candidates(cycles: DataFrame, current: str | None, keep: int = 2) -> DataFrame:
    """Generations that may be removed: neither current nor among the latest published.

    A listing only; the generation before the current one is the rollback and
    never appears.
    """
    latest = (
        cycles.filter(F.col("publicado_em").isNotNull())
        .orderBy(F.desc("publicado_em"), F.desc("schema_nome"))
        .limit(keep)
        .select("schema_nome")
    )
    rest = cycles.select("schema_nome").join(latest, "schema_nome", "left_anti")
    if current is not None:
        rest = rest.filter(F.col("schema_nome") != current)
    return rest


class GenerationStore:
    """Pointer and cycle table of the generations under one root folder.

    ``<root>/_ciclos`` holds the cycles, ``<root>/_vigente`` one row naming the
    served generation.  Both are ``Versions``: a change is a new version that one
    writer alone can claim, and nothing is ever moved or removed, so an
    interrupted change leaves the version before it in force, and two writers
    lose none of their changes.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.root}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        found = self._table(name).read()
        return self.spark.createDataFrame([], schema) if found is None else found

    def cycles(self) -> DataFrame:
        return self._read("_ciclos", CYCLE_SCHEMA)

    def current(self) -> str | None:
        row = self._read("_vigente", "schema_nome string").first()
        return row["schema_nome"] if row else None

    def record(self, load_id: str, stage: str, **fields) -> None:
        """Set the stage and extra fields of a load, on first sight as well."""
        given = {
            "load_id": load_id,
            "schema_nome": generation_name(load_id),
            "etapa": stage,
            **fields,
        }

        def change(known: DataFrame | None) -> DataFrame:
            if known is None:
                known = self.spark.createDataFrame([], CYCLE_SCHEMA)
            values = dict(given)
            if known.filter(F.col("load_id") == load_id).isEmpty():
                values.setdefault("iniciado_em", dt.datetime.now())
            names = [f for f in known.schema.fieldNames() if f in values]
            schema = "load_id string, " + ", ".join(
                f"{n} {known.schema[n].dataType.simpleString()}" for n in names if n != "load_id"
            )
            row = tuple(values[n] for n in ["load_id", *[n for n in names if n != "load_id"]])
            # a few rows: one per load
            return upsert_cycle(known, self.spark.createDataFrame([row], schema)).coalesce(1)

        self._table("_ciclos").put(change)

    def point_to(self, generation: str) -> None:
        named = self.spark.createDataFrame([(generation,)], "schema_nome string").coalesce(1)
        self._table("_vigente").put(lambda _: named)

    def serve(self, database: str, names: Iterable[str]) -> None:
        """Views of a serving database over the tables of the current generation."""
        served = self.current()
        for name in names:
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {database}.{name} AS "
                f"SELECT * FROM parquet.`{self.root}/{served}/{name}`"
            )

    def _stored(self, name: str, table: str) -> DataFrame:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}/{table}")
        except AnalysisException as failure:
            raise CycleAborted(f"{name}/{table} cannot be read: {failure}") from failure

    def stored(self, name: str) -> Generation:
        """A generation as its tables lie under the root.

        A search table that ``digests.write_digested`` stored is compared by
        buckets when it is published.
        """
        return Generation(
            self._stored(name, "estabelecimento"),
            {view: self._stored(name, view) for view in VIEWS},
            self._stored(name, SEARCH_TABLE),
        )

    def adopt(self, cycles: DataFrame, served: str) -> None:
        """Take over a history and the generation it serves."""
        self._table("_ciclos").put(lambda _: cycles.coalesce(1))  # one row per load
        self.point_to(served)

    def publish(
        self,
        load_id: str,
        new: Generation | None = None,
        current: Generation | None = None,
        minimum: int = MINIMUM_ESTABLISHMENTS,
        max_pct: float = MAX_DELTA_PCT,
        skip_validation: bool = False,
        now: dt.datetime | None = None,
    ) -> bool:
        """Validate now and switch the pointer; False when already published.

        The gates run at this moment and not earlier, because the data may have
        changed since the load ended.  Both generations are read from the store
        unless they are given; the verdict of a first load is only for a store
        that serves nothing.
        """
        name = generation_name(load_id)
        served = self.current()
        if served == name:
            return False
        if not skip_validation:
            from_store = new is None and current is None and served is not None
            if new is None:
                new = self.stored(name)
            if current is None and served is not None:
                # the gate compares search tables only
                search = self._stored(served, SEARCH_TABLE)
                current = Generation(search, {}, search)
            if from_store:
                roots = (f"{self.root}/{n}" for n in (name, served))
                new.delta = stored_delta(self.spark, *roots, SEARCH_TABLE)
            report = validate_generation(new, current, minimum, max_pct)
            pct = next(r["value"] for r in report if r["check"] == "delta")
            self.record(load_id, VALIDATED, delta_pct=Decimal(str(round(pct, 3))))
        self.point_to(name)
        self.record(load_id, PUBLISHED, publicado_em=now or dt.datetime.now())
        return True

    def rollback(self, to: str | None = None) -> str:
        """Point back to ``to`` or to the latest published other generation."""
        if to is None:
            row = previous_published(self.cycles(), self.current()).first()
            if row is None:
                raise CycleAborted("no earlier published generation to return to")
            to = row["schema_nome"]
        elif self.cycles().filter(
            (F.col("schema_nome") == to) & F.col("publicado_em").isNotNull()
        ).isEmpty():
            raise CycleAborted(f"{to} was never published")
        self.point_to(to)
        return to
