"""Data-quality checks; every check is a DataFrame of findings.

Nothing here fixes or fails: a constraint the table should satisfy becomes a
count of the rows that do not.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.model.source import TableSource
from civitas.model.specs import TABLES, TableSpec
from civitas.plans.rollups import SERIES_FLOOR


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _per_column(df: DataFrame, table: TableSpec, failing: dict, counted: str) -> DataFrame:
    """One pass over the table, one row per checked column."""
    one = df.agg(*[F.count_if(cond).alias(c) for c, cond in failing.items()])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias(counted)) for c in failing]
    return one.select(F.lit(table.name).alias("table"), F.inline(F.array(*pairs)))


def check_not_null(df: DataFrame, table: TableSpec) -> DataFrame:
    failing = {c.name: F.col(c.name).isNull() for c in table.columns if c.required}
    return _per_column(df, table, failing, "nulls")


def check_length(df: DataFrame, table: TableSpec) -> DataFrame:
    failing = {c.name: F.length(c.name) > c.max_len for c in table.columns if c.max_len}
    return _per_column(df, table, failing, "too_long")


def check_unique(df: DataFrame, keys: Iterable[str], strict_nulls: bool = False) -> DataFrame:
    """Keys held by more than one row.

    A key with a NULL part is exempt, as in a unique index, unless
    ``strict_nulls``.
    """
    keys = list(keys)
    present = df
    if not strict_nulls:
        present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def check_keys(source: TableSource, tables: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """Repeated values per declared primary and unique key, and NULLs in primary keys."""
    found = []
    for table in tables.values():
        for keys in filter(None, (table.primary_key, *table.unique_keys)):
            frame = source.table(table.name, keys)
            lacking = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda c: c)
            null_rows = F.count_if(lacking) if keys == table.primary_key else F.lit(0)
            repeated = check_unique(frame, keys).agg(F.count("*").alias("repeated"))
            found.append(
                frame.agg(null_rows.cast("bigint").alias("nulls"))
                .crossJoin(repeated)  # one row each
                .select(
                    F.lit(table.name).alias("table"),
                    F.lit(",".join(keys)).alias("key"),
                    "repeated",
                    "nulls",
                )
            )
    return _stack(found)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Counts of the child rows whose value has no parent.

    The child is reduced to one row per value before it meets the parent, so
    a value that fills a third of the table joins once.
    """
    values = (
        child.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
        .filter("value IS NOT NULL")
    )
    known = parent.select(F.col(parent_column).alias("value"))
    return values.join(known, "value", "left_anti")


def _orphan_total(found: DataFrame) -> DataFrame:
    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphans"))


def check_fk(source: TableSource, tables: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """Orphans per declared foreign key; all keys are tried, failing or not.

    A child table is read once: each row gives one (key, value) pair per foreign
    key, and pairs are counted map side before they move, so a value that fills a
    third of a table is one row.  The pairs of all tables meet all parents in one
    anti join; a parent column is read once however many keys point to it.
    """
    keys = [(table.name, key) for table in tables.values() for key in table.foreign_keys]
    parents = list(dict.fromkeys((key.parent, key.parent_column) for _, key in keys))
    children = []
    for table in tables.values():
        own = [(n, key) for n, (name, key) in enumerate(keys) if name == table.name]
        if not own:
            continue
        pairs = F.array(
            *[
                F.struct(
                    F.lit(n).alias("key"),
                    F.lit(parents.index((k.parent, k.parent_column))).alias("points_to"),
                    F.col(k.column).cast("string").alias("value"),
                )
                for n, k in own
            ]
        )
        columns = dict.fromkeys(k.column for _, k in own)
        children.append(
            source.table(table.name, columns)
            .select(F.explode(pairs).alias("p")).select("p.*")
            .filter("value IS NOT NULL")
        )
    counted = _stack(children).groupBy("key", "points_to", "value").agg(F.count("*").alias("rows"))
    known = _stack(
        [
            source.table(name, (column,)).select(
                F.lit(n).alias("points_to"), F.col(column).cast("string").alias("value")
            )
            for n, (name, column) in enumerate(parents)
        ]
    )
    found = (
        counted.join(known, ["points_to", "value"], "left_anti")
        .groupBy("key").agg(F.sum("rows").alias("orphans"))
    )
    names = [(n, name, key.column, key.parent) for n, (name, key) in enumerate(keys)]
    listed = counted.sparkSession.createDataFrame(
        names, "key int, table string, column string, parent string"
    )
    return listed.join(found, "key", "left").select(
        "table", "column", "parent", F.coalesce("orphans", F.lit(0)).cast("bigint").alias("orphans")
    )


# The named referential checks and their warnings.
REFERENTIAL_CHECKS = (
    ("fk_estab_empresa", "estabelecimento", "cnpj_basico", "empresa", "cnpj_basico",
     "AVISO: Registros órfãos"),
    ("fk_estab_cnae", "estabelecimento", "cod_cnae_principal", "cnae", "cod_cnae",
     "AVISO: CNAEs não encontrados"),
    ("fk_socio_empresa", "socio", "cnpj_basico", "empresa", "cnpj_basico",
     "AVISO: Sócios órfãos"),
)


def referential_report(source: TableSource) -> DataFrame:
    """The three named orphan checks; a NULL reference counts as an orphan."""
    rows = []
    for name, table, column, parent, parent_column, warning in REFERENTIAL_CHECKS:
        values = (
            source.table(table, (column,))
            .groupBy(F.col(column).alias("value"))
            .agg(F.count("*").alias("rows"))
        )
        known = source.table(parent, (parent_column,)).select(
            F.col(parent_column).alias("value")
        )
        total = _orphan_total(values.join(known, "value", "left_anti"))
        rows.append(
            total.select(
                F.lit(name).alias("fk_name"),
                F.lit(table).alias("source_table"),
                F.col("orphans").alias("orphan_count"),
                F.when(F.col("orphans") == 0, "OK").otherwise(warning).alias("status"),
            )
        )
    return _stack(rows)


def _finding(df: DataFrame, check: str, table: str, condition, warning: str) -> DataFrame:
    return df.agg(F.count_if(condition).alias("count")).select(
        F.lit(check).alias("check_name"),
        F.lit(table).alias("table_name"),
        "count",
        F.when(F.col("count") == 0, "OK").otherwise(warning).alias("status"),
    )


def check_id_nulls(source: TableSource) -> DataFrame:
    cell = F.col("cnpj_completo")
    return _stack(
        _finding(
            source.table(table, ("cnpj_completo",)),
            "cnpj_completo_nulls",
            table,
            cell.isNull() | (cell == ""),
            "FALHA: NULLs encontrados",
        )
        for table in ("estabelecimento", "estabelecimento_cnae_sec")
    )


def check_id_format(est: DataFrame) -> DataFrame:
    return _finding(
        est,
        "cnpj_completo_format",
        "estabelecimento",
        F.length("cnpj_completo") != 14,
        "FALHA: Formato incorreto",
    )


def check_id_consistency(est: DataFrame) -> DataFrame:
    parts = F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    return _finding(
        est,
        "cnpj_completo_consistency",
        "estabelecimento",
        F.col("cnpj_completo") != parts,
        "AVISO: Inconsistências encontradas",
    )


# Fixed value: fewer establishments than this means a truncated source.
MINIMUM_ESTABLISHMENTS = 60_000_000


def check_row_floor(est: DataFrame, minimum: int = MINIMUM_ESTABLISHMENTS) -> DataFrame:
    return est.agg(F.count("*").alias("rows")).select(
        "rows",
        F.lit(minimum).cast("bigint").alias("minimum"),
        (F.col("rows") >= minimum).alias("passed"),
    )


def check_views(views: Mapping[str, DataFrame]) -> DataFrame:
    """One row per view, ``empty`` when it holds no row.

    Each view is looked into for a single row; all views are checked.
    """
    if not views:
        raise ValueError("no view to check")
    return _stack(
        view.limit(1)
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("view"), (F.col("n") == 0).alias("empty"))
        for name, view in views.items()
    )


def check_count_match(derived: DataFrame, source: DataFrame) -> DataFrame:
    """Row counts of a derived table and its source, in one row."""
    sides = derived.select(F.lit(1).alias("d"), F.lit(0).alias("s")).unionByName(
        source.select(F.lit(0).alias("d"), F.lit(1).alias("s"))
    )
    return sides.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("derived_rows"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
    ).withColumn("passed", F.col("derived_rows") == F.col("source_rows"))


def sanity_anchor(views: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct anchors over the views; one is right."""
    anchors = _stack(v.select("mes_ancora").distinct() for v in views.values())
    return anchors.agg(F.count_distinct("mes_ancora").alias("ancoras"))


def sanity_12m(comparison: DataFrame, states: DataFrame) -> DataFrame:
    """States whose 12-month openings differ from their ``novos_1ano``; none is right."""
    year = comparison.filter("nivel = 'estado' AND periodo_meses = 12")
    both = year.select("cod_estado_ibge", "aberturas_atual").join(
        states.select("cod_estado_ibge", "novos_1ano"), "cod_estado_ibge"
    )
    return both.agg(
        F.count_if(F.col("aberturas_atual") != F.col("novos_1ano")).alias("divergentes")
    )


def sanity_levels(comparison: DataFrame) -> DataFrame:
    """Openings per period at country, region and state level.

    Rows without a state count in the country only, so on such data the levels
    may differ; the report shows them and leaves the judgement to the reader.
    """

    def level(name):
        value = F.when(F.col("nivel") == name, F.col("aberturas_atual"))
        return F.sum(value).alias(name)

    totals = comparison.groupBy("periodo_meses").agg(
        level("brasil"), level("regiao"), level("estado")
    )
    differs = (F.col("brasil") != F.col("regiao")) | (F.col("brasil") != F.col("estado"))
    return totals.withColumn("diverge", differs)


def sanity_closings(series: DataFrame, est: DataFrame, floor=SERIES_FLOOR) -> DataFrame:
    """Closings of the series against those of the base table; equal is right."""
    closed = (F.col("cod_situacao_cadastral") == "08") & (
        F.col("data_situacao_cadastral") >= F.lit(floor)
    )
    one_sided = series.agg(F.sum("baixas").alias("serie")).select(
        "serie", F.lit(0).cast("bigint").alias("base")
    )
    other = est.agg(F.count_if(closed).alias("base")).select(
        F.lit(0).cast("bigint").alias("serie"), "base"
    )
    return (
        one_sided.unionByName(other)
        .agg(F.sum("serie").alias("serie"), F.sum("base").alias("base"))
        .withColumn("diferenca", F.col("serie") - F.col("base"))
    )


def sanity_null_variation(comparison: DataFrame) -> DataFrame:
    """Rows with a variation although nothing preceded; none is right."""
    wrong = (F.col("aberturas_anterior") == 0) & F.col("aberturas_variacao_pct").isNotNull()
    return comparison.agg(F.count_if(wrong).alias("erradas"))
