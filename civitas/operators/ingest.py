"""From file rows to table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.functions.text import empty_to_null, sanitize_df
from civitas.functions.values import (
    compose_id,
    is_unreadable_date,
    parse_date8,
    parse_decimal_br,
)
from civitas.model.specs import DERIVED_TABLE, TableSpec, spec
from civitas.operators.geo import GEO_COLUMNS, add_geo

REJECTS = "_rejects"  # reasons found while parsing, before the table rules
CELLS = "_cells"  # the row's file cells as they came
PROVENANCE = ("_source_file", "_member", "_line", "_fields", "_payload", CELLS)


def provenance_of(df: DataFrame) -> list[str]:
    return [c for c in PROVENANCE if c in df.columns]


def derive_establishment(df: DataFrame, cities: DataFrame, states: DataFrame) -> DataFrame:
    """Add the fourteen-digit id and the three geographic codes, in table order."""
    enriched = add_geo(df, cities, states).withColumn(
        "cnpj_completo",
        compose_id(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")),
    )
    names = spec("estabelecimento").column_names
    extra = [c for c in enriched.columns if c not in names]
    return enriched.select(*names, *extra)


def explode_secondary(df: DataFrame, cities: DataFrame, states: DataFrame) -> DataFrame:
    """One row per (establishment, secondary activity); repeats are kept.

    Only the seven columns used travel through the two joins, and the list is
    split after them, so the joins see one row per establishment.  Foreign
    rows keep their place here, unlike in the main table.
    """
    lean = df.select(
        "cnpj_basico",
        "cnpj_ordem",
        "cnpj_dv",
        "uf",
        "cod_municipio",
        "data_inicio_atividade",
        F.split(F.coalesce("cod_cnae_secundario", F.lit("")), ",").alias("codes"),
        *provenance_of(df),
    ).filter(F.exists("codes", lambda c: F.trim(c) != ""))
    placed = add_geo(lean, cities, states, guard_foreign=False)
    return (
        placed.withColumn("cod_cnae", F.explode("codes"))
        .withColumn("cod_cnae", F.trim("cod_cnae"))
        .filter("cod_cnae <> ''")
        .select(
            compose_id(F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")).alias(
                "cnpj_completo"
            ),
            "cod_cnae",
            *GEO_COLUMNS,
            "data_inicio_atividade",
            *provenance_of(df),
        )
    )


def _reason(name: str, what: str, cell):
    """The offending text stays in the reason: the typed column cannot hold it."""
    return F.concat(F.lit(f"{name}: {what}: "), cell)


def _typed(df: DataFrame, table: TableSpec) -> DataFrame:
    """Parse text to the declared types; remember what could not be read."""
    text_now = {c for c, t in df.dtypes if t == "string"}
    reasons, parsed = [], {}
    for column in table.columns:
        name, cell = column.name, F.col(column.name)
        if name not in text_now:
            continue
        if name in table.date_columns:
            parsed[name] = parse_date8(cell)
            reasons.append(F.when(is_unreadable_date(cell), _reason(name, "not a date", cell)))
        elif name in table.decimal_columns:
            value = parse_decimal_br(cell, column.dtype.precision, column.dtype.scale)
            parsed[name] = value
            present = F.coalesce(cell, F.lit("")) != ""
            reasons.append(F.when(present & value.isNull(), _reason(name, "not a number", cell)))
        elif column.dtype.typeName() in ("integer", "short"):
            value = cell.try_cast(column.dtype)
            parsed[name] = value
            present = F.coalesce(cell, F.lit("")) != ""
            reasons.append(F.when(present & value.isNull(), _reason(name, "not a number", cell)))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.withColumn(REJECTS, found).withColumns(parsed)


def transform_table(
    df: DataFrame,
    name: str,
    cities: DataFrame | None = None,
    states: DataFrame | None = None,
) -> DataFrame:
    """Whole chain of one table: clean, place and identify, parse, empty to NULL.

    The result carries the table's columns in order, the provenance of the row,
    its untouched cells (not for the derived table, whose rows are no file rows)
    and ``_rejects`` for :func:`civitas.operators.quarantine.split_valid`.
    """
    table = spec(name)
    if name != DERIVED_TABLE:
        cells = [c for c in table.file_schema.fieldNames() if c in df.columns]
        df = df.withColumn(CELLS, F.struct(*cells))
    out = sanitize_df(df, keep=PROVENANCE)
    if name == "estabelecimento":
        out = derive_establishment(out, cities, states)
    elif name == DERIVED_TABLE:
        out = explode_secondary(out, cities, states)
    return _finish(out, table)


def retype_table(df: DataFrame, name: str) -> DataFrame:
    """Rows of a table as text to its types, without deriving anything."""
    return _finish(sanitize_df(df, keep=PROVENANCE), spec(name))


def _finish(df: DataFrame, table: TableSpec) -> DataFrame:
    out = empty_to_null(_typed(df, table))
    casts = [F.col(c.name).cast(c.dtype).alias(c.name) for c in table.columns]
    return out.select(*casts, REJECTS, *provenance_of(out))


