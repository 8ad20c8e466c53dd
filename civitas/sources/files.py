"""Extracted files, dimension files and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitas.functions.text import STRIP_CHARS
from civitas.model.specs import TABLES, TableSpec, spec

PERIOD_FOLDER = "^[0-9]{4}-[0-9]{2}$"


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An extracted source file: columns by position, names from the contract."""
    return (
        spark.read.schema(spec(name).file_schema)
        .option("sep", ";")
        .option("encoding", "ISO-8859-1")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
        .csv(path)
    )


def stems(spark: SparkSession, specs: dict[str, TableSpec] | None = None) -> DataFrame:
    """Target tables by lower-case file stem; one stem may feed two tables."""
    chosen = specs or TABLES
    return spark.createDataFrame(
        [(s.stem.lower(), s.name) for s in chosen.values()], "stem string, target string"
    )


def route_files(listing: DataFrame, specs: dict[str, TableSpec] | None = None) -> DataFrame:
    """Target table(s) of each file; ``target`` is NULL for a stem nobody claims."""
    base = F.regexp_replace("filename", "\\.[^.]*$", "")
    keyed = listing.withColumn("stem", F.lower(F.regexp_replace(base, "[0-9]+$", "")))
    return keyed.join(stems(listing.sparkSession, specs), "stem", "left")


# Header names accepted for each dimension column, first match wins.
DIMENSION_ALIASES = {
    "ibge_regiao": {
        "cod_regiao_ibge": ("cod_regiao_ibge", "ibge_code"),
        "sigla_regiao": ("sigla_regiao", "abbreviation"),
        "nome_regiao": ("nome_regiao", "name"),
    },
    "ibge_estado": {
        "cod_estado_ibge": ("cod_estado_ibge", "ibge_code", "state_code"),
        "sigla_uf": ("sigla_estado", "sigla_uf", "abbreviation"),
        "nome_estado": ("nome_estado", "name"),
        "latitude": ("latitude",),
        "longitude": ("longitude",),
        "cod_regiao_ibge": ("cod_regiao_ibge", "region_id"),
    },
    "ibge_cidade": {
        "cod_cidade_ibge": ("cod_cidade_ibge", "ibge_code"),
        "nome_cidade": ("nome_cidade", "name"),
        "latitude": ("latitude",),
        "longitude": ("longitude",),
        "capital": ("capital", "is_capital"),
        "cod_estado_ibge": ("cod_estado_ibge", "state_code"),
        "cod_municipio": ("cod_municipio", "siafi_id"),
        "ddd": ("ddd",),
        "fuso_horario": ("fuso_horario", "timezone"),
    },
}


def _delimiter(spark: SparkSession, path: str) -> str:
    """``;`` or ``,``: whichever splits the first five lines more often."""
    head = "\n".join(r.value for r in spark.read.text(path).limit(5).collect())
    return ";" if head.count(";") > head.count(",") else ","


def read_dimension_csv(
    spark: SparkSession,
    path: str,
    aliases: dict[str, tuple[str, ...]],
    types: T.StructType | None = None,
) -> DataFrame:
    """A header CSV in UTF-8 (byte-order mark or not) under canonical names."""
    raw = spark.read.csv(
        path, header=True, sep=_delimiter(spark, path), encoding="UTF-8", enforceSchema=False
    )
    present = {c.lstrip("\ufeff").strip(): c for c in raw.columns}
    selected = []
    for name, spellings in aliases.items():
        cells = [
            F.nullif(F.btrim(F.col(f"`{present[s]}`"), F.lit(STRIP_CHARS)), F.lit(""))
            for s in spellings
            if s in present
        ]
        value = F.coalesce(*cells) if cells else F.lit(None).cast("string")
        if types is not None and name in types.fieldNames():
            value = value.try_cast(types[name].dataType)
        selected.append(value.alias(name))
    return raw.select(*selected)


def read_dimension(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of the three geographic dimensions, typed by its contract."""
    return read_dimension_csv(spark, path, DIMENSION_ALIASES[name], spec(name).schema)


def diff_manifest(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Status of every file in either listing: ok, missing, extra or size."""
    here = local.select("filename", F.col("size_bytes").alias("local_bytes"))
    there = remote.select("filename", F.col("size_bytes").alias("remote_bytes"))
    return here.join(there, "filename", "full_outer").withColumn(
        "status",
        F.when(F.col("local_bytes").isNull(), "missing")
        .when(F.col("remote_bytes").isNull(), "extra")
        .when(F.col("local_bytes") != F.col("remote_bytes"), "size_mismatch")
        .otherwise("ok"),
    )


def manifest_is_valid(local: DataFrame, remote: DataFrame) -> bool:
    return diff_manifest(local, remote).filter("status <> 'ok'").limit(1).count() == 0


def available_periods(folders: DataFrame) -> DataFrame:
    """Monthly folders, newest first, with the newest one marked."""
    names = folders.filter(F.col("name").rlike(PERIOD_FOLDER)).select("name").distinct()
    newest = names.agg(F.max("name").alias("newest"))
    return (
        names.join(newest, F.col("name") == F.col("newest"), "left")
        .select(
            F.col("name").alias("period"),
            F.concat(F.substr("name", F.lit(6)), F.lit("/"), F.substr("name", F.lit(1), F.lit(4)))
            .alias("month_year"),
            F.col("newest").isNotNull().alias("is_latest"),
        )
        .orderBy(F.desc("period"))
    )
