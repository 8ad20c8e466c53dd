"""Any page of a listing by one range read.

``OFFSET k`` sorts a listing and throws k rows away.  Here the rows are stored in
the order of the listing and a directory keeps the first id of every page, so
page 1000 costs what page 0 does: two directory rows and one range of ids that
is pushed to the scan.

Ranks come without sorting a listing in one task: rows are range-partitioned by
(listing, id), each file numbers its own rows, and the rows of the files before
are added.  A listing of a third of all rows is spread over many files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civitas.functions.text import starts_with
from civitas.scratch import fresh_path

DIRECTORY = "_paginas"
LISTING = ("cod_cidade_ibge", "cod_cnae_principal")
ID = "cnpj_completo"


def write_pages(
    rows: DataFrame, path: str, size: int, keys: Sequence[str] = LISTING, order: str = ID
) -> None:
    """Store ``rows`` in listing order under ``path`` and their page directory beside it.

    Rows without a key belong to no listing and are left out; ``order`` has to be
    unique inside a listing.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    listed = rows.dropna(subset=[*keys, order])
    listed.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order).write.parquet(path)
    placed = spark.read.schema(rows.schema).parquet(path).select(
        *keys, order, F.col("_metadata.file_path").alias("_file")
    )
    # files of a listing don't overlap: their first ids put them in order
    files = placed.groupBy(*keys, "_file").agg(F.count("*").alias("_rows"), F.min(order).alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select(
        *keys, "_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(*keys, "_file").orderBy(order)
    ranked = (
        placed.withColumn("_nth", F.row_number().over(inside) - 1)
        .join(starts, [*keys, "_file"])
        .withColumn("_rank", F.col("_before") + F.col("_nth"))
    )
    (
        ranked.filter(F.col("_rank") % size == 0)
        .select(*keys, F.expr(f"_rank div {size}").alias("pagina"), F.col(order).alias("primeiro"))
        .repartitionByRange(*keys, "pagina").sortWithinPartitions(*keys, "pagina")
        .write.parquet(path + DIRECTORY)
    )


def read_page(
    spark: SparkSession,
    path: str,
    values: Sequence,
    number: int,
    keys: Sequence[str] = LISTING,
    order: str = ID,
) -> DataFrame:
    """Page ``number`` (from 0) of one listing; no rows beyond its end."""
    path, chosen = path.rstrip("/"), F.lit(True)
    for key, value in zip(keys, values, strict=True):
        chosen = chosen & (F.col(key) == F.lit(value))
    bounds = {
        r["pagina"]: r["primeiro"]
        for r in spark.read.parquet(path + DIRECTORY)
        .filter(chosen & F.col("pagina").isin(number, number + 1)).collect()  # two rows at most
    }
    rows = spark.read.parquet(path).filter(chosen)
    if number not in bounds:
        return rows.limit(0)
    rows = rows.filter(F.col(order) >= F.lit(bounds[number]))
    if number + 1 in bounds:
        rows = rows.filter(F.col(order) < F.lit(bounds[number + 1]))
    return rows.orderBy(order)


# -- counts of names by prefix --------------------------------------------------------

CROWDED = 10_000


def prefix_counts(names: DataFrame, column: str, crowded: int = CROWDED) -> DataFrame | None:
    """``prefixo, total`` of every prefix whose parent has more than ``crowded`` names.

    Level by level; a level reads only the names below prefixes that are still
    crowded, and counts are taken map side.  Names that end at a crowded prefix
    go no deeper, so many equal names end the descent.  None without a name.
    """
    text = F.col(column)
    given = names.select(column).filter(text.isNotNull() & (text != ""))
    levels, below, length = None, given, 0
    while True:
        length += 1
        level = (
            below.filter(F.length(column) >= length)
            .groupBy(F.substring(column, 1, length).alias("prefixo"))
            .agg(F.count("*").alias("total"))
        )
        path = fresh_path(names.sparkSession, "prefixes")
        level.write.parquet(path)
        level = names.sparkSession.read.schema(level.schema).parquet(path)
        if level.isEmpty():
            return levels
        levels = level if levels is None else levels.unionByName(level)
        more = level.filter(F.col("total") > crowded).select(F.col("prefixo").alias("_prefix"))
        if more.isEmpty():
            return levels
        below = given.join(more, F.substring(column, 1, length) == F.col("_prefix"), "left_semi")


def count_by_prefix(
    counts: DataFrame, names: DataFrame, column: str, term: str, crowded: int = CROWDED
) -> DataFrame:
    """``total`` of the names that start with ``term``.

    A stored prefix answers at once.  Below one that is not crowded at most
    ``crowded`` names are counted, in a range that a table sorted by name skips
    to; below a crowded one all that exists is stored, so the answer is 0.
    """
    spark = counts.sparkSession
    if not term:
        return names.filter((F.col(column) != "")).agg(F.count("*").alias("total"))
    heads = [term[:n] for n in range(1, len(term) + 1)]
    found = counts.filter(F.col("prefixo").isin(heads)).collect()  # one row per letter at most
    best = max(found, key=lambda r: len(r["prefixo"]), default=None)
    if best is not None and best["prefixo"] != term and best["total"] <= crowded:
        return names.filter(starts_with(F.col(column), term)).agg(F.count("*").alias("total"))
    total = best["total"] if best is not None and best["prefixo"] == term else 0
    return spark.range(1).select(F.lit(total).cast("bigint").alias("total"))
