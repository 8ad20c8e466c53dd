"""Rows that break their table's contract are kept aside, never dropped.

A row is judged on its own: what it breaks is listed in ``errors`` and the row
goes to the quarantine next to its table and source file, as JSON of the cells
it had in the file.  A retry runs the whole chain on those cells again.  With
``granularity='file'`` one bad row takes its whole file along, which is the
all-or-nothing behaviour of a bulk load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.model.specs import DERIVED_TABLE, TableSpec, file_fields
from civitas.operators.ingest import CELLS, REJECTS, retype_table, transform_table

PENDING, PROCESSED = "pending", "processed"


def violations(table: TableSpec, columns: list[str]) -> Column:
    """Array of the rules a row breaks."""
    checks = []
    for c in table.columns:
        if c.name not in columns:
            continue
        cell = F.col(c.name)
        if c.required:
            checks.append(F.when(cell.isNull(), F.lit(f"{c.name}: missing")))
        if c.max_len:
            too_long = F.length(cell) > c.max_len
            checks.append(F.when(too_long, F.lit(f"{c.name}: longer than {c.max_len}")))
        if c.exact_len:
            checks.append(
                F.when(F.length(cell) < c.max_len, F.lit(f"{c.name}: shorter than {c.max_len}"))
            )
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def wrong_width(table: TableSpec) -> Column:
    """The reason of a line with too few or too many cells, or of a damaged file."""
    found, wanted = F.col("_fields"), file_fields(table.name)
    return F.when(found < 0, F.lit("file: damaged")).when(
        found != wanted, F.format_string(f"fields: %d instead of {wanted}", found)
    )


def judge(df: DataFrame, table: TableSpec) -> DataFrame:
    """Add ``errors``: the line's width and parse failures first, then broken rules."""
    found = violations(table, df.columns)
    if REJECTS in df.columns:
        found = F.concat(F.col(REJECTS), found)
    if "_fields" in df.columns:
        found = F.concat(F.array_compact(F.array(wrong_width(table))), found)
    # As a generated column the list is computed once per row.  As a plain one a
    # filter on it would be rewritten in terms of the raw text, and deriving
    # constraints from that takes the optimizer minutes on a wide table.
    return df.select("*", F.explode(F.array(found)).alias("errors"))


def split_valid(
    df: DataFrame,
    table: TableSpec,
    granularity: str = "row",
    source_file: str = "_source_file",
    staging: str | None = None,
    park_damaged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows to load and quarantine rows.

    ``park_damaged`` parks every row of a file that could not be read to its end.

    Together they hold every input row exactly once.  With a ``staging`` path
    the judged rows are written there and both results read them back, so the
    work before this point is done once instead of once per result.
    """
    if granularity not in ("row", "file"):
        raise ValueError(f"granularity must be row or file, not {granularity}")
    judged = judge(df, table)
    if source_file not in judged.columns:
        judged = judged.withColumn(source_file, F.lit(None).cast("string"))
    whole_files = granularity == "file" or (park_damaged and "_fields" in judged.columns)
    columns = [c for c in table.column_names if c in df.columns]
    cells = CELLS if CELLS in judged.columns else F.struct(*columns)
    payload = F.to_json(cells, {"ignoreNullFields": "false"})
    if not whole_files:  # rows that load need none
        payload = F.when(F.size("errors") > 0, payload)
    tainting = F.size("errors") > 0 if granularity == "file" or not whole_files else (
        F.col("_fields") < 0
    )
    judged = judged.withColumns(
        {"_own_payload": payload, "_failed": F.size("errors") > 0, "_taints": tainting}
    ).drop(CELLS)
    if staging:
        judged.write.partitionBy("_failed").parquet(staging)
        judged = judged.sparkSession.read.schema(judged.schema).parquet(staging)
    failed = F.col("_failed")
    if whole_files:
        # files with a bad row: one row per file, collapsed map side first
        tainted = (
            judged.filter("_taints")
            .select(F.col(source_file).alias("_file"), F.lit(True).alias("_hit"))
            .distinct()
        )
        judged = (
            judged.join(tainted, F.col(source_file).eqNullSafe(F.col("_file")), "left")
            .withColumn("_out", F.coalesce("_hit", F.lit(False)) | failed)
            .drop("_file", "_hit")
        )
    else:
        judged = judged.withColumn("_out", failed)
    good = judged.filter(~F.col("_out")).select(*columns)
    bad = judged.filter("_out").select(
        F.lit(table.name).alias("table"),
        F.col(source_file).alias("source_file"),
        F.col("_own_payload").alias("payload"),
        "errors",
        F.lit(PENDING).alias("status"),
    )
    return good, bad


def list_quarantine(quarantine: DataFrame) -> DataFrame:
    """Parked rows per table and source file."""
    return (
        quarantine.filter(F.col("status") == PENDING)
        .groupBy("table", "source_file")
        .agg(F.count("*").alias("rows"))
    )


def retry_quarantine(
    quarantine: DataFrame,
    table: TableSpec,
    cities: DataFrame | None = None,
    states: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Run the whole chain on the (corrected) parked rows of one table again.

    Establishments are placed anew, which takes the two dimensions.  Returns the
    rows that now pass, the quarantine with those marked processed rather than
    removed, and one row of counts.
    """
    mine = (F.col("table") == table.name) & (F.col("status") == PENDING)
    derived = table.name == DERIVED_TABLE
    names = table.column_names if derived else table.file_schema.fieldNames()
    layout = ", ".join(f"`{n}` string" for n in names)
    cells = (
        quarantine.filter(mine)
        .withColumn("row", F.from_json("payload", layout))
        .select(
            *[F.col(f"row.{n}").alias(n) for n in names],
            F.col("source_file").alias("_source_file"),
            F.col("payload").alias("_payload"),
        )
    )
    rows = (
        retype_table(cells, table.name)
        if derived
        else transform_table(cells, table.name, cities, states)
    )
    judged = judge(rows, table).drop(CELLS)
    present = table.column_names
    passed = F.size("errors") == 0
    loaded = judged.filter(passed).select(*present)
    rejudged = judged.select(
        F.lit(table.name).alias("table"),
        F.col("_source_file").alias("source_file"),
        F.col("_payload").alias("payload"),
        "errors",
        F.when(passed, F.lit(PROCESSED)).otherwise(F.lit(PENDING)).alias("status"),
    )
    untouched = quarantine.filter(~F.coalesce(mine, F.lit(False))).select(*rejudged.columns)
    counts = rejudged.agg(
        F.count("*").alias("retried"),
        F.count_if(F.col("status") == PROCESSED).alias("succeeded"),
        F.count_if(F.col("status") == PENDING).alias("failed"),
    )
    return loaded, untouched.unionByName(rejudged), counts


def load_metrics(good: dict[str, DataFrame], quarantine: DataFrame) -> DataFrame:
    """Rows loaded and parked per table; ``in_total`` tells what a total adds up."""
    loaded = None
    for name, frame in good.items():
        one = frame.agg(F.count("*").alias("rows_loaded")).select(
            F.lit(name).alias("table"), "rows_loaded"
        )
        loaded = one if loaded is None else loaded.unionByName(one)
    parked = (
        quarantine.filter(F.col("status") == PENDING)
        .groupBy("table", "source_file")
        .agg(F.count("*").alias("rows"))
        .groupBy("table")
        .agg(F.sum("rows").alias("rows_failed"), F.count("*").alias("files_failed"))
    )
    zero = F.lit(0).cast("bigint")
    return loaded.join(parked, "table", "full_outer").select(
        "table",
        F.coalesce("rows_loaded", zero).alias("rows_loaded"),
        F.coalesce("rows_failed", zero).alias("rows_failed"),
        F.coalesce("files_failed", zero).alias("files_failed"),
        (F.col("table") != DERIVED_TABLE).alias("in_total"),
    )


