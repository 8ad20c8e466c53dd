"""The anchor month and the calendar windows counted back from it.

Every window ends at the last complete month of the load.  The anchor is the
one value a plan needs before it is built: as a date literal it reaches the
Parquet scan as a pushed filter, which a joined one-row frame would not.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Lengths of the compared periods and of the "new" windows.
PERIOD_SIZES = (1, 6, 12, 24, 48)
NEW_WINDOWS = {
    "novos_1mes": 1,
    "novos_6meses": 6,
    "novos_1ano": 12,
    "novos_2anos": 24,
    "novos_4anos": 48,
}
VALID_PERIOD = "^[0-9]{4}-(0[1-9]|1[0-2])$"


def month_add(day: dt.date, months: int) -> dt.date:
    """First of the month ``months`` after the month of ``day``."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def month_of(col: Column) -> Column:
    return F.trunc(col, "MM")


def anchor_frame(
    runs: DataFrame | None, establishments: DataFrame | None, today: dt.date | None = None
) -> DataFrame:
    """One row, one column ``mes_ancora``: the earlier of two months.

    One is the month before the reference period of the latest run that has a
    valid one, the other the month before that of the latest opening.  Each
    guards the other: the run history lies when views are rebuilt without a
    load, the data lies when the source has openings in the future.  Both
    tables go through one aggregate, which ignores the side a row has not got.
    """
    sides = []
    if runs is not None:
        run = F.struct("started_at", "run_id", "reference_period")
        valid = runs.filter(F.col("reference_period").rlike(VALID_PERIOD))
        sides.append(valid.select(run.alias("run"), F.lit(None).cast("date").alias("opened")))
    if establishments is not None:
        no_run = F.lit(None).cast(
            "struct<started_at:timestamp,run_id:string,reference_period:string>"
        )
        sides.append(
            establishments.select(no_run.alias("run"), F.col("data_inicio_atividade").alias("opened"))
        )
    if not sides:
        raise ValueError("an anchor needs the run history or the establishments")
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    latest = both.agg(F.max("run").alias("run"), F.max("opened").alias("opened"))
    by_run = F.add_months(F.to_date("run.reference_period", "yyyy-MM"), -1)
    by_data = F.add_months(month_of(F.col("opened")), -1)
    now = F.lit(today) if today else F.current_date()
    fallback = F.add_months(month_of(now), -1)
    return latest.select(F.coalesce(F.least(by_run, by_data), fallback).alias("mes_ancora"))


def anchor_month(
    runs: DataFrame | None, establishments: DataFrame | None, today: dt.date | None = None
) -> dt.date:
    return anchor_frame(runs, establishments, today).first()["mes_ancora"]


def window_starts(anchor: dt.date) -> dict[str, dt.date]:
    """First day of each "new in the last N months" window."""
    return {name: month_add(anchor, 1 - n) for name, n in NEW_WINDOWS.items()}


def window_end(anchor: dt.date) -> dt.date:
    """First day after every window."""
    return month_add(anchor, 1)


def anchor_windows(anchor_row: DataFrame) -> DataFrame:
    """The window bounds as columns beside ``mes_ancora``."""
    at = F.col("mes_ancora")
    names = {
        "ini_1mes": 0, "ini_6meses": -5, "ini_1ano": -11, "ini_2anos": -23, "ini_4anos": -47,
        "fim_exclusivo": 1,
    }
    return anchor_row.select(at, *[F.add_months(at, n).alias(c) for c, n in names.items()])


@dataclass(frozen=True)
class Period:
    """Two neighbouring windows of ``size`` months; bounds are inclusive months."""

    size: int
    current_start: dt.date
    current_end: dt.date
    previous_start: dt.date
    previous_end: dt.date


def periods(anchor: dt.date, sizes: tuple[int, ...] = PERIOD_SIZES) -> list[Period]:
    return [
        Period(
            n,
            month_add(anchor, 1 - n),
            anchor,
            month_add(anchor, 1 - 2 * n),
            month_add(anchor, -n),
        )
        for n in sizes
    ]


def period_windows(spark: SparkSession, anchor: dt.date, sizes=PERIOD_SIZES) -> DataFrame:
    """The windows of :func:`periods` as rows."""
    rows = [
        (p.size, anchor, p.current_start, p.current_end, p.previous_start, p.previous_end)
        for p in periods(anchor, tuple(sizes))
    ]
    schema = (
        "periodo_meses smallint, mes_ancora date, periodo_atual_inicio date, "
        "periodo_atual_fim date, periodo_anterior_inicio date, periodo_anterior_fim date"
    )
    return spark.createDataFrame(rows, schema)
