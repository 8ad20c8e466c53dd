"""Percentages of the comparison views, all in decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(20,0)"

# Fixed value: where a variation stops growing, the edge of decimal(8,2).
VARIATION_LIMIT = "999999.99"


def _percent(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` rounded half up to two places; ``whole`` <> 0."""
    return F.round(part.cast(_WIDE) * F.lit(100) / whole.cast(_WIDE), 2)


def variation_pct(current: Column, previous: Column) -> Column:
    """Change against the previous period, cut at plus or minus 999999.99.

    NULL when there is no previous value to compare with.  The cut happens
    before the cast because an overflowing cast raises in ANSI mode.
    """
    change = _percent(current - previous, F.nullif(previous, F.lit(0)))
    limit = F.lit(VARIATION_LIMIT).cast("decimal(8,2)")
    inside = F.greatest(F.least(change, limit), -limit)
    # greatest/least skip NULL, so an undefined change has to be restored.
    return F.when(change.isNotNull(), inside).cast("decimal(8,2)")


def survival_pct(still_active: Column, openings: Column) -> Column:
    """Share of a cohort still active; NULL for an empty cohort."""
    return _percent(still_active, F.nullif(openings, F.lit(0))).cast("decimal(5,2)")


def ratio_pct(part: Column, whole: Column) -> Column:
    """Guarded percentage for reports; NULL when ``whole`` is zero."""
    return _percent(part, F.nullif(whole, F.lit(0))).cast("decimal(18,2)")
