"""Numbers, dates, identifiers, hashes and NULL-aware comparisons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civitas.functions.text import STRIP_CHARS
from civitas.model.specs import TableSpec


def decimal_br_text(col: Column) -> Column:
    """``1.234,56`` to ``1234.56``; anything else is left as it is.

    Only text made of digits, dots and at least one comma (and one digit) is
    rewritten, so a signed or already plain number passes through.
    """
    digits = F.translate(col, ".,", "")
    is_br = F.contains(col, F.lit(",")) & digits.rlike("^[0-9]+\\z")
    return F.when(is_br, F.translate(F.translate(col, ".", ""), ",", ".")).otherwise(col)


def parse_decimal_br(col: Column, precision: int = 16, scale: int = 2) -> Column:
    """Decimal value of a number in either notation; NULL when unreadable."""
    return decimal_br_text(col).try_cast(f"decimal({precision},{scale})")


def is_missing_date(col: Column) -> Column:
    """The spellings that mean "no date"."""
    return F.btrim(col, F.lit(STRIP_CHARS)).isin("00000000", "", "0")


def parse_date8(col: Column) -> Column:
    """Date of ``YYYYMMDD`` or ISO text; NULL when missing or impossible."""
    value = F.btrim(col, F.lit(STRIP_CHARS))
    return (
        F.when(is_missing_date(col), F.lit(None).cast("date"))
        .when(value.rlike("^[0-9]{8}\\z"), F.try_to_date(value, "yyyyMMdd"))
        .when(value.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z"), value.try_cast("date"))
    )


def is_unreadable_date(col: Column) -> Column:
    """Text the load must reject: neither missing, nor 8 digits, nor ISO."""
    value = F.btrim(col, F.lit(STRIP_CHARS))
    tolerated = is_missing_date(col) | value.rlike("^[0-9]{8}\\z")
    return F.coalesce(~tolerated & parse_date8(col).isNull(), F.lit(False))


def parse_dates(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """:func:`parse_date8` on the date columns of ``spec``.

    Without a spec, on every text column whose name starts with ``data_``.
    """
    if spec is None:
        targets = [c for c, t in df.dtypes if c.startswith("data_") and t == "string"]
    else:
        text_now = {c for c, t in df.dtypes if t == "string"}
        targets = [c for c in spec.date_columns if c in text_now]
    return df.withColumns({c: parse_date8(F.col(c)) for c in targets})


def _zero_fill(col: Column, width: int) -> Column:
    value = F.coalesce(col, F.lit(""))
    return F.lpad(value, F.greatest(F.length(value), F.lit(width)), F.lit("0"))


def compose_id(basico: Column, ordem: Column, dv: Column) -> Column:
    """Fourteen-digit establishment id out of its three parts."""
    joined = F.concat(_zero_fill(basico, 8), _zero_fill(ordem, 4), _zero_fill(dv, 2))
    return F.rpad(F.substr(joined, F.lit(1), F.lit(14)), 14, "0")


def compose_id_raw(basico: Column, ordem: Column, dv: Column) -> Column:
    """The three parts as they are, without padding or cutting."""
    return F.concat(basico, ordem, dv)


def row_hash(columns: Iterable[Column]) -> Column:
    """md5 over the fields joined with ``|``; NULL counts as an empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def is_distinct(a: Column, b: Column) -> Column:
    """Inequality in which NULL is an ordinary value."""
    return ~a.eqNullSafe(b)


def least_non_null(*columns: Column) -> Column:
    """Smallest of the values present; NULL only when all are missing."""
    return F.least(*columns)
