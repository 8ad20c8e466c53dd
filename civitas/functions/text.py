"""Cleaning and matching of text columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a text strip removes at both ends.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The characters windows-1252 has outside Latin-1.
CP1252_EXTRAS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

_NOT_CP1252 = "[^\\x00-\\x7F\\xA0-\\xFF" + CP1252_EXTRAS + "]"


def sanitize(col: Column) -> Column:
    """Drop NUL, strip both ends, then drop what windows-1252 cannot hold.

    The order matters: a text ending in U+0085 loses it to the strip together
    with the blanks before it, while one ending in U+0091 keeps its blanks.
    """
    stripped = F.btrim(F.translate(col, "\x00", ""), F.lit(STRIP_CHARS))
    return F.regexp_replace(stripped, _NOT_CP1252, "")


def _text_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def sanitize_df(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`sanitize` on every text column except those in ``keep``."""
    texts = _text_columns(df) - set(keep)
    return df.select(*[sanitize(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns])


def empty_to_null(df: DataFrame) -> DataFrame:
    """``''`` becomes NULL in every text column."""
    texts = _text_columns(df)
    return df.select(
        *[F.when(F.col(c) != "", F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


# Upper-case letters whose plain spelling is not "the same letter
# without its mark".
SPECIAL_LETTERS = {
    "Æ": "AE",
    "Œ": "OE",
    "Þ": "TH",
    "ẞ": "SS",
    "Ĳ": "IJ",
    "Ø": "O",
    "Đ": "D",
    "Ð": "D",
    "Ħ": "H",
    "Ł": "L",
    "Ŧ": "T",
    "ı": "I",
}


# Signs and what they are spelled as.
SPECIAL_SIGNS = {
    "¡": "!",
    "©": "(C)",
    "ª": "a",
    "«": "<<",
    "®": "(R)",
    "±": "+/-",
    "º": "o",
    "»": ">>",
    "¼": " 1/4",
    "½": " 1/2",
    "¾": " 3/4",
    "¿": "?",
    "×": "*",
    "÷": "/",
    "‐": "-",
    "‑": "-",
    "‒": "-",
    "–": "-",
    "—": "-",
    "―": "-",
    "‘": "'",
    "’": "'",
    "‚": ",",
    "‛": "'",
    "“": '"',
    "”": '"',
    "„": ",,",
    "‥": "..",
    "…": "...",
    "‹": "<",
    "›": ">",
    "⁄": "/",
    "№": "No",
    "℃": "°C",
    "℉": "°F",
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "st",
    "ﬆ": "st",
}


def _marked_letters() -> dict[str, str]:
    """Accented capitals of the Latin-1, Extended-A and Vietnamese blocks."""
    found = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        plain = "".join(c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c))
        if char == char.upper() and len(plain) == 1 and plain != char and plain.isascii():
            found[char] = plain
    return found


FOLDED = {**_marked_letters(), **SPECIAL_LETTERS, **SPECIAL_SIGNS}
_ONE_TO_ONE = {k: v for k, v in FOLDED.items() if len(v) == 1}
_ONE_TO_MANY = {k: v for k, v in FOLDED.items() if len(v) > 1}


def normalize_name(col: Column) -> Column:
    """Upper case without accents, signs spelled out; names are stored and searched so.

    One letter for another is one pass for all of them.  Texts holding a character
    that becomes several are taken apart once and every character is looked up.
    """
    out = F.translate(F.upper(col), "".join(_ONE_TO_ONE), "".join(_ONE_TO_ONE.values()))
    spelled = F.create_map(*[F.lit(x) for pair in _ONE_TO_MANY.items() for x in pair])
    chars = F.transform(F.split(out, ""), lambda c: F.coalesce(F.try_element_at(spelled, c), c))
    rare = "[" + "".join(_ONE_TO_MANY) + "]"
    return F.when(F.rlike(out, F.lit(rare)), F.array_join(chars, "")).otherwise(out)


def pad_code(col: Column, width: int, only_len: int) -> Column:
    """Left-pad with zeros, but only codes whose trimmed length is ``only_len``."""
    return F.when(F.length(F.trim(col)) == only_len, F.lpad(col, width, "0")).otherwise(col)


def label_codes(col: Column, mapping: dict[str, str]) -> Column:
    """Readable label of a code; NULL for codes outside the mapping."""
    pairs = list(mapping.items())
    out = F.when(col == pairs[0][0], F.lit(pairs[0][1]))
    for code, label in pairs[1:]:
        out = out.when(col == code, F.lit(label))
    return out


# Labels of the establishment kind and of the partner kind.
ESTABLISHMENT_KINDS = {"1": "MATRIZ", "2": "FILIAL"}
PARTNER_KINDS = {"1": "Pessoa Jurídica", "2": "Pessoa Física", "3": "Estrangeiro"}


def normalize_period(col: Column) -> Column:
    """``MM/YYYY`` or ``YYYY-M`` to ``YYYY-MM``; other text is only trimmed."""
    value = F.nullif(F.btrim(col, F.lit(STRIP_CHARS)), F.lit(""))
    blank = F.nullif(col, F.lit(""))

    def two_digits(part: Column) -> Column:
        return F.lpad(part, F.greatest(F.length(part), F.lit(2)), F.lit("0"))

    slash, dash = F.instr(value, "/"), F.instr(value, "-")
    month = F.btrim(F.substr(value, F.lit(1), slash - 1), F.lit(STRIP_CHARS))
    year = F.btrim(F.substr(value, slash + 1), F.lit(STRIP_CHARS))
    tail = F.substr(value, dash + 1)
    return (
        F.when(blank.isNull(), F.lit(None).cast("string"))
        .when(slash > 0, F.concat(year, F.lit("-"), two_digits(month)))
        .when(dash == 5, F.concat(F.substr(value, F.lit(1), F.lit(5)), two_digits(tail)))
        .otherwise(F.btrim(col, F.lit(STRIP_CHARS)))
    )


def has_email(col: Column) -> Column:
    return col.isNotNull() & (col != "")


def is_prospect_email(col: Column) -> Column:
    """A usable address that does not look like an accounting office."""
    return has_email(col) & ~F.lower(col).contains("contab")


def starts_with(col: Column, term: str, ignore_case: bool = False) -> Column:
    """Prefix match; the case-sensitive form reaches the Parquet scan."""
    if ignore_case:
        return F.lower(col).startswith(term.lower())
    return col.startswith(term)


def contains(col: Column, term: str, ignore_case: bool = False) -> Column:
    """Substring match anywhere in the text."""
    if ignore_case:
        return F.lower(col).contains(term.lower())
    return col.contains(term)
