"""Column functions on literal edge rows."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from civitas.functions import indicators, text
from civitas.functions import values as v
from civitas.model.specs import spec


def apply(spark, items, function, kind="string"):
    rows = [(i, item) for i, item in enumerate(items)]
    frame = spark.createDataFrame(rows, f"i int, c {kind}")
    return [r[0] for r in frame.orderBy("i").select(function(F.col("c"))).collect()]


def python_sanitize(value):
    stripped = value.replace("\x00", "").strip()
    return stripped.encode("windows-1252", "ignore").decode("windows-1252")


DIRTY = [
    None,
    "",
    "   ",
    "\x00 A \x00",
    "plain",
    "end\x85",
    "\xa0both\xa0",
    "keep \x91",
    "mid\x91dle\x9f",
    "tab\tin\tside\t",
    "line\nbreak\n",
    'quote "x"; semi',
    "café ção ÿ",
    "euro € dash – bullet •",
    "greek αβγ emoji 😀 end",
    "\x1c\x1fsep\x1e",
    " wide　",
    "soft\xadhyphen",
]


def test_sanitize_equals_the_python_rule(spark):
    got = apply(spark, DIRTY, text.sanitize)
    assert got == [None if s is None else python_sanitize(s) for s in DIRTY]


def test_sanitize_df_touches_only_text(spark):
    frame = spark.createDataFrame([(1, " a ", " b ")], "n int, t string, keep string")
    assert text.sanitize_df(frame, keep=("keep",)).first() == (1, "a", " b ")


def test_empty_to_null(spark):
    frame = spark.createDataFrame([("", " ", 0)], "a string, b string, n int")
    assert text.empty_to_null(frame).first() == (None, " ", 0)


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("1.234,56", "1234.56"),
        ("10,5", "10.5"),
        ("-1,0", "-1,0"),
        ("1234", "1234"),
        ("1.234", "1.234"),
        (",", ","),
        ("1,2,3", "1.2.3"),
        ("abc,1", "abc,1"),
        (None, None),
    ],
)
def test_decimal_br_text(spark, raw, expected):
    assert apply(spark, [raw], v.decimal_br_text) == [expected]


def test_parse_decimal_br(spark):
    items = ["1.234,56", "10,5", "-1,0", "1234", "1.234", "-7.5", "x", None, "1,2,3"]
    got = apply(spark, items, v.parse_decimal_br)
    assert got == [
        Decimal("1234.56"), Decimal("10.50"), None, Decimal("1234.00"), Decimal("1.23"),
        Decimal("-7.50"), None, None, None,
    ]


def test_parse_date8(spark):
    items = ["00000000", "0", "", " ", "20230230", "20230228", " 20230228 ", "2023-02-28", "abc",
             None, "2023022"]
    day = dt.date(2023, 2, 28)
    assert apply(spark, items, v.parse_date8) == [
        None, None, None, None, None, day, day, day, None, None, None,
    ]
    assert apply(spark, items, v.is_unreadable_date) == [
        False, False, False, False, False, False, False, False, True, False, True,
    ]


def test_parse_dates_by_table_and_by_name(spark):
    frame = spark.createDataFrame(
        [("1", "20200101", "20200102")], "cnpj_basico string, data_opcao_mei string, data_x string"
    )
    by_table = v.parse_dates(frame, spec("simples"))
    assert by_table.dtypes[1:] == [("data_opcao_mei", "date"), ("data_x", "string")]
    assert [t for _, t in v.parse_dates(frame).dtypes[1:]] == ["date", "date"]


def test_compose_id(spark):
    rows = [
        ("12345678", "0001", "00"),
        ("1", "2", "3"),
        (None, None, None),
        ("123456789", "0001", "99"),
        ("", "", ""),
    ]
    frame = spark.createDataFrame(rows, "b string, o string, d string")
    got = [r[0] for r in frame.select(v.compose_id(F.col("b"), F.col("o"), F.col("d"))).collect()]
    expected = [
        ((b or "").zfill(8) + (o or "").zfill(4) + (d or "").zfill(2))[:14].ljust(14, "0")
        for b, o, d in rows
    ]
    assert got == expected
    raw = frame.select(v.compose_id_raw(F.col("b"), F.col("o"), F.col("d"))).collect()[1][0]
    assert raw == "123"


def test_normalize_name(spark):
    items = ["São João & Cia", "ÀÉÎÕÜ ç ñ", "Straße", "Æther œuvre", "Øre đ", None, "ABC 1"]
    assert apply(spark, items, text.normalize_name) == [
        "SAO JOAO & CIA", "AEIOU C N", "STRASSE", "AETHER OEUVRE", "ORE D", None, "ABC 1",
    ]


def test_normalize_name_folds_every_mapped_character(spark):
    """Alone, between letters, and all in one text, against a reading of the table."""
    mapped = text.FOLDED
    items = [*mapped, *[f"x{c}y{c}" for c in mapped], "".join(mapped), "1ª LOJA «½ m²» – S…", "", " "]

    def plain(value):
        upper = "".join(c if c in mapped else c.upper() for c in value)
        return "".join(mapped.get(c, c) for c in upper)

    # the capital of these is a letter of its own or several letters
    changed = [c for c in mapped if c.upper() != c]
    assert changed == ["ı", "ﬀ", "ﬁ", "ﬂ", "ﬃ", "ﬄ", "ﬅ", "ﬆ"]
    for c in changed:
        items = [i for i in items if c not in i]
    assert apply(spark, items, text.normalize_name) == [plain(i) for i in items]
    assert apply(spark, changed, text.normalize_name) == ["I", "FF", "FI", "FL", "FFI", "FFL", "ST", "ST"]
    assert apply(spark, ["1ª LOJA «½ m²»"], text.normalize_name) == ["1a LOJA << 1/2 M²>>"]


def test_pad_code(spark):
    items = ["23", " 3", "105", "0", None, "7 "]
    assert apply(spark, items, lambda c: text.pad_code(c, 3, 2)) == [
        "023", " 3", "105", "0", None, "7 ",
    ]


def test_row_hash_treats_null_as_empty(spark):
    rows = [("a", None, dt.date(2020, 1, 2), 7), ("a", "", dt.date(2020, 1, 2), 7)]
    frame = spark.createDataFrame(rows, "x string, y string, d date, n int")
    got = [r[0] for r in frame.select(v.row_hash([F.col(c) for c in frame.columns])).collect()]
    assert got == [hashlib.md5(b"a||2020-01-02|7").hexdigest()] * 2


def test_labels(spark):
    kinds = apply(spark, ["1", "2", "9", None], lambda c: text.label_codes(c, text.ESTABLISHMENT_KINDS))
    assert kinds == ["MATRIZ", "FILIAL", None, None]


def test_normalize_period(spark):
    items = ["07/2026", "7/2026", "2026-07", "2026-7", None, "", " 7 / 2026 ", "202607"]
    assert apply(spark, items, text.normalize_period) == [
        "2026-07", "2026-07", "2026-07", "2026-07", None, None, "2026-07", "202607",
    ]
    again = apply(spark, ["2026-07"], lambda c: text.normalize_period(text.normalize_period(c)))
    assert again == ["2026-07"]


def test_prospect_email(spark):
    items = ["a@b.c", "x@CONTABil.com", "", None]
    assert apply(spark, items, text.is_prospect_email) == [True, False, False, False]


def test_matching(spark):
    items = ["MARIA", "maria", "ANA MARIA"]
    assert apply(spark, items, lambda c: text.starts_with(c, "MA")) == [True, False, False]
    assert apply(spark, items, lambda c: text.starts_with(c, "MA", True)) == [True, True, False]
    assert apply(spark, items, lambda c: text.contains(c, "MAR")) == [True, False, True]
    assert apply(spark, items, lambda c: text.contains(c, "mar", True)) == [True, True, True]


def test_null_aware_comparisons(spark):
    frame = spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 2)], "a int, b int")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in frame.select(v.is_distinct(a, b)).collect()] == [False, True, False, True]
    assert [r[0] for r in frame.select(v.least_non_null(a, b)).collect()] == [1, 1, None, 1]


def test_indicators(spark):
    rows = [(150, 100), (1, 3), (0, 5), (5, 0), (5, None), (10**9, 1), (-(10**9), 1), (1005, 1000)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    a, b = F.col("a"), F.col("b")
    got = [r[0] for r in frame.select(indicators.variation_pct(a, b)).collect()]
    assert got == [
        Decimal("50.00"), Decimal("-66.67"), Decimal("-100.00"), None, None,
        Decimal("999999.99"), Decimal("-999999.99"), Decimal("0.50"),
    ]
    few = frame.filter("b IS NULL OR abs(a) < 1000000")
    assert [r[0] for r in few.select(indicators.survival_pct(a, b)).collect()][:4] == [
        Decimal("150.00"), Decimal("33.33"), Decimal("0.00"), None,
    ]
    assert frame.select(indicators.ratio_pct(a, b)).collect()[3][0] is None


def test_rounding_is_half_away_from_zero(spark):
    rows = [(1, 800), (-1, 800), (3, 800)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    got = [r[0] for r in frame.select(indicators.ratio_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13"), Decimal("0.38")]
