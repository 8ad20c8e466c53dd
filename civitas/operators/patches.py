"""Fixed corrections of the reference data, applied after the load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.functions.text import pad_code

# Codes in use that the published country file lacks.
MISSING_COUNTRIES = (
    ("008", "ABU DHABI"),
    ("009", "DIRCE"),
    ("015", "ALAND, ILHAS"),
    ("150", "JERSEY"),
    ("151", "CANARIAS, ILHAS"),
    ("200", "CURACAO"),
    ("321", "GUERNSEY"),
    ("359", "MAN, ILHA DE"),
    ("367", "INGLATERRA"),
    ("393", "JERSEY"),
    ("449", "MACEDONIA (ANTIGA REP. IUGOSLAVA)"),
    ("452", "MADEIRA, ILHA DA"),
    ("498", "MOLDAVIA"),
    ("578", "PALESTINA"),
    ("678", "SAO TOME E PRINCIPE"),
    ("699", "SAO MARTINHO, ILHA DE (PARTE HOLANDESA)"),
    ("737", "SERVIA"),
    ("994", "AZERBAIJAO"),
)
# Partner qualification and status reasons the files lack.
MISSING_QUALIFICATIONS = (("36", "Gerente-Delegado"),)
MISSING_REASONS = (
    ("32", "DECURSO DE PRAZO DE INTERRUPCAO TEMPORARIA"),
    ("81", "SOLICITACAO DA ADMINISTRACAO TRIBUTARIA MUNICIPAL/ESTADUAL - SC"),
    ("93", "CNPJ - TITULAR BAIXADO"),
)
# Roots whose tax regime rows have no company.
ORPHAN_REGIME_ROOTS = (
    "24417449",
    "24539162",
    "30721933",
    "30728066",
    "30760363",
    "30847991",
    "30857441",
    "30886793",
    "30972017",
)
# Fixed value: name given to a country code nobody documents.
UNKNOWN_COUNTRY = "CODIGO NAO CONSTANTE NA TABELA RFB"


def insert_if_missing(df: DataFrame, rows, key: str) -> DataFrame:
    """Add the literal rows whose key is not there yet."""
    extra = df.sparkSession.createDataFrame(list(rows), df.schema)
    return df.unionByName(extra.join(df.select(key), key, "left_anti"))


def pad_country(df: DataFrame) -> DataFrame:
    """Two-digit country codes get their third digit."""
    return df.withColumn("cod_pais", pad_code(F.col("cod_pais"), 3, 2))


def null_zero_country(df: DataFrame) -> DataFrame:
    """``'0'`` is no country."""
    return df.withColumn("cod_pais", F.nullif(F.col("cod_pais"), F.lit("0")))


def fill_porte(df: DataFrame, also_null: bool = False) -> DataFrame:
    """Empty company size becomes ``'00'``.

    A freshly loaded table holds NULL instead of empty text, so by default this
    changes nothing there; ``also_null`` fills those rows too.
    """
    size = F.col("cod_porte")
    empty = F.coalesce(size == "", F.lit(also_null))
    return df.withColumn("cod_porte", F.when(empty, F.lit("00")).otherwise(size))




def absorb_orphans(
    dim: DataFrame,
    facts: list[tuple[DataFrame, str]],
    key: str,
    label: str,
    name: str = UNKNOWN_COUNTRY,
) -> tuple[DataFrame, DataFrame]:
    """Add every orphan code under a fixed name; also return the added rows.

    The count of the second frame is worth reporting: a new orphan means the
    source changed.
    """
    used = None
    for fact, column in facts:
        one = fact.select(F.col(column).alias(key)).filter(F.col(key).isNotNull()).distinct()
        used = one if used is None else used.unionByName(one)
    added = (
        used.distinct().join(dim.select(key), key, "left_anti").withColumn(label, F.lit(name))
    )
    return dim.unionByName(added), added


def dedup_company(df: DataFrame, order_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per company root, a row with a name first.

    ``order_cols`` (source file and line, when kept) settle the rest; without
    them all columns do, so the choice never depends on physical order.

    The best row is a minimum over a struct, which combines map side: the
    copies of one root never have to meet in one task first.
    """
    ties = list(order_cols) or [c for c in df.columns if c != "cnpj_basico"]
    nameless = F.coalesce(F.trim("razao_social") == "", F.lit(True)).cast("int")
    row = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(
        nameless.alias("nameless"),
        *[
            part
            for i, c in enumerate(ties)
            for part in (F.col(c).isNull().cast("int").alias(f"n{i}"), F.col(c).alias(f"v{i}"))
        ],
    )
    return (
        df.groupBy("cnpj_basico")
        .agg(F.min_by(row, rank).alias("kept"))
        .select("kept.*")
        .select(*df.columns)
    )




def drop_keys(df: DataFrame, key: str, values) -> DataFrame:
    """Leave out the rows of the listed keys; rows without a key stay."""
    listed = F.coalesce(F.col(key).isin(*values), F.lit(False))
    return df.filter(~listed)


def apply_patches(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All corrections in their fixed order; returns every table, patched or not.

    Missing reference rows come first, then code normalisation, then orphan
    countries (after padding, or two-digit codes would enter the dimension),
    then duplicate companies and orphan regimes.
    """
    out = dict(tables)
    out["pais"] = insert_if_missing(out["pais"], MISSING_COUNTRIES, "cod_pais")
    out["qualificacao_socio"] = insert_if_missing(
        out["qualificacao_socio"], MISSING_QUALIFICATIONS, "cod_qualificacao"
    )
    out["motivo"] = insert_if_missing(out["motivo"], MISSING_REASONS, "cod_motivo")
    out["estabelecimento"] = null_zero_country(pad_country(out["estabelecimento"]))
    out["empresa"] = fill_porte(out["empresa"])
    out["pais"], _ = absorb_orphans(
        out["pais"],
        [(out["estabelecimento"], "cod_pais"), (out["socio"], "cod_pais")],
        "cod_pais",
        "nome_pais",
    )
    out["empresa"] = dedup_company(out["empresa"])
    out["simples"] = drop_keys(out["simples"], "cnpj_basico", ORPHAN_REGIME_ROOTS)
    return out
