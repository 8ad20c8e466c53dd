"""Geographic enrichment from a municipal code and a state abbreviation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Country codes that mean the establishment is in Brazil.
HOME_COUNTRY_CODES = ("105", "0105")
GEO_COLUMNS = ("cod_regiao_ibge", "cod_estado_ibge", "cod_cidade_ibge")
_PADDED_WIDTHS = (4, 7)


def city_spellings(cities: DataFrame) -> DataFrame:
    """Every written form of a municipal code that leads to a city.

    A code is tried as written, then zero-padded to four, then to seven
    digits, against the official code and against the code without leading
    zeros.  Listing the accepted inputs turns those tries into one equi-join;
    where two cities claim an input, the earlier try wins, then the official
    over the stripped code, then the lower city code.
    """
    code = F.trim("cod_municipio")
    bare = F.regexp_replace(code, "^0+", "")
    forms = (
        cities.filter(F.nullif(code, F.lit("")).isNotNull())
        .select("cod_cidade_ibge", "cod_estado_ibge", F.posexplode(F.array(code, bare)))
        .select("cod_cidade_ibge", "cod_estado_ibge", F.col("pos").alias("kind"),
                F.col("col").alias("key"))
    )
    inputs = forms.select("*", F.lit(0).alias("attempt"), F.col("key").alias("spelling"))
    for attempt, width in enumerate(_PADDED_WIDTHS, start=1):
        # inputs that become ``key`` once padded: ``key`` minus leading zeros
        zeros = F.length("key") - F.length(F.regexp_replace("key", "^0+", ""))
        shorter = F.transform(
            F.sequence(F.lit(0), zeros), lambda i: F.substr(F.col("key"), i + 1)
        )
        padded = (
            forms.filter(F.length("key") == width)
            .select("*", F.lit(attempt).alias("attempt"), F.explode(shorter).alias("spelling"))
        )
        inputs = inputs.unionByName(padded)
    first = Window.partitionBy("spelling").orderBy("attempt", "kind", "cod_cidade_ibge")
    return (
        inputs.filter("spelling <> ''")
        .withColumn("n", F.row_number().over(first))
        .filter("n = 1")
        .select("spelling", "cod_cidade_ibge", "cod_estado_ibge")
    )


def add_geo(
    df: DataFrame,
    cities: DataFrame,
    states: DataFrame,
    city: str = "cod_municipio",
    state: str = "uf",
    country: str = "cod_pais",
    guard_foreign: bool = True,
) -> DataFrame:
    """Add the region, state and city codes.

    The state is the city's own when known, else the one of the abbreviation;
    the region is that state's.  With ``guard_foreign`` a row of another
    country gets none of the three.
    """
    known = states.select(
        F.col("cod_estado_ibge").alias("_code"),
        F.col("cod_regiao_ibge").alias("_region"),
        F.upper(F.trim("sigla_uf")).alias("_uf"),
    )
    by_spelling = (
        city_spellings(cities)
        .join(known.drop("_uf"), F.col("cod_estado_ibge") == F.col("_code"), "left")
        .select(
            F.col("spelling").alias("_spelling"),
            F.col("cod_cidade_ibge").alias("_city"),
            F.col("_code").alias("_city_state"),
            F.col("_region").alias("_city_region"),
        )
    )
    # one row per abbreviation, whatever the dimension holds: a repeated one must
    # not multiply the rows that use it
    by_uf = (
        known.groupBy("_uf")
        .agg(F.min(F.struct("_code", "_region")).alias("_state"))
        .select(
            "_uf",
            F.col("_state._code").alias("_uf_state"),
            F.col("_state._region").alias("_uf_region"),
        )
    )
    at_home = F.lit(True)
    if guard_foreign:
        code = F.col(country)
        blank = F.coalesce(code, F.lit("")) == ""
        at_home = blank | F.trim(code).isin(*HOME_COUNTRY_CODES)
    own = F.col("_city_state").isNotNull()
    return (
        df.join(by_spelling, F.trim(F.col(city)) == F.col("_spelling"), "left")
        .join(by_uf, F.upper(F.trim(F.col(state))) == F.col("_uf"), "left")
        .withColumns(
            {
                "cod_regiao_ibge": F.when(
                    at_home, F.when(own, F.col("_city_region")).otherwise(F.col("_uf_region"))
                ),
                "cod_estado_ibge": F.when(at_home, F.coalesce("_city_state", "_uf_state")),
                "cod_cidade_ibge": F.when(at_home, F.col("_city")),
            }
        )
        .drop("_spelling", "_city", "_city_state", "_city_region", "_uf", "_uf_state", "_uf_region")
    )


def geo_dimensions(
    regions: DataFrame, states: DataFrame, cities: DataFrame
) -> dict[str, DataFrame]:
    """Dimension rows ready to load: coded rows only, one per code.

    Of several rows with one code the one that sorts first stays, whatever
    order the file was read in.
    """

    def unique(frame: DataFrame, key: str) -> DataFrame:
        others = [F.asc_nulls_last(c) for c in frame.columns if c != key]
        ranked = Window.partitionBy(key).orderBy(*others)
        return (
            frame.filter(F.col(key).isNotNull())
            .withColumn("_n", F.row_number().over(ranked))
            .filter("_n = 1")
            .drop("_n")
        )

    return {
        "ibge_regiao": unique(regions, "cod_regiao_ibge"),
        "ibge_estado": unique(
            states.filter(F.nullif(F.trim("sigla_uf"), F.lit("")).isNotNull()), "cod_estado_ibge"
        ),
        "ibge_cidade": unique(
            cities.filter(F.nullif(F.trim("cod_municipio"), F.lit("")).isNotNull()),
            "cod_cidade_ibge",
        ),
    }
