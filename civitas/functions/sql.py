"""The indicator functions under their SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from civitas.functions.indicators import VARIATION_LIMIT


def register_functions(spark: SparkSession) -> None:
    """``fn_variacao_pct`` and ``fn_sobrevivencia_pct`` for SQL users.

    Both are SQL expressions, inlined into the calling query by the analyzer.
    """
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION fn_variacao_pct(atual BIGINT, anterior BIGINT)
        RETURNS DECIMAL(8,2)
        RETURN CASE WHEN anterior <> 0 THEN cast(greatest(least(
            round(cast(atual - anterior AS DECIMAL(20,0)) * 100 / cast(anterior AS DECIMAL(20,0)), 2),
            {VARIATION_LIMIT}BD), -{VARIATION_LIMIT}BD) AS DECIMAL(8,2)) END
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION fn_sobrevivencia_pct(ativos BIGINT, aberturas BIGINT)
        RETURNS DECIMAL(5,2)
        RETURN cast(round(cast(ativos AS DECIMAL(20,0)) * 100
            / cast(nullif(aberturas, 0) AS DECIMAL(20,0)), 2) AS DECIMAL(5,2))
        """
    )
    if not all(spark.catalog.tableExists(t) for t in ("pipeline_stats", "estabelecimento")):
        return  # the anchor can only be defined over existing tables
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION fn_mes_ancora()
        RETURNS DATE
        RETURN coalesce(
            least(
                (SELECT add_months(to_date(max_by(reference_period, struct(started_at, run_id)),
                                           'yyyy-MM'), -1)
                   FROM pipeline_stats
                  WHERE reference_period RLIKE '^[0-9]{4}-(0[1-9]|1[0-2])$'),
                (SELECT add_months(trunc(max(data_inicio_atividade), 'MM'), -1)
                   FROM estabelecimento)),
            add_months(trunc(current_date(), 'MM'), -1))
        """
    )
