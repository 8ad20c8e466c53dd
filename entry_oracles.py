"""DuckDB SQL for every registered query, written against the driver tables.

``_CTES`` holds the registry-shaped tables as SQL; ``_sql`` puts the ones a
query mentions in front of it.  The statements are written independently of
the Spark plans: they follow the definitions, not the jobs.
"""

from __future__ import annotations

import re

_CTES: dict[str, str] = {}

_CTES["ibge_regiao"] = """
SELECT (r_regionkey + 1)::INTEGER AS cod_regiao_ibge, substr(r_name, 1, 2) AS sigla_regiao,
       r_name AS nome_regiao
FROM region
"""
_CTES["ibge_estado"] = """
SELECT (n_nationkey + 1)::INTEGER AS cod_estado_ibge, n_name AS sigla_uf, n_name AS nome_estado,
       (-n_nationkey)::DECIMAL(9,6) AS latitude, (-n_nationkey * 2)::DECIMAL(9,6) AS longitude,
       (n_regionkey + 1)::INTEGER AS cod_regiao_ibge
FROM nation
"""
_CTES["ibge_cidade"] = """
SELECT ((n_nationkey + 1) * 100 + k)::INTEGER AS cod_cidade_ibge,
       n_name || '_C' || k::VARCHAR AS nome_cidade,
       (-k)::DECIMAL(9,6) AS latitude, (-k * 3)::DECIMAL(9,6) AS longitude,
       k = 0 AS capital, (n_nationkey + 1)::INTEGER AS cod_estado_ibge,
       lpad(((n_nationkey + 1) * 100 + k)::VARCHAR, 4, '0') AS cod_municipio,
       (k + 11)::VARCHAR AS ddd, 'UTC' AS fuso_horario
FROM nation, generate_series(0, 7) AS g(k)
"""
_CTES["cnae"] = """
SELECT DISTINCT lpad(substr(p_brand, 7), 7, '0') AS cod_cnae, p_brand AS nome_cnae FROM part
"""
_CTES["natureza_juridica"] = """
SELECT cod_natureza, 'Forma ' || cod_natureza AS nome_natureza
FROM (SELECT DISTINCT c_mktsegment AS cod_natureza FROM customer
      UNION ALL SELECT 'SEM EMPRESA') f
"""
_CTES["pais"] = """
SELECT lpad((n_nationkey * 5)::VARCHAR, 3, '0') AS cod_pais, n_name AS nome_pais FROM nation
"""
_CTES["motivo"] = """
SELECT DISTINCT lpad(substr(o_orderpriority, 1, 1), 2, '0') AS cod_motivo,
       o_orderpriority AS nome_motivo FROM orders
"""
_CTES["municipio_rfb"] = """
SELECT cod_municipio, upper(nome_cidade) AS nome_municipio FROM ibge_cidade
"""
_CTES["qualificacao_socio"] = """
SELECT DISTINCT lpad(p_size::VARCHAR, 2, '0') AS cod_qualificacao,
       'Qualificação ' || p_size::VARCHAR AS nome_qualificacao FROM part
"""
_CTES["empresa"] = """
SELECT lpad(c_custkey::VARCHAR, 8, '0') AS cnpj_basico, c_name AS razao_social,
       c_mktsegment AS cod_natureza_juridica,
       lpad((c_custkey % 53 + 1)::VARCHAR, 2, '0') AS cod_qualificacao_responsavel,
       c_acctbal::DECIMAL(16,2) AS capital_social,
       CASE WHEN c_acctbal < 0 THEN '00' WHEN c_acctbal < 3000 THEN '01'
            WHEN c_acctbal < 6000 THEN '03' ELSE '05' END AS cod_porte,
       NULL::VARCHAR AS ente_federativo_responsavel
FROM customer
"""
_CTES["simples"] = """
SELECT lpad(c_custkey::VARCHAR, 8, '0') AS cnpj_basico,
       CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END AS opcao_simples,
       CASE WHEN c_custkey % 2 = 0 THEN DATE '1996-01-01' + (c_custkey % 1000)::INTEGER END
           AS data_opcao_simples,
       NULL::DATE AS data_exclusao_simples,
       CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE 'N' END AS opcao_mei,
       CASE WHEN c_custkey % 3 = 0 THEN DATE '1996-01-01' + (c_custkey % 1000)::INTEGER END
           AS data_opcao_mei,
       NULL::DATE AS data_exclusao_mei
FROM customer WHERE c_custkey % 5 <> 0
"""
_CTES["socio"] = """
SELECT lpad(o_custkey::VARCHAR, 8, '0') AS cnpj_basico,
       (l_suppkey % 3 + 1)::VARCHAR AS identificador_socio, s_name AS nome_socio,
       lpad(l_suppkey::VARCHAR, 14, '0') AS cnpj_cpf_socio,
       lpad((l_suppkey % 53 + 1)::VARCHAR, 2, '0') AS cod_qualificacao_socio,
       entry AS data_entrada_sociedade,
       CASE WHEN l_suppkey % 11 = 0 THEN '042' WHEN l_suppkey % 7 = 0 THEN '105' END AS cod_pais,
       NULL::VARCHAR AS cpf_representante_legal, NULL::VARCHAR AS nome_representante_legal,
       CASE WHEN l_suppkey % 13 = 0 THEN lpad((l_suppkey % 60 + 1)::VARCHAR, 2, '0') END
           AS cod_qualificacao_representante_legal,
       (l_suppkey % 9 + 1)::VARCHAR AS cod_faixa_etaria
FROM (SELECT o_custkey, l_suppkey, min(l_shipdate)::DATE AS entry
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) p
LEFT JOIN supplier ON l_suppkey = s_suppkey
"""
_CTES["estabelecimento"] = """
SELECT lpad(o_custkey::VARCHAR, 8, '0') AS cnpj_basico,
       substr(lpad(o_orderkey::VARCHAR, 14, '0'), 9, 4) AS cnpj_ordem,
       substr(lpad(o_orderkey::VARCHAR, 14, '0'), 13, 2) AS cnpj_dv,
       lpad(o_orderkey::VARCHAR, 14, '0') AS cnpj_completo,
       CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1
            THEN '1' ELSE '2' END AS matriz_filial,
       'Café ' || p_name AS nome_fantasia,
       CASE o_orderstatus WHEN 'O' THEN '02' WHEN 'F' THEN '08' ELSE '04' END
           AS cod_situacao_cadastral,
       last_ship AS data_situacao_cadastral,
       CASE WHEN o_orderkey % 101 = 0 THEN '99'
            ELSE lpad(substr(o_orderpriority, 1, 1), 2, '0') END AS cod_motivo_situacao_cadastral,
       NULL::VARCHAR AS nome_cidade_exterior,
       CASE WHEN o_orderkey % 11 = 0 THEN '105' WHEN o_orderkey % 13 = 0 THEN '23'
            WHEN o_orderkey % 17 = 0 THEN '0' END AS cod_pais,
       o_orderdate::DATE AS data_inicio_atividade,
       lpad(substr(p_brand, 7), 7, '0') AS cod_cnae_principal,
       NULL::VARCHAR AS cod_cnae_secundario, 'RUA' AS tipo_logradouro,
       'Rua ' || (o_orderkey % 500)::VARCHAR AS logradouro,
       (o_orderkey % 1000)::VARCHAR AS numero, NULL::VARCHAR AS complemento,
       'São ' || o_orderpriority AS bairro,
       lpad((o_orderkey % 100000)::VARCHAR, 8, '0') AS cep,
       'NATION_' || c_nationkey::VARCHAR AS uf,
       CASE WHEN o_orderkey % 97 <> 0
            THEN lpad(((c_nationkey + 1) * 100 + c_custkey % 8)::VARCHAR, 4, '0') END AS cod_municipio,
       CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 89 + 11)::VARCHAR END AS ddd_telefone_1,
       CASE WHEN o_orderkey % 4 <> 0 THEN '999' END AS telefone_1,
       CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 7 + 11)::VARCHAR END AS ddd_telefone_2,
       CASE WHEN o_orderkey % 3 = 0 THEN '888' END AS telefone_2,
       NULL::VARCHAR AS ddd_fax, NULL::VARCHAR AS fax,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'x@CONTABil.com'
            ELSE 'u@e.com' END AS email,
       NULL::VARCHAR AS situacao_especial, NULL::DATE AS data_situacao_especial,
       CASE WHEN o_orderkey % 194 <> 0 THEN (n_regionkey + 1)::INTEGER END AS cod_regiao_ibge,
       CASE WHEN o_orderkey % 194 <> 0 THEN (c_nationkey + 1)::INTEGER END AS cod_estado_ibge,
       CASE WHEN o_orderkey % 97 <> 0
            THEN ((c_nationkey + 1) * 100 + c_custkey % 8)::INTEGER END AS cod_cidade_ibge
FROM orders
LEFT JOIN (SELECT l_orderkey, max(l_shipdate)::DATE AS last_ship FROM lineitem GROUP BY 1) sh
       ON l_orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey AS line_of, min(l_partkey) AS first_part
           FROM (SELECT l_orderkey, l_partkey,
                        rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
                 FROM lineitem) ranked
           WHERE place = 1 GROUP BY l_orderkey) lines ON line_of = o_orderkey
LEFT JOIN part ON p_partkey = first_part
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
"""
_CTES["estabelecimento_cnae_sec"] = """
SELECT e.cnpj_completo, s.cod_cnae, e.cod_regiao_ibge::SMALLINT AS cod_regiao_ibge,
       e.cod_estado_ibge::SMALLINT AS cod_estado_ibge, e.cod_cidade_ibge, e.data_inicio_atividade
FROM (SELECT DISTINCT lpad(l_orderkey::VARCHAR, 14, '0') AS cnpj_completo,
             lpad(substr(p_brand, 7), 7, '0') AS cod_cnae
      FROM lineitem JOIN part ON l_partkey = p_partkey) s
JOIN estabelecimento e ON e.cnpj_completo = s.cnpj_completo
"""
_CTES["listas_secundarias"] = """
SELECT l_orderkey, string_agg(cod, ', ' ORDER BY cod) || ',,' AS codes
FROM (SELECT DISTINCT l_orderkey, lpad(substr(p_brand, 7), 7, '0') AS cod
      FROM lineitem JOIN part ON l_partkey = p_partkey) d GROUP BY 1
"""
_CTES["estabelecimento_file"] = """
SELECT o_custkey::VARCHAR AS cnpj_basico, (o_orderkey % 9999)::VARCHAR AS cnpj_ordem,
       (o_orderkey % 97)::VARCHAR AS cnpj_dv,
       CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '2' END AS matriz_filial,
       '  Loja ' || o_orderpriority || chr(145) || ' ' || chr(133) AS nome_fantasia,
       CASE WHEN o_orderstatus = 'O' THEN '02' ELSE '08' END AS cod_situacao_cadastral,
       '00000000' AS data_situacao_cadastral, '01' AS cod_motivo_situacao_cadastral,
       '' AS nome_cidade_exterior,
       CASE WHEN o_orderkey % 11 = 0 THEN '105' WHEN o_orderkey % 13 = 0 THEN '23'
            WHEN o_orderkey % 17 = 0 THEN ' 0105 ' ELSE '' END AS cod_pais,
       CASE o_orderkey % 10 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN '00000000'
            WHEN 2 THEN '20230230' WHEN 3 THEN '0' WHEN 4 THEN ' '
            ELSE strftime(o_orderdate, '%Y%m%d') END AS data_inicio_atividade,
       o_orderdate::DATE AS opened, o_orderkey, c_nationkey, c_custkey,
       lpad((o_orderkey % 25 + 1)::VARCHAR, 7, '0') AS cod_cnae_principal,
       coalesce(codes, '') AS cod_cnae_secundario, 'RUA' AS tipo_logradouro,
       'A; "B"' AS logradouro, (o_orderkey % 1000)::VARCHAR AS numero, '' AS complemento,
       'CENTRO' AS bairro, lpad((o_orderkey % 100000)::VARCHAR, 8, '0') AS cep,
       'nation_' || c_nationkey::VARCHAR AS uf,
       CASE WHEN o_orderkey % 97 = 0 THEN '9999'
            WHEN o_orderkey % 3 = 0 THEN ((c_nationkey + 1) * 100 + c_custkey % 8)::VARCHAR
            WHEN o_orderkey % 3 = 1
            THEN lpad(((c_nationkey + 1) * 100 + c_custkey % 8)::VARCHAR, 4, '0')
            ELSE lpad(((c_nationkey + 1) * 100 + c_custkey % 8)::VARCHAR, 7, '0') END AS cod_municipio
FROM orders JOIN customer ON c_custkey = o_custkey
LEFT JOIN listas_secundarias ON l_orderkey = o_orderkey
"""
_CTES["pipeline_stats"] = """
SELECT event_id::VARCHAR AS run_id,
       CASE WHEN event_id % 10 = 3 THEN '13/2001'
            ELSE strftime(ts - INTERVAL 269 MONTH, '%Y-%m') END AS reference_period,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'partial'
            ELSE 'completed' END AS status,
       ts AS started_at,
       ts + to_seconds(trunc(value)::INTEGER * 60) AS finished_at,
       (trunc(value)::INTEGER * 60)::DECIMAL(18,2) AS duration_seconds,
       json_extract(props, '$.k')::BIGINT * 1000 AS records_inserted_total,
       2 AS files_downloaded_count,
       json_extract(props, '$.k')::BIGINT AS k, event_id,
       CASE WHEN event_type = 'error' THEN 'boom' END AS error
FROM events
"""
_CTES["ciclos"] = """
SELECT load_id, 'dados_' || load_id AS schema_nome,
       CASE WHEN load_id::INTEGER % 3 = 0 THEN 'validado' ELSE 'publicado' END AS etapa,
       CASE WHEN load_id::INTEGER % 3 <> 0 THEN last_day END AS publicado_em,
       n AS linhas_estabelecimento
FROM (SELECT strftime(o_orderdate, '%Y%m') AS load_id, max(o_orderdate) AS last_day, count(*) AS n
      FROM orders GROUP BY 1) m
"""
_CTES["remote_files"] = """
SELECT (CASE doc_id % 5 WHEN 0 THEN 'Empresas' WHEN 1 THEN 'ESTABELECIMENTOS' WHEN 2 THEN 'socios'
        WHEN 3 THEN 'Cnaes' ELSE 'Leiame' END) || doc_id::VARCHAR || '.zip' AS filename,
       n_chars AS size_bytes, doc_id
FROM documents
"""
_CTES["local_files"] = """
SELECT CASE WHEN doc_id % 13 = 0 THEN 'old_' || filename ELSE filename END AS filename,
       CASE WHEN doc_id % 11 = 0 THEN size_bytes - 1 ELSE size_bytes END AS size_bytes
FROM remote_files WHERE doc_id % 7 <> 0
"""
_CTES["remote_folders"] = """
SELECT CASE WHEN o_orderkey % 100 = 0 THEN 'temp'
            WHEN o_orderkey % 100 = 1 THEN strftime(o_orderdate, '%Y%m')
            ELSE strftime(o_orderdate, '%Y-%m') END AS name
FROM orders
"""
_CTES["anchor_arms"] = """
SELECT (SELECT strptime(reference_period || '-01', '%Y-%m-%d')::DATE - INTERVAL 1 MONTH
        FROM pipeline_stats
        WHERE regexp_matches(reference_period, '^[0-9]{4}-(0[1-9]|1[0-2])$')
        ORDER BY started_at DESC, run_id DESC LIMIT 1)::DATE AS by_run,
       (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 1 MONTH FROM orders)::DATE AS by_data
"""
_CTES["ancora"] = """
SELECT coalesce(least(by_run, by_data),
                (date_trunc('month', current_date) - INTERVAL 1 MONTH)::DATE) AS mes_ancora
FROM anchor_arms
"""
_CTES["janelas"] = """
SELECT mes_ancora, mes_ancora AS ini_1mes, (mes_ancora - INTERVAL 5 MONTH)::DATE AS ini_6meses,
       (mes_ancora - INTERVAL 11 MONTH)::DATE AS ini_1ano,
       (mes_ancora - INTERVAL 23 MONTH)::DATE AS ini_2anos,
       (mes_ancora - INTERVAL 47 MONTH)::DATE AS ini_4anos,
       (mes_ancora + INTERVAL 1 MONTH)::DATE AS fim_exclusivo
FROM ancora
"""
_CTES["periodos"] = """
SELECT n::SMALLINT AS periodo_meses, mes_ancora,
       (mes_ancora - to_months(n - 1))::DATE AS periodo_atual_inicio,
       mes_ancora AS periodo_atual_fim,
       (mes_ancora - to_months(2 * n - 1))::DATE AS periodo_anterior_inicio,
       (mes_ancora - to_months(n))::DATE AS periodo_anterior_fim
FROM ancora, (VALUES (1), (6), (12), (24), (48)) AS p(n)
"""


def _new(only: tuple[str, ...] = ("1mes", "6meses", "1ano", "2anos", "4anos")) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE e.data_inicio_atividade >= j.ini_{w}"
        f" AND e.data_inicio_atividade < j.fim_exclusivo) AS novos_{w}"
        for w in only
    )


_ACT = "e.cod_situacao_cadastral = '02'"
_TERRITORY = f"""
count(*) AS total_estabelecimentos, count(*) FILTER (WHERE {_ACT}) AS ativos,
count(*) FILTER (WHERE {_ACT} AND e.matriz_filial = '1') AS matrizes_ativas,
count(*) FILTER (WHERE {_ACT} AND e.matriz_filial = '2') AS filiais_ativas,
count(DISTINCT e.cnpj_basico) AS total_empresas
"""
_MAIL = "e.email IS NOT NULL AND e.email <> ''"

_CTES["mv_stats_estado"] = f"""
SELECT e.cod_estado_ibge, d.sigla_uf, d.nome_estado, d.cod_regiao_ibge, {_TERRITORY},
       {_new()}, j.mes_ancora
FROM estabelecimento e JOIN ibge_estado d ON e.cod_estado_ibge = d.cod_estado_ibge, janelas j
GROUP BY e.cod_estado_ibge, d.sigla_uf, d.nome_estado, d.cod_regiao_ibge, j.mes_ancora
"""
_CTES["mv_stats_municipio"] = f"""
SELECT e.cod_cidade_ibge, m.nome_cidade, e.cod_estado_ibge, d.sigla_uf, d.cod_regiao_ibge,
       {_TERRITORY}, min(e.data_inicio_atividade) AS primeira_abertura,
       max(e.data_inicio_atividade) AS ultima_abertura, {_new()}, j.mes_ancora
FROM estabelecimento e JOIN ibge_cidade m ON e.cod_cidade_ibge = m.cod_cidade_ibge
JOIN ibge_estado d ON e.cod_estado_ibge = d.cod_estado_ibge, janelas j
GROUP BY e.cod_cidade_ibge, m.nome_cidade, e.cod_estado_ibge, d.sigla_uf, d.cod_regiao_ibge,
         j.mes_ancora
"""
_CTES["mv_stats_cnae"] = f"""
SELECT e.cod_cnae_principal, c.nome_cnae, count(*) AS total_estabelecimentos,
       count(*) FILTER (WHERE {_ACT}) AS ativos,
       count(DISTINCT e.cod_estado_ibge) AS estados_presentes,
       count(DISTINCT e.cod_cidade_ibge) AS cidades_presentes,
       count(*) FILTER (WHERE e.matriz_filial = '1') AS matrizes,
       count(*) FILTER (WHERE {_MAIL}) AS com_email,
       count(*) FILTER (WHERE e.telefone_1 IS NOT NULL) AS com_telefone, {_new()}, j.mes_ancora
FROM estabelecimento e LEFT JOIN cnae c ON e.cod_cnae_principal = c.cod_cnae, janelas j
GROUP BY e.cod_cnae_principal, c.nome_cnae, j.mes_ancora
"""
_CTES["mv_stats_cnae_estado"] = f"""
SELECT e.cod_cnae_principal, e.cod_estado_ibge, count(*) AS total,
       count(*) FILTER (WHERE {_ACT}) AS ativos, count(*) FILTER (WHERE {_MAIL}) AS com_email,
       count(*) FILTER (WHERE e.matriz_filial = '1') AS matrizes
FROM estabelecimento e GROUP BY 1, 2
"""


def _series(keys: str, opening: str, floor: str, unique: bool = False, company: bool = False) -> str:
    """Openings and closings aggregated apart, stacked and summed again."""
    join = "JOIN empresa c ON c.cnpj_basico = e.cnpj_basico" if company else ""
    names = ", ".join(k.split(" AS ")[-1].split(".")[-1].strip() for k in keys.split(","))
    uniq = "count(DISTINCT e.cnpj_basico)" if unique else "0"
    out = "sum(uniq)::BIGINT AS empresas_unicas," if unique else ""
    arm = """
    SELECT date_trunc('month', {day})::DATE AS mes_abertura, {keys},
           max(e.cod_regiao_ibge) AS reg, {cols}
    FROM estabelecimento e {join} WHERE {where} GROUP BY ALL
    """
    opened = arm.format(
        day="e.data_inicio_atividade",
        keys=keys,
        cols=f"count(*) AS ab, {uniq} AS uniq, count(*) FILTER (WHERE {_ACT}) AS ai, 0 AS ba",
        join=join,
        where=f"e.data_inicio_atividade >= DATE '{floor}'",
    )
    closed = arm.format(
        day="e.data_situacao_cadastral",
        keys=keys,
        cols="0 AS ab, 0 AS uniq, 0 AS ai, count(*) AS ba",
        join=join,
        where="e.cod_situacao_cadastral = '08' "
        f"AND e.data_situacao_cadastral >= DATE '{floor}'",
    )
    return f"""
    SELECT mes_abertura, {names}, max(reg) AS cod_regiao_ibge, sum(ab)::BIGINT AS {opening}, {out}
           sum(ai)::BIGINT AS ainda_ativos, sum(ba)::BIGINT AS baixas,
           (sum(ab) - sum(ba))::BIGINT AS saldo, a.mes_ancora,
           mes_abertura > a.mes_ancora AS mes_parcial
    FROM ({opened} UNION ALL {closed}) m, ancora a
    GROUP BY mes_abertura, {names}, a.mes_ancora
    """


# The driver's orders start in 1995; the published floor would leave the long
# windows without data, so the registered queries use this one (FIXTURES.md).
FLOOR = "1995-01-01"

_CTES["mv_abertura_periodo"] = _series(
    "e.cod_cidade_ibge, e.cod_estado_ibge", "total_aberturas", FLOOR, unique=True
)
_CTES["mv_abertura_periodo_2000"] = _series(
    "e.cod_cidade_ibge, e.cod_estado_ibge", "total_aberturas", "2000-01-01", unique=True
)
_CTES["mv_movimentacao_mensal_cnae"] = _series(
    "e.cod_cnae_principal, e.cod_estado_ibge", "aberturas", FLOOR
)
_CTES["mv_movimentacao_mensal_natureza"] = _series(
    "c.cod_natureza_juridica AS cod_natureza, e.cod_estado_ibge", "aberturas", FLOOR, company=True
)
_CTES["mv_movimentacao_mensal_porte"] = _series(
    "c.cod_porte, e.cod_estado_ibge", "aberturas", FLOOR, company=True
)
_CTES["mv_top_cnaes_cidade"] = f"""
SELECT *, row_number() OVER (PARTITION BY cod_cidade_ibge
                             ORDER BY ativos DESC, cod_cnae_principal) AS ranking
FROM (SELECT e.cod_cidade_ibge, e.cod_cnae_principal, c.nome_cnae, m.cod_estado_ibge,
             count(*) AS total, count(*) FILTER (WHERE {_ACT}) AS ativos,
             {_new(("1mes", "6meses", "1ano"))}, j.mes_ancora
      FROM estabelecimento e JOIN cnae c ON e.cod_cnae_principal = c.cod_cnae
      JOIN ibge_cidade m ON e.cod_cidade_ibge = m.cod_cidade_ibge, janelas j
      GROUP BY e.cod_cidade_ibge, e.cod_cnae_principal, c.nome_cnae, m.cod_estado_ibge, j.mes_ancora
      HAVING count(*) FILTER (WHERE {_ACT}) >= 5) s
"""
_PLACE = "e.cod_cidade_ibge, e.cod_estado_ibge, e.cod_regiao_ibge, e.cod_situacao_cadastral"
_CTES["mv_stats_cidade_situacao"] = f"""
SELECT {_PLACE}, count(*) AS total, count(*) FILTER (WHERE e.matriz_filial = '1') AS matrizes,
       count(*) FILTER (WHERE {_MAIL}) AS com_email,
       count(*) FILTER (WHERE e.telefone_1 IS NOT NULL) AS com_telefone,
       count(*) FILTER (WHERE {_MAIL} AND e.email NOT ILIKE '%contab%') AS email_prospeccao
FROM estabelecimento e GROUP BY {_PLACE}
"""
_CTES["mv_regime_tributario_cidade"] = f"""
SELECT {_PLACE}, count(*) AS total,
       count(*) FILTER (WHERE s.opcao_simples = 'S') AS simples_nacional,
       count(*) FILTER (WHERE s.opcao_mei = 'S') AS mei,
       count(*) FILTER (WHERE s.opcao_simples = 'S' OR s.opcao_mei = 'S') AS simples_ou_mei,
       count(*) FILTER (WHERE coalesce(s.opcao_simples, 'N') <> 'S'
                          AND coalesce(s.opcao_mei, 'N') <> 'S') AS lucro_presumido_real
FROM estabelecimento e LEFT JOIN empresa c ON e.cnpj_basico = c.cnpj_basico
LEFT JOIN simples s ON c.cnpj_basico = s.cnpj_basico GROUP BY {_PLACE}
"""
_CTES["mv_porte_cidade"] = f"""
SELECT {_PLACE}, c.cod_porte, count(*) AS total,
       count(*) FILTER (WHERE e.matriz_filial = '1') AS matrizes,
       count(*) FILTER (WHERE {_MAIL}) AS com_email
FROM estabelecimento e JOIN empresa c ON e.cnpj_basico = c.cnpj_basico
GROUP BY {_PLACE}, c.cod_porte
"""
_FORM_COUNTS = """count(DISTINCT c.cnpj_basico) AS total,
       count(DISTINCT CASE WHEN e.cod_situacao_cadastral = '02' THEN c.cnpj_basico END) AS ativos"""
_FORM_JOINS = """FROM natureza_juridica n
LEFT JOIN empresa c ON n.cod_natureza = c.cod_natureza_juridica
LEFT JOIN estabelecimento e ON c.cnpj_basico = e.cnpj_basico AND e.matriz_filial = '1'"""
_CTES["mv_stats_natureza_juridica_estado"] = f"""
SELECT n.cod_natureza, d.cod_regiao_ibge, e.cod_estado_ibge, {_FORM_COUNTS} {_FORM_JOINS}
LEFT JOIN ibge_estado d ON e.cod_estado_ibge = d.cod_estado_ibge
WHERE e.cod_estado_ibge IS NOT NULL GROUP BY 1, 2, 3
"""
_CTES["mv_stats_natureza_juridica_municipio"] = f"""
SELECT n.cod_natureza, e.cod_estado_ibge, e.cod_cidade_ibge, {_FORM_COUNTS} {_FORM_JOINS}
WHERE e.cod_cidade_ibge IS NOT NULL GROUP BY 1, 2, 3
"""
_CTES["mv_stats_natureza_juridica"] = f"""
SELECT n.cod_natureza, n.nome_natureza, {_FORM_COUNTS} {_FORM_JOINS} GROUP BY 1, 2
"""
_CTES["mv_stats_natureza_juridica_cnae"] = """
SELECT c.cod_natureza_juridica AS cod_natureza, e.cod_cnae_principal AS cod_cnae,
       count(DISTINCT c.cnpj_basico) AS total
FROM empresa c JOIN estabelecimento e ON c.cnpj_basico = e.cnpj_basico
     AND e.matriz_filial = '1' AND e.cod_situacao_cadastral = '02'
JOIN cnae a ON e.cod_cnae_principal = a.cod_cnae
GROUP BY 1, 2 HAVING count(DISTINCT c.cnpj_basico) > 0
"""


def _hundredths(part: str, whole: str) -> str:
    """round(part*100/whole, 2) half away from zero, in whole hundredths."""
    size = f"((20000 * abs({part})::HUGEINT + {whole}) // (2 * {whole}))"
    return f"(CASE WHEN {part} < 0 THEN -{size} ELSE {size} END)"


def _variation(now: str, before: str) -> str:
    cut = f"least(greatest({_hundredths(f'({now} - {before})', before)}, -99999999), 99999999)"
    return (
        f"CASE WHEN {before} IS NULL OR {before} = 0 THEN NULL "
        f"ELSE ({cut}::DECIMAL(18,0) * 0.01::DECIMAL(3,2))::DECIMAL(8,2) END"
    )


def _share(part: str, whole: str, kind: str = "DECIMAL(5,2)") -> str:
    return (
        f"CASE WHEN {whole} <> 0 THEN "
        f"({_hundredths(part, whole)}::DECIMAL(18,0) * 0.01::DECIMAL(3,2))::{kind} END"
    )


def _comparison(series: str, entity: str, levels: dict[str, str], opening: str) -> str:
    """One branch per level, windows applied as filters over a period join."""
    pre = f"{entity}, " if entity else ""
    geo = {"regiao": "cod_regiao_ibge", "estado": "cod_estado_ibge", "municipio": "cod_cidade_ibge"}

    def branch(level: str) -> str:
        codes = ", ".join(
            f"{col if name == level else 0} AS {col.replace('cod', 'k', 1)}"
            for name, col in geo.items()
        )
        where = f"WHERE {geo[level]} IS NOT NULL" if level in geo else ""
        return (
            f"SELECT {pre} '{level}' AS nivel, {codes}, mes_abertura, {opening} AS aberturas, "
            f"ainda_ativos, baixas FROM base {where}"
        )

    branches = " UNION ALL ".join(branch(level) for level in levels)
    sums = ", ".join(
        f"coalesce(sum({m}) FILTER (WHERE {cond}), 0)::BIGINT AS {m}_{when}"
        for m in ("aberturas", "ainda_ativos", "baixas")
        for when, cond in (
            ("atual", "mes_abertura >= periodo_atual_inicio"),
            (
                "anterior",
                "mes_abertura >= periodo_anterior_inicio AND mes_abertura <= periodo_anterior_fim",
            ),
        )
    )
    now = _share("ainda_ativos_atual", "aberturas_atual")
    before = _share("ainda_ativos_anterior", "aberturas_anterior")
    return f"""
    WITH base AS (SELECT s.* FROM {series} s
                  WHERE mes_abertura >= (s.mes_ancora - INTERVAL 95 MONTH)::DATE
                    AND mes_abertura <= s.mes_ancora),
    niveis AS ({branches}),
    agregados AS (
      SELECT {pre} nivel, k_regiao_ibge AS cod_regiao_ibge, k_estado_ibge AS cod_estado_ibge,
             k_cidade_ibge AS cod_cidade_ibge, p.*, {sums}
      FROM niveis, periodos p GROUP BY ALL)
    SELECT {pre} nivel, cod_regiao_ibge, cod_estado_ibge, cod_cidade_ibge, periodo_meses,
           mes_ancora, periodo_atual_inicio, periodo_atual_fim, periodo_anterior_inicio,
           periodo_anterior_fim, aberturas_atual, aberturas_anterior,
           aberturas_atual - aberturas_anterior AS aberturas_variacao_abs,
           {_variation("aberturas_atual", "aberturas_anterior")} AS aberturas_variacao_pct,
           ainda_ativos_atual, ainda_ativos_anterior,
           {now} AS sobrevivencia_atual_pct, {before} AS sobrevivencia_anterior_pct,
           (({now}) - ({before}))::DECIMAL(6,2) AS sobrevivencia_delta_pp,
           baixas_atual, baixas_anterior, baixas_atual - baixas_anterior AS baixas_variacao_abs,
           {_variation("baixas_atual", "baixas_anterior")} AS baixas_variacao_pct,
           aberturas_atual - baixas_atual AS saldo_atual,
           aberturas_anterior - baixas_anterior AS saldo_anterior
    FROM agregados
    """


_CTES["mv_comparativo_territorio"] = _comparison(
    "mv_abertura_periodo", "", ("brasil", "regiao", "estado", "municipio"), "total_aberturas"
)
_CTES["mv_comparativo_cnae"] = _comparison(
    "mv_movimentacao_mensal_cnae", "cod_cnae_principal", ("brasil", "regiao", "estado"), "aberturas"
)
_CTES["mv_comparativo_natureza"] = _comparison(
    "mv_movimentacao_mensal_natureza", "cod_natureza", ("brasil", "regiao", "estado"), "aberturas"
)

_WORD = re.compile(r"[a-z_0-9]+")


def _sql(body: str) -> str:
    """``body`` behind the tables it mentions, directly or through others."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        found = set(_WORD.findall(pending.pop())) & set(_CTES) - needed
        needed |= found
        pending += [_CTES[name] for name in found]
    # definition order respects dependencies: a table only reads earlier ones
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in _CTES.items() if name in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


ORACLES: dict[str, str] = {}


def _add(key: str, body: str) -> None:
    ORACLES[key] = _sql(body)


for _name in [n for n in _CTES if n.startswith("mv_") and not n.endswith("_2000")]:
    _add(_name, f"SELECT * FROM {_name}")


# -- shared pieces -------------------------------------------------------------


def _chars(codes) -> str:
    return " || ".join(f"chr({c})" for c in codes)


_STRIP_CODES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_STRIP = f"({_chars(_STRIP_CODES)})"
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def _dirty(col: str) -> str:
    return (
        f"(chr(9) || chr(0) || ' ' || {col} || ' ' || chr(145) || ' ' || chr(133) || chr(160))"
    )


def _clean(expr: str) -> str:
    return (
        f"regexp_replace(trim(replace({expr}, chr(0), ''), {_STRIP}), "
        f"'[^\\x00-\\x7F\\x{{A0}}-\\x{{FF}}{_CP1252}]', '', 'g')"
    )


def _zfill(col: str, width: int) -> str:
    return f"lpad({col}, greatest(length({col}), {width})::INTEGER, '0')"


_COMPOSED = (
    f"rpad(substr({_zfill('cnpj_basico', 8)} || {_zfill('cnpj_ordem', 4)} || "
    f"{_zfill('cnpj_dv', 2)}, 1, 14), 14, '0')"
)


def _day(col: str) -> str:
    value = f"trim({col}, {_STRIP})"
    return (
        f"CASE WHEN {value} IN ('', '0', '00000000') THEN NULL "
        f"WHEN regexp_full_match({value}, '[0-9]{{8}}') THEN try_strptime({value}, '%Y%m%d')::DATE "
        f"WHEN regexp_full_match({value}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN TRY_CAST({value} AS DATE) END"
    )


_CTES["empresa_file"] = """
SELECT lpad(c_custkey::VARCHAR, 8, '0') AS cnpj_basico,
       ' ' || c_name || ' ; "Ltda"' AS razao_social,
       CASE WHEN c_custkey % 30 = 7 THEN '' ELSE substr(c_mktsegment, 1, 4) END
           AS cod_natureza_juridica,
       '10' AS cod_qualificacao_responsavel,
       CASE WHEN c_custkey % 20 = 13 THEN 'abc'
            WHEN c_custkey % 3 = 0 OR c_acctbal < 0 THEN plain
            ELSE regexp_replace(plain, '^(-?[0-9]+)([0-9]{3})[.]([0-9]{2})$', '\\1.\\2,\\3') END
           AS capital_social,
       '' AS cod_porte, '' AS ente_federativo_responsavel,
       'Empresas' || (c_custkey % 10)::VARCHAR || '.zip' AS source_file, c_custkey
FROM (SELECT *, c_acctbal::DECIMAL(16,2)::VARCHAR AS plain FROM customer) c
"""
_CTES["grafias"] = """
SELECT DISTINCT spelling, cod_cidade_ibge, cod_estado_ibge
FROM (SELECT cod_municipio AS spelling, cod_cidade_ibge, cod_estado_ibge FROM ibge_cidade
      UNION ALL
      SELECT ltrim(cod_municipio, '0'), cod_cidade_ibge, cod_estado_ibge FROM ibge_cidade) s
"""
_CTES["colocados"] = """
SELECT f.*, g.cod_cidade_ibge AS cid, coalesce(g.cod_estado_ibge, u.cod_estado_ibge) AS est_,
       coalesce(ge.cod_regiao_ibge, u.cod_regiao_ibge) AS reg_,
       trim(f.cod_pais) IN ('', '105', '0105') AS em_casa
FROM estabelecimento_file f
LEFT JOIN grafias g ON g.spelling = trim(f.cod_municipio)
LEFT JOIN ibge_estado ge ON ge.cod_estado_ibge = g.cod_estado_ibge
LEFT JOIN ibge_estado u ON u.sigla_uf = upper(trim(f.uf))
"""
_OPEN_GEO = "reg_ AS cod_regiao_ibge, est_ AS cod_estado_ibge, cid AS cod_cidade_ibge"
_HOME_GEO = (
    "CASE WHEN em_casa THEN reg_ END AS cod_regiao_ibge, "
    "CASE WHEN em_casa THEN est_ END AS cod_estado_ibge, "
    "CASE WHEN em_casa THEN cid END AS cod_cidade_ibge"
)
_NAME = "strip_accents(upper({0}))"
_CTES["busca_estabelecimento"] = f"""
SELECT e.cnpj_completo, e.cnpj_basico, {_NAME.format("c.razao_social")} AS razao_social_norm,
       {_NAME.format("e.nome_fantasia")} AS nome_fantasia_norm, e.cod_regiao_ibge,
       e.cod_estado_ibge, e.cod_cidade_ibge, e.cod_cnae_principal, e.cod_situacao_cadastral,
       e.matriz_filial, c.cod_porte, c.cod_natureza_juridica, e.data_inicio_atividade, e.cep,
       e.ddd_telefone_1, e.ddd_telefone_2, {_NAME.format("e.bairro")} AS bairro_norm,
       md5(coalesce(c.razao_social, '') || '|' || coalesce(e.nome_fantasia, '') || '|' ||
           coalesce(e.cod_cnae_principal, '') || '|' || coalesce(e.cod_situacao_cadastral, '')
           || '|' || coalesce(e.cod_cidade_ibge::VARCHAR, '') || '|' || coalesce(c.cod_porte, '')
           || '|' || coalesce(c.cod_natureza_juridica, '') || '|' ||
           coalesce(e.data_inicio_atividade::VARCHAR, '') || '|' || coalesce(e.cep, '') || '|' ||
           coalesce(e.matriz_filial, '')) AS row_hash
FROM estabelecimento e LEFT JOIN empresa c ON c.cnpj_basico = e.cnpj_basico
"""
_CTES["geracoes"] = """
SELECT n.cnpj_completo AS novo, v.cnpj_completo AS vigente, n.row_hash AS hn, v.row_hash AS hv
FROM (SELECT * FROM busca_estabelecimento WHERE cnpj_completo::BIGINT % 70 <> 3) n
FULL OUTER JOIN (SELECT cnpj_completo, CASE WHEN cnpj_completo::BIGINT % 40 = 1 THEN 'alterado'
                        ELSE row_hash END AS row_hash
                 FROM busca_estabelecimento WHERE cnpj_completo::BIGINT % 50 <> 0) v
ON n.cnpj_completo = v.cnpj_completo
"""
_CTES["delta"] = """
SELECT count(*) FILTER (WHERE vigente IS NULL) AS novas,
       count(*) FILTER (WHERE novo IS NULL) AS removidas,
       count(*) FILTER (WHERE novo IS NOT NULL AND vigente IS NOT NULL
                          AND hn IS DISTINCT FROM hv) AS alteradas,
       count(*) FILTER (WHERE vigente IS NOT NULL) AS total_vigente
FROM geracoes
"""
_DELTA_PCT = "100.0 * (novas + removidas + alteradas)::DOUBLE / greatest(total_vigente, 1)"

# -- sources and sinks -----------------------------------------------------------

_FILE_COLUMNS = (
    "cnpj_basico, razao_social, cod_natureza_juridica, cod_qualificacao_responsavel, "
    "capital_social, cod_porte, ente_federativo_responsavel"
)
_add("src_zip_csv", f"SELECT {_FILE_COLUMNS}, 7 AS _fields FROM empresa_file")
_add(
    "src_route",
    """
SELECT f.filename, f.stem, s.target
FROM (SELECT filename, lower(rtrim(regexp_replace(filename, '\\.[^.]*$', ''), '0123456789')) AS stem
      FROM remote_files) f
LEFT JOIN (VALUES ('empresas', 'empresa'), ('estabelecimentos', 'estabelecimento'),
                  ('estabelecimentos', 'estabelecimento_cnae_sec'), ('socios', 'socio'),
                  ('cnaes', 'cnae')) AS s(stem, target) ON s.stem = f.stem
""",
)
_add("src_fixed_schema", "SELECT * FROM simples")
_add("src_dim_csv", "SELECT * FROM ibge_estado")
_add(
    "sink_table",
    """SELECT * EXCLUDE (nome_cidade_exterior, cod_cnae_secundario, complemento, ddd_fax, fax,
    situacao_especial, data_situacao_especial) FROM estabelecimento""",
)
_add(
    "sink_replace_dims",
    """SELECT c.*, e.sigla_uf, e.nome_estado, e.cod_regiao_ibge, r.sigla_regiao, r.nome_regiao
    FROM ibge_cidade c JOIN ibge_estado e ON c.cod_estado_ibge = e.cod_estado_ibge
    JOIN ibge_regiao r ON r.cod_regiao_ibge = e.cod_regiao_ibge""",
)
_FORM_BAD = "c_custkey % 30 = 7"
_CAPITAL_BAD = "c_custkey % 20 = 13"
_ERRORS = f"""concat_ws(' | ',
    CASE WHEN {_CAPITAL_BAD} THEN 'capital_social: not a number: abc' END,
    CASE WHEN {_FORM_BAD} THEN 'cod_natureza_juridica: missing' END,
    CASE WHEN {_CAPITAL_BAD} THEN 'capital_social: missing' END)"""
_add(
    "sink_quarantine",
    f"""SELECT 'empresa' AS "table", CASE WHEN bad THEN source_file END AS source_file,
    CASE WHEN bad THEN 'pending' ELSE 'loaded' END AS status, cnpj_basico,
    CASE WHEN bad THEN errors ELSE '' END AS errors
    FROM (SELECT *, {_FORM_BAD} OR {_CAPITAL_BAD} AS bad, {_ERRORS} AS errors FROM empresa_file) f""",
)
_add(
    "sink_quarantine_file",
    f"""SELECT cnpj_basico, CASE WHEN source_file IN (SELECT source_file FROM empresa_file
        WHERE {_FORM_BAD} OR {_CAPITAL_BAD}) THEN 'parked' ELSE 'loaded' END AS fate
    FROM empresa_file""",
)
_add(
    "quarantine_list",
    f"""SELECT 'empresa' AS "table", source_file, count(*) AS "rows" FROM empresa_file
    WHERE {_FORM_BAD} OR {_CAPITAL_BAD} GROUP BY source_file""",
)
_add(
    "quarantine_retry",
    f"""SELECT count(*) AS retried, count(*) FILTER (WHERE NOT ({_CAPITAL_BAD})) AS succeeded,
    count(*) FILTER (WHERE {_CAPITAL_BAD}) AS failed
    FROM empresa_file WHERE {_FORM_BAD} OR {_CAPITAL_BAD}""",
)
_add(
    "quarantine_retry_rows",
    f"""SELECT cnpj_basico,
    CASE WHEN {_FORM_BAD} THEN '2062' ELSE cod_natureza_juridica END AS cod_natureza_juridica,
    CASE WHEN {_CAPITAL_BAD} THEN 1234.56::DECIMAL(16,2)
         WHEN capital_social LIKE '%,%'
         THEN replace(replace(capital_social, '.', ''), ',', '.')::DECIMAL(16,2)
         ELSE capital_social::DECIMAL(16,2) END AS capital_social
    FROM empresa_file WHERE {_FORM_BAD} OR {_CAPITAL_BAD}""",
)
_add(
    "src_zip_csv_field_count",
    f"""SELECT cnpj_basico, CASE cnpj_basico::INTEGER % 3 WHEN 0 THEN 'fields: 6 instead of 7'
         WHEN 2 THEN 'fields: 8 instead of 7'
         ELSE CASE WHEN {_FORM_BAD} OR {_CAPITAL_BAD} THEN 'parked' ELSE 'loaded' END END AS fate
    FROM empresa_file""",
)
_add(
    "load_metrics",
    f"""SELECT 'empresa' AS "table", count(*) FILTER (WHERE NOT bad) AS rows_loaded,
    count(*) FILTER (WHERE bad) AS rows_failed,
    count(DISTINCT CASE WHEN bad THEN source_file END) AS files_failed, TRUE AS in_total
    FROM (SELECT *, {_FORM_BAD} OR {_CAPITAL_BAD} AS bad FROM empresa_file) f
    UNION ALL SELECT 'estabelecimento_cnae_sec', count(*), 0, 0, FALSE
    FROM estabelecimento_cnae_sec""",
)
_add("sink_build_and_swap", "SELECT * FROM busca_estabelecimento")
_add("sink_version", "SELECT * FROM busca_estabelecimento")
_add(
    "manifest_diff",
    """SELECT coalesce(l.filename, r.filename) AS filename, l.size_bytes AS local_bytes,
    r.size_bytes AS remote_bytes,
    CASE WHEN l.filename IS NULL THEN 'missing' WHEN r.filename IS NULL THEN 'extra'
         WHEN l.size_bytes <> r.size_bytes THEN 'size_mismatch' ELSE 'ok' END AS status
    FROM local_files l FULL OUTER JOIN remote_files r ON l.filename = r.filename""",
)
_add(
    "manifest_periods",
    """SELECT DISTINCT name AS period, substr(name, 6) || '/' || substr(name, 1, 4) AS month_year,
    name = (SELECT max(name) FROM remote_folders
            WHERE regexp_full_match(name, '[0-9]{4}-[0-9]{2}')) AS is_latest
    FROM remote_folders WHERE regexp_full_match(name, '[0-9]{4}-[0-9]{2}')""",
)

# -- cleaning and scalar functions -----------------------------------------------

_add("clean_sanitize", f"SELECT doc_id, {_clean(_dirty('text'))} AS text FROM documents")
_add(
    "clean_all_strings",
    f"SELECT page_id, {_clean(_dirty('url'))} AS url, {_clean(_dirty('html'))} AS html FROM pages",
)
_add(
    "clean_empty_null",
    """SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN nullif(role, '') END AS role,
    CASE WHEN conv_id % 2 <> 0 THEN nullif(text, '') END AS text FROM conversations""",
)
_BR = (
    "CASE WHEN contains(capital_social, ',') AND "
    "regexp_full_match(replace(replace(capital_social, '.', ''), ',', ''), '[0-9]+') "
    "THEN replace(replace(capital_social, '.', ''), ',', '.') ELSE capital_social END"
)
_add(
    "parse_decimal_br",
    f"""SELECT cnpj_basico, capital_social, TRY_CAST({_BR} AS DECIMAL(16,2)) AS valor
    FROM empresa_file""",
)
_add(
    "parse_date8",
    f"""SELECT cnpj_basico, cnpj_ordem, texto, {_day("texto")} AS dia, texto = 'abc' AS ilegivel
    FROM (SELECT *, CASE WHEN cnpj_ordem::INTEGER % 50 = 49 THEN 'abc'
                         ELSE data_inicio_atividade END AS texto FROM estabelecimento_file) f""",
)
_add("date_columns_by_table", "SELECT * FROM simples")
_add(
    "compose_cnpj",
    f"""SELECT cnpj_basico, cnpj_ordem, cnpj_dv, {_COMPOSED} AS cnpj_completo
    FROM estabelecimento_file""",
)
_add(
    "compose_cnpj_raw",
    """SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj_basico || cnpj_ordem || cnpj_dv
    AS cnpj_completo FROM estabelecimento_file""",
)
_add(
    "normalize_name",
    "SELECT doc_id, strip_accents(upper(replace(text, 'ß', 'ss'))) AS text_norm FROM documents",
)
_add(
    "pad_code",
    """SELECT cnpj_completo, CASE WHEN length(trim(cod_pais)) = 2 THEN lpad(cod_pais, 3, '0')
    ELSE cod_pais END AS cod_pais FROM estabelecimento""",
)
_add("row_hash", "SELECT cnpj_completo, row_hash FROM busca_estabelecimento")
_add(
    "label_codes",
    """SELECT cnpj_basico, nome_socio, CASE identificador_socio WHEN '1' THEN 'Pessoa Jurídica'
    WHEN '2' THEN 'Pessoa Física' WHEN '3' THEN 'Estrangeiro' END AS tipo_socio FROM socio""",
)
_add(
    "period_normalize",
    """SELECT event_id, CASE WHEN event_id % 6 <= 3 THEN strftime(ts, '%Y-%m')
    WHEN event_id % 6 = 4 THEN strftime(ts, '%Y%m') END AS periodo FROM events""",
)
_add(
    "email_prospect",
    """SELECT cnpj_completo, coalesce(email <> '' AND email NOT ILIKE '%contab%', FALSE) AS ok
    FROM estabelecimento""",
)
_add("like_prefix", "SELECT page_id, url FROM pages WHERE url LIKE 'https://m.%'")
_add(
    "like_substring",
    """SELECT doc_id, text LIKE '%tion%' AS com, text ILIKE '%TION%' AS com_ilike
    FROM documents""",
)
_add(
    "null_safe_diff",
    """SELECT cnpj_completo, ddd_telefone_1 IS DISTINCT FROM ddd_telefone_2 AS difere
    FROM estabelecimento""",
)
_add(
    "ratio_guard",
    f"""SELECT cod_natureza, {_share("ativos", "total", "DECIMAL(18,2)")} AS taxa_atividade
    FROM mv_stats_natureza_juridica""",
)
_add(
    "least_ignore_null",
    """SELECT cnpj_completo, least(data_situacao_cadastral, CASE WHEN cnpj_completo::BIGINT % 2 = 0
    THEN data_inicio_atividade END) AS menor FROM estabelecimento""",
)

# -- enrichment --------------------------------------------------------------------

_P3 = "cnpj_basico, cnpj_ordem, cnpj_dv"
_add("geo_lookup", f"SELECT {_P3}, cod_municipio, uf, {_OPEN_GEO} FROM colocados")
_add("geo_foreign_guard", f"SELECT {_P3}, cod_pais, {_HOME_GEO} FROM colocados")
_SECONDARY = f"""
SELECT {_COMPOSED} AS cnpj_completo, trim(item) AS cod_cnae, {_OPEN_GEO}, data_inicio_atividade
FROM (SELECT *, unnest(string_split(cod_cnae_secundario, ',')) AS item FROM colocados) s
WHERE trim(item) <> ''
"""
_add("explode_secondary", _SECONDARY)
_add(
    "geo_secondary",
    f"""SELECT cod_regiao_ibge, cod_estado_ibge, cod_cidade_ibge, count(*) AS atividades
    FROM ({_SECONDARY}) s GROUP BY 1, 2, 3""",
)
_add(
    "derive_establishment",
    f"""SELECT {_COMPOSED} AS cnpj_completo, matriz_filial, nome_fantasia, uf, {_HOME_GEO}
    FROM colocados""",
)
_add(
    "transform_table",
    f"""SELECT {_COMPOSED} AS cnpj_completo, {_clean("nome_fantasia")} AS nome_fantasia,
    nullif(trim(cod_pais), '') AS cod_pais, NULL::DATE AS data_situacao_cadastral,
    {_day("data_inicio_atividade")} AS data_inicio_atividade, logradouro,
    nullif(complemento, '') AS complemento, {_HOME_GEO}, 0 AS rejeitos FROM colocados""",
)
_add("geo_dims_rows", "SELECT * FROM ibge_cidade")

# -- patches -----------------------------------------------------------------------

# The reference rows that are added when missing.
_COUNTRIES = """(VALUES ('008', 'ABU DHABI'), ('009', 'DIRCE'), ('015', 'ALAND, ILHAS'),
('150', 'JERSEY'), ('151', 'CANARIAS, ILHAS'), ('200', 'CURACAO'), ('321', 'GUERNSEY'),
('359', 'MAN, ILHA DE'), ('367', 'INGLATERRA'), ('393', 'JERSEY'),
('449', 'MACEDONIA (ANTIGA REP. IUGOSLAVA)'), ('452', 'MADEIRA, ILHA DA'), ('498', 'MOLDAVIA'),
('578', 'PALESTINA'), ('678', 'SAO TOME E PRINCIPE'),
('699', 'SAO MARTINHO, ILHA DE (PARTE HOLANDESA)'), ('737', 'SERVIA'), ('994', 'AZERBAIJAO'))
AS x(cod_pais, nome_pais)"""
_CTES["pais_completo"] = f"""
SELECT cod_pais, nome_pais FROM pais
UNION ALL SELECT cod_pais, nome_pais FROM {_COUNTRIES}
WHERE cod_pais NOT IN (SELECT cod_pais FROM pais)
"""
_PADDED = "CASE WHEN length(trim(cod_pais)) = 2 THEN lpad(cod_pais, 3, '0') ELSE cod_pais END"
_CTES["paises_usados"] = f"""
SELECT DISTINCT cod_pais FROM (
  SELECT nullif({_PADDED}, '0') AS cod_pais FROM estabelecimento
  UNION ALL SELECT cod_pais FROM socio) u WHERE cod_pais IS NOT NULL
"""
_add("patch_insert_missing", "SELECT * FROM pais_completo")
_add("patch_pad_country", f"SELECT cnpj_completo, {_PADDED} AS cod_pais FROM estabelecimento")
_add("patch_null_zero", "SELECT cnpj_completo, nullif(cod_pais, '0') AS cod_pais FROM estabelecimento")
_add(
    "patch_empty_porte",
    """SELECT cnpj_basico, CASE n % 10 WHEN 0 THEN '00' WHEN 1 THEN NULL ELSE cod_porte END
    AS cod_porte, CASE WHEN n % 10 <= 1 THEN '00' ELSE cod_porte END AS cod_porte_todos
    FROM (SELECT cnpj_basico, cod_porte, cnpj_basico::BIGINT AS n FROM empresa) e""",
)
_add(
    "patch_absorb_orphans",
    """SELECT cod_pais, nome_pais FROM pais
    UNION ALL SELECT cod_pais, 'CODIGO NAO CONSTANTE NA TABELA RFB' FROM paises_usados
    WHERE cod_pais NOT IN (SELECT cod_pais FROM pais)""",
)
_add(
    "patch_dedup_company",
    """SELECT * EXCLUDE (n, ente_federativo_responsavel) FROM (
      SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY
             CASE WHEN razao_social IS NOT NULL AND trim(razao_social) <> '' THEN 0 ELSE 1 END,
             razao_social, cod_natureza_juridica, cod_qualificacao_responsavel, capital_social,
             cod_porte) AS n
      FROM (SELECT * FROM empresa
            UNION ALL SELECT * REPLACE (' ' AS razao_social) FROM empresa
                      WHERE cnpj_basico::BIGINT % 2 = 0
            UNION ALL SELECT * REPLACE ('A ' || razao_social AS razao_social) FROM empresa
                      WHERE cnpj_basico::BIGINT % 3 = 0) u) r WHERE n = 1""",
)
_add(
    "patch_delete_keys",
    """SELECT * FROM simples WHERE cnpj_basico NOT IN ('00000001', '00000002', '00000012',
    '24417449', '24539162', '30721933', '30728066', '30760363', '30847991', '30857441',
    '30886793', '30972017')""",
)
_add(
    "patch_all_values",
    f"""SELECT 'estabelecimento' AS "table", nullif({_PADDED}, '0') AS value, count(*) AS n
    FROM estabelecimento GROUP BY 2
    UNION ALL SELECT 'empresa', CASE WHEN cod_porte = '' THEN '00' ELSE cod_porte END,
      count(DISTINCT cnpj_basico) FROM empresa GROUP BY 2
    UNION ALL SELECT 'pais', cod_pais, count(*) FROM (
      SELECT cod_pais FROM pais_completo UNION ALL SELECT cod_pais FROM paises_usados
      WHERE cod_pais NOT IN (SELECT cod_pais FROM pais_completo)) p GROUP BY 2""",
)
_add(
    "patch_all",
    """SELECT * FROM (
    SELECT 'pais' AS "table", (SELECT count(*) FROM pais_completo) + (SELECT count(*)
      FROM paises_usados WHERE cod_pais NOT IN (SELECT cod_pais FROM pais_completo)) AS "rows"
    UNION ALL SELECT 'qualificacao_socio', count(*) +
      CASE WHEN bool_or(cod_qualificacao = '36') THEN 0 ELSE 1 END FROM qualificacao_socio
    UNION ALL SELECT 'motivo', count(*) + 3 FROM motivo
    UNION ALL SELECT 'estabelecimento', count(*) FROM estabelecimento
    UNION ALL SELECT 'empresa', count(DISTINCT cnpj_basico) FROM empresa
    UNION ALL SELECT 'simples', count(*) FROM simples
    UNION ALL SELECT 'socio', count(*) FROM socio) s""",
)

# -- quality -----------------------------------------------------------------------

_REQUIRED = (
    "cnpj_basico cnpj_ordem cnpj_dv cnpj_completo matriz_filial cod_situacao_cadastral "
    "cod_motivo_situacao_cadastral data_inicio_atividade cod_cnae_principal uf"
).split()
_add(
    "check_not_null",
    " UNION ALL ".join(
        f"""SELECT 'estabelecimento' AS "table", '{c}' AS "column",
        count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM estabelecimento"""
        for c in _REQUIRED
    ),
)
_LENGTHS = {
    "cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "cnpj_completo": 14, "matriz_filial": 1,
    "nome_fantasia": 60, "cod_situacao_cadastral": 2, "cod_motivo_situacao_cadastral": 2,
    "nome_cidade_exterior": 60, "cod_pais": 3, "cod_cnae_principal": 7, "tipo_logradouro": 20,
    "logradouro": 60, "numero": 6, "complemento": 200, "bairro": 60, "cep": 8, "uf": 2,
    "cod_municipio": 7, "ddd_telefone_1": 4, "telefone_1": 10, "ddd_telefone_2": 4,
    "telefone_2": 10, "ddd_fax": 4, "fax": 10, "situacao_especial": 100,
}
_add(
    "check_length",
    " UNION ALL ".join(
        f"""SELECT 'estabelecimento' AS "table", '{c}' AS "column",
        count(*) FILTER (WHERE length({c}) > {n}) AS too_long FROM estabelecimento"""
        for c, n in _LENGTHS.items()
    ),
)
_add(
    "check_unique",
    """SELECT cnpj_basico, cod_cidade_ibge, count(*) AS copies FROM estabelecimento
    WHERE cod_cidade_ibge IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1""",
)
_EDGES = (
    ("ibge_estado", "cod_regiao_ibge", "ibge_regiao", "cod_regiao_ibge"),
    ("ibge_cidade", "cod_estado_ibge", "ibge_estado", "cod_estado_ibge"),
    ("empresa", "cod_natureza_juridica", "natureza_juridica", "cod_natureza"),
    ("empresa", "cod_qualificacao_responsavel", "qualificacao_socio", "cod_qualificacao"),
    ("estabelecimento", "cnpj_basico", "empresa", "cnpj_basico"),
    ("estabelecimento", "cod_cnae_principal", "cnae", "cod_cnae"),
    ("estabelecimento", "cod_pais", "pais", "cod_pais"),
    ("estabelecimento", "cod_motivo_situacao_cadastral", "motivo", "cod_motivo"),
    ("estabelecimento", "cod_regiao_ibge", "ibge_regiao", "cod_regiao_ibge"),
    ("estabelecimento", "cod_estado_ibge", "ibge_estado", "cod_estado_ibge"),
    ("estabelecimento", "cod_cidade_ibge", "ibge_cidade", "cod_cidade_ibge"),
    ("simples", "cnpj_basico", "empresa", "cnpj_basico"),
    ("socio", "cnpj_basico", "empresa", "cnpj_basico"),
    ("socio", "cod_pais", "pais", "cod_pais"),
    ("socio", "cod_qualificacao_socio", "qualificacao_socio", "cod_qualificacao"),
    ("socio", "cod_qualificacao_representante_legal", "qualificacao_socio", "cod_qualificacao"),
    ("estabelecimento_cnae_sec", "cnpj_completo", "estabelecimento", "cnpj_completo"),
    ("estabelecimento_cnae_sec", "cod_cnae", "cnae", "cod_cnae"),
)
_add(
    "check_fk",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", '{p}' AS parent, count(*) AS orphans
        FROM {t} f WHERE f.{c} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{k} = f.{c})"""
        for t, c, p, k in _EDGES
    ),
)


_KEYS = (
    ("cnae", "cod_cnae", True),
    ("motivo", "cod_motivo", True),
    ("municipio_rfb", "cod_municipio", True),
    ("natureza_juridica", "cod_natureza", True),
    ("pais", "cod_pais", True),
    ("qualificacao_socio", "cod_qualificacao", True),
    ("ibge_regiao", "cod_regiao_ibge", True),
    ("ibge_regiao", "sigla_regiao", False),
    ("ibge_estado", "cod_estado_ibge", True),
    ("ibge_estado", "sigla_uf", False),
    ("ibge_cidade", "cod_cidade_ibge", True),
    ("ibge_cidade", "cod_municipio", False),
    ("empresa", "cnpj_basico", True),
    ("estabelecimento", "cnpj_completo", True),
    ("simples", "cnpj_basico", True),
)
_add(
    "check_keys",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{k}' AS "key", count(*) FILTER (WHERE n > 1 AND v IS NOT NULL)
          AS repeated,
        {"coalesce(sum(n) FILTER (WHERE v IS NULL), 0)::BIGINT" if primary else "0::BIGINT"} AS nulls
        FROM (SELECT {k} AS v, count(*) AS n FROM {t} GROUP BY {k}) g"""
        for t, k, primary in _KEYS
    ),
)


def _report(name, table, column, parent, key, warning):
    return f"""SELECT '{name}' AS fk_name, '{table}' AS source_table, count(*) AS orphan_count,
    CASE WHEN count(*) = 0 THEN 'OK' ELSE '{warning}' END AS status FROM {table} f
    WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = f.{column})"""


_add(
    "check_fk_report",
    " UNION ALL ".join(
        (
            _report("fk_estab_empresa", "estabelecimento", "cnpj_basico", "empresa", "cnpj_basico",
                    "AVISO: Registros órfãos"),
            _report("fk_estab_cnae", "estabelecimento", "cod_cnae_principal", "cnae", "cod_cnae",
                    "AVISO: CNAEs não encontrados"),
            _report("fk_socio_empresa", "socio", "cnpj_basico", "empresa", "cnpj_basico",
                    "AVISO: Sócios órfãos"),
        )
    ),
)


def _finding(check, table, where, warning):
    return f"""SELECT '{check}' AS check_name, '{table}' AS table_name, count(*) AS count,
    CASE WHEN count(*) = 0 THEN 'OK' ELSE '{warning}' END AS status FROM {table} WHERE {where}"""


_NO_ID = "cnpj_completo IS NULL OR cnpj_completo = ''"
_add(
    "check_cnpj_nulls",
    " UNION ALL ".join(
        _finding("cnpj_completo_nulls", t, _NO_ID, "FALHA: NULLs encontrados")
        for t in ("estabelecimento", "estabelecimento_cnae_sec")
    ),
)
_add(
    "check_cnpj_format",
    _finding("cnpj_completo_format", "estabelecimento", "length(cnpj_completo) <> 14",
             "FALHA: Formato incorreto"),
)
_add(
    "check_cnpj_consistency",
    _finding("cnpj_completo_consistency", "estabelecimento",
             "cnpj_completo <> (cnpj_basico || cnpj_ordem || cnpj_dv)",
             "AVISO: Inconsistências encontradas"),
)
_add(
    "check_row_floor",
    """SELECT count(*) AS "rows", 60000000::BIGINT AS minimum, count(*) >= 60000000 AS passed
    FROM estabelecimento""",
)
_add(
    "check_views_present",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS "view", count(*) = 0 AS empty FROM {n}"""
        for n in _CTES
        if n.startswith("mv_") and not n.endswith("_2000")
    ),
)
_add(
    "check_count_match",
    """SELECT (SELECT count(*) FROM busca_estabelecimento) AS derived_rows,
    (SELECT count(*) FROM estabelecimento) AS source_rows,
    (SELECT count(*) FROM busca_estabelecimento) = (SELECT count(*) FROM estabelecimento) AS passed""",
)
_add(
    "sanity_anchor",
    """SELECT count(DISTINCT mes_ancora) AS ancoras FROM (
    SELECT mes_ancora FROM mv_stats_estado UNION SELECT mes_ancora FROM mv_abertura_periodo
    UNION SELECT mes_ancora FROM mv_movimentacao_mensal_cnae
    UNION SELECT mes_ancora FROM mv_comparativo_territorio) u""",
)
_add(
    "sanity_12m",
    """SELECT count(*) FILTER (WHERE c.aberturas_atual <> s.novos_1ano) AS divergentes
    FROM mv_comparativo_territorio c JOIN mv_stats_estado s ON s.cod_estado_ibge = c.cod_estado_ibge
    WHERE c.nivel = 'estado' AND c.periodo_meses = 12""",
)
_add(
    "sanity_levels",
    """SELECT *, brasil <> regiao OR brasil <> estado AS diverge FROM (
    SELECT periodo_meses, (sum(aberturas_atual) FILTER (WHERE nivel = 'brasil'))::BIGINT AS brasil,
           (sum(aberturas_atual) FILTER (WHERE nivel = 'regiao'))::BIGINT AS regiao,
           (sum(aberturas_atual) FILTER (WHERE nivel = 'estado'))::BIGINT AS estado
    FROM mv_comparativo_territorio GROUP BY 1) t""",
)
_add(
    "sanity_closings",
    f"""SELECT serie, base, serie - base AS diferenca FROM (
    SELECT (SELECT sum(baixas)::BIGINT FROM mv_abertura_periodo) AS serie,
           (SELECT count(*) FROM estabelecimento WHERE cod_situacao_cadastral = '08'
            AND data_situacao_cadastral >= DATE '{FLOOR}') AS base) t""",
)
_add(
    "sanity_null_variation",
    """SELECT count(*) AS erradas FROM mv_comparativo_territorio
    WHERE aberturas_anterior = 0 AND aberturas_variacao_pct IS NOT NULL""",
)

# -- generations -------------------------------------------------------------------

_add("delta_counts", "SELECT * FROM delta")
_add("delta_counts_stored", "SELECT * FROM delta")
_add(
    "bucket_digests",
    """SELECT (total_vigente + novas - removidas)::BIGINT AS novas_linhas,
    total_vigente::BIGINT AS vigentes, novas + removidas + alteradas > 0 AS diferem FROM delta""",
)
_add(
    "delta_gate",
    f"""SELECT *, round({_DELTA_PCT}, 3)::DECIMAL(9,3) AS delta_pct, {_DELTA_PCT} <= 25 AS aprovado
    FROM delta""",
)
_add(
    "validate_generation",
    f"""SELECT 'row_floor' AS "check", count(*) >= 1000 AS passed,
    count(*)::VARCHAR || ' of 1000' AS detail FROM estabelecimento
    UNION ALL SELECT 'view mv_stats_cnae_estado', count(*) > 0, 'has rows' FROM mv_stats_cnae_estado
    UNION ALL SELECT 'delta', {_DELTA_PCT} <= 25, 'novas=' || novas || ' removidas=' || removidas
      || ' alteradas=' || alteradas || ' total_vigente=' || total_vigente FROM delta""",
)
_add(
    "publish_generation",
    f"""SELECT '200106' AS load_id, 'dados_200106' AS schema_nome, 'publicado' AS etapa,
    NULL::DECIMAL(6,3) AS delta_pct, FALSE AS vigente
    UNION ALL SELECT '200107', 'dados_200107', 'publicado',
      round({_DELTA_PCT}, 3)::DECIMAL(6,3), TRUE FROM delta""",
)
_add(
    "publish_truncated",
    """SELECT '200106' AS load_id, 'publicado' AS etapa, TRUE AS vigente, TRUE AS iniciado,
    count(*) FILTER (WHERE o_orderkey % 2 <> 0) > 0.25 * count(*) AS recusado FROM orders""",
)
_add(
    "rollback_generation",
    """SELECT schema_nome, publicado_em FROM ciclos WHERE publicado_em IS NOT NULL
    ORDER BY publicado_em DESC LIMIT 1 OFFSET 1""",
)
_add(
    "gc_candidates",
    """SELECT schema_nome FROM ciclos WHERE schema_nome NOT IN (SELECT schema_nome FROM ciclos
    WHERE publicado_em IS NOT NULL ORDER BY publicado_em DESC LIMIT 2)""",
)
_add(
    "cycle_upsert",
    """SELECT coalesce(c.load_id, s.load_id) AS load_id,
    'dados_' || coalesce(c.load_id, s.load_id) AS schema_nome,
    CASE WHEN s.load_id IS NOT NULL THEN 'carregado' ELSE c.etapa END AS etapa, c.publicado_em,
    coalesce(s.n, c.linhas_estabelecimento) AS linhas_estabelecimento
    FROM ciclos c FULL OUTER JOIN (SELECT strftime(l_shipdate, '%Y%m') AS load_id, count(*) AS n
    FROM lineitem GROUP BY 1) s ON c.load_id = s.load_id""",
)

# -- anchor and indicators ---------------------------------------------------------

_add("anchor_month", "SELECT mes_ancora FROM ancora")
_add("anchor_windows", "SELECT * FROM janelas")
_add("period_windows", "SELECT * FROM periodos")
_CTES["anos_cliente"] = """
SELECT o_custkey, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-06-01') AS atual,
       count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-06-01') AS anterior,
       count(*) FILTER (WHERE o_orderstatus = 'O') AS ativos,
       count(*) FILTER (WHERE o_orderstatus <> 'P') AS aberturas
FROM orders GROUP BY 1
"""
_add(
    "variation_pct",
    f"""SELECT o_custkey, {_variation("atual", "anterior")} AS variacao,
    {_variation("(atual * 12345)", "anterior")} AS variacao_grande,
    {_variation("(atual * -12345)", "anterior")} AS variacao_negativa FROM anos_cliente""",
)
_add(
    "survival_pct",
    f"SELECT o_custkey, {_share('ativos', 'aberturas')} AS sobrevivencia FROM anos_cliente",
)

# -- view graph --------------------------------------------------------------------


def _counts(*names):
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "table", count(*) AS "rows" FROM {n}""" for n in names
    )


_add(
    "build_views",
    _counts("mv_stats_estado", "mv_abertura_periodo", "mv_porte_cidade", "mv_comparativo_territorio"),
)
_REFRESHED = ("mv_stats_estado", "mv_abertura_periodo", "mv_comparativo_territorio")
_VIEW_NAMES = [n for n in _CTES if n.startswith("mv_") and not n.endswith("_2000")]
# every refreshed view is OK when its definition yields a result at all
_add(
    "refresh_views",
    " UNION ALL ".join(
        f"SELECT '{n}' AS mv_name, CASE WHEN count(*) >= 0 THEN 'OK' END AS status FROM {n}"
        if n in _REFRESHED
        else f"SELECT '{n}', 'AUSENTE'"
        for n in sorted(_VIEW_NAMES, key=lambda n: n not in _REFRESHED)
    ),
)
_add(
    "companies_by_territory",
    """SELECT cod_regiao_ibge, cod_estado_ibge, 'estado' AS nivel,
    count(DISTINCT cnpj_basico) AS total_empresas, count(*) AS total_estabelecimentos
    FROM estabelecimento WHERE cod_regiao_ibge IS NOT NULL AND cod_estado_ibge IS NOT NULL GROUP BY 1, 2
    UNION ALL SELECT cod_regiao_ibge, NULL, 'regiao', count(DISTINCT cnpj_basico), count(*)
    FROM estabelecimento WHERE cod_regiao_ibge IS NOT NULL AND cod_estado_ibge IS NOT NULL GROUP BY 1""",
)
_add("stats_estado_bitmaps", "SELECT * FROM mv_stats_estado")
for _key, _view in (
    ("refresh_changed_territory", "mv_stats_municipio"),
    ("refresh_changed_series", "mv_abertura_periodo"),
    ("refresh_changed_companies", "mv_regime_tributario_cidade"),
    ("refresh_changed_ranking", "mv_top_cnaes_cidade"),
):
    _add(_key, f"SELECT * FROM {_view}")
_BASE = (
    "cnae motivo municipio_rfb natureza_juridica pais qualificacao_socio ibge_regiao ibge_estado "
    "ibge_cidade empresa estabelecimento simples socio estabelecimento_cnae_sec"
).split()
_add("table_stats", f"SELECT * FROM ({_counts(*_BASE)}) t WHERE \"rows\" > 0")

# -- search ------------------------------------------------------------------------

_B = "busca_estabelecimento"
_add(_B, f"SELECT * FROM {_B}")
_add(
    "search_name_prefix",
    f"""SELECT cnpj_completo, razao_social_norm FROM {_B}
    WHERE razao_social_norm LIKE 'CUSTOMER#0000000%' AND cod_situacao_cadastral = '02'
    ORDER BY razao_social_norm, cnpj_completo LIMIT 20""",
)
_add(
    "search_name_prefix_count",
    f"SELECT count(*) AS total FROM {_B} WHERE nome_fantasia_norm LIKE 'CAFE B%'",
)
_add(
    "search_name_substring",
    f"""SELECT cnpj_completo, nome_fantasia_norm FROM {_B}
    WHERE nome_fantasia_norm LIKE '%RING%'""",
)
_add(
    "search_city_activity_page",
    f"""SELECT cnpj_completo, razao_social_norm FROM {_B} WHERE cod_cidade_ibge = 100
    AND cod_cnae_principal = '0000009' AND cod_situacao_cadastral = '02'
    ORDER BY cnpj_completo LIMIT 51 OFFSET 1""",
)
_add(
    "search_curve_layout",
    """SELECT cnpj_completo, cod_cidade_ibge, cod_cnae_principal, cod_situacao_cadastral,
    data_inicio_atividade FROM estabelecimento WHERE cod_cnae_principal = '0000009'
    AND cod_situacao_cadastral = '02' AND data_inicio_atividade >= DATE '1996-03-01'""",
)
_add(
    "search_stored_page",
    """SELECT cnpj_completo, cod_cidade_ibge, cod_cnae_principal, cod_situacao_cadastral
    FROM estabelecimento WHERE cod_cidade_ibge = 100
    AND cod_cnae_principal = '0000009' AND cod_situacao_cadastral = '02'
    ORDER BY cnpj_completo LIMIT 1 OFFSET 1""",
)
_add(
    "page_directory",
    """SELECT cod_cidade_ibge, cod_cnae_principal, (place - 1) // 5 AS pagina, cnpj_completo AS primeiro
    FROM (SELECT *, row_number() OVER (
            PARTITION BY cod_cidade_ibge, cod_cnae_principal ORDER BY cnpj_completo) AS place
          FROM estabelecimento WHERE cod_cidade_ibge IS NOT NULL AND cod_cnae_principal IS NOT NULL) r
    WHERE (place - 1) % 5 = 0""",
)
_add(
    "name_prefix_counts",
    """SELECT prefixo, count(*) AS total FROM (
      SELECT razao_social, unnest(range(1, length(razao_social) + 1)) AS n,
        substr(razao_social, 1, n) AS prefixo, substr(razao_social, 1, n - 1) AS parent FROM empresa
      WHERE razao_social <> '') p
    WHERE n = 1 OR parent IN (
      SELECT substr(razao_social, 1, k) FROM (
        SELECT razao_social, unnest(range(1, length(razao_social) + 1)) AS k FROM empresa) q
      GROUP BY 1 HAVING count(*) > 20)
    GROUP BY 1""",
)
_add(
    "search_keyset_page",
    """SELECT cnpj_completo, cod_estado_ibge, cod_situacao_cadastral FROM estabelecimento
    WHERE cod_estado_ibge = 3 AND cod_situacao_cadastral = '02' AND cnpj_completo > '00000000000100'
    ORDER BY cnpj_completo LIMIT 51""",
)
_add(
    "search_area_code",
    f"""SELECT cnpj_completo, ddd_telefone_1, ddd_telefone_2 FROM {_B}
    WHERE ddd_telefone_1 = '12' OR ddd_telefone_2 = '12'""",
)
_add(
    "search_filters",
    f"""SELECT cnpj_completo, cnpj_basico, data_inicio_atividade FROM {_B} WHERE cod_estado_ibge = 5
    AND cod_situacao_cadastral = '02' AND matriz_filial = '2'
    AND data_inicio_atividade >= DATE '1996-01-01' AND bairro_norm LIKE '%SAO%'
    AND cnpj_basico IN (SELECT cnpj_basico FROM empresa WHERE capital_social BETWEEN 0 AND 8000)
    AND cnpj_basico IN (SELECT cnpj_basico FROM simples WHERE opcao_simples = 'S')""",
)
_add(
    "leads_with_email",
    """SELECT 'atividade' AS lista, cnpj_completo FROM estabelecimento
    WHERE cod_cnae_principal = '0000009' AND cod_situacao_cadastral = '02' AND email <> ''
    UNION ALL SELECT 'cidade', cnpj_completo FROM estabelecimento WHERE cod_cidade_ibge = 201
    AND cod_situacao_cadastral = '02' AND email <> '' AND email NOT ILIKE '%contab%'""",
)
_add(
    "sitemap_state_companies",
    """SELECT cnpj_basico, cnpj_completo FROM estabelecimento
    WHERE cod_estado_ibge = 7 AND matriz_filial = '1'""",
)
_add(
    "sitemap_state_activities",
    """SELECT cod_cnae_principal, count(*) AS total FROM estabelecimento WHERE cod_estado_ibge = 7
    GROUP BY 1 HAVING count(*) >= 20""",
)
_add(
    "sitemap_city_activities",
    """SELECT cod_cidade_ibge, cod_cnae_principal, count(*) AS total FROM estabelecimento
    WHERE cod_estado_ibge = 7 GROUP BY 1, 2""",
)
_add(
    "secondary_activity_filter",
    "SELECT * FROM estabelecimento_cnae_sec WHERE cod_cnae = '0000011' AND cod_estado_ibge = 4",
)

# -- consumer queries --------------------------------------------------------------

_add(
    "by_full_id",
    """SELECT e.cnpj_completo, c.razao_social, e.nome_fantasia, e.uf, d.nome_cidade
    FROM estabelecimento e JOIN empresa c ON e.cnpj_basico = c.cnpj_basico
    LEFT JOIN ibge_cidade d ON e.cod_cidade_ibge = d.cod_cidade_ibge
    WHERE e.cnpj_completo = '00000000000123'""",
)
_add(
    "by_root",
    """SELECT e.cnpj_completo, c.razao_social,
    CASE e.matriz_filial WHEN '1' THEN 'MATRIZ' WHEN '2' THEN 'FILIAL' END AS tipo
    FROM estabelecimento e JOIN empresa c ON e.cnpj_basico = c.cnpj_basico
    WHERE e.cnpj_basico = '00000042'""",
)
_add(
    "partners_of",
    """SELECT s.nome_socio, q.nome_qualificacao AS qualificacao, s.data_entrada_sociedade,
    CASE s.identificador_socio WHEN '1' THEN 'Pessoa Jurídica' WHEN '2' THEN 'Pessoa Física'
    WHEN '3' THEN 'Estrangeiro' END AS tipo_socio
    FROM socio s JOIN qualificacao_socio q ON s.cod_qualificacao_socio = q.cod_qualificacao
    WHERE s.cnpj_basico = '00000042'""",
)
_add(
    "per_state",
    """SELECT u.sigla_uf, u.nome_estado, count(*) AS total_estabelecimentos,
    count(*) FILTER (WHERE e.cod_situacao_cadastral = '02') AS ativos
    FROM estabelecimento e JOIN ibge_estado u ON e.cod_estado_ibge = u.cod_estado_ibge GROUP BY 1, 2""",
)
_add(
    "per_city_geo",
    """SELECT d.nome_cidade, u.sigla_uf, d.latitude, d.longitude, count(*) AS total
    FROM estabelecimento e JOIN ibge_cidade d ON e.cod_cidade_ibge = d.cod_cidade_ibge
    JOIN ibge_estado u ON d.cod_estado_ibge = u.cod_estado_ibge
    WHERE e.cod_situacao_cadastral = '02' GROUP BY 1, 2, 3, 4
    ORDER BY total DESC, d.nome_cidade, u.sigla_uf LIMIT 20""",
)
_add(
    "per_region",
    """SELECT r.nome_regiao, count(DISTINCT e.cnpj_basico) AS total_empresas,
    count(*) AS total_estabelecimentos FROM estabelecimento e
    JOIN ibge_regiao r ON e.cod_regiao_ibge = r.cod_regiao_ibge
    WHERE e.cod_situacao_cadastral = '02' GROUP BY 1""",
)
_add(
    "secondary_of",
    """SELECT s.cnpj_completo, s.cod_cnae, c.nome_cnae FROM estabelecimento_cnae_sec s
    JOIN cnae c ON s.cod_cnae = c.cod_cnae WHERE s.cnpj_completo = '00000000000123'""",
)
_add(
    "activities_in_state",
    """SELECT c.cod_cnae, c.nome_cnae, count(*) AS total FROM estabelecimento e
    JOIN cnae c ON e.cod_cnae_principal = c.cod_cnae
    WHERE e.cod_estado_ibge = 7 AND e.cod_situacao_cadastral = '02' GROUP BY 1, 2
    ORDER BY total DESC, c.cod_cnae LIMIT 20""",
)
_add(
    "view_state_rank",
    """SELECT sigla_uf, nome_estado, total_estabelecimentos, ativos, matrizes_ativas,
    total_empresas, novos_1ano FROM mv_stats_estado""",
)
_add(
    "view_top_cities",
    """SELECT nome_cidade, sigla_uf, total_empresas, ativos, novos_6meses FROM mv_stats_municipio
    ORDER BY total_empresas DESC, nome_cidade, sigla_uf LIMIT 10""",
)
_add(
    "view_top_activities",
    """SELECT cod_cnae_principal, nome_cnae, total_estabelecimentos, ativos, estados_presentes
    FROM mv_stats_cnae ORDER BY total_estabelecimentos DESC, cod_cnae_principal LIMIT 20""",
)
_add(
    "series_state",
    """SELECT mes_abertura, sum(total_aberturas)::BIGINT AS total_aberturas,
    sum(empresas_unicas)::BIGINT AS empresas_unicas, sum(ainda_ativos)::BIGINT AS ainda_ativos
    FROM mv_abertura_periodo WHERE cod_estado_ibge = 7 AND mes_abertura >= DATE '1998-01-01'
    GROUP BY 1""",
)
_add(
    "series_city",
    """SELECT mes_abertura, total_aberturas, empresas_unicas, ainda_ativos
    FROM mv_abertura_periodo WHERE cod_cidade_ibge = 703 AND mes_abertura >= DATE '1998-01-01'""",
)
_add(
    "ranking_city",
    """SELECT cod_cnae_principal, nome_cnae, total, ranking FROM mv_top_cnaes_cidade
    WHERE cod_cidade_ibge = 301""",
)
_add(
    "form_rank_states",
    f"""SELECT e.sigla_uf, e.nome_estado, m.total, m.ativos,
    {_share("m.ativos", "m.total", "DECIMAL(18,2)")} AS taxa_atividade
    FROM mv_stats_natureza_juridica_estado m JOIN ibge_estado e
    ON m.cod_estado_ibge = e.cod_estado_ibge WHERE m.cod_natureza = 'BUILDING'""",
)
_BY_REGION = """FROM mv_stats_natureza_juridica_estado m JOIN ibge_regiao r
    ON m.cod_regiao_ibge = r.cod_regiao_ibge WHERE m.cod_natureza = 'BUILDING'"""
_add(
    "form_by_region",
    f"""SELECT r.nome_regiao, r.sigla_regiao, sum(m.total)::BIGINT AS total,
    sum(m.ativos)::BIGINT AS ativos {_BY_REGION} GROUP BY 1, 2""",
)
_add(
    "form_regions_in",
    f"""SELECT r.nome_regiao, sum(m.total)::BIGINT AS total {_BY_REGION}
    AND m.cod_regiao_ibge IN (3, 4) GROUP BY 1""",
)
_add(
    "forms_of_state",
    """SELECT n.nome_natureza, m.total, m.ativos FROM mv_stats_natureza_juridica_estado m
    JOIN natureza_juridica n ON m.cod_natureza = n.cod_natureza WHERE m.cod_estado_ibge = 7""",
)
_add(
    "forms_of_city",
    """SELECT n.nome_natureza, m.total, m.ativos FROM mv_stats_natureza_juridica_municipio m
    JOIN natureza_juridica n ON m.cod_natureza = n.cod_natureza WHERE m.cod_cidade_ibge = 703""",
)
_add(
    "top_cities_by_form",
    """SELECT c.nome_cidade, e.sigla_uf, m.total, m.ativos
    FROM mv_stats_natureza_juridica_municipio m
    JOIN ibge_cidade c ON m.cod_cidade_ibge = c.cod_cidade_ibge
    JOIN ibge_estado e ON m.cod_estado_ibge = e.cod_estado_ibge WHERE m.cod_natureza = 'BUILDING'
    ORDER BY m.total DESC, c.nome_cidade, e.sigla_uf LIMIT 10""",
)
_add(
    "capitals_compare",
    """SELECT c.nome_cidade, e.sigla_uf, sum(m.total)::BIGINT AS total,
    sum(m.ativos)::BIGINT AS ativos FROM mv_stats_natureza_juridica_municipio m
    JOIN ibge_cidade c ON m.cod_cidade_ibge = c.cod_cidade_ibge
    JOIN ibge_estado e ON m.cod_estado_ibge = e.cod_estado_ibge WHERE c.capital GROUP BY 1, 2""",
)
_add(
    "form_search",
    """SELECT * FROM mv_stats_natureza_juridica
    WHERE cod_natureza ILIKE '%mach%' OR nome_natureza ILIKE '%forma b%'""",
)
_add(
    "form_summary",
    """SELECT count(*) AS total_naturezas, sum(total)::BIGINT AS total_empresas,
    sum(ativos)::BIGINT AS total_ativas FROM mv_stats_natureza_juridica""",
)
_add(
    "form_top_rate",
    f"""SELECT cod_natureza, nome_natureza, total, ativos,
    {_share("ativos", "total", "DECIMAL(18,2)")} AS taxa_atividade
    FROM mv_stats_natureza_juridica WHERE total > 10
    ORDER BY taxa_atividade DESC NULLS FIRST, cod_natureza LIMIT 5""",
)
_add(
    "comparison_lookup",
    "SELECT * FROM mv_comparativo_territorio WHERE nivel = 'estado' AND cod_estado_ibge = 7",
)
_add(
    "activity_growth_rank",
    "SELECT * FROM mv_comparativo_cnae WHERE nivel = 'brasil' AND periodo_meses = 12",
)

# -- run history -------------------------------------------------------------------

_add(
    "run_start",
    """SELECT run_id, CASE WHEN event_id % 2 = 0 THEN reference_period ELSE '2001-09' END
    AS reference_period, CASE WHEN event_id % 2 = 0 THEN status ELSE 'in_progress' END AS status,
    CASE WHEN event_id % 2 = 0 THEN started_at ELSE finished_at END AS started_at
    FROM pipeline_stats""",
)
_add(
    "run_finish",
    """SELECT run_id, CASE WHEN d THEN started_at + to_seconds(90) ELSE finished_at END AS finished_at,
    CASE WHEN d THEN 'completed' ELSE status END AS status,
    CASE WHEN d THEN 90::DECIMAL(18,2) ELSE duration_seconds END AS duration_seconds,
    CASE WHEN d AND event_id % 2 = 0 THEN 7 ELSE records_inserted_total END
        AS records_inserted_total,
    CASE WHEN NOT d THEN error END AS error
    FROM (SELECT *, event_id % 3 = 0 AS d FROM pipeline_stats) p""",
)
_LAST = """(SELECT run_id FROM pipeline_stats {0} ORDER BY started_at DESC, run_id DESC LIMIT 1)"""
_add(
    "run_mark_refresh",
    f"""SELECT run_id, CASE WHEN run_id = {_LAST.format("WHERE reference_period = '2001-08'")}
    THEN TIMESTAMP '2024-02-01 03:00:00' END AS views_refreshed_at FROM pipeline_stats""",
)
_add(
    "run_status",
    """SELECT user_id::VARCHAR AS run_id,
    CASE WHEN bool_or(event_type = 'error' AND user_id % 5 = 0) THEN 'failed'
         WHEN count(DISTINCT CASE WHEN event_type <> 'signup' AND event_id % 9 <> 0
                             AND NOT (event_type = 'error' AND user_id % 5 = 0)
                             THEN event_id % 9 END) = 8 THEN 'completed'
         ELSE 'partial' END AS run_status FROM events GROUP BY user_id""",
)
_add(
    "run_last",
    f"""SELECT reference_period, started_at, finished_at, duration_seconds, status
    FROM pipeline_stats WHERE run_id = {_LAST.format("")}""",
)
_add(
    "run_files_of_period",
    f"""SELECT files_downloaded_count FROM pipeline_stats
    WHERE run_id = {_LAST.format("WHERE reference_period = '2001-08'")}""",
)
_add(
    "run_monthly_volume",
    """SELECT reference_period, records_inserted_total,
    (((duration_seconds::BIGINT * 200 + 3600) // 7200)::DECIMAL(16,0) * 0.01::DECIMAL(3,2))
        ::DECIMAL(18,2) AS horas
    FROM pipeline_stats WHERE status = 'completed'""",
)
_add(
    "run_big_files",
    f"""SELECT 'Empresas' || (event_id % 10) || '.zip' AS arquivo, k * 21474837 AS tamanho
    FROM pipeline_stats WHERE run_id = {_LAST.format("")} AND k * 21474837 > 1073741824
    UNION ALL SELECT 'Socios' || (event_id % 10) || '.zip', k * 1000000
    FROM pipeline_stats WHERE run_id = {_LAST.format("")} AND k * 1000000 > 1073741824""",
)
_add(
    "run_files_summary",
    """SELECT run_id, 2::BIGINT AS files_downloaded, k * 21474837 + k * 1000000 AS total_bytes
    FROM pipeline_stats""",
)
