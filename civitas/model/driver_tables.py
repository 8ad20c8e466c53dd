"""Registry-shaped tables over the star-schema test tables.

One order stands for one establishment, one customer for one company, one brand
for one activity and one nation for one state; ``FIXTURES.md`` lists the whole
binding.  A table is put together only from the joins its requested columns
need, so a view that reads no status date never touches ``lineitem``.

Joins into ``orders`` go through the unique order key wherever the value allows
it: the first order of a customer is found by an aggregate, not by a window
that would hold all orders of one customer in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.model.source import TableSource

# Layout of the test tables (FIXTURES.md section 3).  Stated here so
# that reading a table starts no schema inference job.
LAYOUTS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

CITIES_PER_STATE = 8


def _pad(col, width: int):
    return F.lpad(col.cast("string"), width, "0")


class DriverTables(TableSource):
    """The fourteen tables plus history, listings and raw file rows."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def raw(self, name: str, *columns: str) -> DataFrame:
        frame = self.spark.read.schema(LAYOUTS[name]).parquet(f"{self.sf_dir}/{name}.parquet")
        return frame.select(*columns) if columns else frame

    def has(self, name):
        return hasattr(self, f"_{name}")

    def load(self, name, columns):
        build = getattr(self, f"_{name}")
        if name in ("estabelecimento", "pipeline_stats"):  # only build what is asked for
            return build(None if columns is None else set(columns))
        return build()

    @staticmethod
    def _pick(frame: DataFrame, columns: dict, wanted: set[str] | None) -> DataFrame:
        chosen = columns if wanted is None else [c for c in columns if c in wanted]
        return frame.select(*[columns[c]().alias(c) for c in chosen])

    # -- geography ---------------------------------------------------------

    def _ibge_regiao(self):
        return self.raw("region").select(
            (F.col("r_regionkey") + 1).cast("int").alias("cod_regiao_ibge"),
            F.substr("r_name", F.lit(1), F.lit(2)).alias("sigla_regiao"),
            F.col("r_name").alias("nome_regiao"),
        )

    def _ibge_estado(self):
        return self.raw("nation").select(
            (F.col("n_nationkey") + 1).cast("int").alias("cod_estado_ibge"),
            F.col("n_name").alias("sigla_uf"),
            F.col("n_name").alias("nome_estado"),
            (-F.col("n_nationkey")).cast("decimal(9,6)").alias("latitude"),
            (-F.col("n_nationkey") * 2).cast("decimal(9,6)").alias("longitude"),
            (F.col("n_regionkey") + 1).cast("int").alias("cod_regiao_ibge"),
        )

    def _ibge_cidade(self):
        k = F.col("k")
        code = (F.col("n_nationkey") + 1) * 100 + k
        return (
            self.raw("nation")
            .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(CITIES_PER_STATE - 1))))
            .select(
                code.cast("int").alias("cod_cidade_ibge"),
                F.concat("n_name", F.lit("_C"), k.cast("string")).alias("nome_cidade"),
                (-k).cast("decimal(9,6)").alias("latitude"),
                (-k * 3).cast("decimal(9,6)").alias("longitude"),
                (k == 0).alias("capital"),
                (F.col("n_nationkey") + 1).cast("int").alias("cod_estado_ibge"),
                _pad(code, 4).alias("cod_municipio"),
                (k + 11).cast("string").alias("ddd"),
                F.lit("UTC").alias("fuso_horario"),
            )
        )

    # -- code tables -------------------------------------------------------

    def _cnae(self):
        return (
            self.raw("part", "p_brand")
            .distinct()
            .select(self._activity("p_brand").alias("cod_cnae"), F.col("p_brand").alias("nome_cnae"))
        )

    @staticmethod
    def _activity(brand: str):
        return F.lpad(F.substr(F.col(brand), F.lit(7)), 7, "0")

    def _natureza_juridica(self):
        forms = self.raw("customer", "c_mktsegment").distinct()
        # one form without a company, so that zero rows are exercised
        empty = self.raw("region").filter("r_regionkey = 0").select(F.lit("SEM EMPRESA"))
        return forms.union(empty).select(
            F.col("c_mktsegment").alias("cod_natureza"),
            F.concat(F.lit("Forma "), F.col("c_mktsegment")).alias("nome_natureza"),
        )

    def _pais(self):
        return self.raw("nation").select(
            _pad(F.col("n_nationkey") * 5, 3).alias("cod_pais"), F.col("n_name").alias("nome_pais")
        )

    def _motivo(self):
        priority = F.col("o_orderpriority")
        return (
            self.raw("orders", "o_orderpriority")
            .distinct()
            .select(
                F.lpad(F.substr(priority, F.lit(1), F.lit(1)), 2, "0").alias("cod_motivo"),
                priority.alias("nome_motivo"),
            )
        )

    def _municipio_rfb(self):
        return self._ibge_cidade().select(
            "cod_municipio", F.upper("nome_cidade").alias("nome_municipio")
        )

    def _qualificacao_socio(self):
        return (
            self.raw("part", "p_size")
            .distinct()
            .select(
                _pad(F.col("p_size"), 2).alias("cod_qualificacao"),
                F.concat(F.lit("Qualificação "), F.col("p_size").cast("string")).alias(
                    "nome_qualificacao"
                ),
            )
        )

    # -- companies ---------------------------------------------------------

    def _empresa(self):
        balance = F.col("c_acctbal")
        return self.raw("customer").select(
            _pad(F.col("c_custkey"), 8).alias("cnpj_basico"),
            F.col("c_name").alias("razao_social"),
            F.col("c_mktsegment").alias("cod_natureza_juridica"),
            _pad(F.col("c_custkey") % 53 + 1, 2).alias("cod_qualificacao_responsavel"),
            balance.cast("decimal(16,2)").alias("capital_social"),
            F.when(balance < 0, "00")
            .when(balance < 3000, "01")
            .when(balance < 6000, "03")
            .otherwise("05")
            .alias("cod_porte"),
            F.lit(None).cast("string").alias("ente_federativo_responsavel"),
        )

    def _simples(self):
        key = F.col("c_custkey")
        none = F.lit(None).cast("date")
        start = F.date_add(F.lit("1996-01-01").cast("date"), (key % 1000).cast("int"))
        return (
            self.raw("customer", "c_custkey")
            .filter(key % 5 != 0)
            .select(
                _pad(key, 8).alias("cnpj_basico"),
                F.when(key % 2 == 0, "S").otherwise("N").alias("opcao_simples"),
                F.when(key % 2 == 0, start).alias("data_opcao_simples"),
                none.alias("data_exclusao_simples"),
                F.when(key % 3 == 0, "S").otherwise("N").alias("opcao_mei"),
                F.when(key % 3 == 0, start).alias("data_opcao_mei"),
                none.alias("data_exclusao_mei"),
            )
        )

    def _socio(self):
        """Each (customer, supplier) pair that traded, entered on first shipment.

        The customer of a line is looked up by order key; the pairs collapse
        per (customer, supplier) after a map-side minimum.
        """
        lines = self.raw("lineitem", "l_orderkey", "l_suppkey", "l_shipdate")
        orders = self.raw("orders", "o_orderkey", "o_custkey")
        supplier = F.col("l_suppkey")
        pairs = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_suppkey")
            .agg(F.min("l_shipdate").cast("date").alias("entry"))
        )
        named = pairs.join(
            self.raw("supplier", "s_suppkey", "s_name"), supplier == F.col("s_suppkey"), "left"
        )
        return named.select(
            _pad(F.col("o_custkey"), 8).alias("cnpj_basico"),
            (supplier % 3 + 1).cast("string").alias("identificador_socio"),
            F.col("s_name").alias("nome_socio"),
            _pad(supplier, 14).alias("cnpj_cpf_socio"),
            _pad(supplier % 53 + 1, 2).alias("cod_qualificacao_socio"),
            F.col("entry").alias("data_entrada_sociedade"),
            F.when(supplier % 11 == 0, "042").when(supplier % 7 == 0, "105").alias("cod_pais"),
            F.lit(None).cast("string").alias("cpf_representante_legal"),
            F.lit(None).cast("string").alias("nome_representante_legal"),
            F.when(supplier % 13 == 0, _pad(supplier % 60 + 1, 2)).alias(
                "cod_qualificacao_representante_legal"
            ),
            (supplier % 9 + 1).cast("string").alias("cod_faixa_etaria"),
        )

    # -- establishments ----------------------------------------------------

    def _estabelecimento(self, wanted: set[str] | None):
        """One row per order; ``wanted`` limits both columns and joins."""
        order_key, customer_key = F.col("o_orderkey"), F.col("o_custkey")
        ident = _pad(order_key, 14)
        lacks_state = order_key % 194 == 0
        lacks_city = order_key % 97 == 0
        state = (F.col("c_nationkey") + 1).cast("int")
        status = F.col("o_orderstatus")
        none = F.lit(None).cast("string")
        columns = {
            "cnpj_basico": lambda: _pad(customer_key, 8),
            "cnpj_ordem": lambda: F.substr(ident, F.lit(9), F.lit(4)),
            "cnpj_dv": lambda: F.substr(ident, F.lit(13), F.lit(2)),
            "cnpj_completo": lambda: ident,
            "matriz_filial": lambda: F.when(F.col("is_first"), "1").otherwise("2"),
            "nome_fantasia": lambda: F.concat(F.lit("Café "), F.col("p_name")),
            "cod_situacao_cadastral": lambda: F.when(status == "O", "02")
            .when(status == "F", "08")
            .otherwise("04"),
            "data_situacao_cadastral": lambda: F.col("last_ship"),
            "cod_motivo_situacao_cadastral": lambda: F.when(order_key % 101 == 0, "99").otherwise(
                F.lpad(F.substr("o_orderpriority", F.lit(1), F.lit(1)), 2, "0")
            ),
            "nome_cidade_exterior": lambda: none,
            "cod_pais": lambda: F.when(order_key % 11 == 0, "105")
            .when(order_key % 13 == 0, "23")
            .when(order_key % 17 == 0, "0"),
            "data_inicio_atividade": lambda: F.col("o_orderdate").cast("date"),
            "cod_cnae_principal": lambda: self._activity("p_brand"),
            "cod_cnae_secundario": lambda: none,
            "tipo_logradouro": lambda: F.lit("RUA"),
            "logradouro": lambda: F.concat(F.lit("Rua "), (order_key % 500).cast("string")),
            "numero": lambda: (order_key % 1000).cast("string"),
            "complemento": lambda: none,
            "bairro": lambda: F.concat(F.lit("São "), F.col("o_orderpriority")),
            "cep": lambda: _pad(order_key % 100000, 8),
            "uf": lambda: F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")),
            "cod_municipio": lambda: F.when(~lacks_city, _pad(state * 100 + customer_key % 8, 4)),
            "ddd_telefone_1": lambda: F.when(order_key % 4 != 0, (order_key % 89 + 11).cast("string")),
            "telefone_1": lambda: F.when(order_key % 4 != 0, "999"),
            "ddd_telefone_2": lambda: F.when(order_key % 3 == 0, (order_key % 7 + 11).cast("string")),
            "telefone_2": lambda: F.when(order_key % 3 == 0, "888"),
            "ddd_fax": lambda: none,
            "fax": lambda: none,
            "email": lambda: F.when(order_key % 5 == 0, none)
            .when(order_key % 7 == 0, "x@CONTABil.com")
            .otherwise("u@e.com"),
            "situacao_especial": lambda: none,
            "data_situacao_especial": lambda: F.lit(None).cast("date"),
            "cod_regiao_ibge": lambda: F.when(~lacks_state, (F.col("n_regionkey") + 1).cast("int")),
            "cod_estado_ibge": lambda: F.when(~lacks_state, state),
            "cod_cidade_ibge": lambda: F.when(~lacks_city, (state * 100 + customer_key % 8).cast("int")),
        }
        wanted = set(columns) if wanted is None else wanted
        frame = self.raw(
            "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
        )
        if "matriz_filial" in wanted:
            first = (
                self.raw("orders", "o_orderkey", "o_custkey")
                .groupBy("o_custkey")
                .agg(F.min("o_orderkey").alias("first_key"))
                .select("first_key", F.lit(True).alias("is_first"))
            )
            frame = frame.join(first, order_key == F.col("first_key"), "left")
        activity = bool(wanted & {"cod_cnae_principal", "nome_fantasia"})
        if activity or "data_situacao_cadastral" in wanted:
            first_line = F.min(F.struct("l_linenumber", "l_partkey"))["l_partkey"]
            lines = (
                self.raw("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
                .groupBy("l_orderkey")
                .agg(
                    F.max("l_shipdate").cast("date").alias("last_ship"),
                    first_line.alias("first_part"),
                )
            )
            frame = frame.join(lines, order_key == F.col("l_orderkey"), "left")
        if activity:
            parts = self.raw("part", "p_partkey", "p_brand", "p_name")
            frame = frame.join(parts, F.col("first_part") == F.col("p_partkey"), "left")
        if wanted & {"cod_regiao_ibge", "cod_estado_ibge", "cod_cidade_ibge", "uf", "cod_municipio"}:
            customers = self.raw("customer", "c_custkey", "c_nationkey")
            if "cod_regiao_ibge" in wanted:
                nations = self.raw("nation", "n_nationkey", "n_regionkey")
                customers = customers.join(
                    nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
                )
            frame = frame.join(customers, customer_key == F.col("c_custkey"), "left")
        return self._pick(frame, columns, wanted)

    def secondary_lists(self) -> DataFrame:
        """Comma list of the activities of each order's lines, with a blank item."""
        lines = self.raw("lineitem", "l_orderkey", "l_partkey")
        parts = self.raw("part", "p_partkey", "p_brand")
        brand = self._activity("p_brand")
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_set(brand)).alias("codes"))
            .select("l_orderkey", F.concat(F.array_join("codes", ", "), F.lit(",,")).alias("codes"))
        )

    def _estabelecimento_cnae_sec(self):
        """Distinct (order, brand of a line) with the order's geography."""
        lines = self.raw("lineitem", "l_orderkey", "l_partkey")
        parts = self.raw("part", "p_partkey", "p_brand")
        pairs = (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(_pad(F.col("l_orderkey"), 14).alias("cnpj_completo"),
                    self._activity("p_brand").alias("cod_cnae"))
            .distinct()
        )
        owner = self._estabelecimento(
            {
                "cnpj_completo",
                "cod_regiao_ibge",
                "cod_estado_ibge",
                "cod_cidade_ibge",
                "data_inicio_atividade",
            }
        )
        return pairs.join(owner, "cnpj_completo").select(
            "cnpj_completo",
            "cod_cnae",
            F.col("cod_regiao_ibge").cast("smallint"),
            F.col("cod_estado_ibge").cast("smallint"),
            "cod_cidade_ibge",
            "data_inicio_atividade",
        )

    # -- raw file rows, run history, listings --------------------------------

    def _estabelecimento_file(self):
        """The thirty text columns of the establishment file, with rough edges."""
        order_key, customer_key = F.col("o_orderkey"), F.col("o_custkey")
        city = (F.col("c_nationkey") + 1) * 100 + customer_key % 8
        opened = F.col("o_orderdate")
        none = F.lit(None).cast("string")
        frame = (
            self.raw("orders")
            .join(self.raw("customer", "c_custkey", "c_nationkey"), customer_key == F.col("c_custkey"))
            .join(self.secondary_lists(), order_key == F.col("l_orderkey"), "left")
        )
        return frame.select(
            customer_key.cast("string").alias("cnpj_basico"),
            (order_key % 9999).cast("string").alias("cnpj_ordem"),
            (order_key % 97).cast("string").alias("cnpj_dv"),
            F.when(order_key % 2 == 0, "1").otherwise("2").alias("matriz_filial"),
            F.concat(F.lit("  Loja "), F.col("o_orderpriority"), F.lit("\x91 \x85")).alias("nome_fantasia"),
            F.when(F.col("o_orderstatus") == "O", "02").otherwise("08").alias("cod_situacao_cadastral"),
            F.lit("00000000").alias("data_situacao_cadastral"),
            F.lit("01").alias("cod_motivo_situacao_cadastral"),
            F.lit("").alias("nome_cidade_exterior"),
            F.when(order_key % 11 == 0, "105")
            .when(order_key % 13 == 0, "23")
            .when(order_key % 17 == 0, " 0105 ")
            .otherwise("")
            .alias("cod_pais"),
            F.when(order_key % 10 == 0, F.date_format(opened, "yyyy-MM-dd"))
            .when(order_key % 10 == 1, "00000000")
            .when(order_key % 10 == 2, "20230230")
            .when(order_key % 10 == 3, "0")
            .when(order_key % 10 == 4, " ")
            .otherwise(F.date_format(opened, "yyyyMMdd"))
            .alias("data_inicio_atividade"),
            _pad(order_key % 25 + 1, 7).alias("cod_cnae_principal"),
            F.coalesce(F.col("codes"), F.lit("")).alias("cod_cnae_secundario"),
            F.lit("RUA").alias("tipo_logradouro"),
            F.lit("A; \"B\"").alias("logradouro"),
            (order_key % 1000).cast("string").alias("numero"),
            F.lit("").alias("complemento"),
            F.lit("CENTRO").alias("bairro"),
            _pad(order_key % 100000, 8).alias("cep"),
            F.lower(F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))).alias("uf"),
            F.when(order_key % 97 == 0, "9999")
            .when(order_key % 3 == 0, city.cast("string"))
            .when(order_key % 3 == 1, _pad(city, 4))
            .otherwise(_pad(city, 7))
            .alias("cod_municipio"),
            *[
                none.alias(c)
                for c in (
                    "ddd_telefone_1 telefone_1 ddd_telefone_2 telefone_2 ddd_fax fax email "
                    "situacao_especial data_situacao_especial"
                ).split()
            ],
        )

    def _empresa_file(self):
        """The seven text columns of the company file; two files hold bad rows."""
        key = F.col("c_custkey")
        plain = F.col("c_acctbal").cast("decimal(16,2)").cast("string")
        grouped = F.regexp_replace(plain, "^(-?[0-9]+)([0-9]{3})[.]([0-9]{2})$", "$1.$2,$3")
        return self.raw("customer").select(
            _pad(key, 8).alias("cnpj_basico"),
            F.concat(F.lit(" "), F.col("c_name"), F.lit(' ; "Ltda"')).alias("razao_social"),
            F.when(key % 30 == 7, "")
            .otherwise(F.substr("c_mktsegment", F.lit(1), F.lit(4)))
            .alias("cod_natureza_juridica"),
            F.lit("10").alias("cod_qualificacao_responsavel"),
            F.when(key % 20 == 13, "abc")
            .when(key % 3 == 0, plain)
            .otherwise(F.when(F.col("c_acctbal") < 0, plain).otherwise(grouped))
            .alias("capital_social"),
            F.lit("").alias("cod_porte"),
            F.lit("").alias("ente_federativo_responsavel"),
            F.concat(F.lit("Empresas"), (key % 10).cast("string"), F.lit(".zip")).alias(
                "_source_file"
            ),
        )

    def _pipeline_stats(self, wanted: set[str] | None = None):
        """One load run per event; periods lie just after the last orders."""
        key, kind = F.col("event_id"), F.col("event_type")
        started = F.col("ts").cast("timestamp")
        seconds = F.col("value").cast("int") * 60
        k = F.get_json_object("props", "$.k").cast("long")
        month = F.date_format(F.add_months(F.col("ts").cast("date"), -269), "yyyy-MM")
        detail = (
            '[{"filename":"Empresas%d.zip","size_bytes":%d},'
            '{"filename":"Socios%d.zip","size_bytes":%d}]'
        )
        columns = {
            "run_id": lambda: key.cast("string"),
            "reference_period": lambda: F.when(key % 10 == 3, "13/2001").otherwise(month),
            "status": lambda: F.when(kind == "error", "failed")
            .when(kind == "signup", "partial")
            .otherwise("completed"),
            "started_at": lambda: started,
            "finished_at": lambda: F.timestamp_add("SECOND", seconds, started),
            "duration_seconds": lambda: seconds.cast("decimal(18,2)"),
            "records_inserted_total": lambda: k * 1000,
            "tables_populated": lambda: F.array(
                F.struct(F.lit("empresa").alias("table"), k.alias("rows")),
                F.struct(F.lit("socio").alias("table"), (k * 2).alias("rows")),
            ),
            "files_downloaded_count": lambda: F.lit(2),
            "files_downloaded_detail": lambda: F.format_string(
                detail, key % 10, k * 21474837, key % 10, k * 1000000
            ),
            "views_refreshed_at": lambda: F.lit(None).cast("timestamp"),
            "error": lambda: F.when(kind == "error", "boom"),
        }
        return self._pick(self.raw("events"), columns, wanted)

    def _ciclos(self):
        """One load cycle per month of orders; every third one unpublished."""
        month = F.date_format("o_orderdate", "yyyyMM")
        return (
            self.raw("orders", "o_orderdate")
            .groupBy(month.alias("load_id"))
            .agg(F.max("o_orderdate").alias("last"), F.count("*").alias("rows"))
            .select(
                "load_id",
                F.concat(F.lit("dados_"), F.col("load_id")).alias("schema_nome"),
                F.when(F.col("load_id").cast("int") % 3 == 0, "validado")
                .otherwise("publicado")
                .alias("etapa"),
                F.when(F.col("load_id").cast("int") % 3 != 0, F.col("last"))
                .cast("timestamp")
                .alias("publicado_em"),
                F.col("rows").alias("linhas_estabelecimento"),
                F.lit(None).cast("decimal(6,3)").alias("delta_pct"),
                F.lit(None).cast("string").alias("observacao"),
            )
        )

    def _remote_files(self):
        """Published listing: one archive per document."""
        key = F.col("doc_id")
        stem = F.element_at(
            F.array(*[F.lit(s) for s in ("Empresas", "ESTABELECIMENTOS", "socios", "Cnaes", "Leiame")]),
            (key % 5 + 1).cast("int"),
        )
        return self.raw("documents", "doc_id", "n_chars").select(
            F.concat(stem, key.cast("string"), F.lit(".zip")).alias("filename"),
            F.col("n_chars").alias("size_bytes"),
        )

    def _local_files(self):
        """Downloaded listing: some missing, some extra, some truncated."""
        key = F.regexp_extract("filename", "([0-9]+)", 1).cast("long")
        return self._remote_files().filter(key % 7 != 0).select(
            F.when(key % 13 == 0, F.concat(F.lit("old_"), F.col("filename")))
            .otherwise(F.col("filename"))
            .alias("filename"),
            F.when(key % 11 == 0, F.col("size_bytes") - 1)
            .otherwise(F.col("size_bytes"))
            .alias("size_bytes"),
        )

    def _remote_folders(self):
        """Folder names of the file server, one per order, with strangers."""
        return self.raw("orders", "o_orderkey", "o_orderdate").select(
            F.when(F.col("o_orderkey") % 100 == 0, "temp")
            .when(F.col("o_orderkey") % 100 == 1, F.date_format("o_orderdate", "yyyyMM"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM"))
            .alias("name")
        )
