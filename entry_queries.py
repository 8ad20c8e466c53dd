"""Spark callables behind ``queries()``; each takes (spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.functions import indicators, text, values
from civitas.functions.text import empty_to_null
from civitas.model.driver_tables import DriverTables
from civitas.model.source import FrameSource, OverlaySource, PathSource
from civitas.model.specs import TABLES, spec
from civitas.operators import digests, generations, layout, pages, patches, quality, search
from civitas.operators import runs as runs_
from civitas.operators.geo import add_geo, geo_dimensions
from civitas.operators.ingest import derive_establishment, explode_secondary, transform_table
from civitas.operators.joins import hot_keys
from civitas.operators.quarantine import (
    list_quarantine,
    load_metrics,
    retry_quarantine,
    split_valid,
)
from civitas.operators.search import SEARCH_READS, build_search_table
from civitas.plans import anchor, distinct, graph, incremental, lookups, stock
from civitas.plans.graph import VIEWS, Build
from civitas.scratch import fresh_path
from civitas.sources import files, sinks
from civitas.sources.zip_csv import read_zip_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The driver's orders start in 1995 (FIXTURES.md).
FLOOR = dt.date(1995, 1, 1)


def query(key: str):
    """Register a function of the bound tables under ``key``."""

    def register(function: Callable[[DriverTables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: function(DriverTables(spark, sf_dir))
        return function

    return register


def build_of(tables: DriverTables, floor: dt.date = FLOOR) -> Build:
    return Build(tables, graph.anchor_of(tables), floor)


def view_of(tables: DriverTables, name: str) -> DataFrame:
    return VIEWS[name].build(build_of(tables))


for _name in VIEWS:
    query(_name)(lambda tables, name=_name: view_of(tables, name))


# -- sources and sinks ---------------------------------------------------------


def write_zips(frame: DataFrame, folder: str) -> None:
    """Write text rows as quoted Latin-1 CSV inside one ZIP per partition."""

    def write(rows):
        import csv
        import io
        import zipfile

        from pyarrow import fs
        from pyspark import TaskContext

        remote = "://" in folder
        system, base = fs.FileSystem.from_uri(folder) if remote else (fs.LocalFileSystem(), folder)
        number = TaskContext.get().partitionId()
        system.create_dir(base, recursive=True)
        with (
            system.open_output_stream(f"{base}/Empresas{number}.zip") as out,
            zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
            archive.open(f"K{number}.EMPRECSV", "w", force_zip64=True) as raw,
        ):
            text = io.TextIOWrapper(raw, encoding="latin1", newline="")
            csv.writer(text, delimiter=";", quoting=csv.QUOTE_ALL).writerows(tuple(r) for r in rows)
            text.flush()

    frame.foreachPartition(write)


@query("src_zip_csv")
def _(t):
    folder = fresh_path(t.spark, "zips")
    layout = spec("empresa").file_schema
    write_zips(t.table("empresa_file", layout.fieldNames()).repartition(4, "cnpj_basico"), folder)
    return read_zip_csv(t.spark, f"{folder}/*.zip", layout).select(*layout.fieldNames(), "_fields")


@query("src_route")
def _(t):
    return files.route_files(t.table("remote_files")).select("filename", "stem", "target")


@query("src_fixed_schema")
def _(t):
    path = fresh_path(t.spark, "simples")
    columns = spec("simples").file_schema.fieldNames()
    text = t.table("simples").select(*[F.col(c).cast("string") for c in columns])
    text.write.csv(path, sep=";", quoteAll=True, encoding="ISO-8859-1")
    return values.parse_dates(
        empty_to_null(files.read_table(t.spark, "simples", path)), spec("simples")
    )


@query("src_dim_csv")
def _(t):
    path = fresh_path(t.spark, "estados")
    t.table("ibge_estado").select(
        F.col("cod_estado_ibge").alias("ibge_code"),
        F.concat(F.lit(" "), F.col("sigla_uf"), F.lit(" ")).alias("abbreviation"),
        F.col("nome_estado").alias("name"),
        "latitude",
        "longitude",
        F.col("cod_regiao_ibge").alias("region_id"),
    ).write.csv(path, header=True, sep=";", ignoreLeadingWhiteSpace=False)
    return files.read_dimension(t.spark, "ibge_estado", path)


@query("sink_table")
def _(t):
    root = fresh_path(t.spark, "sink")
    return sinks.write_table(t.table("estabelecimento"), root, "estabelecimento").drop(
        *_ALWAYS_NULL
    )


_ALWAYS_NULL = (
    "nome_cidade_exterior",
    "cod_cnae_secundario",
    "complemento",
    "ddd_fax",
    "fax",
    "situacao_especial",
    "data_situacao_especial",
)


@query("sink_replace_dims")
def _(t):
    root = fresh_path(t.spark, "dims")
    names = ("ibge_regiao", "ibge_estado", "ibge_cidade")
    for _round in range(2):  # the second replacement meets existing tables
        dims = sinks.replace_dimensions(root, *[t.table(n) for n in names])
    return dims["ibge_cidade"].join(dims["ibge_estado"].drop("latitude", "longitude"),
                                    "cod_estado_ibge").join(dims["ibge_regiao"], "cod_regiao_ibge")


def company_split(t, granularity="row"):
    rows = transform_table(t.table("empresa_file"), "empresa")
    return split_valid(rows, spec("empresa"), granularity)


_QUARANTINED = ("table", "source_file", "status")


@query("sink_quarantine")
def _(t):
    good, bad = company_split(t)
    parked = bad.select(
        *_QUARANTINED,
        F.get_json_object("payload", "$.cnpj_basico").alias("cnpj_basico"),
        F.array_join("errors", " | ").alias("errors"),
    )
    loaded = good.select(
        F.lit("empresa").alias("table"),
        F.lit(None).cast("string").alias("source_file"),
        F.lit("loaded").alias("status"),
        "cnpj_basico",
        F.lit("").alias("errors"),
    )
    return parked.unionByName(loaded)


@query("sink_quarantine_file")
def _(t):
    good, bad = company_split(t, "file")
    return good.select("cnpj_basico", F.lit("loaded").alias("fate")).unionByName(
        bad.select(
            F.get_json_object("payload", "$.cnpj_basico").alias("cnpj_basico"),
            F.lit("parked").alias("fate"),
        )
    )


@query("quarantine_list")
def _(t):
    return list_quarantine(company_split(t)[1])


@query("quarantine_retry")
def _(t):
    fixed = company_split(t)[1].withColumn(
        "payload",
        F.regexp_replace(
            "payload", '"cod_natureza_juridica":(null|" *")', '"cod_natureza_juridica":"2062"'
        ),
    )
    return retry_quarantine(fixed, spec("empresa"))[2]


@query("quarantine_retry_rows")
def _(t):
    """What a retry loads: form and capital were put right in the parked text."""
    fixed = company_split(t)[1].withColumn(
        "payload",
        F.regexp_replace(
            F.regexp_replace(
                "payload", '"cod_natureza_juridica":(null|" *")', '"cod_natureza_juridica":"2062"'
            ),
            '"capital_social":"abc"',
            '"capital_social":"1.234,56"',
        ),
    )
    loaded = retry_quarantine(fixed, spec("empresa"))[0]
    return loaded.select("cnpj_basico", "cod_natureza_juridica", "capital_social")


@query("src_zip_csv_field_count")
def _(t):
    """Lines of the archives that have a cell too many or too few are parked."""
    layout = spec("empresa").file_schema
    folder = fresh_path(t.spark, "zips")
    number = F.col("cnpj_basico").cast("int")
    wide = t.table("empresa_file", layout.fieldNames()).withColumn("extra", F.lit("x"))
    for rest, columns in enumerate((layout.fieldNames()[:-1], layout.fieldNames(), wide.columns)):
        write_zips(
            wide.filter(number % 3 == rest).select(*columns).repartition("cnpj_basico"),
            f"{folder}/{rest}",
        )
    good = bad = None
    for rest in range(3):
        raw = read_zip_csv(t.spark, f"{folder}/{rest}/*.zip", layout)
        kept, parked = split_valid(transform_table(raw, "empresa"), spec("empresa"))
        good = kept if good is None else good.unionByName(kept)
        bad = parked if bad is None else bad.unionByName(parked)
    width = F.filter("errors", lambda e: e.startswith("fields"))
    return good.select("cnpj_basico", F.lit("loaded").alias("fate")).unionByName(
        bad.select(
            F.get_json_object("payload", "$.cnpj_basico").alias("cnpj_basico"),
            F.coalesce(F.try_element_at(width, F.lit(1)), F.lit("parked")).alias("fate"),
        )
    )


@query("load_metrics")
def _(t):
    good, bad = company_split(t)
    return load_metrics(
        {"empresa": good, "estabelecimento_cnae_sec": t.table("estabelecimento_cnae_sec")}, bad
    )


@query("sink_version")
def _(t):
    target, table = f"{fresh_path(t.spark, 'versoes')}/busca", search_table(t)
    sinks.build_version(table.limit(3), target, 3)
    return sinks.build_version(table, target)


@query("sink_build_and_swap")
def _(t):
    target = fresh_path(t.spark, "busca")
    est = t.table("estabelecimento", SEARCH_READS)
    hot = hot_keys(t.table("estabelecimento", ("cnpj_basico",)), "cnpj_basico")
    built = build_search_table(est, t.table("empresa"), hot)
    expected = t.raw("orders", "o_orderkey").count()
    sinks.build_and_swap(built, target, expected)
    return sinks.build_and_swap(built, target, expected)


@query("manifest_diff")
def _(t):
    return files.diff_manifest(t.table("local_files"), t.table("remote_files"))


@query("manifest_periods")
def _(t):
    return files.available_periods(t.table("remote_folders"))


# -- cleaning and scalar functions -----------------------------------------------


def dirty(column: str):
    return F.concat(F.lit("\t\x00 "), F.col(column), F.lit(" \x91 \x85\xa0"))


@query("clean_sanitize")
def _(t):
    return t.raw("documents", "doc_id", "text").select(
        "doc_id", text.sanitize(dirty("text")).alias("text")
    )


@query("clean_all_strings")
def _(t):
    pages = t.raw("pages").select("page_id", dirty("url").alias("url"), dirty("html").alias("html"))
    return text.sanitize_df(pages)


@query("clean_empty_null")
def _(t):
    turns = t.raw("conversations").select(
        "conv_id", "turn", F.when(F.col("turn") % 3 == 0, "").otherwise(F.col("role")).alias("role"),
        F.when(F.col("conv_id") % 2 == 0, "").otherwise(F.col("text")).alias("text"),
    )
    return empty_to_null(turns)


@query("parse_decimal_br")
def _(t):
    rows = t.table("empresa_file", ("cnpj_basico", "capital_social"))
    return rows.select("*", values.parse_decimal_br(F.col("capital_social")).alias("valor"))


@query("parse_date8")
def _(t):
    day = F.col("data_inicio_atividade")
    odd = F.when(F.col("cnpj_ordem").cast("int") % 50 == 49, "abc").otherwise(day)
    rows = t.table("estabelecimento_file").select("cnpj_basico", "cnpj_ordem", odd.alias("texto"))
    return rows.select(
        "*",
        values.parse_date8(F.col("texto")).alias("dia"),
        values.is_unreadable_date(F.col("texto")).alias("ilegivel"),
    )


@query("date_columns_by_table")
def _(t):
    dates = spec("simples").date_columns
    rows = t.table("simples")
    as_text = rows.select(
        "cnpj_basico",
        "opcao_simples",
        "opcao_mei",
        *[F.coalesce(F.date_format(c, "yyyyMMdd"), F.lit("00000000")).alias(c) for c in dates],
    )
    return values.parse_dates(as_text, spec("simples"))


def id_parts():
    return F.col("cnpj_basico"), F.col("cnpj_ordem"), F.col("cnpj_dv")


@query("compose_cnpj")
def _(t):
    rows = t.table("estabelecimento_file", ("cnpj_basico", "cnpj_ordem", "cnpj_dv"))
    return rows.select("*", values.compose_id(*id_parts()).alias("cnpj_completo"))


@query("compose_cnpj_raw")
def _(t):
    rows = t.table("estabelecimento_file", ("cnpj_basico", "cnpj_ordem", "cnpj_dv"))
    return rows.select("*", values.compose_id_raw(*id_parts()).alias("cnpj_completo"))


@query("normalize_name")
def _(t):
    return t.raw("documents", "doc_id", "text").select(
        "doc_id", text.normalize_name(F.col("text")).alias("text_norm")
    )


@query("pad_code")
def _(t):
    return t.table("estabelecimento", ("cnpj_completo", "cod_pais")).select(
        "cnpj_completo", text.pad_code(F.col("cod_pais"), 3, 2).alias("cod_pais")
    )


def search_table(t):
    return build_search_table(t.table("estabelecimento", SEARCH_READS), t.table("empresa"))


@query("row_hash")
def _(t):
    return search_table(t).select("cnpj_completo", "row_hash")


@query("label_codes")
def _(t):
    return t.table("socio").select(
        "cnpj_basico",
        "nome_socio",
        text.label_codes(F.col("identificador_socio"), text.PARTNER_KINDS).alias("tipo_socio"),
    )


@query("period_normalize")
def _(t):
    key, ts = F.col("event_id"), F.col("ts")
    month = F.month(ts).cast("string")
    written = (
        F.when(key % 6 == 0, F.date_format(ts, "MM/yyyy"))
        .when(key % 6 == 1, F.concat(F.lit(" "), month, F.lit("/"), F.date_format(ts, "yyyy ")))
        .when(key % 6 == 2, F.date_format(ts, "yyyy-MM"))
        .when(key % 6 == 3, F.concat(F.date_format(ts, "yyyy-"), month))
        .when(key % 6 == 4, F.date_format(ts, "yyyyMM"))
    )
    return t.raw("events", "event_id", "ts").select(
        "event_id", text.normalize_period(written).alias("periodo")
    )


@query("email_prospect")
def _(t):
    return t.table("estabelecimento", ("cnpj_completo", "email")).select(
        "cnpj_completo", F.coalesce(text.is_prospect_email(F.col("email")), F.lit(False)).alias("ok")
    )


@query("like_prefix")
def _(t):
    return t.raw("pages", "page_id", "url").filter(text.starts_with(F.col("url"), "https://m."))


@query("like_substring")
def _(t):
    return t.raw("documents", "doc_id", "text").select(
        "doc_id",
        text.contains(F.col("text"), "tion").alias("com"),
        text.contains(F.col("text"), "TION", ignore_case=True).alias("com_ilike"),
    )


@query("null_safe_diff")
def _(t):
    rows = t.table("estabelecimento", ("cnpj_completo", "ddd_telefone_1", "ddd_telefone_2"))
    return rows.select(
        "cnpj_completo",
        values.is_distinct(F.col("ddd_telefone_1"), F.col("ddd_telefone_2")).alias("difere"),
    )


@query("ratio_guard")
def _(t):
    forms = view_of(t, "mv_stats_natureza_juridica")
    return forms.select(
        "cod_natureza",
        indicators.ratio_pct(F.col("ativos"), F.col("total")).alias("taxa_atividade"),
    )


@query("least_ignore_null")
def _(t):
    rows = t.table(
        "estabelecimento", ("cnpj_completo", "data_inicio_atividade", "data_situacao_cadastral")
    )
    later = F.when(F.col("cnpj_completo").cast("long") % 2 == 0, F.col("data_inicio_atividade"))
    return rows.select(
        "cnpj_completo",
        values.least_non_null(F.col("data_situacao_cadastral"), later).alias("menor"),
    )


# -- enrichment --------------------------------------------------------------------

_GEO = ("cod_regiao_ibge", "cod_estado_ibge", "cod_cidade_ibge")
_PARTS = ("cnpj_basico", "cnpj_ordem", "cnpj_dv")


def placed(t, guard):
    return add_geo(
        t.table("estabelecimento_file"),
        t.table("ibge_cidade"),
        t.table("ibge_estado"),
        guard_foreign=guard,
    )


@query("geo_lookup")
def _(t):
    return placed(t, False).select(*_PARTS, "cod_municipio", "uf", *_GEO)


@query("geo_foreign_guard")
def _(t):
    return placed(t, True).select(*_PARTS, "cod_pais", *_GEO)


def secondary_rows(t):
    return explode_secondary(
        t.table("estabelecimento_file"), t.table("ibge_cidade"), t.table("ibge_estado")
    )


@query("geo_secondary")
def _(t):
    return secondary_rows(t).groupBy(*_GEO).agg(F.count("*").alias("atividades"))


@query("explode_secondary")
def _(t):
    return secondary_rows(t)


@query("derive_establishment")
def _(t):
    rows = derive_establishment(
        t.table("estabelecimento_file"), t.table("ibge_cidade"), t.table("ibge_estado")
    )
    return rows.select("cnpj_completo", "matriz_filial", "nome_fantasia", "uf", *_GEO)


@query("transform_table")
def _(t):
    rows = transform_table(
        t.table("estabelecimento_file"),
        "estabelecimento",
        t.table("ibge_cidade"),
        t.table("ibge_estado"),
    )
    return rows.select(
        "cnpj_completo",
        "nome_fantasia",
        "cod_pais",
        "data_situacao_cadastral",
        "data_inicio_atividade",
        "logradouro",
        "complemento",
        *_GEO,
        F.size("_rejects").alias("rejeitos"),
    )


@query("geo_dims_rows")
def _(t):
    cities = t.table("ibge_cidade")
    copies = cities.withColumn("nome_cidade", F.concat("nome_cidade", F.lit("_z")))
    blank = cities.withColumns({"cod_cidade_ibge": -F.col("cod_cidade_ibge"),
                                "cod_municipio": F.lit(" ")})
    dims = geo_dimensions(
        t.table("ibge_regiao"),
        t.table("ibge_estado"),
        cities.unionByName(copies).unionByName(blank),
    )
    return dims["ibge_cidade"]


# -- patches -----------------------------------------------------------------------


@query("patch_insert_missing")
def _(t):
    return patches.insert_if_missing(t.table("pais"), patches.MISSING_COUNTRIES, "cod_pais")


@query("patch_pad_country")
def _(t):
    return patches.pad_country(t.table("estabelecimento", ("cnpj_completo", "cod_pais")))


@query("patch_null_zero")
def _(t):
    return patches.null_zero_country(t.table("estabelecimento", ("cnpj_completo", "cod_pais")))


@query("patch_empty_porte")
def _(t):
    key = F.col("cnpj_basico").cast("long")
    size = F.when(key % 10 == 0, "").when(key % 10 != 1, F.col("cod_porte"))
    rows = t.table("empresa", ("cnpj_basico", "cod_porte")).withColumn("cod_porte", size)
    kept, filled = patches.fill_porte(rows), patches.fill_porte(rows, also_null=True)
    return kept.join(filled.withColumnRenamed("cod_porte", "cod_porte_todos"), "cnpj_basico")


@query("patch_absorb_orphans")
def _(t):
    est = patches.null_zero_country(
        patches.pad_country(t.table("estabelecimento", ("cnpj_completo", "cod_pais")))
    )
    return patches.absorb_orphans(
        t.table("pais"), [(est, "cod_pais"), (t.table("socio"), "cod_pais")], "cod_pais", "nome_pais"
    )[0]


@query("patch_dedup_company")
def _(t):
    companies = t.table("empresa")
    key = F.col("cnpj_basico").cast("long")
    unnamed = companies.filter(key % 2 == 0).withColumn("razao_social", F.lit(" "))
    renamed = companies.filter(key % 3 == 0).withColumn(
        "razao_social", F.concat(F.lit("A "), F.col("razao_social"))
    )
    return patches.dedup_company(companies.unionByName(unnamed).unionByName(renamed)).drop(
        "ente_federativo_responsavel"
    )


@query("patch_delete_keys")
def _(t):
    listed = ("00000001", "00000002", "00000012", *patches.ORPHAN_REGIME_ROOTS)
    return patches.drop_keys(t.table("simples"), "cnpj_basico", listed)


@query("patch_all_values")
def _(t):
    names = ("pais", "qualificacao_socio", "motivo", "estabelecimento", "empresa", "simples", "socio")
    patched = patches.apply_patches({n: t.table(n) for n in names})
    est = patched["estabelecimento"].groupBy("cod_pais").agg(F.count("*").alias("n"))
    sizes = patched["empresa"].groupBy("cod_porte").agg(F.count("*").alias("n"))
    known = patched["pais"].select("cod_pais", F.lit(1).cast("bigint").alias("n"))
    rows = [("estabelecimento", est), ("empresa", sizes), ("pais", known)]
    parts = [f.select(F.lit(n).alias("table"), F.col(f.columns[0]).alias("value"), "n") for n, f in rows]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("patch_all")
def _(t):
    names = ("pais", "qualificacao_socio", "motivo", "estabelecimento", "empresa", "simples", "socio")
    patched = patches.apply_patches({n: t.table(n) for n in names})
    return graph.table_stats(FrameSource(patched), names)


# -- quality -----------------------------------------------------------------------


@query("check_not_null")
def _(t):
    return quality.check_not_null(t.table("estabelecimento"), spec("estabelecimento"))


@query("check_unique")
def _(t):
    keys = ("cnpj_basico", "cod_cidade_ibge")
    return quality.check_unique(t.table("estabelecimento", keys), keys)


@query("check_fk")
def _(t):
    return quality.check_fk(t)


@query("check_keys")
def _(t):
    return quality.check_keys(t)


@query("check_fk_report")
def _(t):
    return quality.referential_report(t)


@query("check_length")
def _(t):
    return quality.check_length(t.table("estabelecimento"), spec("estabelecimento"))


@query("check_cnpj_nulls")
def _(t):
    return quality.check_id_nulls(t)


@query("check_cnpj_format")
def _(t):
    return quality.check_id_format(t.table("estabelecimento", ("cnpj_completo",)))


@query("check_cnpj_consistency")
def _(t):
    return quality.check_id_consistency(t.table("estabelecimento", ("cnpj_completo", *_PARTS)))


@query("check_row_floor")
def _(t):
    return quality.check_row_floor(t.table("estabelecimento", ("cnpj_completo",)))


@query("check_views_present")
def _(t):
    target = fresh_path(t.spark, "views")
    graph.build_views(t.spark, graph.establishments_once(t.spark, t), target, floor=FLOOR)
    return quality.check_views({n: t.spark.read.parquet(f"{target}/{n}") for n in VIEWS})


@query("check_count_match")
def _(t):
    return quality.check_count_match(
        search_table(t).select("cnpj_completo"), t.table("estabelecimento", ("cnpj_completo",))
    )


@query("sanity_anchor")
def _(t):
    build = build_of(t)
    names = (
        "mv_stats_estado",
        "mv_abertura_periodo",
        "mv_movimentacao_mensal_cnae",
        "mv_comparativo_territorio",
    )
    return quality.sanity_anchor({n: VIEWS[n].build(build) for n in names})


@query("sanity_12m")
def _(t):
    build = build_of(t)
    return quality.sanity_12m(
        VIEWS["mv_comparativo_territorio"].build(build), VIEWS["mv_stats_estado"].build(build)
    )


@query("sanity_levels")
def _(t):
    return quality.sanity_levels(view_of(t, "mv_comparativo_territorio"))


@query("sanity_closings")
def _(t):
    columns = ("cod_situacao_cadastral", "data_situacao_cadastral")
    return quality.sanity_closings(
        view_of(t, "mv_abertura_periodo"), t.table("estabelecimento", columns), FLOOR
    )


@query("sanity_null_variation")
def _(t):
    return quality.sanity_null_variation(view_of(t, "mv_comparativo_territorio"))


# -- generations -------------------------------------------------------------------


def two_generations(t):
    """The search table as the new generation and an older, different one."""
    now = search_table(t).select("cnpj_completo", "row_hash")
    number = F.col("cnpj_completo").cast("long")
    older = now.filter(number % 50 != 0).withColumn(
        "row_hash", F.when(number % 40 == 1, F.lit("alterado")).otherwise(F.col("row_hash"))
    )
    return now.filter(number % 70 != 3), older


@query("delta_counts")
def _(t):
    return generations.generation_delta(*two_generations(t))


@query("delta_counts_stored")
def _(t):
    root = fresh_path(t.spark, "geracoes")
    for name, frame in zip(("nova", "vigente"), two_generations(t), strict=True):
        digests.write_digested(frame, f"{root}/{name}", "busca_estabelecimento", buckets=16)
    return digests.stored_delta(t.spark, f"{root}/nova", f"{root}/vigente", "busca_estabelecimento")


@query("bucket_digests")
def _(t):
    new, current = (digests.bucket_digests(f, "cnpj_completo", "row_hash", 64) for f in two_generations(t))
    return new.agg(F.sum("linhas").alias("novas_linhas")).crossJoin(
        current.agg(F.sum("linhas").alias("vigentes"))
    ).withColumn("diferem", F.lit(len(digests.differing_buckets(new, current)) > 0))


@query("delta_gate")
def _(t):
    gate = generations.delta_gate(generations.generation_delta(*two_generations(t)))
    return gate.withColumn("delta_pct", F.round("delta_pct", 3).cast("decimal(9,3)"))


def generation_pair(t):
    new, older = two_generations(t)
    est = t.table("estabelecimento", ("cnpj_completo",))
    views = {"mv_stats_cnae_estado": view_of(t, "mv_stats_cnae_estado")}
    return (
        generations.Generation(est, views, new),
        generations.Generation(est, views, older),
    )


@query("validate_generation")
def _(t):
    new, current = generation_pair(t)
    return generations.validation_report(new, current, minimum=1000).drop("value")


@query("publish_generation")
def _(t):
    new, current = generation_pair(t)
    store = generations.GenerationStore(t.spark, fresh_path(t.spark, "geracoes"))
    store.publish("200106", current, minimum=1, skip_validation=True)
    store.publish("200107", new, current, minimum=1)
    served = store.current()
    return store.cycles().select(
        "load_id", "schema_nome", "etapa", "delta_pct", (F.col("schema_nome") == served).alias("vigente")
    )


@query("publish_truncated")
def _(t):
    """Half of the served rows are gone: refused, though nobody names what is served."""
    new, current = generation_pair(t)
    root = fresh_path(t.spark, "geracoes")
    store = generations.GenerationStore(t.spark, root)
    served = generations.generation_name("200106")
    current.search.write.parquet(f"{root}/{served}/{generations.SEARCH_TABLE}")
    store.publish("200106", current, skip_validation=True)
    half = current.search.filter(F.col("cnpj_completo").cast("decimal(14,0)") % 2 == 0)
    cut = generations.Generation(new.establishments, new.views, half)
    try:
        store.publish("200107", cut, minimum=1)
        refused = False
    except generations.CycleAborted:
        refused = True
    return store.cycles().select(
        "load_id",
        "etapa",
        (F.col("schema_nome") == store.current()).alias("vigente"),
        F.col("iniciado_em").isNotNull().alias("iniciado"),
        F.lit(refused).alias("recusado"),
    )


def latest_cycle(t):
    return generations.previous_published(t.table("ciclos"), None).first()["schema_nome"]


@query("rollback_generation")
def _(t):
    cycles = t.table("ciclos")
    store = generations.GenerationStore(t.spark, fresh_path(t.spark, "geracoes"))
    store.adopt(cycles, latest_cycle(t))
    store.rollback()
    served = F.col("schema_nome") == store.current()
    return store.cycles().filter(served).select("schema_nome", "publicado_em")


@query("gc_candidates")
def _(t):
    return generations.retention_candidates(t.table("ciclos"), latest_cycle(t))


@query("cycle_upsert")
def _(t):
    shipped = (
        t.raw("lineitem", "l_shipdate")
        .groupBy(F.date_format("l_shipdate", "yyyyMM").alias("load_id"))
        .agg(F.count("*").alias("linhas_estabelecimento"))
        .select(
            "load_id",
            F.concat(F.lit("dados_"), F.col("load_id")).alias("schema_nome"),
            F.lit("carregado").alias("etapa"),
            "linhas_estabelecimento",
        )
    )
    return generations.upsert_cycle(t.table("ciclos"), shipped).drop("delta_pct", "observacao")


# -- anchor and indicators ---------------------------------------------------------


@query("anchor_month")
def _(t):
    return anchor.anchor_frame(
        t.table("pipeline_stats"), t.table("estabelecimento", ("data_inicio_atividade",))
    )


@query("anchor_windows")
def _(t):
    opened = t.table("estabelecimento", ("data_inicio_atividade",))
    return anchor.anchor_windows(anchor.anchor_frame(t.table("pipeline_stats"), opened))


@query("period_windows")
def _(t):
    return anchor.period_windows(t.spark, graph.anchor_of(t))


def customer_years(t):
    day = F.col("o_orderdate")
    return t.raw("orders", "o_custkey", "o_orderdate", "o_orderstatus").groupBy("o_custkey").agg(
        F.count_if(day >= F.lit("2000-06-01").cast("timestamp_ntz")).alias("atual"),
        F.count_if(day < F.lit("1996-06-01").cast("timestamp_ntz")).alias("anterior"),
        F.count_if(F.col("o_orderstatus") == "O").alias("ativos"),
        F.count_if(F.col("o_orderstatus") != "P").alias("aberturas"),
    )


@query("variation_pct")
def _(t):
    # the factor drives some changes past the limit of the type
    now = F.col("atual") * 12345
    return customer_years(t).select(
        "o_custkey",
        indicators.variation_pct(F.col("atual"), F.col("anterior")).alias("variacao"),
        indicators.variation_pct(now, F.col("anterior")).alias("variacao_grande"),
        indicators.variation_pct(-now, F.col("anterior")).alias("variacao_negativa"),
    )


@query("survival_pct")
def _(t):
    return customer_years(t).select(
        "o_custkey",
        indicators.survival_pct(F.col("ativos"), F.col("aberturas")).alias("sobrevivencia"),
    )


# -- view graph --------------------------------------------------------------------


@query("build_views")
def _(t):
    target = fresh_path(t.spark, "views")
    source = graph.establishments_once(t.spark, t)
    names = graph.build_views(
        t.spark, source, target, only=["05_", "stats_estado", "porte_cidade"], floor=FLOOR
    )
    return graph.table_stats(PathSource(t.spark, target), names)


@query("refresh_views")
def _(t):
    target = fresh_path(t.spark, "views")
    present = ("mv_stats_estado", "mv_abertura_periodo", "mv_comparativo_territorio")
    source = graph.establishments_once(t.spark, t)
    report = graph.refresh_views(t.spark, source, target, present, floor=FLOOR)
    return report.drop("duration_seconds")


def older_tables(t):
    """The generation before: rows not there yet, rows since removed, others unlike."""
    est = t.table("estabelecimento", ("cnpj_completo", *incremental.READS["estabelecimento"]))
    number = F.col("cnpj_completo").cast("long")
    removed = est.filter(number % 70 == 3).withColumn(
        "data_inicio_atividade", F.lit(dt.date(1994, 1, 1))
    )
    unlike = number % 40 == 1
    est = est.filter(number % 50 != 0).withColumns(
        {
            "cod_situacao_cadastral": F.when(unlike, "01").otherwise(F.col("cod_situacao_cadastral")),
            "cod_cnae_principal": F.when(unlike, "0000011").otherwise(F.col("cod_cnae_principal")),
        }
    )
    root = F.col("cnpj_basico").cast("int")
    companies = t.table("empresa", incremental.READS["empresa"]).withColumn(
        "cod_porte", F.when(root % 90 == 0, "05").otherwise(F.col("cod_porte"))
    )
    simples = t.table("simples", incremental.READS["simples"]).filter(root % 80 != 5)
    return OverlaySource(
        t,
        FrameSource({"estabelecimento": est.unionByName(removed), "empresa": companies, "simples": simples}),
    )


def refreshed(t, name: str) -> DataFrame:
    """One view of the tables, merged from that of the generation before."""
    new = graph.establishments_once(t.spark, t, "cnpj_completo")
    old, now = older_tables(new), graph.anchor_of(new)
    stored, target = fresh_path(t.spark, "views"), fresh_path(t.spark, "views")
    only = [graph.file_name(name)]
    incremental.build_first(t.spark, old, stored, only, anchor.month_add(now, -1), FLOOR)
    merged = incremental.refresh_changed(t.spark, old, new, stored, target, only, now, FLOOR)
    if name not in merged:
        raise RuntimeError(f"{name} was built in full")
    return t.spark.read.parquet(f"{target}/{name}")


@query("refresh_changed_territory")
def _(t):
    return refreshed(t, "mv_stats_municipio")


@query("refresh_changed_series")
def _(t):
    return refreshed(t, "mv_abertura_periodo")


@query("refresh_changed_companies")
def _(t):
    return refreshed(t, "mv_regime_tributario_cidade")


@query("refresh_changed_ranking")
def _(t):
    return refreshed(t, "mv_top_cnaes_cidade")


@query("table_stats")
def _(t):
    return graph.table_stats(t, TABLES)


# -- search ------------------------------------------------------------------------


@query("busca_estabelecimento")
def _(t):
    return search_table(t)


@query("search_name_prefix")
def _(t):
    return search.by_name_prefix(search_table(t), "CUSTOMER#0000000", "02").select(
        "cnpj_completo", "razao_social_norm"
    )


@query("search_name_prefix_count")
def _(t):
    return search.count_name_prefix(search_table(t), "CAFE B", "nome_fantasia_norm")


@query("search_name_substring")
def _(t):
    return search.by_name_substring(search_table(t), "RING", "nome_fantasia_norm").select(
        "cnpj_completo", "nome_fantasia_norm"
    )


@query("search_city_activity_page")
def _(t):
    return search.city_activity_page(search_table(t), 100, "0000009", offset=1).select(
        "cnpj_completo", "razao_social_norm"
    )


@query("search_curve_layout")
def _(t):
    path = f"{fresh_path(t.spark, 'curva')}/busca"
    columns = ("cod_cidade_ibge", "cod_cnae_principal", "cod_situacao_cadastral", "data_inicio_atividade")
    layout.write_curve(t.table("estabelecimento", ("cnpj_completo", *columns)), path, columns, files=16)
    return search.search(
        t.spark.read.parquet(path), cnae="0000009", status="02", opened_from=dt.date(1996, 3, 1)
    )


@query("search_stored_page")
def _(t):
    path = f"{fresh_path(t.spark, 'paginas')}/busca"
    columns = ("cnpj_completo", "cod_cidade_ibge", "cod_cnae_principal", "cod_situacao_cadastral")
    active = t.table("estabelecimento", columns).filter("cod_situacao_cadastral = '02'")
    pages.write_pages(active, path, size=1)
    return pages.read_page(t.spark, path, (100, "0000009"), 1)


@query("page_directory")
def _(t):
    path = f"{fresh_path(t.spark, 'paginas')}/busca"
    pages.write_pages(t.table("estabelecimento", ("cnpj_completo", *pages.LISTING)), path, size=5)
    return t.spark.read.parquet(path + pages.DIRECTORY)


@query("name_prefix_counts")
def _(t):
    return pages.prefix_counts(t.table("empresa", ("razao_social",)), "razao_social", crowded=20)


@query("search_keyset_page")
def _(t):
    est = t.table("estabelecimento", ("cnpj_completo", "cod_estado_ibge", "cod_situacao_cadastral"))
    return search.keyset_page(est, "cod_estado_ibge", 3, "00000000000100", "02")


@query("search_area_code")
def _(t):
    return search.by_area_code(search_table(t), "12").select(
        "cnpj_completo", "ddd_telefone_1", "ddd_telefone_2"
    )


@query("search_filters")
def _(t):
    return search.search(
        search_table(t),
        state=5,
        status="02",
        kind="2",
        opened_from=dt.date(1996, 1, 1),
        district="são",
        capital=(0, 8000),
        companies=t.table("empresa", ("cnpj_basico", "capital_social")),
        simples=True,
        regimes=t.table("simples"),
    ).select("cnpj_completo", "cnpj_basico", "data_inicio_atividade")


@query("leads_with_email")
def _(t):
    est = t.table(
        "estabelecimento",
        ("cnpj_completo", "cod_cnae_principal", "cod_cidade_ibge", "cod_situacao_cadastral", "email"),
    )
    by_activity = search.leads(est, cnae="0000009").select(
        F.lit("atividade").alias("lista"), "cnpj_completo"
    )
    by_city = search.leads(est, city=201).select(F.lit("cidade").alias("lista"), "cnpj_completo")
    return by_activity.unionByName(by_city)


@query("sitemap_state_companies")
def _(t):
    columns = ("cnpj_basico", "cnpj_completo", "cod_estado_ibge", "matriz_filial")
    return search.state_head_offices(t.table("estabelecimento", columns), 7)


@query("sitemap_state_activities")
def _(t):
    columns = ("cod_estado_ibge", "cod_cnae_principal")
    return search.state_activities(t.table("estabelecimento", columns), 7, 20)


@query("sitemap_city_activities")
def _(t):
    columns = ("cod_estado_ibge", "cod_cidade_ibge", "cod_cnae_principal")
    return search.city_activities(t.table("estabelecimento", columns), 7)


@query("secondary_activity_filter")
def _(t):
    return search.by_secondary_activity(
        t.table("estabelecimento_cnae_sec"), "0000011", state=4
    )


# -- consumer queries --------------------------------------------------------------

_ID = "00000000000123"
_ROOT = "00000042"


@query("by_full_id")
def _(t):
    columns = ("cnpj_completo", "cnpj_basico", "nome_fantasia", "uf", "cod_cidade_ibge")
    return lookups.by_full_id(
        t.table("estabelecimento", columns), t.table("empresa"), t.table("ibge_cidade"), _ID
    )


@query("by_root")
def _(t):
    columns = ("cnpj_completo", "cnpj_basico", "matriz_filial")
    return lookups.by_root(t.table("estabelecimento", columns), t.table("empresa"), _ROOT)


@query("partners_of")
def _(t):
    return lookups.partners_of(t.table("socio"), t.table("qualificacao_socio"), _ROOT)


@query("per_state")
def _(t):
    columns = ("cod_estado_ibge", "cod_situacao_cadastral")
    return lookups.per_state(t.table("estabelecimento", columns), t.table("ibge_estado"))


@query("companies_by_territory")
def _(t):
    columns = ("cnpj_basico", "cod_regiao_ibge", "cod_estado_ibge")
    return distinct.region_and_state(t.table("estabelecimento", columns))


@query("stats_estado_bitmaps")
def _(t):
    build = build_of(t)
    columns = ("cnpj_basico", "cod_estado_ibge", "cod_situacao_cadastral", "matriz_filial", "data_inicio_atividade")
    return stock.stats_estado(build.est(*columns), build.dim("ibge_estado"), build.anchor, by_bitmaps=True)


@query("per_city_geo")
def _(t):
    columns = ("cod_cidade_ibge", "cod_situacao_cadastral")
    return lookups.per_city_geo(
        t.table("estabelecimento", columns), t.table("ibge_cidade"), t.table("ibge_estado")
    )


@query("per_region")
def _(t):
    columns = ("cod_regiao_ibge", "cnpj_basico", "cod_situacao_cadastral")
    return lookups.per_region(t.table("estabelecimento", columns), t.table("ibge_regiao"))


@query("secondary_of")
def _(t):
    return lookups.secondary_of(t.table("estabelecimento_cnae_sec"), t.table("cnae"), _ID)


@query("activities_in_state")
def _(t):
    columns = ("cod_estado_ibge", "cod_cnae_principal", "cod_situacao_cadastral")
    return lookups.activities_in_state(t.table("estabelecimento", columns), t.table("cnae"), 7)


@query("view_state_rank")
def _(t):
    return lookups.view_state_rank(view_of(t, "mv_stats_estado"))


@query("view_top_cities")
def _(t):
    return lookups.view_top_cities(view_of(t, "mv_stats_municipio"))


@query("view_top_activities")
def _(t):
    return lookups.view_top_activities(view_of(t, "mv_stats_cnae"))


@query("series_state")
def _(t):
    return lookups.series_state(view_of(t, "mv_abertura_periodo"), 7, dt.date(1998, 1, 1))


@query("series_city")
def _(t):
    return lookups.series_city(view_of(t, "mv_abertura_periodo"), 703, dt.date(1998, 1, 1))


@query("ranking_city")
def _(t):
    return lookups.ranking_city(view_of(t, "mv_top_cnaes_cidade"), 301)


_FORM = "BUILDING"


@query("form_rank_states")
def _(t):
    return lookups.form_rank_states(
        view_of(t, "mv_stats_natureza_juridica_estado"), t.table("ibge_estado"), _FORM
    )


@query("form_by_region")
def _(t):
    return lookups.form_by_region(
        view_of(t, "mv_stats_natureza_juridica_estado"), t.table("ibge_regiao"), _FORM
    )


@query("forms_of_state")
def _(t):
    return lookups.forms_of(
        view_of(t, "mv_stats_natureza_juridica_estado"),
        t.table("natureza_juridica"),
        "cod_estado_ibge",
        7,
    )


@query("forms_of_city")
def _(t):
    return lookups.forms_of(
        view_of(t, "mv_stats_natureza_juridica_municipio"),
        t.table("natureza_juridica"),
        "cod_cidade_ibge",
        703,
    )


@query("form_regions_in")
def _(t):
    return lookups.form_regions_in(
        view_of(t, "mv_stats_natureza_juridica_estado"), t.table("ibge_regiao"), _FORM, (3, 4)
    )


@query("top_cities_by_form")
def _(t):
    return lookups.top_cities_by_form(
        view_of(t, "mv_stats_natureza_juridica_municipio"),
        t.table("ibge_cidade"),
        t.table("ibge_estado"),
        _FORM,
    )


@query("capitals_compare")
def _(t):
    return lookups.capitals_compare(
        view_of(t, "mv_stats_natureza_juridica_municipio"),
        t.table("ibge_cidade"),
        t.table("ibge_estado"),
    )


@query("form_search")
def _(t):
    return lookups.form_search(view_of(t, "mv_stats_natureza_juridica"), "mach", "forma b")


@query("form_summary")
def _(t):
    return lookups.form_summary(view_of(t, "mv_stats_natureza_juridica"))


@query("form_top_rate")
def _(t):
    return lookups.form_top_rate(view_of(t, "mv_stats_natureza_juridica"), minimum=10)


@query("comparison_lookup")
def _(t):
    return lookups.comparison_lookup(
        view_of(t, "mv_comparativo_territorio"), "estado", "cod_estado_ibge", 7
    )


@query("activity_growth_rank")
def _(t):
    return lookups.activity_growth_rank(view_of(t, "mv_comparativo_cnae"), "brasil", 12)


# -- run history -------------------------------------------------------------------

_PERIOD = "2001-08"


def plain_runs(t):
    return t.table("pipeline_stats").drop("tables_populated")


@query("run_start")
def _(t):
    runs = plain_runs(t)
    number = F.col("run_id").cast("long")
    known = runs.filter(number % 2 == 0)
    new = runs.select(
        "run_id", F.lit("2001-09").alias("reference_period"), F.col("finished_at").alias("started_at")
    )
    return runs_.start_run(known, new).select("run_id", "reference_period", "status", "started_at")


@query("run_finish")
def _(t):
    runs = plain_runs(t)
    number = F.col("run_id").cast("long")
    done = runs.filter(number % 3 == 0).select(
        "run_id",
        F.timestamp_add("SECOND", F.lit(90), F.col("started_at")).alias("finished_at"),
        F.lit("completed").alias("status"),
        F.when(number % 2 == 0, F.lit(7).cast("bigint")).alias("records_inserted_total"),
    )
    return runs_.finish_run(runs, done).select(
        "run_id", "finished_at", "status", "duration_seconds", "records_inserted_total", "error"
    )


@query("run_mark_refresh")
def _(t):
    when = dt.datetime(2024, 2, 1, 3, 0, 0)
    return runs_.mark_refresh(plain_runs(t), when, _PERIOD).select("run_id", "views_refreshed_at")


@query("run_status")
def _(t):
    """Steps of a run: one event per step, eleven steps dealt out by id."""
    names = F.array(*[F.lit(s) for s in ("download", *runs_.REQUIRED_STEPS)])
    key = F.col("event_id")
    steps = t.raw("events", "event_id", "event_type", "user_id").select(
        F.col("user_id").cast("string").alias("run_id"),
        F.element_at(names, (key % 9 + 1).cast("int")).alias("name"),
        F.when((F.col("event_type") == "error") & (F.col("user_id") % 5 == 0), "failed")
        .when(F.col("event_type") == "signup", "pending")
        .otherwise("success")
        .alias("status"),
    )
    return runs_.run_status(steps)


@query("run_last")
def _(t):
    return runs_.last_run(plain_runs(t))


@query("run_files_of_period")
def _(t):
    return runs_.files_of(plain_runs(t), _PERIOD)


@query("run_monthly_volume")
def _(t):
    return runs_.monthly_volume(plain_runs(t))


@query("run_big_files")
def _(t):
    return runs_.big_files(plain_runs(t))


@query("run_files_summary")
def _(t):
    return runs_.files_summary(plain_runs(t))
