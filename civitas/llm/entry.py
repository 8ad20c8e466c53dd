"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civitas.llm import chat, hard_negatives, license_scan, resampling, warc
from civitas.llm.common import read, stage
from civitas.llm.embeddings import near_vectors
from civitas.llm.order_minhash import near_texts
from civitas.llm.packing import pack
from civitas.llm.substrings import remove_repeats
from civitas.llm.suffix_tree import suffix_tree_scores
from civitas.llm.tiling import contamination
from civitas.llm.toxicity import toxicity
from civitas.llm.wrappers import extract
from civitas.scratch import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(read(spark, sf_dir, "conversations"))


ORACLES["op1_chat_perspectives"] = chat.ORACLE


@query
def op2_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "archives")
    rows = warc.with_originals(read(spark, sf_dir, "pages"))
    manifest = stage(warc.write_archives(rows, folder), "manifest")
    return warc.read_archives(spark, folder).drop("payload", "url").join(
        manifest.select("archive"), "archive", "left_semi"
    ).drop("archive")


ORACLES["op2_warc_zstd"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS size
  FROM pages),
shared AS (
  SELECT payload, max(page_id) AS original FROM payloads WHERE size >= 1000 GROUP BY payload)
SELECT p.page_id, CAST(p.size AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN s.original <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN s.original <> p.page_id THEN s.original END AS refers_to
FROM payloads p LEFT JOIN shared s ON p.size >= 1000 AND s.payload = p.payload
"""


@query
def op3_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op4_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


@query
def op5_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_texts(read(spark, sf_dir, "documents"))


@query
def op7_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op8_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_scores(read(spark, sf_dir, "documents"))


@query
def op9_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).drop("text")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path())


@query
def op11_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_digest(license_scan.scan(read(spark, sf_dir, "documents")))


ORACLES["op11_license_diagonals"] = license_scan.ORACLE


@query
def op12_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"))


ORACLES["op12_strassen_negatives"] = hard_negatives.ORACLE


@query
def op13_importance_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLES["op13_importance_radix"] = resampling.ORACLE
