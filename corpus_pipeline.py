"""Documents to training sequences in five stages.

``run(spark, sf_dir)`` applies ``STAGES`` to the table ``documents``.  Every
stage takes (spark, docs, sf_dir) and works on all that the one before kept;
each result is written to the shared folder and read again, so a lost executor
repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civitas.llm.common import read, stage
from civitas.llm.entry import tokenizer_path
from civitas.llm.order_minhash import near_texts
from civitas.llm.packing import pack
from civitas.llm.substrings import MADE, remove_repeats
from civitas.llm.tiling import contamination
from civitas.llm.toxicity import THRESHOLD, score, train

CATEGORIES = ("quality", "toxic")


def _without(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """The documents whose ids are not listed; the list is written first, so
    that it is broadcast only if it turns out to be small."""
    listed = stage(ids.select(F.col("doc_id").alias("gone")).distinct(), label)
    return docs.join(listed, F.col("doc_id") == F.col("gone"), "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier chain rejects."""
    links = train(docs, read(spark, sf_dir, "labels"), CATEGORIES)
    scored = score(docs, links, CATEGORIES)
    return scored.filter(F.col(f"p_{CATEGORIES[-1]}") < THRESHOLD).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return _without(docs, near_texts(docs).filter("not kept"), "copies")


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out what a document with a smaller id already has."""
    left = remove_repeats(docs).drop(*MADE)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a benchmark item."""
    found = contamination(docs, read(spark, sf_dir, "benchmark"))
    return _without(docs, found.filter("contaminated"), "leaks")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the remaining documents into training sequences."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("order_minhash", near_dedup_stage),
    ("suffix_groups", substring_dedup_stage),
    ("string_tiling", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
